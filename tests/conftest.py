import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from peerscope.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[4]").appName("peerscope-tests")
         .config("spark.sql.shuffle.partitions", "4"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    # tests own their session: a private checkpoint folder is set only here
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="peerscope-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
