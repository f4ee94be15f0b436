"""Session helpers: the settings the operators assume, and reliable materialisation."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session should carry. AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "peerscope", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    Used by tests, the bench and the local entry point.  On a cluster the
    submitter normally owns the session; the operators only need
    ``ensure_checkpoint_dir`` to have a reliable folder.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("PEERSCOPE_DRIVER_MEMORY", "16g")
    log_dir = os.environ.get("PEERSCOPE_EVENT_LOG_DIR")
    if log_dir:   # stage and task times without the web UI
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = log_dir
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from ``spark.checkpoint.dir``.

    A cluster must name a shared folder in ``spark.checkpoint.dir``.  Only a
    local-mode session without that setting (tests, laptop runs) gets a
    private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
                "so that materialised intermediates survive executor loss")
        configured = tempfile.mkdtemp(prefix="peerscope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once as Parquet under the reliable checkpoint folder and
    return a frame reading the stored copy.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    upstream plan), pins values that are not stable under recomputation
    (partition ids after a range repartition), and gives later readers
    column pruning and predicate pushdown.  Unlike an eager RDD checkpoint
    the plan runs once.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/peerscope/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    written(spark, path)
    return spark.read.parquet(path)


_WRITTEN: dict[str, list[str]] = {}


def written(spark: SparkSession, path: str) -> None:
    """Notes a folder of this application for ``drop_intermediates``."""
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)


def drop_intermediates(spark: SparkSession) -> int:
    """Delete what ``materialize`` has written in this application (call it when the results that read
    these files are written or collected); returns the number of folders."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(hadoop).delete(path, True)
    return len(paths)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``peerscope`` importable in Python workers (what ``--py-files`` does):
    the package is zipped once per application and added with ``addPyFile``.
    Needed before any pandas UDF whose code refers to library functions."""
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        import peerscope
        root = os.path.dirname(os.path.abspath(peerscope.__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="peerscope-pyfiles-"), "peerscope.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(out)
        _SHIPPED.add(sc.applicationId)
