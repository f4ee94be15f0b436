from peerscope.session import ensure_checkpoint_dir, materialize


def test_materialize_writes_under_session_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert base.startswith(configured.rstrip("/")) or base.startswith("file:" + configured.rstrip("/"))
    df = materialize(spark.range(10).selectExpr("id", "id * 2 AS twice"), "unit")
    assert df.count() == 10
    files = df.inputFiles()
    assert files and all("/peerscope/unit-" in f for f in files)
    assert all(base.replace("file:", "") in f for f in files)


def test_drop_intermediates_deletes_what_was_written(spark, monkeypatch):
    import os

    from peerscope import session as S
    monkeypatch.setattr(S, "_WRITTEN", {})      # leave the other tests' files alone
    files = [f.replace("file://", "") for f in materialize(spark.range(5), "gone").inputFiles()]
    assert files and all(os.path.exists(f) for f in files)
    assert S.drop_intermediates(spark) == 1 and not any(os.path.exists(f) for f in files)
    assert S.drop_intermediates(spark) == 0
