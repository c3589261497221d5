from surgewatch.session import checkpoint_dir, scratch_path


def test_checkpoint_dir_reads_the_configured_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    assert got and spark.sparkContext.getCheckpointDir() is not None
    if configured:
        assert got == configured.rstrip("/")
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(got + "/")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as N

    import pytest
    from surgewatch.session import checkpoint_dir
    conf = N(get=lambda *a: None)
    sc = N(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        checkpoint_dir(N(sparkContext=sc, conf=conf))
