from martlet.session import build_session, ensure_checkpoint_dir, shared_dir


def test_shared_dir_is_under_the_session_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    assert base and ensure_checkpoint_dir(spark) == base
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/martlet/x-")


def test_build_session_reuses_the_active_session(spark):
    assert build_session(app_name="again") is spark


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from martlet.session import ensure_checkpoint_dir

    def session(conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: conf.get(k, default)),
                               sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session({"spark.master": master}))
    assert ensure_checkpoint_dir(session({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"
    assert ensure_checkpoint_dir(session({"spark.master": "local[4]"}))


def test_scratch_is_deleted_but_for_what_is_kept(spark):
    import os

    from martlet.session import scratch, stage
    there = lambda df: os.path.exists(df._martlet_staged.removeprefix("file:"))
    with scratch(spark) as kept:
        one, two = stage(spark.range(3), "a"), stage(spark.range(4), "b")
        kept.append(two)
        with scratch(spark) as inner:
            three, four = stage(spark.range(5), "c"), stage(spark.range(6), "d")
            inner.append(four)
        assert there(one) and not there(three) and there(four)
    assert not there(one) and not there(four) and there(two) and two.count() == 4
