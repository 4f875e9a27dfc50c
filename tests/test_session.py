import pytest

from termloom import session


def test_scratch_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get(session.CHECKPOINT_DIR, None)
    if named is not None:
        assert session.scratch_root(spark) == named.rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_own_scratch_folder_only_for_local_sessions(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.termloom.unset")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    root = session.scratch_root(spark)
    assert root == session.scratch_root(spark) and "termloom-" in root
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    with pytest.raises(RuntimeError, match="must name a folder"):
        session.scratch_root(spark)


def test_materialized_table_keeps_rows_and_schema(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 'a', 0.5D), (2L, NULL, 1.5D) AS t(i, s, d)")
    stored = session.materialize(df, "t")
    assert stored.exceptAll(df).count() == 0 and stored.count() == 2
    assert stored.dtypes == df.dtypes
    assert "LocalTableScan" not in stored._jdf.queryExecution().executedPlan().toString()
