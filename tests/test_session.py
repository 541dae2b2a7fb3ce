"""Session helpers: lineage staging and its cleanup, scratch folders."""

import os

from telemetra import session


def test_materialize_cuts_lineage_and_release_deletes(spark):
    df = spark.range(1000).selectExpr("id", "id * 2 AS x")
    staged = session.materialize(df, "t-stage")
    path = staged._stage_path
    assert path.startswith(session.checkpoint_root(spark).rstrip("/"))
    assert staged.count() == 1000 and "Scan parquet" in staged._jdf.queryExecution().executedPlan().toString()
    session.release(staged)
    assert not os.path.exists(session.local_path(path))


def test_scratch_dirs_are_fresh_and_under_checkpoint_root(spark):
    a, b = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert a != b and a.startswith(session.checkpoint_root(spark).rstrip("/"))
