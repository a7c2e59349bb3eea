"""Plan properties that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

from roadlake import schemas

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_write_rebalances_on_partition_columns(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("dt"), "id")
    plan = _plan(df.hint("rebalance", "dt"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_filters_and_projection_reach_the_scan(spark, tmp_dir):
    from roadlake.sinks import write_table
    from roadlake.sources import read_table
    rows = [(1, None, "2025-01-01", 40.0, 30.0, "None", 2.0, "dry"),
            (5, None, "2025-01-02", 41.0, 31.0, "Rain", 3.0, "wet")]
    df = spark.createDataFrame(rows, schemas.RWIS_CLEAN)
    write_table(df, tmp_dir + "/clean", ["dt"])
    q = read_table(spark, tmp_dir + "/clean", schemas.RWIS_CLEAN) \
        .where((F.col("station_id") == 5) & (F.col("dt") == "2025-01-02")) \
        .select("station_id", "air_temp_f")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(station_id), EqualTo(station_id,5)]" in plan
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "ReadSchema: struct<station_id:int,air_temp_f:double>" in plan
    assert [tuple(r) for r in q.collect()] == [(5, 41.0)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")
def test_day_grain_joins_are_broadcast_by_aqe(spark):
    import __spark_entry__ as E
    df = E.queries()["daily_coverage"](spark, SF)
    exec_plan = df._jdf.queryExecution().executedPlan()
    exec_plan.executeCollect()                      # let AQE finalise this plan
    text = exec_plan.toString()
    assert "isFinalPlan=true" in text
    final = text.split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in final


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")
def test_no_python_evaluation_in_any_feed_query(spark):
    from roadlake.plans import queries as feed_queries
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                    "MapInPandas", "PythonUDF")
    for name, fn in feed_queries.queries().items():
        plan = _plan(fn(spark, SF))
        assert not any(n in plan for n in python_nodes), name
