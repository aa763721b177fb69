"""Positions and running totals inside groups: any slices give what one window gives."""

import pytest
from pyspark.sql import Window, functions as F

from tallywright.operators.numbering import number_within, running_within
from tallywright.plans import tables

SF = "/root/testdata/sf0.001"


def numbered(df, **options):
    rows = number_within(df, "k", ["a", "b"], **options).collect()
    return sorted((row.k, row.a, row.b, row.position) for row in rows)


def table(spark):
    # One key holds a third of the rows.
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7919 % 10).alias("a"),
        F.col("id").alias("b"),
    )


@pytest.mark.parametrize("slice_rows", [1 << 20, 300, 10, 1])
def test_slices_are_numbered_like_one_window(spark, slice_rows):
    """With one row per slice the hot group has a thousand cuts, more than are searched one by one."""
    df = table(spark)
    window = Window.partitionBy("k").orderBy("a", "b")
    expected = sorted(tuple(row) for row in df.withColumn("p", F.row_number().over(window)).collect())
    assert numbered(df, slice_rows=slice_rows) == expected


@pytest.mark.parametrize("slice_rows", [1 << 20, 50, 1])
def test_running_totals(spark, slice_rows):
    df = table(spark).withColumn("v", F.when(F.col("b") % 11 > 0, F.col("b")))
    window = Window.partitionBy("k").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("before", F.coalesce(F.sum("v").over(window), F.lit(0)))
    found = running_within(df, "k", ["a", "b"], {"before": F.col("v")}, slice_rows=slice_rows)
    columns = ["k", "a", "b", "before"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_equal_rows_and_nulls(spark):
    rows = [(1, None), (1, 2), (1, 2), (1, 2), (1, 5), (None, 3), (None, 3), (2, None)]
    df = spark.createDataFrame(rows, "k long, a long")
    for slice_rows in (1 << 20, 1):
        found = number_within(df, "k", ["a"], slice_rows=slice_rows).collect()
        got = {}
        for row in found:
            got.setdefault(row.k, []).append((row.position, row.a))
        assert {k: sorted(v) for k, v in got.items()} == {
            1: [(1, None), (2, 2), (3, 2), (4, 2), (5, 5)],
            None: [(1, 3), (2, 3)],
            2: [(1, None)],
        }


def test_large_group_is_spread_over_tasks(spark):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # the table is tiny; keep its partitions apart
    try:
        result = number_within(table(spark).filter("k = 7"), "k", ["a", "b"], slice_rows=50)
        sizes = [r["count"] for r in result.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(setting)
    assert len(sizes) > 4 and max(sizes) < 0.6 * sum(sizes)


def test_building_the_plan_runs_no_job_and_numbers_once(spark):
    spark.sparkContext.setJobGroup("numbering", "building")
    try:
        df = tables.numbered_lines(spark, SF)
        # A table's schema is read once by a job of its own; numbering adds none.
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("numbering"))
        number_within(df.drop("position"), "order_key", tables.LINE_ORDER)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("numbering")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "p_retailprice" not in plan and "InMemoryRelation" not in plan and "ExistingRDD" not in plan
