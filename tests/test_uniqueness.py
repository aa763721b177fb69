"""First file per number, with one number on a third of all files."""

import pytest
from pyspark.sql import functions as F

from tallywright.operators.uniqueness import key_bucket, keys_nearby, mark_first


def documents(spark):
    key = F.col("id")
    return spark.range(900).select(
        F.format_string("f-%04d.pdf", key * 7 % 900).alias("source_file"),
        F.when(key % 3 == 0, "HOT").otherwise(F.concat(F.lit("N"), key % 200)).alias("invoice_number"),
        F.when(key % 10 == 9, "no").alias("reason"),
        F.lit(None).cast("string").alias("stage"),
    )


def test_first_in_name_order_wins(spark):
    rows = documents(spark).collect()
    best = {}
    for row in rows:
        if row.reason is None:
            best[row.invoice_number] = min(best.get(row.invoice_number, "~"), row.source_file)
    marked = mark_first(documents(spark)).collect()
    assert len(marked) == len(rows)
    for row in marked:
        assert row.is_first == (row.reason is None and best[row.invoice_number] == row.source_file)


def test_stored_numbers_win_over_arrivals(spark):
    stored = spark.createDataFrame([("HOT",), ("N1",), ("N1",)], "invoice_number string")
    marked = mark_first(documents(spark), stored)
    first = {r.invoice_number for r in marked.filter("is_first").collect()}
    assert "HOT" not in first and "N1" not in first and "N2" in first


def test_number_is_reduced_before_it_is_shuffled(spark):
    plan = mark_first(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_one_file_name_twice_stores_one_invoice(spark):
    df = spark.createDataFrame(
        [("a.pdf", "N-1", None), ("a.pdf", "N-1", None), ("b.pdf", "N-1", None)],
        "source_file string, invoice_number string, reason string",
    )
    assert [r.source_file for r in mark_first(df).filter("is_first").collect()] == ["a.pdf"]


def test_other_splits_between_two_reads_change_nothing(spark, tmp_path):
    """Rows compete by the numbers written with them: every number has one winner, however it is read."""
    path, setting = str(tmp_path / "documents"), "spark.sql.files.minPartitionNum"
    documents(spark).withColumn("source_file", F.lit("same.pdf")).repartition(6).write.parquet(path)
    for first, second in ((2, 8), (8, 2), (1, 40)):
        try:
            spark.conf.set(setting, first)
            marked = mark_first(spark.read.parquet(path))
            spark.conf.set(setting, second)
            won = [r.invoice_number for r in marked.filter("is_first").collect()]
        finally:
            spark.conf.unset(setting)
        assert len(won) == len(set(won)) == documents(spark).filter("reason IS NULL").select("invoice_number").distinct().count()


def test_later_file_takes_a_number_over_only_where_it_may(spark):
    stored = spark.createDataFrame(
        [("HOT", "f-0500.pdf", "r"), ("N1", "a", "r"), ("N2", "f-9999.pdf", "r"), ("N4", "f-9999.pdf", "r"), ("N4", None, None)],
        "invoice_number string, holder string, holder_run string",
    )
    rows = mark_first(documents(spark), stored).filter("is_first").collect()
    won = {r.invoice_number: r.source_file for r in rows}
    assert won["HOT"] == "f-0000.pdf" and "N2" in won and "N1" not in won and "N4" not in won


def test_only_the_buckets_of_a_run_are_read(spark, tmp_path):
    path = str(tmp_path / "keys")
    number = F.concat(F.lit("N"), F.col("id"))
    keys = spark.range(4000).select(number.alias("invoice_number"), key_bucket(number).alias("bucket"))
    keys.repartition("bucket").write.partitionBy("bucket").parquet(path)
    run = spark.createDataFrame([("N7",), ("N8",), ("new",), (None,)], "invoice_number string")
    near = keys_nearby(spark.read.parquet(path), run)
    assert {"N7", "N8"} <= {r.invoice_number for r in near.collect()} and near.count() < 100
    plan = near._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    assert near.select(F.input_file_name()).distinct().count() <= 3
