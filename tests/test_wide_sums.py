"""One document with sums beyond every type is rejected by reason; the others go on."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tallywright.plans.catalog import QUERIES
from tallywright.sources.assembly import document_totals

TABLES = "region nation customer supplier part orders"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables, with one order whose lines are far beyond any amount, and one that is nearly."""
    path = tmp_path_factory.mktemp("wide")
    for name in TABLES.split():
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    price = (
        F.when(F.col("l_orderkey") == 8, F.lit(9e15))
        .when((F.col("l_orderkey") == 10) & (F.col("l_linenumber") == 4), F.lit(1e300))
        .otherwise(F.col("l_extendedprice"))
    )
    hot = lines.filter("l_orderkey = 8").limit(1).crossJoin(spark.range(300)).select(lines.columns)
    lines.unionByName(hot).withColumn("l_extendedprice", price).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_other_documents_keep_their_outcome(spark, folder):
    before = {r.source_file: r for r in QUERIES["outcomes"](spark, SF).collect()}
    after = {r.source_file: r for r in QUERIES["outcomes"](spark, folder).collect()}
    changed = {name for name in before if before[name] != after[name]}
    assert before.keys() == after.keys() and changed == {"inv-000000008.pdf", "inv-000000010.pdf"}
    assert {after[name].outcome for name in changed} == {"failed"}
    assert "out of range" in after["inv-000000008.pdf"].reason
    assert after["inv-000000010.pdf"].reason == "Extraction failed: Missing required field(s): total_amount"


def test_assembled_totals_beyond_their_type_are_null(spark):
    rows = [("a", 1e11, 1e11), ("a", 1.0, 1.0), ("b", 2.0, 3.0), ("c", float("nan"), 1.0), ("d", 1e300, 1.0)]
    lines = spark.createDataFrame(rows, "k string, q double, p double")
    found = {r.k: (r.n_items, r.subtotal, r.total_amount) for r in document_totals(lines, "k", "q", "p").collect()}
    assert found["a"] == (2, None, None) and [float(x) for x in found["b"]] == [1, 6, 7.14]
    assert found["c"] == found["d"] == (1, None, None)
