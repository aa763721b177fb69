"""What a run leaves on disk, and how it is written."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallywright import shared
from tallywright.operators.mapping import fields_read, map_header
from tallywright.plans import tables
from tallywright.plans.batch import commit_run
from tallywright.plans.catalog import QUERIES
from tallywright.shared import CLEANUP_SETTING, scratch_folder, stage, staging
from tallywright.sources.store import derive_line_items, read_outcomes
from tallywright.streaming import arrivals

from conftest import SF


@pytest.fixture(autouse=True)
def own_folder(monkeypatch, tmp_path):
    """The shared folder may be that of other sessions, too."""
    monkeypatch.setattr(shared, "shared_folder", lambda spark: str(tmp_path))


def scratch(spark):
    return {p.name for p in Path(shared.shared_folder(spark)).iterdir()}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(at).getName() for at in range(files.size())}
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def written_small(root):
    files = [p.name for p in Path(root).rglob("*.parquet") if p.is_file()]
    return bool(files) and all(".zstd" in name for name in files)


def documents(spark):
    rows = [(f"f{at}.pdf", f"N{at % 7}", None, None) for at in range(20)]
    kinds = "source_file string, invoice_number string, stage string, reason string"
    made = spark.createDataFrame(rows, kinds)
    empty = {n: F.array().cast("array<string>") for n in ("extraction_warnings", "validation_issues")}
    null = {n: F.lit(None).cast("string") for n in "vendor_name vendor_address vendor_tax_id vendor_iban customer_name customer_address".split()}
    days = {n: F.lit(None).cast("date") for n in ("invoice_date", "due_date")}
    sums = {n: F.lit(None).cast("decimal(18,6)") for n in ("subtotal", "vat_amount", "total_amount")}
    rest = {"vat_rate": F.lit(None).cast("double"), "confidence_score": F.lit(0.9), "validation_status": F.lit("valid")}
    return made.withColumns(empty | null | days | sums | rest)


def test_a_run_leaves_its_store_alone(spark):
    root = f"{scratch_folder(spark, 'disk')}/store"
    evaluated, before = documents(spark), scratch(spark)
    decided = commit_run(spark, evaluated, root, "one")
    derive_line_items(spark, root)
    assert scratch(spark) - before <= {Path(root).parent.name}
    assert decided.count() == read_outcomes(spark, root).count() == 20
    assert all(written_small(f"{root}/{name}") for name in ("invoices_nested", "outcomes", "keys"))


@pytest.mark.parametrize("name", ["write_audit", "stored_items", "retried_rejects", "arrival_stream"])
def test_queries_of_the_store_leave_their_store_alone(spark, name):
    before = scratch(spark)
    rows = QUERIES[name](spark, SF)
    left = {n.rsplit("-", 1)[0] for n in scratch(spark) - before}
    assert left <= {"runs", "retries", "arrivals"}
    assert rows.count() > 0


def test_a_staged_table_goes_with_its_scope(spark):
    with staging(spark):
        outer = stage(spark.range(5), "outer")
        with staging(spark):
            inner = stage(outer, "inner").inputFiles()[0]
            assert inner.endswith(".zstd.parquet")
        assert outer.count() == 5 and not Path(inner.removeprefix("file:")).exists()
        kept = Path(outer.inputFiles()[0].removeprefix("file:"))
    assert not kept.exists()
    alone = stage(spark.range(3), "alone")
    assert alone.count() == 3


def test_a_write_leaves_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(CLEANUP_SETTING, None)
    dealt = spark.range(100_000).withColumn("n", F.xxhash64("id") % 1000).groupBy("n").agg(F.collect_list("id"))
    assert stage(dealt, "dealt").count() <= 1999
    assert spark.conf.get(CLEANUP_SETTING, None) == was

    def left():
        return {name.split("_")[1] for name in shuffle_files(spark) - before}

    # They go in the background; the count after the write has a shuffle of its own.
    until = time.time() + 30
    while len(left()) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(left()) <= 1


def test_read_fields_are_what_the_mapping_reads(spark):
    recorded = tables.header_documents(spark, SF, customers=True)
    some = recorded.withColumn("fields", F.when(F.col("order_key") % 5 != 0, F.col("fields")))
    columns = [n for n in map_header(some).columns if n not in recorded.columns]
    whole = map_header(some).select("source_file", *columns)
    read = map_header(some.withColumn("fields", fields_read())).select("source_file", *columns)
    assert whole.exceptAll(read).isEmpty() and read.exceptAll(whole).isEmpty()


def test_waiting_rows_are_compressed_well(spark):
    class Writer:
        def __getattr__(self, _):
            return lambda *_, **__: self

        def start(self):
            return spark.conf.get(arrivals.STATE_CODEC_SETTING)

    class Stream:
        columns, sparkSession, writeStream = ["reason"], spark, Writer()

    before = spark.conf.get(arrivals.STATE_CODEC_SETTING)
    assert arrivals.store_arrivals(Stream(), "root", "checkpoint") == "zstd"
    assert spark.conf.get(arrivals.STATE_CODEC_SETTING) == before
