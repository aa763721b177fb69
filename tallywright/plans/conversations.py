"""Document files made from the conversation table: one file per conversation, one page per turn.

The rules are written down in FIXTURES.md.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import padded
from ..operators.intake import SIGNATURE, unopenable_detail
from ..sources.documents import triage_manifest

# Names that are expected but have no page at all.
EXTRA_FILES = 20


def _every(n: int) -> Column:
    return F.col("conv_id") % n == 0


def _source_file() -> Column:
    ending = F.when(_every(11), ".TXT").when(_every(10), ".PDF").otherwise(".pdf")
    return F.concat(F.lit("conv-"), padded(F.col("conv_id")), ending)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select(
        _source_file().alias("source_file"),
        F.col("turn").alias("page_no"),
        F.when(_every(7), "   ").otherwise(F.col("text")).alias("text"),
        _every(17).alias("is_encrypted"),
    )


def expected_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id")
    last = F.max("conv_id")
    extra = ids.agg(F.sequence(last + 1, last + EXTRA_FILES).alias("ids")).select(
        F.explode("ids").alias("conv_id")
    )
    return ids.distinct().unionByName(extra)


def triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = expected_ids(spark, sf_dir)
    length = F.when(_every(19), 0).otherwise(4096)
    head = F.encode(F.lit(f"{SIGNATURE}1.7"), "ISO-8859-1")
    files = ids.filter(~_every(13)).select(
        _source_file().alias("source_file"),
        unopenable_detail(length, head).alias("open_error"),
        _every(17).alias("is_encrypted"),
    )
    manifest = ids.select(_source_file().alias("source_file"))
    return triage_manifest(manifest, files, pages(spark, sf_dir))
