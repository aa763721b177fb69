"""Listing of document files (S1) and their joined triage facts."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.intake import EMPTY_FILE, byte_facts, file_name, oversized_facts, page_facts, triage

# Fixed value: the listing takes this pattern as written, lower case, one folder deep.
PATTERN = "*.pdf"

# Spark ends a job that reads the content of a longer file.
LENGTH_SETTING, LENGTH_DEFAULT = "spark.sql.sources.binaryFile.maxLength", 2**31 - 1


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """`binaryFile` rows; `content` is read only by steps that select it.

    Spark leaves files of zero bytes out of every listing. A manifest (see `triage_folder`) brings
    them back, so that they are rejected by name and not overlooked.
    """
    return spark.read.format("binaryFile").option("pathGlobFilter", PATTERN).load(folder)


def triage_folder(
    spark: SparkSession, folder: str, pages: DataFrame, manifest: DataFrame | None = None
) -> DataFrame:
    """Every listed file with its first failure reason. `pages`: see `page_facts`.

    With a `manifest` (`source_file, length`, such as a storage inventory) its names are the files
    of the run instead: those not on disk fail as missing, those of length zero as empty. A file
    longer than Spark may read is rejected from the listing, its content unread.
    """
    limit = int(spark.conf.get(LENGTH_SETTING, str(LENGTH_DEFAULT)))
    listed = list_documents(spark, folder)
    readable = byte_facts(listed.filter(F.col("length") <= limit))
    facts = readable.unionByName(oversized_facts(listed.filter(F.col("length") > limit), limit))
    files = facts.withColumn("source_file", file_name(F.col("path")))
    if manifest is None:
        return triage_listed(files.withColumn("on_disk", F.lit(True)), pages)
    return triage_manifest(manifest, files.drop("length"), pages)


def triage_manifest(manifest: DataFrame, files: DataFrame, pages: DataFrame) -> DataFrame:
    """For expected names that may be absent (T1). `files` as from `byte_facts`."""
    facts = files.select("source_file", "open_error", "is_encrypted").withColumn(
        "listed", F.lit(True)
    )
    listed = F.coalesce("listed", F.lit(False))
    is_empty = F.col("length") == 0 if "length" in manifest.columns else F.lit(False)
    expected = manifest.join(facts, "source_file", "left").withColumns(
        {
            "on_disk": listed | F.coalesce(is_empty, F.lit(False)),
            "open_error": F.when(~listed & is_empty, EMPTY_FILE).otherwise(F.col("open_error")),
        }
    )
    return triage_listed(expected.drop("listed"), pages)


def triage_listed(files: DataFrame, pages: DataFrame) -> DataFrame:
    counted = page_facts(pages).withColumnRenamed("is_encrypted", "page_encrypted")
    encrypted = F.coalesce("is_encrypted", F.lit(False)) | F.coalesce("page_encrypted", F.lit(False))
    joined = files.join(counted, "source_file", "left").withColumn("is_encrypted", encrypted)
    return triage(joined.drop("page_encrypted"))
