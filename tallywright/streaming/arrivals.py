"""Documents handled as they arrive."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from .. import fixed
from ..functions.text import fill
from ..operators.intake import byte_facts, file_name, suffix
from ..operators.retry import due
from ..plans.batch import commit_run, evaluate, intake_verdict
from ..schema import FILE, RESPONSE
from ..shared import setting
from ..sources import store
from ..sources.documents import PATTERN, triage_listed
from ..sources.responses import JSON_OPTIONS, attach_responses, named_after_file

# How long a file waits for its response, and how far events may be out of order.
PATIENCE = "1 hour"
DELAY = "10 minutes"

STREAM = "arrivals"

# What the files and responses that wait are compressed with.
STATE_CODEC_SETTING = "spark.sql.streaming.stateStore.compression.codec"


def arriving_files(
    spark: SparkSession, folder: str, pages: DataFrame, files_per_batch: int | None = None
) -> DataFrame:
    """New document files as a stream of triage verdicts: `source_file, stage, reason, file_time`.

    `pages` is a table (see `page_facts`), read anew for every micro-batch.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", PATTERN)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(folder)
    facts = byte_facts(files, "modificationTime").withColumns(
        {"source_file": file_name(F.col("path")), "on_disk": F.lit(True)}
    )
    triaged = triage_listed(facts, pages)
    return intake_verdict(triaged, F.col("modificationTime").alias("file_time"))


def arriving_responses(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """New JSON responses in `folder` as a stream of documents, with `response_time`."""
    reader = spark.readStream.schema(RESPONSE).options(**JSON_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return named_after_file(reader.json(folder), F.col("_metadata.file_modification_time").alias("response_time"))


def joined_arrivals(
    files: DataFrame, responses: DataFrame, patience: str = PATIENCE, delay: str = DELAY
) -> DataFrame:
    """Each arriving file with its response, or without one when its time is over.

    `files` has `source_file, stage, reason, file_time`, `responses` `source_file, response_time` and
    what the analysis said. Both are streams with watermarks: a file and its response may come in
    either order within `patience`; a file whose response has not come when the watermark passes the
    end of its wait comes out without it and is rejected by name. State holds what still waits.
    """
    answers = responses.withColumnRenamed("source_file", "_answered").withColumn("has_response", F.lit(True))
    same = F.col("source_file") == F.col("_answered")
    within = F.col("response_time").between(
        F.col("file_time") - F.expr(f"INTERVAL {patience}"), F.col("file_time") + F.expr(f"INTERVAL {patience}")
    )
    return (
        files.withWatermark("file_time", delay)
        .join(answers.withWatermark("response_time", delay), same & within, "left_outer")
        .drop("_answered", "response_time", "file_time")
    )


def name_verdict(arrived: DataFrame) -> DataFrame:
    """The one intake check that needs no file: its name."""
    ending = suffix(file_name(F.col("source_file")))
    wrong = F.lower(ending) != ".pdf"
    return arrived.withColumns(
        {
            "stage": F.when(wrong, "preprocessing"),
            "reason": F.when(wrong, fill(fixed.WRONG_EXTENSION, suffix=ending)),
        }
    )


def store_arrivals(
    arrived: DataFrame,
    root: str,
    checkpoint: str,
    as_of: Column | None = None,
    read_written: bool = False,
    judged: Callable[[DataFrame], DataFrame] | None = None,
    items: Callable[[DataFrame], DataFrame] | None = None,
    **trigger,
) -> StreamingQuery:
    """Run every arriving document through the batch steps and store it.

    `arrived` is a stream of responses, or of files joined with them (`joined_arrivals`). Each
    micro-batch is one run named after its batch number; together they are one stream, in which the
    first file in name order keeps a number even if it arrives last, so any split into micro-batches
    ends up as one batch would. Spark repeats a failed batch with the same number and the same files;
    its commit replaces that of the first attempt. `judged` and `items` stand in for the steps on
    recorded responses where documents come in another form.
    """

    def store_batch(batch: DataFrame, number: int) -> None:
        spark, run_id = batch.sparkSession, f"{STREAM}-{number:012d}"
        evaluated = judged(batch) if judged else evaluate(batch, as_of, read_written=read_written)
        own = items(batch) if items else None
        commit_run(spark, evaluated, root, run_id, own, one_stream=f"{STREAM}-")
        store.derive_line_items(spark, root)

    named = arrived if "reason" in arrived.columns else name_verdict(arrived)
    writer = (
        named.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    # A stream keeps the codec it was started with, also when it is started again.
    with setting(arrived.sparkSession, STATE_CODEC_SETTING, "zstd"):
        return writer.start()


def retry_rejects(
    spark: SparkSession,
    responses: DataFrame | None,
    root: str,
    run_id: str,
    as_of: Column | None = None,
    now: Column | None = None,
    read_written: bool = False,
    judged: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Another attempt for the rejects whose time has come; returns their new outcome rows.

    `responses` is the table of all recorded responses. The new outcome takes the place of the old
    one; a file that fails again waits twice as long, until its attempts are used up. A file that got
    its invoice waits no more, so calling this again changes nothing. Give a `run_id` that starts like
    those of the stream (`arrivals-`) if the files came by it. `judged` stands in for the steps on
    recorded responses, as in `store_arrivals`.
    """
    again = due(store.read_retries(spark, root, without=run_id), now)
    none = F.lit(None).cast("string")
    waiting = again.select("source_file", none.alias("stage"), none.alias("reason"))
    if judged:
        evaluated = judged(waiting)
    else:
        evaluated = evaluate(attach_responses(waiting, responses), as_of, read_written=read_written)
    prefix = f"{STREAM}-"
    one_stream = prefix if run_id.startswith(prefix) else None
    decided = commit_run(spark, evaluated, root, run_id, one_stream=one_stream, replaces=again, now=now)
    store.derive_line_items(spark, root)
    return decided
