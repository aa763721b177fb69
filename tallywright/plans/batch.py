"""A batch run: triage, map, check, assess, store."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed
from ..operators.crosscheck import clean_parties, cross_check
from ..operators.mapping import (
    extraction_warnings,
    item_facts_in_place,
    map_header,
    read_written_values,
    reject_unmappable,
)
from ..functions.text import fill
from ..operators.outcome import outcomes, reject_taken_numbers, summary
from ..operators.plausibility import assess
from ..operators.retry import retries_of
from ..operators.uniqueness import invoice_key, keys_nearby, mark_winners, number_holders
from ..schema import OUTCOME, STORED_INVOICE
from ..shared import stage, stage_numbered, staging
from ..sources import store
from ..sources.documents import triage_folder
from ..sources.responses import attach_responses, first_document, read_responses


def intake_verdict(triaged: DataFrame, *more: Column) -> DataFrame:
    """Triage result as `source_file, stage, reason`, reason null where the file may go on."""
    return triaged.select(
        "source_file",
        *more,
        F.when(~F.col("is_valid"), "preprocessing").alias("stage"),
        F.when(~F.col("is_valid"), F.col("reason")).alias("reason"),
    )


def judge(
    mapped: DataFrame,
    as_of: Column | None = None,
    threshold: float = fixed.CONFIDENCE_THRESHOLD,
    tolerance: str = fixed.ROUNDING_TOLERANCE,
) -> DataFrame:
    """From header columns and item facts to warnings, reasons, issues and status."""
    return (
        mapped.withColumn("extraction_warnings", extraction_warnings(threshold))
        .transform(reject_unmappable)
        .transform(clean_parties)
        .transform(cross_check, tolerance)
        .transform(assess, as_of, threshold=threshold)
    )


def evaluate(
    documents: DataFrame,
    as_of: Column | None = None,
    threshold: float = fixed.CONFIDENCE_THRESHOLD,
    tolerance: str = fixed.ROUNDING_TOLERANCE,
    read_written: bool = False,
) -> DataFrame:
    """Every rule on documents with `source_file, stage, reason, documents`; no shuffle.

    Items stay inside their document. This alone is the single-document preview: nothing is stored.
    """
    first = first_document(documents)
    if read_written:
        first = read_written_values(first)
    items = F.col("fields.Items")
    mapped = item_facts_in_place(first, items, tolerance).transform(map_header, threshold)
    return judge(mapped, as_of, threshold, tolerance)


def lost_to(holders: DataFrame) -> DataFrame:
    """Outcome rows of stored files that lose their number to a document of this run."""
    number_taken = fill(fixed.STAGE_PREFIX["unexpected"], reason=F.lit(fixed.NUMBER_TAKEN))
    return holders.filter(F.col("holder").isNotNull()).select(
        F.col("holder.holder").alias("source_file"),
        F.lit(fixed.FAILED).alias("outcome"),
        F.lit("unexpected").alias("stage"),
        number_taken.alias("reason"),
        F.lit(0).alias("n_issues"),
        F.col("holder.holder_run").alias("old_run_id"),
        invoice_key(F.col("invoice_number")).alias("invoice_id"),
    )


def commit_run(
    spark: SparkSession,
    evaluated: DataFrame,
    root: str,
    run_id: str,
    items: DataFrame | None = None,
    one_stream: str | None = None,
    replaces: DataFrame | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Decide the numbers and store one run; returns its outcome rows.

    The evaluated documents are written once and read back by column: the number decision then
    touches two narrow columns, and no later step repeats the mapping; they go once the run is stored.
    Nothing is visible before the marker at the end, and repeating the call with the same `run_id` gives the same tables.

    `items` (`source_file` and the stored item columns) are the items of documents that do not carry
    theirs. Numbers of other runs are taken, except that with `one_stream` the runs whose id starts
    with it are parts of one: among them the first file in name order keeps a number, whenever it
    comes. `replaces` (`run_id, source_file, attempts`) names earlier rejects this run decides anew.
    """
    with staging(spark):
        columns = [n for n in STORED_INVOICE.names if n in evaluated.columns]
        staged = stage_numbered(evaluated.select(*columns, "stage", "reason"), f"evaluated-{run_id}")
        open_cases = staged.filter(F.col("reason").isNull())
        keys = store.read_keys(spark, root, run_id, lambda part: keys_nearby(part, open_cases))
        may_lose = F.col("run_id").startswith(one_stream) if one_stream else F.lit(False)
        stored = keys.select(
            "invoice_number",
            F.when(may_lose, F.col("source_file")).alias("holder"),
            F.when(may_lose, F.col("run_id")).alias("holder_run"),
        )
        holders = stage(number_holders(staged, stored), f"numbers-{run_id}")
        decided = reject_taken_numbers(mark_winners(staged, holders))

        attempt = store.new_attempt()
        put = (root, run_id, attempt)
        metrics = store.write_invoices(decided.filter(F.col("reason").isNull()), *put)
        if items is not None:
            store.write(items.select(store.ITEM_ROW.names), root, store.ITEM_ROWS, run_id, attempt)
        losers = lost_to(holders)
        both = outcomes(decided).unionByName(losers.select(OUTCOME.names))
        metrics |= store.write_outcomes(both, *put)
        gone = losers.select(store.REPLACED.names)
        if replaces is not None:
            none = F.lit(None).cast("string").alias("invoice_id")
            gone = gone.unionByName(replaces.select(F.col("run_id").alias("old_run_id"), "source_file", none))
        store.write(gone, root, store.SUPERSEDED, run_id, attempt)
        written = spark.read.schema(OUTCOME).parquet(f"{root}/{store.OUTCOMES}/run_id={run_id}/attempt={attempt}")
        store.write(retries_of(written, replaces, now), root, store.RETRIES, run_id, attempt)
        store.commit(spark, root, run_id, store.RUN, attempt, metrics)
    return store.read_outcomes(spark, root).filter(F.col("run_id") == run_id)


def run_batch(
    spark: SparkSession,
    documents_folder: str,
    responses_folder: str,
    pages: DataFrame,
    root: str,
    run_id: str,
    as_of: Column | None = None,
    read_written: bool = False,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """The whole run over a folder, or over the names of a manifest; returns the summary row."""
    listed = intake_verdict(triage_folder(spark, documents_folder, pages, manifest))
    answered = attach_responses(listed, read_responses(spark, responses_folder))
    evaluated = evaluate(answered, as_of, read_written=read_written)
    decided = commit_run(spark, evaluated, root, run_id)
    store.derive_line_items(spark, root)
    return summary(decided)
