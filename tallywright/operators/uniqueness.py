"""One stored invoice per invoice number."""

from pyspark.sql import Column, DataFrame, functions as F

from ..shared import ROW, stage_numbered

# Buckets of the key store; a lookup sends at most so many rows to every task.
KEY_BUCKETS = 256


def invoice_key(number: Column) -> Column:
    """Stable id from the number itself: no counter, no global order."""
    return F.sha2(number, 256)


def key_bucket(number: Column) -> Column:
    """Where the key store keeps a number."""
    return F.pmod(F.xxhash64(number), F.lit(KEY_BUCKETS)).cast("int")


def keys_nearby(keys: DataFrame, candidates: DataFrame) -> DataFrame:
    """`keys` (with `bucket`) from the buckets that numbers of `candidates` can be in.

    The store grows without end while a run is often small. What travels to it are the run's distinct
    buckets, `KEY_BUCKETS` at most, and the scan takes only folders of these buckets (dynamic
    partition pruning): the work follows the run, not the store.
    """
    numbers = candidates.filter(F.col("invoice_number") > "")
    buckets = numbers.select(key_bucket(F.col("invoice_number")).alias("bucket")).distinct()
    return keys.join(F.broadcast(buckets), "bucket", "left_semi")


def number_holders(df: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """One row per number that documents of `df` without a reason compete for.

    `invoice_number, first, winner, holder`: `first` is the first file in name order with its row,
    `winner` that row if it keeps the number, and `holder` the stored file that loses it. `stored` has
    `invoice_number` and, where a later document may take a number over, `holder, holder_run`: that
    document's name must come first. The minimum is taken map-side, so a number shared by a third of
    all files costs each task one row.
    """
    open_cases = df.filter(F.col("reason").isNull() & F.col("invoice_number").isNotNull())
    first = F.min(F.struct("source_file", ROW)).alias("first")
    numbers = open_cases.groupBy("invoice_number").agg(first, F.count("*").alias("n"))
    if stored is None:
        nobody = F.lit(None).cast("struct<holder:string,holder_run:string>")
        return numbers.withColumns({"winner": F.col(f"first.{ROW}"), "holder": nobody})
    if "holder" not in stored.columns:
        none = F.lit(None).cast("string")
        stored = stored.withColumns({"holder": none, "holder_run": none})
    known = stored.groupBy("invoice_number").agg(
        F.bool_or(F.col("holder").isNull()).alias("is_final"),
        F.min(F.struct("holder", "holder_run")).alias("held"),
    )
    taken = F.col("is_final") | (F.col("held.holder") <= F.col("first.source_file"))
    free = F.col("is_final").isNull()
    joined = numbers.join(known, "invoice_number", "left")
    return joined.select(
        "invoice_number",
        "first",
        "n",
        F.when(free | ~taken, F.col(f"first.{ROW}")).alias("winner"),
        F.when(~free & ~taken, F.col("held")).alias("holder"),
    )


def mark_winners(df: DataFrame, holders: DataFrame) -> DataFrame:
    """Add `is_first` to documents without a reason yet; false for everything else.

    Nearly every number has one document, which wins without being looked up. Only contested numbers
    are joined to the documents: adaptive execution broadcasts them while they are few and splits a
    hot one otherwise.
    """
    contested = holders.filter((F.col("n") > 1) | F.col("winner").isNull())
    lookup = contested.select("invoice_number", F.lit(True).alias("_contested"), "winner")
    alone = F.col("_contested").isNull() | (F.col("winner") == F.col(ROW))
    is_first = F.col("reason").isNull() & F.coalesce(alone, F.lit(False))
    return df.join(lookup, "invoice_number", "left").withColumn("is_first", is_first).drop(
        "_contested", "winner"
    )


def mark_first(df: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Documents with `is_first`, the first file of each number in name order unless it is stored.

    Two rows with one file name compete like any others, by the numbers of `stage_numbered`; a table
    without them is written first.
    """
    rows = df if ROW in df.columns else stage_numbered(df, "documents")
    marked = mark_winners(rows, number_holders(rows, stored))
    return marked if ROW in df.columns else marked.drop(ROW)
