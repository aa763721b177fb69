"""Exact duplicates by deterministic block naming.

A normalised text is cut into fixed-size blocks. Equal blocks get one integer name, then adjacent pairs
of names do, and so on until one name is left for the document: two documents share it exactly when
their blocks are equal, byte for byte. No hash decides anything.

Every task first names what it reads: it keeps one copy of each block and pair among its documents,
numbered in the order of first use. The copies of all tasks are then sorted by content, level by level,
and equal ones take the smallest number among them. So a block that a third of all documents hold is
sorted once per batch, not once per document, and only one copy of a text travels.

Nulls and odd rows: a null text counts as empty, and all empty texts are equal; a null doc_id is smaller
than any other; of repeated rows with one doc_id and one text, exactly one stays; an empty table gives
an empty result. Columns other than
`doc_id, text` are not read.
"""

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .tasks import FILE, PLACE, drop_rows, named, names_of, row_number, ship, staged, whole_text

BLOCK_BYTES = 4096
# Bytes of distinct blocks after which a task starts a new dictionary, and after which it sends rows on.
BATCH_BYTES, SENT_BYTES = 32 << 20, 2 << 20

NAMED = "kind string, level int, name long, block binary, a long, b long, doc_id long, sha256 string, n_bytes long"
NAMES = f", {FILE} string, {PLACE} long"


def _named_locally(block_bytes: int, batch_bytes: int):
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    kinds += [pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [field.split()[0] for field in (NAMED + NAMES).split(", ")]

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = TaskContext.get().partitionId() << 33
        known: dict = {}
        held = fresh = 0
        for batch in batches:
            rows: list[tuple] = []
            columns = (*("row", "doc_id", "text"), *(c for c in (FILE, PLACE) if c in batch.schema.names))
            for number, key, text, *name in zip(*(batch[c] for c in columns)):
                data = text.as_py().encode().lower()  # bytes lower A-Z only
                named_row = [x.as_py() for x in name] or [None, None]
                level, row = 0, []
                for at in range(0, len(data) or 1, block_bytes):
                    block = data[at : at + block_bytes]
                    if block not in known:
                        known[block] = free
                        rows.append(("block", 0, free, block, *[None] * 7))
                        free += 1
                        fresh += len(block)
                    row.append(known[block])
                while len(row) > 1:
                    level += 1
                    if len(row) % 2:
                        row.append(-1)
                    paired = []
                    for pair in zip(row[::2], row[1::2]):
                        if pair not in known:
                            known[pair] = free
                            rows.append(("pair", level, free, None, *pair, *[None] * 5))
                            free += 1
                        paired.append(known[pair])
                    row = paired
                digest = sha256(data).hexdigest()
                rows.append(("doc", level, row[0], None, number.as_py(), None, key.as_py(), digest, len(data), *named_row))
                if fresh > SENT_BYTES:
                    yield sent(rows)
                    rows, held, fresh = [], held + fresh, 0
            if rows:
                yield sent(rows)
            held, fresh = held + fresh, 0
            if held > batch_bytes:
                known, held = {}, 0

    return run


def _renamed(df: DataFrame, columns: list[str], by_content: list[str]) -> DataFrame:
    """`name, canonical` of those names that are not the smallest of their content."""
    same = Window.partitionBy(*by_content)
    smallest = df.select("name", F.min("name").over(same).alias("canonical"), *columns)
    return smallest.filter("name <> canonical")


def name_documents(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """`row, doc_id, sha256, n_bytes, identity`: equal texts, and only those, share `identity`."""
    ship(docs.sparkSession)
    texts = docs.select(
        row_number(),
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text().alias("text"),
        *(carried := names_of(docs)),
    )
    local = texts.mapInArrow(_named_locally(block_bytes, batch_bytes), NAMED + NAMES)
    local = staged(local, "block-names", "kind")
    top = local.filter("kind = 'doc'").agg(F.max("level")).first()[0] or 0

    blocks = local.filter("kind = 'block'").select("name", "block")
    renames = staged(_renamed(blocks, [], ["block"]), "names-0")
    everything = renames
    for level in range(1, top + 1):
        pairs = local.filter(F.col("kind") == "pair").filter(F.col("level") == level)
        pairs = pairs.select("name", "a", "b")
        for side in ("a", "b"):
            to = renames.select(F.col("name").alias(side), F.col("canonical").alias("_to"))
            pairs = pairs.join(to, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
        renames = staged(_renamed(pairs, [], ["a", "b"]), f"names-{level}")
        everything = everything.unionByName(renames)
    kept = ["doc_id", "sha256", "n_bytes", *carried]
    found = local.filter("kind = 'doc'").select("name", F.col("a").alias("row"), *kept)
    identity = F.coalesce("canonical", "name").alias("identity")
    return found.join(everything, "name", "left").select("row", *kept, identity)


def exact_groups(docs: DataFrame, **how) -> DataFrame:
    """One row per document: `row, doc_id, keep_id, group_size, kept, text_sha256`.

    The row with the largest doc_id of each group stays.
    """
    rows = staged(name_documents(docs, **how), "identities")
    last = F.max(F.struct("doc_id", "row")).alias("last")
    groups = rows.groupBy("identity").agg(F.count("*").alias("group_size"), last)
    # Groups of one need no lookup. Both sides are written out, so a large group can be split.
    groups = staged(groups.filter("group_size > 1"), "groups")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    return rows.join(groups, "identity", "left").select(
        "row",
        "doc_id",
        F.when(F.col("last").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        size.alias("group_size"),
        F.coalesce(F.col("last.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.col("sha256").alias("text_sha256"),
        *names_of(rows),
    )


def without_copies(docs: DataFrame, **how) -> DataFrame:
    """`docs`, all columns, with one row of each group of equal texts."""
    docs = named(docs)
    return drop_rows(docs, exact_groups(docs, **how).filter("NOT kept"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts and whether it stays."""
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row")
