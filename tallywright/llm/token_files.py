"""Token-id files: one id array over all documents, their ends as Elias-Fano code.

A set of files is a Parquet folder of segments in ascending `doc_id` order. A segment's `payload` is

    magic "TWT1" | width of an id in bytes, 2 or 4 | ends of the documents (Elias-Fano) | doc_ids
    (a null byte each, then int64) | ids, little-endian

and `part, segment, n_docs, n_tokens` beside it are what a reader needs to know where it starts.

Nulls and odd rows: a null text is empty and has the end id alone; null doc_ids come first; rows with
one doc_id follow each other in the order of a hash of their texts; an empty table gives a folder
without segments. Columns of the input other than `doc_id, text` are not read.
"""

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..shared import scratch_folder
from . import elias_fano
from .tasks import ship, whole_text
from .tokens import encoder, vocabulary_path

MAGIC = b"TWT1"
# A segment is closed at so many ids, so it stays a few MB however large its part is.
SEGMENT_TOKENS = 1 << 20
# Documents whose boundaries are selected at a time when a segment is read.
SELECTED = 4096

SEGMENTS = "part int, segment int, n_docs long, n_tokens long, payload binary"


def _segment(doc_ids: list[int | None], ids: list[bytes]) -> tuple[int, int, bytes]:
    ends = np.cumsum([len(x) // 4 for x in ids])
    tokens = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if int(tokens.max()) < 1 << 16 else 4
    known = np.array([x is not None for x in doc_ids], np.uint8)
    keys = np.array([x or 0 for x in doc_ids], "<i8")
    data = tokens.astype("<u2") if width == 2 else tokens
    head = MAGIC + struct.pack("<B", width)
    payload = head + elias_fano.encode(ends) + known.tobytes() + keys.tobytes() + data.tobytes()
    return len(doc_ids), int(ends[-1]), payload


class Segment:
    """One segment as it lies in its file: boundaries by `select`, ids by slices of the array."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        width = payload[4]
        self.ends = elias_fano.Reader(payload[5:])
        at, self.n = 5 + self.ends.size, self.ends.n
        self.known = np.frombuffer(payload, np.uint8, self.n, at)
        self.keys = np.frombuffer(payload, "<i8", self.n, at + self.n)
        self.tokens = np.frombuffer(payload, f"<u{width}", offset=at + 9 * self.n)

    def documents(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """doc_ids, whether they are known, first id and end of the documents, `SELECTED` at a time."""
        for low in range(0, self.n, SELECTED):
            numbers = np.arange(low, min(low + SELECTED, self.n))
            ends = self.ends.select_many(numbers).astype(np.int64)
            before = self.ends.select(low - 1) if low else 0
            yield self.keys[numbers], self.known[numbers] > 0, np.append(before, ends[:-1]), ends

    def ids(self, start: int, end: int) -> bytes:
        """Ids from `start` to `end` as little-endian unsigned 32-bit integers."""
        return self.tokens[start:end].astype("<u4").tobytes()


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encode `docs` (doc_id, text) and write its ids to `path` in ascending doc_id order."""
    ship(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(vocabulary).encode, pa.schema(
            [("part", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64())]
            + [("n_tokens", pa.int64()), ("payload", pa.binary())]
        )
        doc_ids, ids, held, number, part = [], [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            n_docs, n_tokens, payload = _segment(doc_ids, ids)
            row = [[part], [number], [n_docs], [n_tokens], [payload]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, kind)], schema=kind)

        for batch in batches:
            part = batch["part"][0].as_py() if batch.num_rows else part
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                doc_ids.append(key)
                ids.append(encode(text))
                held += len(ids[-1]) // 4
                if held >= SEGMENT_TOKENS:
                    yield closed()
                    doc_ids, ids, held, number = [], [], 0, number + 1
        if doc_ids:
            yield closed()

    # The text's hash orders rows of one doc_id and lets many of them spread over several parts.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = ordered.withColumn("part", F.spark_partition_id())
    parts.mapInArrow(segments, SEGMENTS).write.mode("overwrite").parquet(path)


def read_token_files(
    spark: SparkSession, path: str, kind: str = "ids binary", made: Callable[[bytes], object] = bytes
) -> DataFrame:
    """`doc_id, start, n_tokens, ids`: ids as little-endian unsigned 32-bit integers.

    `start` counts the ids before a document: in earlier parts, earlier segments of its part and
    earlier documents of its segment. Only counts travel, one row per part, segment and document.
    With `made` and its `kind` the last column is what that function makes of each document's ids where
    they are read, so that the ids themselves need not leave the task.
    """
    ship(spark)
    files = spark.read.schema(SEGMENTS).parquet(path)
    schema = f"part int, segment int, doc_id long, _inside long, n_tokens long, {kind}"
    name, kind = kind.split()
    arrow = {"binary": pa.binary(), "long": pa.int64()}[kind]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, payload in zip(*(batch[c].to_pylist() for c in ("part", "segment", "payload"))):
                read = Segment(payload)
                for keys, known, starts, ends in read.documents():
                    n = len(keys)
                    values = [made(read.ids(a, b)) for a, b in zip(starts.tolist(), ends.tolist())]
                    columns = [pa.array([x] * n, pa.int32()) for x in (part, segment)]
                    columns += [pa.array(keys, pa.int64(), mask=~known)]
                    columns += [pa.array(x, pa.int64()) for x in (starts, ends - starts)]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(values, arrow)],
                        names=["part", "segment", "doc_id", "_inside", "n_tokens", name],
                    )

    rows = files.mapInArrow(documents, schema)
    earlier = (Window.unboundedPreceding, -1)
    counts = files.select("part", "segment", "n_tokens")
    parts = counts.groupBy("part").agg(F.sum("n_tokens").alias("_tokens"))
    all_parts = Window.orderBy("part").rowsBetween(*earlier)  # as many rows as there are parts
    parts = parts.select("part", F.coalesce(F.sum("_tokens").over(all_parts), F.lit(0)).alias("_parts"))
    in_part = Window.partitionBy("part").orderBy("segment").rowsBetween(*earlier)
    before = counts.join(parts, "part").select(
        "part",
        "segment",
        (F.col("_parts") + F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))).alias("_before"),
    )
    placed = rows.join(before, ["part", "segment"])
    return placed.select("doc_id", (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens", name)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token-id files, read the files back, one row per document."""
    path = scratch_folder(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_token_files(spark, path, "ids_crc32 long", zlib.crc32)
