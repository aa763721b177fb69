"""Packing documents into sequences of a fixed capacity by multiway differencing.

A document's ids fill whole sequences first; what is left of it is cut into pieces of at most a
quarter of a sequence. The pieces of a chunk go to `k` windows by Karmarkar-Karp differencing: two
partial partitions are merged so that the fullest windows of one meet the emptiest of the other. `k`
starts at the least possible and rises while a window exceeds its capacity. Windows beyond the least
number are then taken apart to fill the gaps of the others, and the chunk's last window is cut at
powers of two, which need no padding.

Nulls and odd rows: a null text is empty, its document is the end id alone; rows with one doc_id are
packed each on its own; an empty table gives no piece. Other columns of the input are not read.
"""

import heapq
from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tasks import ship, whole_text
from .tokens import encoder, vocabulary_path

CAPACITY = 1024
# Ids of remainders that are packed together.
CHUNK_TOKENS = 1 << 19

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indexes of `sizes` in `k` windows of near-equal sums.

    A partial partition is an ascending list of (sum, tie, items); windows it lacks are empty. `tie`
    makes the order total and the result the same on every run; items are nested pairs.
    """
    if not sizes:
        return [[] for _ in range(k)]
    heap = [(-(size if k > 1 else 0), n, [(size, n, n)]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        free = k - len(a)
        # The fullest of b meet the emptiest of a; as far as a lacks windows, those are empty.
        meet = b[:-free] if free else b
        for window in b[len(meet) :]:
            insort(a, window)
        if meet:
            if len(meet) == 1:
                low = a.pop(0)
                insort(a, (low[0] + meet[0][0], low[1], (low[2], meet[0][2])))
            else:
                paired = list(zip(a, reversed(meet)))
                a = a[len(paired) :] + [(x[0] + y[0], x[1], (x[2], y[2])) for x, y in paired]
                a.sort()
        low = a[0][0] if len(a) == k else 0
        heapq.heappush(heap, (low - a[-1][0], tie, a))
    return [_flat(window[2]) for window in heap[0][2]] + [[] for _ in range(k - len(heap[0][2]))]


def _flat(items) -> list[int]:
    out, rest = [], [items]
    while rest:
        one = rest.pop()
        if isinstance(one, tuple):
            rest.extend(one)
        else:
            out.append(one)
    return out


def windows(pieces: list[tuple[int, int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold all of `pieces`, cut where it helps."""
    total = sum(piece[2] for piece in pieces)
    least = k = -(-total // capacity)
    sizes = [piece[2] for piece in pieces]
    while True:
        parts = differencing(sizes, k)
        over = max(sum(sizes[i] for i in part) for part in parts)
        if over <= capacity:
            break
        k += max(1, k // 100)
    filled = sorted(([pieces[i] for i in part] for part in parts), key=lambda w: -sum(p[2] for p in w))
    whole, spare = filled[:least], [piece for window in filled[least:] for piece in window]
    for at, window in enumerate(whole):
        room = capacity - sum(piece[2] for piece in window)
        while room:
            if not spare:
                # The emptiest of the later windows is used up next.
                if at + 1 == len(whole) or not whole[-1]:
                    break
                spare = whole.pop()
            document, start, length = spare.pop()
            taken = min(room, length)
            window.append((document, start, taken))
            if taken < length:
                spare.append((document, start + taken, length - taken))
            room -= taken
        if at + 1 >= len(whole):
            break
    if spare:
        whole.append(spare)
    last = whole.pop() if whole and sum(piece[2] for piece in whole[-1]) < capacity else []
    return [window for window in whole if window] + _powers(last)


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut a sequence that is not full into ones whose lengths are powers of two."""
    rest, out = list(reversed(pieces)), []
    left = sum(piece[2] for piece in pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            document, start, length = rest.pop()
            taken = min(room, length)
            out[-1].append((document, start, taken))
            if taken < length:
                rest.append((document, start + taken, length - taken))
            room -= taken
    return out


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    chunk_tokens: int = CHUNK_TOKENS,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece with its ids; every task packs the documents it reads, nothing is shuffled."""
    ship(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()
    quarter = max(1, capacity // 4)

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        sequence = TaskContext.get().partitionId() << 40
        held: dict[int, tuple[int | None, bytes]] = {}
        pieces: list[tuple[int, int, int]] = []
        full: list[tuple[int, int, int]] = []
        waiting = number = 0

        def rows(sequences: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list] = [[], [], [], [], [], [], []]
            for window in sequences:
                offset = 0
                for document, start, length in window:
                    key, ids = held[document]
                    row = key, start, length, len(ids) // 4, sequence, offset
                    for column, value in zip(columns, (*row, ids[4 * start : 4 * (start + length)])):
                        column.append(value)
                    offset += length
                sequence += 1
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = [field.split()[0] for field in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text.as_py())
                held[number] = key.as_py(), ids
                n_ids = len(ids) // 4
                body = n_ids - n_ids % capacity
                full.extend((number, start, capacity) for start in range(0, body, capacity))
                pieces.extend((number, at, min(quarter, n_ids - at)) for at in range(body, n_ids, quarter))
                waiting += n_ids - body
                number += 1
                if len(full) * capacity >= chunk_tokens:
                    yield rows([[piece] for piece in full])
                    full = []
                if waiting >= chunk_tokens:
                    yield rows([[piece] for piece in full] + windows(pieces, capacity))
                    held, pieces, full, waiting = {}, [], [], 0
        if held:
            yield rows([[piece] for piece in full] + (windows(pieces, capacity) if pieces else []))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(pieces_of, PIECES)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids, one row per piece."""
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
