"""Benchmark decontamination by latent semantic retrieval.

Passages, windows of 32 words every 16, are TF-IDF vectors over hashed words, with document frequencies
counted over the whole corpus. A randomised SVD gives a latent space: each task adds up its passages'
share of the products, rows of one bucket are summed by Spark, and only matrices of a fixed size reach
the driver. It is fitted on all benchmark passages and all passages of all documents. Those of documents are
first added up with random signs, `SUMS` sums a task and `MOST_SUMS` in all, whose products are on average those
of the passages; together they weigh as much as four passages of `sample` documents, so that the benchmark's
own words keep their place in the space. The signs go by task, so a cosine changes a little with the splits;
what matches does not. Every passage of every document is then projected and compared with every benchmark passage, its whole length counting;
what is close enough is a candidate. So is every region that holds as many of an item's words as a match
must (`COVER` of them, all of a short item): regions are made for each class of item lengths, so that every
window of one and a half item lengths lies in one of them, and none with a match is left out. Every
candidate is checked on words: the longest common subsequence of the item and the region must cover enough
of the item, and of its answer, its last words.

The benchmark is a stated query set: it goes to the tasks in blocks of at most `BLOCK` items.

Nulls and odd rows: null and wordless texts and items match nothing; an item of fewer than 8 words must
occur word for word; repeated rows are judged one by one; of repeated item_ids each text counts; an
empty benchmark or corpus gives no pair. Other columns of the input are not read.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tasks import row_number, ship, staged, whole_text
from .words import batched, word_hashes

BUCKETS = 1 << 15
RANK, OVERSAMPLE, ROUNDS = 128, 8, 2
STRIDE = 16
SAMPLE = 100
# Signed sums of passages that a task makes, and sums in all: beyond that, sums of tasks are added up.
SUMS, MOST_SUMS = 64, 2048
BLOCK = 2_000
# Documents whose buckets are marked at a time, at most 255; passages projected at a time.
GROUP, CHUNK = 64, 512
# Places of the items' words that are grouped into regions at a time.
PLACES = 1 << 17
# Cosine of a candidate; share of an item and of its answer that a match covers; words of a short item.
COSINE, COVER, ANSWER_COVER, SHORT = 0.5, 0.6, 0.5, 8
# A region is asked for a share of one in so many of the words that a match needs, among the rarest ones;
# all of them are counted after that. No match is lost by it.
ASKED = 4

PAIRS = "row long, doc_id long, item_id long, cosine double, covered double, first_word long, last_word long"


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - 15)).astype(np.int64)


def _bucket_rows(docs: DataFrame) -> DataFrame:
    """`buckets`, those of the words of each text in order, as unsigned 16-bit numbers; written once."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py().encode() for x in batch["text"]]
            for low, high in batched(texts):
                words, owner, _, _ = word_hashes(texts[low:high])
                cuts = np.searchsorted(owner, np.arange(high - low + 1))
                data = pa.py_buffer(_bucket(words).astype(np.uint16).tobytes())
                rows = pa.Array.from_buffers(
                    pa.binary(), high - low, [None, pa.py_buffer((2 * cuts).astype(np.int32).tobytes()), data]
                )
                yield pa.RecordBatch.from_arrays([rows], names=["buckets"])

    return staged(docs.select(whole_text().alias("text")).mapInArrow(run, "buckets binary"), "buckets")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The buckets of some texts of `_bucket_rows`, and where each text begins and the last one ends."""
    for batch in batches:
        rows = batch["buckets"]
        ends = np.append(0, np.cumsum([len(row.as_buffer()) // 2 if row.is_valid else 0 for row in rows]))
        low = 0
        while low < len(rows):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + PLACES, side="right")) - 1)
            data = b"".join(row.as_py() or b"" for row in rows[low:high])
            yield np.frombuffer(data, np.uint16).astype(np.int64), ends[low : high + 1] - ends[low]
            low = high


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts in `_bucket_rows`, and how many of them have a word in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(BUCKETS, np.int64), 0
        for buckets, ends in _pieces(batches):
            n += len(ends) - 1
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            keys = owner % GROUP * BUCKETS + buckets
            cuts = ends[np.minimum(np.arange(0, len(ends) - 1 + GROUP, GROUP), len(ends) - 1)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                seen = np.zeros(GROUP * BUCKETS, np.uint8)
                seen[keys[start:end]] = 1
                sums += seen.reshape(GROUP, BUCKETS).sum(0, dtype=np.uint8)
        kept = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, -1)), pa.array(np.append(sums[kept], n))], names=["bucket", "n"]
        )

    counted = rows.mapInArrow(count, "bucket long, n long")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas().astype(np.int64)
    df = np.zeros(BUCKETS, np.int64)
    known = found[found["bucket"] >= 0]
    df[known["bucket"]] = known["n"]
    return int(found.loc[found["bucket"] < 0, "n"].sum()), df


def inverse_frequencies(n: int, df: np.ndarray) -> np.ndarray:
    """Positive for every word: what all documents hold still counts."""
    return (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)


def windows_of(n_words: int, stride: int = STRIDE) -> list[tuple[int, int]]:
    """First and last word of windows of two strides; one window for a text of at most that."""
    if n_words <= 2 * stride:
        return [(0, n_words)] if n_words else []
    starts = range(0, n_words - stride, stride)
    return [(start, min(start + 2 * stride, n_words)) for start in starts]


def _passages(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """`buckets, weights` of all passages of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                buckets = _bucket(word_hashes([text.as_py().encode()])[0])
                for a, b in windows_of(len(buckets)):
                    keys, times = np.unique(buckets[a:b], return_counts=True)
                    weights = times * idf[keys]
                    norm = float(np.sqrt((weights**2).sum()))
                    if norm:
                        out.append((keys.tolist(), (weights / norm).tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for x, _ in out], pa.list_(pa.int64())),
                    pa.array([y for _, y in out], pa.list_(pa.float64())),
                ],
                names=["buckets", "weights"],
            )

    return texts.mapInArrow(run, "buckets array<long>, weights array<double>")


class _Sums:
    """Signed sums of passages, each passage in one of them; up to `SUMS` passages stay apart."""

    def __init__(self, idf: np.ndarray, seed: int):
        self.idf, self.square = idf, idf**2
        self.rng = np.random.default_rng(seed)
        self.sums, self.n = np.zeros((SUMS, BUCKETS), np.float32), 0

    def add(self, buckets: np.ndarray, ends: np.ndarray) -> None:
        """All passages of texts whose words are in `buckets`, text t in `ends[t]:ends[t + 1]`."""
        sizes = np.diff(ends)
        strides = -(-sizes // STRIDE)
        text = np.repeat(np.arange(len(strides)), strides)
        if not len(text):
            return
        base = np.cumsum(strides) - strides
        starts = ends[text] + (np.arange(len(text)) - base[text]) * STRIDE
        square = np.add.reduceat(self.square[buckets], starts)
        # A passage is two strides of one text; a text of one stride is a passage.
        two = np.append(text[1:] == text[:-1], False)
        square[two] += square[1:][two[:-1]]
        first = two | (strides[text] == 1)
        place = np.zeros(len(text), np.int64)
        place[first] = (self.n + np.arange(first.sum())) % SUMS * BUCKETS
        sign = np.where(self.rng.integers(0, 2, len(text)) > 0, 1, -1)
        weight = np.where(first, sign / np.sqrt(np.maximum(square, 1e-30)), 0).astype(np.float32)
        self.n += int(first.sum())
        # A word is in the passage that begins with its stride, and in the one that ends with it.
        own = np.repeat(np.arange(len(text)), np.diff(np.append(starts, ends[-1])))
        value, flat = self.idf[buckets], self.sums.reshape(-1)
        begins = first[own]
        np.add.at(flat, (place[own] + buckets)[begins], (weight[own] * value)[begins])
        before = np.append(False, two[:-1])[own]
        own = own[before] - 1
        np.add.at(flat, place[own] + buckets[before], weight[own] * value[before])


def signed_sums(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """`sum, n, vector`: signed sums of all passages of `_bucket_rows`, and how many passages each one has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made = _Sums(idf, task)
        for buckets, ends in _pieces(batches):
            made.add(buckets, ends)
        kept = np.arange(min(made.n, SUMS))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((task * SUMS + kept) % MOST_SUMS),
                pa.array((made.n - kept + SUMS - 1) // SUMS),
                pa.array([made.sums[at].tobytes() for at in kept], pa.binary()),
            ],
            names=["sum", "n", "vector"],
        )

    def added(rows: pa.Table) -> pa.Table:
        vector = np.zeros(BUCKETS, np.float32)
        for row in rows["vector"]:
            vector += np.frombuffer(row.as_buffer(), np.float32)
        columns = [rows["sum"][:1], pa.array([pc.sum(rows["n"]).as_py()]), pa.array([vector.tobytes()], pa.binary())]
        return pa.table(columns, names=["sum", "n", "vector"])

    kinds = "sum long, n long, vector binary"
    return staged(rows.mapInArrow(run, kinds).groupBy("sum").applyInArrow(added, kinds), "signed-sums")


def orthonormal(p: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of `p`, and columns of zeros for those that depend on others.

    By the small matrix of their products, twice for precision: a QR would hold several copies of `p` in double.
    """
    for _ in range(2):
        gram = np.zeros((p.shape[1], p.shape[1]))
        for low in range(0, len(p), 8 * CHUNK):
            part = p[low : low + 8 * CHUNK].astype(np.float64)
            gram += part.T @ part
        values, vectors = np.linalg.eigh(gram)
        known = values > max(values[-1], 1e-300) * 1e-13
        p = p @ np.where(known, vectors / np.sqrt(np.where(known, values, 1)), 0).astype(np.float32)
    return p


def randomised_svd(
    passages: DataFrame,
    sums: DataFrame | None = None,
    weight: float = 1.0,
    rank: int | None = None,
    rounds: int = ROUNDS,
    seed: int = 7,
) -> np.ndarray:
    """The leading right singular vectors, one column each (BUCKETS x rank), of the matrix of the passages, and
    of the `sums`, if any, whose squares weigh `weight`."""
    spark = passages.sparkSession
    rank = rank or RANK
    width = rank + OVERSAMPLE
    q = np.random.default_rng(seed).standard_normal((BUCKETS, width), np.float32)

    def by_bucket(sums: np.ndarray, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(found), CHUNK):
            some = found[low : low + CHUNK]
            offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * width)
            vectors = pa.ListArray.from_arrays(offsets, pa.array(sums[some].astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(some), vectors], names=["bucket", "v"])

    def product(q: np.ndarray) -> np.ndarray:
        """(A^T A) q, summed over tasks by bucket."""
        shared = spark.sparkContext.broadcast(q)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((BUCKETS, width))
            used = np.zeros(BUCKETS, bool)
            for batch in batches:
                cuts = batch["buckets"].offsets.to_numpy()
                keys, weights = (batch[c].values.to_numpy() for c in ("buckets", "weights"))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    own, w = keys[a:b], weights[a:b]
                    out[own] += w[:, None] * (w @ shared.value[own])  # a passage names a bucket once
                    used[own] = True
            yield from by_bucket(out, np.flatnonzero(used))

        def run_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((BUCKETS, width), np.float32)
            for batch in batches:
                for low in range(0, batch.num_rows, SUMS):
                    vectors = [np.frombuffer(x.as_buffer(), np.float32) for x in batch["vector"][low : low + SUMS]]
                    some = np.array(vectors)
                    out += some.T @ ((some @ shared.value) * np.float32(weight))
            yield from by_bucket(out, np.flatnonzero(out.any(1)))

        kinds = "bucket long, v array<float>"
        rows = passages.mapInArrow(run, kinds)
        if sums is not None:
            # A few tasks with many sums: each one's share of the product is a whole matrix.
            few = sums.select("vector").coalesce(max(1, spark.sparkContext.defaultParallelism))
            rows = rows.unionByName(few.mapInArrow(run_sums, kinds))
        summed = rows.groupBy("bucket").agg(
            *(F.sum(F.col("v")[i]).cast("float").alias(f"v{i}") for i in range(width))
        )
        found = summed.toArrow()
        out = np.zeros((BUCKETS, width), np.float32)
        places = found["bucket"].to_numpy()
        for i in range(width):
            out[places, i] = found[f"v{i}"].to_numpy()
        del found, places
        pa.default_memory_pool().release_unused()
        shared.unpersist()
        return out

    for _ in range(rounds):
        q = orthonormal(product(q))
    core = q.T @ product(q)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    return (q @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32)


def word_masks(item: np.ndarray) -> dict[int, int]:
    """For each word of `item`, a number with one bit per place where it stands."""
    masks: dict[int, int] = {}
    for at, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << at
    return masks


def common_subsequence(item: np.ndarray, words: Iterable[int], masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence; `masks` are the item's, where they are at hand."""
    masks = word_masks(item) if masks is None else masks
    full = (1 << len(item)) - 1
    row = full
    for word in words:
        hit = row & masks.get(word, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def class_of(n: int) -> int:
    """The class of an item of n words: the next of 8, 12, 16, 24, 32, 48, ..."""
    top = 8
    while top < n:
        top = top * 3 // 2 if top & (top - 1) == 0 else top * 4 // 3
    return top


def _occurs(item: np.ndarray, words: np.ndarray) -> bool:
    n = len(item)
    starts = np.flatnonzero(words[: len(words) - n + 1] == item[0]) if len(words) >= n else []
    return any((words[s : s + n] == item).all() for s in starts)


class _Block:
    """A block of benchmark items, ready for comparison inside a task."""

    def __init__(self, items: list[tuple[int, str]], idf: np.ndarray, basis: np.ndarray):
        # The last row stands for no word.
        self.table = np.vstack([basis * idf[:, None], np.zeros((1, basis.shape[1]), np.float32)])
        self.square = idf**2
        self.known = np.zeros(BUCKETS, np.float32)
        self.members = np.zeros((len(items), BUCKETS), bool)
        self.ids, self.words, self.masks, self.answers, vectors, owner = [], [], [], [], [], []
        for item_id, text in items:
            words = word_hashes([text.encode()])[0]
            buckets = _bucket(words)
            self.known[buckets] = self.square[buckets]
            self.members[len(self.ids), buckets] = True
            for a, b in windows_of(len(words)):
                # Scaled so that the passage itself scores 1 however much of it the space shows.
                shown, whole = self.table[buckets[a:b]].sum(0), float(self.square[buckets[a:b]].sum())
                vectors.append(shown * np.sqrt(whole) / max(float((shown**2).sum()), 0.01 * whole, 1e-9))
                owner.append(len(self.ids))
            answer = words[-max(3, len(words) // 4) :]
            self.ids.append(item_id)
            self.words.append(words)
            self.masks.append(word_masks(words))
            self.answers.append((answer, word_masks(answer)))
        self.lengths = np.array([len(words) for words in self.words], np.int64)
        self.owner = np.array(owner, np.int64)
        self.matrix = np.array(vectors, np.float32).reshape(len(vectors), basis.shape[1])

        self.classes = [
            part for top in sorted({class_of(n) for n in self.lengths.tolist() if n}) for part in self._class_of(top, idf)
        ]

    def _class_of(self, top: int, idf: np.ndarray) -> list[tuple]:
        """Items of one class of lengths, in parts that ask for equally many words: the class, that
        number `k`, where the items of each bucket begin, and the items, by bucket.

        Of n words a match has `least`, so of the n - least + k rarest ones it has k: these are listed.
        """
        parts: dict[int, list[tuple[int, int]]] = {}
        for item, n in enumerate(self.lengths.tolist()):
            if n and class_of(n) == top:
                least = n if n < SHORT else int(np.ceil(COVER * n - 1e-6))
                k = max(1, least // ASKED)
                own = _bucket(self.words[item])
                rarest = own[np.argsort(-idf[own], kind="stable")][: n - least + k]
                parts.setdefault(k, []).extend((bucket, item) for bucket in rarest.tolist())
        out = []
        for k, entries in sorted(parts.items()):
            buckets, items = np.array(sorted(entries), np.int64).T
            out.append((top, k, np.searchsorted(buckets, np.arange(BUCKETS + 1)), items))
        return out

    def regions(self, words: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, first, end) of regions with enough of the item's rarest words for a match.

        Regions are two class lengths long, every half class length. A word that occurs again counts again.
        """
        buckets, sizes = _bucket(words), np.diff(cuts)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        found = [(np.zeros(0, np.int64),) * 4]
        for top, k, cut, items in self.classes:
            size, stride, n = 2 * top, top // 2, len(self.ids)
            last = np.maximum(0, -(-(sizes - size) // stride))  # the last region of each text
            base = np.cumsum(last + 1) - last - 1
            times = np.diff(cut)
            known = np.flatnonzero(times[buckets])
            # Texts are taken together as long as their words have `PLACES` places in all.
            held = np.append(0, np.cumsum(times[buckets[known]]))
            low = 0
            while low < len(known):
                high = max(low + 1, int(np.searchsorted(held, held[low] + PLACES, side="right")) - 1)
                if high < len(known):
                    # Not inside a text, unless it is the only one.
                    start = int(np.searchsorted(known, cuts[owner[known[high]]]))
                    high = start if start > low else int(np.searchsorted(known, cuts[owner[known[low]] + 1]))
                place = known[low:high]
                t = times[buckets[place]]
                at = np.repeat(cut[buckets[place]] - np.cumsum(t) + t, t) + np.arange(t.sum())
                text, item, place = np.repeat(owner[place], t), items[at], np.repeat(place, t)
                nearest, keys = (place - cuts[text]) // stride, []
                for back in range(4):
                    number = nearest - back
                    inside = (number >= 0) & (number <= last[text])
                    keys.append(((base[text] + number) * n + item)[inside])
                keys, counts = np.unique(np.concatenate(keys), return_counts=True)
                keys = keys[counts >= k]
                region, item = np.divmod(keys, n)
                text = np.searchsorted(base, region, side="right") - 1
                first = (region - base[text]) * stride
                found.append((text, item, first, np.minimum(first + size, sizes[text])))
                low = high
        return tuple(np.concatenate(x) for x in zip(*found))

    def closeness(self, item: int, words: np.ndarray) -> float:
        """The largest cosine of the item and passages of about its length among `words`."""
        own, buckets = self.matrix[self.owner == item], _bucket(words)
        best = 0.0
        for a, b in windows_of(len(words), max(1, min(STRIDE, int(self.lengths[item] + 1) // 2))):
            length = float(self.square[buckets[a:b]].sum()) ** 0.5
            best = max(best, float((own @ self.table[buckets[a:b]].sum(0)).max()) / length)
        return best

    def check(self, item: int, words: np.ndarray) -> float:
        """Share of the item found in `words`, or 0 if it or its answer is not there."""
        own, masks = self.words[item], self.masks[item]
        if len(own) < SHORT:
            return float(_occurs(own, words))
        found = words.tolist()
        # No subsequence is longer than the number of the item's words that occur at all.
        if sum(masks[word].bit_count() for word in masks.keys() & set(found)) < COVER * len(own):
            return 0.0
        share = common_subsequence(own, found, masks) / len(own)
        if share < COVER:
            return 0.0
        answer, masks = self.answers[item]
        return share if common_subsequence(answer, found, masks) >= ANSWER_COVER * len(answer) else 0.0

    def candidates(self, words: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, stride in the text, cosine) of passages close to an item's, in that order.

        The words of text t are `words[cuts[t]:cuts[t + 1]]`. A passage whose words known to the items
        hold less than COSINE**2 of its squared length is not projected: it is not that close to any.
        """
        strides = -(-np.diff(cuts) // STRIDE)
        text = np.repeat(np.arange(len(strides)), strides)
        within = np.arange(len(text)) - np.repeat(np.cumsum(strides) - strides, strides)
        starts = cuts[text] + within * STRIDE
        none = np.zeros(0, np.int64)
        if not len(starts) or not len(self.owner):
            return none, none, none, np.zeros(0, np.float32)
        buckets = np.append(_bucket(words), BUCKETS)
        square = np.add.reduceat(self.square[buckets[:-1]], starts)
        known = np.add.reduceat(self.known[buckets[:-1]], starts)
        # A passage is two strides of one text; a text of one stride is a passage.
        two = np.append(text[1:] == text[:-1], False)
        square[two] += square[1:][two[:-1]]
        known[two] += known[1:][two[:-1]]
        chosen = np.flatnonzero((two | (strides[text] == 1)) & (known >= COSINE**2 * square) & (square > 0))

        offsets, found = np.arange(STRIDE), []
        for low in range(0, len(chosen), CHUNK):
            some = chosen[low : low + CHUNK]
            # Each stride is summed once, also where two passages have it.
            both = two[some]
            needed = np.unique(np.concatenate((some, some[both] + 1)))
            places = starts[needed, None] + offsets
            places[places >= cuts[text[needed] + 1, None]] = len(words)
            taken = buckets[places].T
            sums, row = self.table[taken[0]], np.empty((len(needed), self.table.shape[1]), np.float32)
            for column in taken[1:]:
                sums += np.take(self.table, column, axis=0, out=row, mode="clip")
            at = np.searchsorted(needed, some)
            vectors = sums[at]
            vectors[both] += sums[at[both] + 1]
            # The passage's whole length counts, also what the latent space does not show of it.
            lengths = np.sqrt(square[some])
            near = vectors @ self.matrix.T
            close = np.flatnonzero(near.max(1) >= COSINE * lengths)
            at, which = np.nonzero(near[close] >= COSINE * lengths[close, None])
            at = close[at]
            found.append((some[at], self.owner[which], near[at, which] / lengths[at]))
        if not found:
            return none, none, none, np.zeros(0, np.float32)
        place, item, cosine = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, item, text[place]))
        place, item, cosine = place[order], item[order], cosine[order]
        return text[place], item, within[place], cosine

    def matches(self, words: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int, float, float, int, int]]:
        """(text, item, cosine, covered, first word, last word), the best place of each pair."""
        text, item, stride, _ = self.candidates(words, cuts)
        # Every passage is looked at with one item length around it, and every region with enough words.
        a = np.maximum(0, stride * STRIDE - self.lengths[item])
        b = np.minimum(np.diff(cuts)[text], (stride + 2) * STRIDE + self.lengths[item])
        text, item, a, b = (np.concatenate(x) for x in zip((text, item, a, b), self.regions(words, cuts)))
        if not len(text):
            return []
        best: dict[tuple[int, int], tuple] = {}
        for at in self.promising(words, item, cuts[text] + a, cuts[text] + b).tolist():
            pair = int(text[at]), int(item[at])
            share = self.check(pair[1], words[cuts[text[at]] :][a[at] : b[at]])
            if share and share > best.get(pair, (0,))[0]:
                best[pair] = share, int(a[at]), int(b[at])
        return [
            (t, i, self.closeness(i, words[cuts[t] + low : cuts[t] + high]), share, low, high)
            for (t, i), (share, low, high) in sorted(best.items())
        ]

    def promising(self, words: np.ndarray, item: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The places with enough words of the item for a match: its share, or all of a short item."""
        buckets, found = _bucket(words), []
        n = self.lengths[item]
        least = np.where(n < SHORT, n, COVER * n - 1e-6)
        for low in range(0, len(item), 8 * CHUNK):
            part = slice(low, low + 8 * CHUNK)
            sizes = ends[part] - starts[part]
            firsts = np.cumsum(sizes) - sizes
            at = np.arange(sizes.sum()) + np.repeat(starts[part] - firsts, sizes)
            held = np.add.reduceat(self.members[np.repeat(item[part], sizes), buckets[at]], firsts, dtype=np.int64)
            found.append(low + np.flatnonzero(held >= least[part]))
        return np.concatenate(found)

    def matches_of(self, texts: list[bytes]) -> Iterator[tuple[int, int, float, float, int, int]]:
        """The matches of whole texts, taken a few megabytes at a time."""
        for low, high in batched(texts):
            words, owner, _, _ = word_hashes(texts[low:high])
            for text, *rest in self.matches(words, np.searchsorted(owner, np.arange(high - low + 1))):
                yield low + text, *rest


def _blocks(benchmark: DataFrame, size: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks; the driver holds one block at a time."""
    held: list[tuple[int, str]] = []
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
    for item_id, text in items.orderBy("item_id", "text").toLocalIterator():
        held.append((item_id, text))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def latent_space(docs: DataFrame, benchmark: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Inverse document frequencies over all of `docs`, and the basis of the latent space.

    It is fitted on all passages; those of `docs` together weigh as four passages of `sample` documents.
    """
    rows = _bucket_rows(docs)
    n, df = document_frequencies(rows)
    idf = inverse_frequencies(n, df)
    sums = signed_sums(rows, idf)
    passages = sums.agg(F.sum("n")).first()[0] or 0
    weight = min(1.0, 4 * sample / max(1, passages))
    items = _passages(benchmark.select(whole_text().alias("text")), idf)
    return idf, randomised_svd(staged(items, "passages"), sums, weight)


def find_leaks(docs: DataFrame, benchmark: DataFrame, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """`row, doc_id, item_id, cosine, covered, first_word, last_word` of every match."""
    spark = docs.sparkSession
    idf, basis = latent_space(docs, benchmark, sample)
    texts = docs.select(row_number(), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    found = None
    for items in _blocks(benchmark, block):
        shared = spark.sparkContext.broadcast((items, idf, basis))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ready = _Block(*shared.value)
            for batch in batches:
                texts = [x.as_py().encode() for x in batch["text"]]
                keys = list(zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist()))
                rows = [(*keys[at], ready.ids[item], *rest) for at, item, *rest in ready.matches_of(texts)]
                kinds = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.int64()] * 2
                names = [field.split()[0] for field in PAIRS.split(", ")]
                columns = zip(*rows) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        pairs = texts.mapInArrow(search, PAIRS)
        found = pairs if found is None else found.unionByName(pairs)
    return texts.limit(0).mapInArrow(lambda batches: iter(()), PAIRS) if found is None else found


def _leaks(shared: Broadcast) -> Callable:
    """A function of texts: does one of the block's items match?"""

    @F.pandas_udf("boolean")
    def leaks(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = _Block(*shared.value)
        for column in columns:
            found = np.zeros(len(column), bool)
            found[[at for at, *_ in ready.matches_of([x.encode() for x in column])]] = True
            yield pd.Series(found)

    return leaks


def without_leaks(docs: DataFrame, benchmark: DataFrame, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """`docs`, all columns, without the rows that `find_leaks` would report."""
    idf, basis = latent_space(docs, benchmark, sample)
    for items in _blocks(benchmark, block):
        shared = docs.sparkSession.sparkContext.broadcast((items, idf, basis))
        docs = docs.filter(~_leaks(shared)(whole_text()))
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains or paraphrases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    pairs = find_leaks(docs, benchmark)
    return pairs.select(
        "doc_id", "item_id", F.round("cosine", 4).alias("cosine"), F.round("covered", 4).alias("covered")
    )
