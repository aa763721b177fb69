"""Ranked lexical search: best-first document intervals with range-maximum tables per posting list.

Terms are runs of ASCII letters and digits and of all characters above U+007F, A-Z lowered. A document's
score for an item is the sum of its impacts, whole numbers, over the item's terms, once each.

1. One pass over the texts keeps, per document, its length and how often it holds each term of the items;
   from this table come the number of documents, of terms, and of the documents that hold a term.
2. Every task of the second pass deals its documents into shards of at most `SHARD_POSTINGS` postings (one
   document at least). A shard's posting lists lie one after another, ordered by term and place, with a
   sparse table over them: level j has, for every place, that of the largest impact among the next 2^j.
   A range within a list is covered by two such stretches, so its maximum is two look-ups.
3. An item starts with the interval of all places of the shard. An interval's bound is the sum of its terms'
   largest impacts in it. The intervals with the highest bounds are taken, `WIDTH` at a time: the document
   that holds the largest impact is scored in full and splits its interval in two. Intervals whose bound is
   below the lowest score that still counts are dropped, and the search ends when none is left. The scores
   of the shards before, in the same task, count too, so later shards start with a bar.
4. The best of all tasks are ranked per item, in salted groups first.

Places within a shard follow the documents' length, so that impacts near each other are alike; the result
does not depend on it. Items come in blocks of at most `BLOCK_BYTES` of text, which bounds what is broadcast;
each block is one pass over the documents.

Nulls and odd rows: a null text, and one without terms, counts for nothing and is never found, and such an
item finds nothing; equal rows of items count once, rows with one item_id and different texts are items of
their own; a null doc_id ranks before all others of one score, rows with one doc_id rank one by one; empty
tables give an empty result. Columns other than `doc_id, text` and `item_id, text` are not read.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .tasks import ship, staged, whole_text

TOP = 10
BLOCK_BYTES = 4 << 20
SHARD_POSTINGS = 1 << 18
# Intervals taken at a time.
WIDTH = 64
SALTS = 64

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

COUNTED = "doc_id long, n long, terms array<int>, counts array<long>"
FOUND = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())  # bytes lower A-Z only


def lengths_in_use(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a document's length adds to the divisor: 10 for none, 100 for the mean length."""
    if 90 * n_docs * int(n.max(initial=0)) < 1 << 63:
        return 10 + 90 * n_docs * n // n_terms
    return np.array([10 + 90 * n_docs * x // n_terms for x in n.tolist()], np.int64)


class Shard:
    """Posting lists of some documents and their range-maximum tables."""

    def __init__(self, n, m, sizes, terms, counts, weights):
        """Per document: terms in all, length in use, number of its postings; then the postings' columns."""
        places = np.empty(len(n), np.int64)
        self.row = np.argsort(n, kind="stable")  # place -> number of the document
        places[self.row] = np.arange(len(n))
        place = np.repeat(places, sizes)
        order = np.lexsort((place, terms))
        terms, counts, self.place = terms[order], counts[order], place[order]
        self.n_places = len(n)
        self.key = terms.astype(np.int64) * self.n_places + self.place
        per_thousand = 1_000_000_000 * counts // (1000 * counts + 8 * m[self.row[self.place]])
        self.impact = weights[terms] * per_thousand
        self.terms = np.append(terms, np.iinfo(terms.dtype).max)
        self._tables()

    def _tables(self) -> None:
        edges = np.flatnonzero(np.diff(self.terms[:-1], prepend=-1, append=-1))
        longest = int(np.diff(edges).max(initial=1))
        size = len(self.impact)
        self.best = np.empty((longest.bit_length(), size), np.int32)
        self.best[0] = np.arange(size, dtype=np.int32)
        for level in range(1, len(self.best)):
            half, last = 1 << (level - 1), size - (1 << level) + 1
            left, right = self.best[level - 1, :last], self.best[level - 1, half : half + last]
            self.best[level, :last] = np.where(self.impact[left] >= self.impact[right], left, right)
            self.best[level, last:] = self.best[level - 1, last:]  # never asked for
        self.log2 = np.zeros(longest + 1, np.int8)
        for n in range(2, longest + 1):
            self.log2[n] = self.log2[n >> 1] + 1

    def largest(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the largest impact of each non-empty range of one list is."""
        level = self.log2[right - left]
        a, b = self.best[level, left], self.best[level, right - (1 << level.astype(np.int64))]
        return np.where(self.impact[a] >= self.impact[b], a, b)

    def _judged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval (a row of ranges, one per term) and the place that splits it."""
        here = right > left
        at = self.largest(left[here], right[here])
        impacts = np.zeros(left.shape, np.int64)
        impacts[here] = self.impact[at]
        places = np.zeros(left.shape, np.int64)
        places[here] = self.place[at]
        return impacts.sum(1), places[np.arange(len(left)), impacts.argmax(1)]

    def search(self, terms: np.ndarray, bar: int, top: int, width: int = WIDTH):
        """Places and scores that hold every one of the `top` best of at least `bar`, and places scored."""
        firsts, lasts = np.searchsorted(self.terms[:-1], terms), np.searchsorted(self.terms[:-1], terms, "right")
        used = lasts > firsts
        base = terms[used].astype(np.int64) * self.n_places
        left, right = firsts[used][None, :], lasts[used][None, :]
        places, scores, scored = np.empty(0, np.int64), np.empty(0, np.int64), 0
        if not used.any():
            return places, scores, scored
        bound, split = self._judged(left, right)
        bar = max(bar, 1)
        while True:
            alive = np.flatnonzero(bound >= bar)
            if not len(alive):
                return places, scores, scored
            if len(alive) > width:
                taken = alive[np.argpartition(bound[alive], -width)[-width:]]
                rest = np.setdiff1d(alive, taken, assume_unique=True)
            else:
                taken, rest = alive, alive[:0]
            l, r, place = left[taken], right[taken], split[taken]
            scored += len(taken)
            at = np.clip(np.searchsorted(self.key, base + place[:, None]), l, r)
            there = (at < r) & (self.place[np.minimum(at, len(self.place) - 1)] == place[:, None])
            full = np.where(there, self.impact[np.minimum(at, len(self.place) - 1)], 0).sum(1)
            good = full >= bar
            places, scores = np.append(places, place[good]), np.append(scores, full[good])
            if len(scores) >= top:
                bar = max(bar, int(np.partition(scores, -top)[-top]))
                kept = scores >= bar
                places, scores = places[kept], scores[kept]
            new_left, new_right = np.concatenate([l, at + there]), np.concatenate([at, r])
            new_bound, new_split = self._judged(new_left, new_right)
            kept = new_bound >= bar
            left = np.concatenate([left[rest], new_left[kept]])
            right = np.concatenate([right[rest], new_right[kept]])
            bound = np.concatenate([bound[rest], new_bound[kept]])
            split = np.concatenate([split[rest], new_split[kept]])


class _Best:
    """The best documents of one item so far: score, doc_id, and whether there is one."""

    def __init__(self):
        self.score, self.doc_id, self.known = (np.empty(0, kind) for kind in (np.int64, np.int64, bool))

    def add(self, score, doc_id, known, top: int) -> None:
        score, doc_id, known = (
            np.concatenate(x) for x in ((self.score, score), (self.doc_id, doc_id), (self.known, known))
        )
        order = np.lexsort((doc_id, known, -score))[:top]
        self.score, self.doc_id, self.known = score[order], doc_id[order], known[order]

    def bar(self, top: int) -> int:
        return int(self.score[-1]) if len(self.score) == top else 1


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with their terms, so many at a time that their texts have at most `limit` bytes."""
    block, held = [], 0
    for row in items.select("item_id", whole_text().alias("text")).distinct().toLocalIterator():
        text = row.text.encode()
        if block and held + len(text) > limit:
            yield block
            block, held = [], 0
        if terms := sorted(set(terms_of(text))):
            block.append((row.item_id, terms))
            held += len(text)
    if block:
        yield block


def _counted(docs: DataFrame, numbers) -> DataFrame:
    """Per document with terms: how many, which of the items' terms, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in batches:
            ids, n, terms, counts = [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = terms_of(text.as_py())
                if words:
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    ids.append(doc_id)
                    n.append(len(words))
                    terms.append(list(found))
                    counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(run, COUNTED)


def _searched(counted: DataFrame, plan, top: int, shard_postings: int) -> DataFrame:
    """The best documents of every task for every item of `plan`."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The documents that hold a term, in tables of so many postings."""
        held, size = [], 0
        for batch in batches:
            sizes = np.diff(batch["terms"].offsets.to_numpy())
            reached = size + np.cumsum(sizes)
            start = 0
            while reached[-1:].sum() >= shard_postings:
                stop = max(start + 1, int(np.searchsorted(reached, shard_postings, side="right")))
                held.append(batch.slice(start, stop - start))
                yield pa.Table.from_batches(held)
                reached = reached - reached[stop - 1]
                reached[:stop] = 0
                held, start = [], stop
                if stop == len(sizes):
                    break
            if start < batch.num_rows:
                held.append(batch.slice(start))
            size = int(reached[-1]) if len(reached) and start < batch.num_rows else 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, n_docs, n_terms = plan.value
        best = [_Best() for _ in items]
        for table in shards(batches):
            ids, n, terms, counts = (table[c].combine_chunks() for c in ("doc_id", "n", "terms", "counts"))
            sizes = np.diff(terms.offsets.to_numpy())
            n = n.to_numpy()
            m = lengths_in_use(n, n_docs, n_terms)
            postings = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            if not len(postings[0]):
                continue
            shard = Shard(n, m, sizes, *postings, weights)
            known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for item, result in zip(items, best):
                places, scores, _ = shard.search(item, result.bar(top), top)
                if len(places):
                    row = shard.row[places]
                    result.add(scores, ids[row], known[row], top)
        for at, result in enumerate(best):
            if len(result.score):
                ids = pa.array(result.doc_id, mask=~result.known)
                columns = [pa.array([at] * len(ids), pa.int32()), ids, pa.array(result.score)]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return counted.mapInArrow(run, FOUND)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `top` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    send = spark.sparkContext.broadcast
    results = []
    for block in _blocks(items, block_bytes):
        numbers = {term: at for at, term in enumerate(sorted({t for _, terms in block for t in terms}))}
        counted = staged(_counted(docs, send(numbers)), "term-counts")
        n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(numbers), np.int64)
        for term, n in holding:
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
        terms = [np.array([numbers[t] for t in x], np.int32) for _, x in block]
        found = _searched(counted, send((terms, weights, n_docs, n_terms)), top, shard_postings)
        best = found.withColumn("salt", F.spark_partition_id() % SALTS)
        for group in (["item", "salt"], ["item"]):
            order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
            best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = pa.table({"item": pa.array(range(len(block)), pa.int32()), "item_id": [x for x, _ in block]})
        names = spark.createDataFrame(names)
        results.append(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        id_type = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    whole = results[0]
    for result in results[1:]:
        whole = whole.unionByName(result)
    return whole


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return ranked(documents, benchmark)
