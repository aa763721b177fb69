"""Ranked search against scores of every document, with odd rows, copies and forced small shards."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallywright.llm import lexical
from tallywright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=10):
    """`item_id, rank, doc_id, score` of all documents scored one by one."""
    split = [(i, w) for i, w in ((i, words(t)) for i, t in docs) if w]
    n_docs, n_terms = len(split), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    rows = []
    for item_id, text in set(items):
        asked = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(words(text)) if df[t]}
        scores = []
        for doc_id, w in split:
            tf, m = Counter(w), 10 + 90 * len(w) * n_docs // n_terms
            score = sum(x * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t, x in asked.items() if tf[t])
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            rows.append((item_id, rank, doc_id, -score))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def tables(spark, docs, items):
    docs = [(i, t, "x", 1) for i, t in docs]
    left = spark.createDataFrame(docs, "doc_id long, text string, score string, rank int").repartition(5)
    right = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id int")
    return left, right


def corpus(seed, size):
    random_ = random.Random(seed)
    vocabulary = [f"w{int(random_.paretovariate(0.7))}" for _ in range(300)]
    texts = [" ".join(random_.choices(vocabulary, k=random_.choice((3, 8, 40, 200)))) for _ in range(size)]
    texts += texts[:1] * (size // 3)  # a third are copies of one text: ties by doc_id
    return list(enumerate(random_.sample(texts, len(texts)))), vocabulary


def test_registered_query_on_the_whole_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got(QUERIES["op13_lexical_search"](spark, SF)) == expected(docs, items)


@pytest.mark.parametrize("shard_postings, block_bytes", [(1 << 18, 1 << 20), (40, 200), (1, 1)])
def test_any_shards_and_blocks(spark, shard_postings, block_bytes):
    docs, vocabulary = corpus(4, 240)
    items = [(n, " ".join(vocabulary[n * 7 : n * 7 + 9])) for n in range(4)]
    left, right = tables(spark, docs, items)
    found = lexical.ranked(left, right, shard_postings=shard_postings, block_bytes=block_bytes)
    assert got(found) == expected(docs, items)


def test_odd_rows(spark):
    docs = [(1, "Äpfel and PEARS, 2 pears"), (2, None), (3, ""), (4, " ...!\x00"), (None, "pears"), (None, "pears")]
    docs += [(5, "pears"), (5, "pears"), (6, "äpfel Äpfel"), (7, "pear " * 30000 + "pears"), (8, "nothing here")]
    items = [(1, "pears"), (1, "pears"), (1, "Äpfel"), (2, None), (3, ""), (4, "absent"), (None, "PEARS 2 äpfel")]
    left, right = tables(spark, docs, items)
    assert got(lexical.ranked(left, right)) == expected(docs, items)
    assert got(lexical.ranked(left, right, top=2)) == expected(docs, items, 2)


def test_empty_tables(spark):
    some = [(1, "a b")]
    for docs, items in (([], some), (some, []), ([], []), ([(1, "!")], some), (some, [(1, "?")])):
        found = lexical.ranked(*tables(spark, docs, items))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_range_maxima():
    random_ = np.random.default_rng(1)
    n, sizes = np.arange(1, 41), np.full(40, 3)
    terms = np.concatenate([random_.choice(6, 3, replace=False) for _ in n]).astype(np.int32)
    counts = random_.integers(1, 9, 120)
    shard = lexical.Shard(n, lexical.lengths_in_use(n, 40, int(n.sum())), sizes, terms, counts, np.arange(5, 11))
    edges = [np.searchsorted(shard.terms[:-1], t, side) for t in range(6) for side in ("left", "right")]
    for low, high in zip(edges[::2], edges[1::2]):
        for left in range(low, high):
            for right in range(left + 1, high + 1):
                at = shard.largest(np.array([left]), np.array([right]))[0]
                assert left <= at < right and shard.impact[at] == shard.impact[left:right].max()


def test_most_documents_are_never_scored():
    """The bounds decide: with one good match only a few places of 5,000 are looked at."""
    random_ = np.random.default_rng(2)
    n = random_.integers(50, 400, 5000)
    terms = np.concatenate([random_.choice(40, 4, replace=False) for _ in n]).astype(np.int32)
    counts = np.ones(len(terms), np.int64)
    counts[:4], terms[:4] = 30, range(4)
    shard = lexical.Shard(n, lexical.lengths_in_use(n, 5000, int(n.sum())), np.full(5000, 4), terms, counts, np.full(40, 100))
    places, scores, scored = shard.search(np.arange(4, dtype=np.int32), 0, 1, width=1)
    assert shard.row[places].tolist() == [0] and scored < 250


def test_lengths_beyond_64_bits():
    n = np.array([5, 10**9])
    want = [10 + 90 * 10**11 * int(x) // (3 * 10**13) for x in n]
    assert lexical.lengths_in_use(n, 10**11, 3 * 10**13).tolist() == want
