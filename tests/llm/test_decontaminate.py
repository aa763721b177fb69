"""Benchmark leaks that are paraphrased, short, frequent, or beside a closer passage."""

import numpy as np

from tallywright.llm import decontaminate
from tallywright.llm.words import word_hashes

rng = np.random.default_rng(5)
VOCABULARY = [f"w{n}x" for n in range(3000)]


def prose(n):
    """Invented words, the first ones most frequent."""
    return [VOCABULARY[int(3000 * x**3)] for x in rng.random(n)]


def brute_force(texts, items):
    """(text, item) with a window of one and a half item lengths, at any place, that passes the check."""
    block = decontaminate._Block(list(enumerate(items)), np.ones(decontaminate.BUCKETS, np.float32), np.zeros((decontaminate.BUCKETS, 1), np.float32))
    found = set()
    for t, text in enumerate(texts):
        words = word_hashes([text.encode()])[0]
        for i, n in enumerate(block.lengths.tolist()):
            size = n + n // 2
            if any(block.check(i, words[a : a + size]) for a in range(max(1, len(words) - size + 1))):
                found.add((t, i))
    return found


def leaks(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()}


def test_no_window_with_a_match_is_lost(spark):
    items = [" ".join(prose(n)) for n in (3, 5, 7, 8, 12, 15, 17, 22, 30, 31, 33, 45, 59, 70)]
    texts = [" ".join(prose(150)) for _ in range(20)]
    for item in items:
        words = item.split()
        n = len(words)
        for kept in (1.0, 0.8, 0.67, 0.61) if n >= 8 else (1.0,):
            # Words are replaced, and the place is out of step with any stride.
            gone = rng.permutation(n)[: int(n * (1 - kept))]
            changed = [f"new{at}" if at in gone else word for at, word in enumerate(words)]
            around = prose(120)
            at = int(rng.integers(0, 100))
            texts.append(" ".join(around[:at] + changed + around[at:]))
    want = brute_force(texts, items)
    assert len(want) >= 40
    assert want <= leaks(spark, texts, items)


def test_an_item_in_many_rows_is_found_in_each(spark):
    item, rare = " ".join(prose(15)), lambda at: " ".join(f"only{at}of{n}" for n in range(17))
    alone = leaks(spark, [item], [item])
    assert alone == {(0, 0)}
    assert leaks(spark, [item] * 5, [item]) == {(at, 0) for at in range(5)}
    texts = [f"{rare(at)} {item} {rare(at)}" if at % 3 == 0 else " ".join(prose(60)) for at in range(60)]
    assert {(at, 0) for at in range(0, 60, 3)} <= leaks(spark, texts, [item])


def test_common_words_keep_a_weight():
    assert (decontaminate.inverse_frequencies(9, np.array([0, 3, 9])) >= 1).all()


def test_a_match_beside_a_closer_passage_is_found(monkeypatch):
    item = [f"word{n}" for n in range(20)]
    near = [f"new{n}" if n % 5 == 4 else word for n, word in enumerate(item)]
    text = " ".join(item[::-1] * 6 + near + item[::-1] * 6)
    basis = np.zeros((decontaminate.BUCKETS, 20), np.float32)
    basis[decontaminate._bucket(word_hashes([" ".join(item).encode()])[0]), np.arange(20)] = 1
    block = decontaminate._Block([(0, " ".join(item))], np.ones(decontaminate.BUCKETS, np.float32), basis)
    # By passages alone: the words in reverse order are closer than the match among them.
    monkeypatch.setattr(block, "regions", lambda *_: (np.zeros(0, np.int64),) * 4)
    assert [found[:2] for found in block.matches_of([text.encode()])] == [(0, 0)]


def test_latent_search_alone_finds_nine_in_ten(spark):
    """Regions are the safety net; this is what candidates by cosine find without them."""
    own = np.random.default_rng(12)

    def invented(n):
        return [VOCABULARY[int(3000 * x**3)] for x in own.random(n)]

    items = [" ".join(invented(n)) for n in (3, 5, 7, 8, 12, 15, 17, 22, 30, 31, 33, 45, 59, 70)]
    texts, want = [" ".join(invented(150)) for _ in range(20)], set()
    for number, item in enumerate(items):
        words = item.split()
        for kept in (1.0, 0.8, 0.67, 0.61) if len(words) >= 8 else (1.0,):
            gone = own.permutation(len(words))[: int(len(words) * (1 - kept))]
            changed = [f"new{at}" if at in gone else word for at, word in enumerate(words)]
            around, at = invented(120), int(own.integers(0, 100))
            want.add((len(texts), number))
            texts.append(" ".join(around[:at] + changed + around[at:]))
    want &= brute_force(texts, items)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    block = decontaminate._Block(list(enumerate(items)), *decontaminate.latent_space(docs, benchmark, decontaminate.SAMPLE))
    found = set()
    for at, text in enumerate(texts):
        words = word_hashes([text.encode()])[0]
        _, item, stride, _ = block.candidates(words, np.array([0, len(words)]))
        for i, s in zip(item.tolist(), stride.tolist()):
            n = int(block.lengths[i])
            a, b = max(0, s * decontaminate.STRIDE - n), (s + 2) * decontaminate.STRIDE + n
            if block.check(i, words[a:b]):
                found.add((at, i))
    recall = len(want & found) / len(want)
    print(f"recall of the latent search alone: {recall:.3f} of {len(want)}")
    assert len(want) >= 40 and recall >= 0.9


def test_every_passage_of_every_document_shapes_the_space(spark):
    texts = [" ".join(prose(150) + [f"late{n}of{at}" for n in range(16)]) for at in range(30)] + ["", None, "short text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame([(0, " ".join(prose(20)))], "item_id long, text string")
    rows = decontaminate._bucket_rows(docs)
    idf = decontaminate.inverse_frequencies(*decontaminate.document_frequencies(rows))
    sums = decontaminate.signed_sums(rows, idf)
    lengths = [len(word_hashes([(text or "").encode()])[0]) for text in texts]
    assert sums.count() == decontaminate.SUMS
    assert sums.agg({"n": "sum"}).first()[0] == sum(len(decontaminate.windows_of(n)) for n in lengths)
    # Words at the end of any document are known, however few documents a sample would have.
    _, basis = decontaminate.latent_space(docs, benchmark, 1)
    last = decontaminate._bucket(word_hashes([text.encode() for text in texts[:30]])[0][lengths[0] - 1 :: lengths[0]])
    assert (np.abs(basis[last]).max(1) > 0).all()


def test_few_passages_stay_apart_and_sums_hold_all():
    idf = 1 + rng.random(decontaminate.BUCKETS).astype(np.float32)
    texts = [" ".join(prose(n)).encode() for n in (100, 5, 0, 16, 17, 33)]
    words, owner, _, _ = word_hashes(texts)
    buckets, ends = decontaminate._bucket(words), np.searchsorted(owner, np.arange(len(texts) + 1))
    made = decontaminate._Sums(idf, 3)
    made.add(buckets, ends)
    want = []
    for a, b in zip(ends[:-1], ends[1:]):
        for low, high in decontaminate.windows_of(int(b - a)):
            own = buckets[a + low : a + high]
            want.append(np.bincount(own, idf[own], decontaminate.BUCKETS) / np.sqrt((idf[own] ** 2).sum()))
    assert made.n == len(want) <= decontaminate.SUMS
    got = made.sums[: made.n] * np.sign(made.sums[: made.n].sum(1, keepdims=True))
    assert np.allclose(got, want, atol=1e-5)
    # Beyond that each sum has every so many-th passage, with a sign.
    for _ in range(40):
        made.add(buckets, ends)
    assert made.n == 41 * len(want)
    assert np.abs(made.sums).sum() > np.abs(want).sum()


def test_orthonormal_columns_and_zeros_for_dependent_ones():
    p = rng.standard_normal((500, 6)).astype(np.float32) * 10.0 ** -np.arange(6)
    q = decontaminate.orthonormal(p.astype(np.float32))
    assert np.allclose(q.T @ q, np.eye(6), atol=1e-5)
    p[:, 3:] = p[:, :3]
    q = decontaminate.orthonormal(p.astype(np.float32))
    assert np.allclose(np.sort(np.diag(q.T @ q)), [0, 0, 0, 1, 1, 1], atol=1e-4)
    assert not decontaminate.orthonormal(np.zeros((50, 3), np.float32)).any()
