"""Registered queries without SQL, on the whole small tables, against brute force of their contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tallywright.llm.queries import QUERIES
from tallywright.llm.tokens import encoder, vocabulary_path
from test_operators import assert_without_repeats, base_spans, brute_fingerprint, unsigned

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op5(spark, texts):
    want = {key: brute_fingerprint(text) for key, text in texts.items()}
    label = {key: key for key in want}
    changed = True
    while changed:
        changed = False
        for a in want:
            low = min(label[b] for b in want if (want[a] ^ want[b]).bit_count() <= 3)
            changed |= low != label[a]
            label[a] = low
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in rows(spark, "op5_simhash")}
    assert got == {(key, f"{fp:016x}", label[key]) for key, fp in want.items()}


def test_op7(spark, texts):
    found = {r.doc_id: r for r in rows(spark, "op7_secret_scan")}
    assert found.keys() == texts.keys()
    for key, text in texts.items():
        base, row = base_spans(text), found[key]
        kinds = Counter(span.split(":")[0] for span in base)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds[k] for k in ("assign", "access", "hex"))
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = row.spans.split(",") if row.spans else []
        assert set(base) <= set(spans) and [s for s in spans if not s.startswith("token:")] == base
        assert spans == sorted(spans, key=lambda s: int(s.split(":")[1])) or len({s.split(":")[1] for s in spans}) < len(spans)


def test_op8(spark, texts):
    tokenizer = encoder(vocabulary_path()).tokenizer
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op8_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == texts.keys()
    for key, text in texts.items():
        ids, at = tokenizer.encode(text, add_special_tokens=False).ids + [0], 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(unsigned(ids[r.start : at]))
        assert at == len(ids)
    total = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        total += end if end & (end - 1) == 0 else 1024
    assert total <= 1.02 * sum(r.length for parts in pieces.values() for r in parts)


def test_op9(spark, texts):
    assert_without_repeats(rows(spark, "op9_suffix_dedup"), [(key, text.encode()) for key, text in texts.items()])


def subsequence(a, b):
    """Length of the longest common subsequence, row by row."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for at, y in enumerate(b, 1):
            before, row[at] = row[at], before + 1 if x == y else max(row[at], row[at - 1])
    return row[-1]


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())


def test_op10(spark, texts):
    """Every item found word for word is a pair, and every pair holds most of its item and its answer in order."""
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r.covered for r in rows(spark, "op10_decontamination")}
    split = {key: words(text) for key, text in texts.items()}
    joined = {key: b" " + b" ".join(text) + b" " for key, text in split.items()}
    verbatim = {(k, i) for k, text in joined.items() for i, item in items.items() if item and b" " + b" ".join(item) + b" " in text}
    assert verbatim and verbatim <= found.keys()
    for (key, item_id), covered in found.items():
        item = items[item_id]
        assert subsequence(item, split[key]) >= round(covered * len(item)) >= 0.6 * len(item) - 1e-6
        answer = item[-max(3, len(item) // 4) :]
        assert subsequence(answer, split[key]) >= 0.5 * len(answer)
