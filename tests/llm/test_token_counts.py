"""Token counts against the library, text by text."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywright.llm import token_counts
from tallywright.llm.queries import QUERIES
from tallywright.llm.tokens import vocabulary_path

SF = "/root/testdata/sf0.001"
PATH = vocabulary_path(token_counts.VOCABULARY)

TEXTS = [
    None,
    "",
    "   \n\t ",
    "Don't STOP, it's 12 o'clock; we'll see'em'S",
    "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|endoftext|>",
    "Élan vital, naïve café é ﬁ Straße ẞ İstanbul ΑΣ ΌΣΟΣ Σ",
    "中文字符 한국어 한 ひらがな \U0001f600‍\U0001f468 a b\u0085c\u001cd e",
    "x" * 3000,
    "the the the " * 4000,
    "!!??__--'''s'''t 1234567890 ²½Ⅷ٣",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_registered_query_on_the_whole_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op12_token_counts"](spark, SF).collect()
    want = [(i, len(t.encode()), n := library(t), n > 2048) for i, t in texts.items()]
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_odd_texts(spark, library):
    rows = [(n, text, "x", 7) for n, text in enumerate(TEXTS)] + [(None, "no id", "y", 1), (3, "one id twice", "z", 1)]
    df = spark.createDataFrame(rows * 3, "doc_id long, text string, n_bytes string, n_tokens int").repartition(4)
    found = token_counts.token_counts(df).collect()
    want = [(i, len((t or "").encode()), library(t)) for i, t, _, _ in rows * 3]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(df).collect() == []
    assert token_counts.frequent_lengths(df, PATH) == {}


def test_every_character_beside_others(library):
    """Every letter, mark, space and digit up to U+33FF and some beyond, between others."""
    counter = token_counts.TokenCounter(PATH)
    letters = [chr(c) for c in [*range(0x3400), *range(0x4E00, 0x4E40), *range(0xAC00, 0xAC40), 0x1F600, 0x10400, 0xFEFF]]
    for frame in ("a{}b", "{0}'s x{0}", "1{0}2 {0}{0}é", "!{0}_a{0}'ll"):
        for letter in letters:
            text = frame.replace("{0}", letter).replace("{}", letter)
            assert counter.count(text) == library(text), repr(text)


def test_mixed_characters(library):
    counter, random_ = token_counts.TokenCounter(PATH, remembered=50), random.Random(3)
    letters = "abcXYZ  '\"!?_.,0123sStTmMdDlLrReEvV\n\t éñßÄΣσ½²<|>-…中"
    for _ in range(3000):
        text = "".join(random_.choices(letters, k=random_.randint(0, 25)))
        assert counter.count(text) == library(text), repr(text)


def test_tables_change_no_count(library):
    """Nothing known, everything known, and a cache of two entries give the same counts."""
    text = TEXTS[3] + " " + TEXTS[5]
    pieces = token_counts.PRE_TOKEN.findall(TEXTS[3].lower())
    table = {piece: library(piece) for piece in pieces}
    for counter in (
        token_counts.TokenCounter(PATH),
        token_counts.TokenCounter(PATH, table),
        token_counts.TokenCounter(PATH, table, remembered=2),
        token_counts.TokenCounter(PATH, {}, remembered=1),
    ):
        assert [counter.count(t or "") for t in (text, *TEXTS) * 2] == [library(t) for t in (text, *TEXTS) * 2]
        assert len(counter.lengths) <= len(counter.lengths.frequent) + counter.lengths.remembered


def test_the_table_holds_the_frequent_words(spark, library):
    df = spark.createDataFrame([(1, "one two two three three three " * 50), (2, None)], "doc_id long, text string")
    df = df.union(spark.range(200).select("id", F.concat(F.lit("three rare"), "id"))).repartition(6)
    table = token_counts.frequent_lengths(df, PATH, entries=2)
    assert table == {"three": library("three"), "rare": library("rare")}


def test_no_pre_token_is_shuffled(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = token_counts.token_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
