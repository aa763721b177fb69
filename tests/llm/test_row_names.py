"""Rows keep their names however the files are split between two reads."""

from collections import Counter

import pytest

from tallywright.llm.exact import without_copies
from tallywright.llm.simhash import fingerprint, without_near_copies
from tallywright.llm.tasks import FILE, PLACE, drop_rows, named

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.fixture
def folder(spark, tmp_path):
    """Six files; every text has a copy, and every third one a near copy, in another file."""
    texts = []
    for n in range(120):
        words = [f"w{n}x{k}" for k in range(60)]
        texts += [" ".join(words)] * 2
        if n % 3 == 0:
            texts.append(" ".join(words[:-1]) + " other")
    rows = [(n, text, "x") for n, text in enumerate(texts)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(6).write.parquet(path)
    return path


def components(texts):
    """How many classes of linked fingerprints the texts have."""
    fps = sorted({fingerprint(text) for text in texts})
    label = {fp: fp for fp in fps}
    for _ in fps:
        for a in fps:
            label[a] = min(label[b] for b in fps if (a ^ b).bit_count() <= 3)
    return len(set(label.values()))


@pytest.mark.parametrize("operator", [without_copies, without_near_copies])
@pytest.mark.parametrize("first, second", [(2, 8), (8, 2), (1, 40)])
def test_other_splits_between_build_and_run(spark, folder, operator, first, second):
    given = {r.text for r in spark.read.parquet(folder).collect()}
    distinct = len(given) if operator is without_copies else components(given)
    try:
        spark.conf.set(SPLITS, first)
        kept = operator(spark.read.parquet(folder))
        spark.conf.set(SPLITS, second)
        texts = Counter(r.text for r in kept.collect())
    finally:
        spark.conf.unset(SPLITS)
    assert len(texts) == distinct and set(texts.values()) == {1}
    assert kept.columns == ["doc_id", "text", "row"]


def test_names_of_rows_that_are_no_file_rows(spark, folder):
    """Two tables in one, or rows made of rows: file and place would not be unique, so they are written."""
    docs = spark.read.parquet(folder)
    for df in (docs.union(docs), docs.crossJoin(spark.range(2)), spark.createDataFrame(docs.collect(), docs.schema)):
        names = named(df)
        assert names.select(FILE, PLACE).distinct().count() == df.count()
        first = names.filter("doc_id = 0").limit(1)
        assert drop_rows(names, first).count() == df.count() - 1
    chosen = named(docs.filter("doc_id > 9").select("text"))
    assert chosen.select(FILE, PLACE).distinct().count() == chosen.count()
