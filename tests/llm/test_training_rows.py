"""The learners' sample stays bounded when one doc_id has many rows."""

from tallywright.llm import toxicity


def test_a_repeated_doc_id_trains_once(spark):
    ids = [n for n in range(60) for _ in range(200 if n == 7 else 1)]
    docs = spark.createDataFrame([(n, f"text {at}") for at, n in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(60)], "doc_id long, toxic int")
    rows, _ = toxicity.training_rows(docs, labels)
    keys = [r.doc_id for r in rows.collect()]
    want = labels.filter(toxicity.fold(labels["doc_id"]) != 1).collect()
    assert sorted(keys) == sorted(r.doc_id for r in want) and 7 in keys
