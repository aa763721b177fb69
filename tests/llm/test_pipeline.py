"""The pipeline's stages take effect one after another, and the queries with SQL agree with it."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from tallywright.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns and 0 < docs.count() <= n
        n = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == n


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = duck.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    mine = QUERIES[name](spark, SF)
    assert sorted(mine.columns) == sorted(names)
    assert sorted(map(tuple, mine.select(names).collect())) == sorted(cursor.fetchall())
