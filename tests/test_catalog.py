"""Every registered query against its SQL, and items in documents against items in rows."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tallywright.operators.mapping import item_facts_in_place, map_header
from tallywright.plans import tables
from tallywright.plans.batch import judge
from tallywright.plans.catalog import QUERIES
from tallywright.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events documents conversations"


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(round(value, 9))
    return "null" if value is None else repr(value)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(names)
    mine = sorted(tuple(comparable(v) for v in row) for row in result.select(names).collect())
    assert mine == sorted(tuple(comparable(v) for v in row) for row in cursor.fetchall())


def test_items_in_documents_equal_items_in_rows(spark):
    """The same rules over arrays and over rows, on the fixture's small documents."""
    as_of = F.lit(tables.AS_OF).cast("date")
    rows = tables.judged_documents(spark, SF)
    numbered = tables.raw_items(tables.priced_lines(spark, SF))
    gathered = numbered.groupBy("order_key").agg(
        F.array_sort(F.collect_list(F.struct("position", "item"))).alias("raw")
    )
    headers = tables.header_documents(spark, SF).join(gathered, "order_key", "left")
    raw = F.transform("raw", lambda entry: entry["item"])
    nested = judge(map_header(item_facts_in_place(headers, raw)), as_of)

    columns = [
        *("source_file", "stage", "reason", "n_items", "extraction_warnings", "n_new_warnings"),
        *("validation_issues", "validation_status"),
    ]
    total = F.coalesce("items_sum", F.lit(0).cast("decimal(38,6)")).alias("items_sum")
    left, right = (df.select(*columns, total) for df in (rows, nested))
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    assert nested.select(F.sum("n_items")).first() == nested.select(F.sum(F.size("line_items"))).first()
