"""Steps that every line or document goes through run as generated code, and shuffle lines once."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF
from tallywright.functions.dates import ISO, safe_date
from tallywright.functions.text import fill
from tallywright.operators.mapping import (
    BROKEN_ITEM,
    PROBLEM_TEXTS,
    item_facts,
    judge_entries,
    judged_lines,
    with_item_findings,
)
from tallywright.operators.numbering import number_within
from tallywright.plans import tables

FIELD = "struct<value:string,content:string,confidence:double>"
ITEM = f"struct<Description:{FIELD},Quantity:{FIELD},UnitPrice:{FIELD},Amount:{FIELD}>"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_judged_without_calls_per_row(spark):
    def field(value):
        return None if value == "absent" else (value, value, 0.9)

    values = ("absent", None, "", "0", "-2", "3", "two", "1.005", "9e12", "NaN")
    rows = [
        (n, n + 1, tuple(field(x) for x in ("Part" if n % 7 else values[n % 3], a, b, c)))
        for n, (a, b, c) in enumerate((a, b, c) for a in values for b in values for c in values)
    ]
    items = spark.createDataFrame([*rows, (-1, None, None)], f"key int, position int, item {ITEM}")
    judged = judged_lines(items)
    assert "lambda" not in plan_of(judged)
    entry = F.array(F.struct("position", "item"))
    want = items.select("key", F.inline_outer(judge_entries(entry)))
    assert judged.columns == want.columns
    shown = [F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in want.columns))]
    assert sorted(judged.select(*shown).collect()) == sorted(want.select(*shown).collect())


def test_plain_dates_are_read_as_by_the_pattern(spark):
    texts = [None, "", "2024-02-29", "2023-02-29", "2024-2-9", " 2024-02-09", "2024-02-09 ", "2024-02-09\n"]
    texts += ["0000-01-01", "0001-01-01", "9999-12-31", "12024-01-01", "+12024-01-01", "2024-13-01", "2024-00-10"]
    texts += ["2024-02-09T10:00", "-2024-01-01", "٢024-01-01", "24-01-01", "1582-10-10", "epoch"]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    read = rows.select("text", safe_date(F.col("text")).alias("day"))
    assert "RLIKE" in plan_of(read)
    want = rows.select("text", F.try_to_date("text", ISO).cast("string").alias("day"))
    assert read.withColumn("day", F.col("day").cast("string")).collect() == want.collect()


def test_lines_are_shuffled_once_for_their_numbers(spark):
    """Whatever the cuts are, lines are sent only to the windows of their slices."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # as if all tables were large
    try:
        lines = spark.range(1000).select((F.col("id") % 10).alias("key"), "id")
        numbered = number_within(lines, "key", ["id"], slice_rows=50)
        assert plan_of(numbered).count("BroadcastHashJoin [key") == 2
        got = {(r.key, r.id): r.position for r in numbered.collect()}
    finally:
        spark.conf.set(name, before)
    assert got == {(n % 10, n): n // 10 + 1 for n in range(1000)}


def test_amounts_are_reported_without_sorting_lines_into_documents(spark):
    """Facts on items that are numbers combine in generated code; no list of findings is gathered."""
    plan = plan_of(tables.judged_documents(spark, SF).select("source_file", "reason", "subtotal"))
    lines = plan[plan.index("first_broken") :]
    assert "HashAggregate" in lines and "collect_list" not in plan and "quantity x unit_price" not in plan


def test_lists_of_flagged_items_are_gathered_from_flagged_lines(spark):
    """Of a written table: the same facts, and only rows with a finding go into a list."""
    rows = [(1, 1, 5.0, None, "", None, "differs"), (1, 2, 6.0, None, "", None, None)]
    rows += [(2, n, 1.0, None, "amount is out of range", "Line item: out", None) for n in (3, 2)]
    rows += [(3, 1, 1.0, "left out", "", None, None), (4, 1, 2.0, None, "", None, None), (None, 1, 1.0, "x", "", None, None)]
    names = "order_key long, position int, line_total decimal(18,6), skipped string, problems string, error string, mismatch string"
    judged = spark.createDataFrame([(r[0], r[1], Decimal(r[2]), *r[3:]) for r in rows], names).withColumns(
        {
            "is_skipped": F.col("skipped").isNotNull(),
            "l_suppkey": F.lit(7).cast("long"),
            "l_shipdate": F.lit("2024-01-01").cast("timestamp"),
            "l_extendedprice": F.lit(1.0),
        }
    )
    written = tables.facts_of_written(judged)
    filtered = plan_of(written).split("collect_list")[-1]
    assert "Filter" in filtered and "coalesce" in filtered
    got = with_item_findings(written.filter("order_key IS NOT NULL"))
    want = with_item_findings(tables.facts_of(judged).filter("order_key IS NOT NULL"))
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    by_key = {r.order_key: r for r in got.collect()}
    assert by_key[2].item_error == "Line item 2: amount is out of range"
    assert by_key[1].item_mismatches == ["differs"] and by_key[3].item_skips == ["left out"]
    assert by_key[4].item_error is None and by_key[4].item_mismatches == [] and by_key[4].n_items == 1


def test_first_broken_item_is_worded_as_its_own_error(spark):
    """Whatever the position and the problems, also where one position comes twice."""
    rows = [(n, p, text) for n, text in enumerate(PROBLEM_TEXTS) for p in (9, 2_000_000_000, -5, 0, 1)]
    rows += [(99, 1, PROBLEM_TEXTS[4]), (99, 1, PROBLEM_TEXTS[3]), (99, 2, PROBLEM_TEXTS[0])]
    judged = spark.createDataFrame(rows, "key int, position int, problems string").withColumns(
        {
            "error": fill(BROKEN_ITEM, position=F.col("position"), problems=F.col("problems")),
            "is_skipped": F.lit(False),
            "line_total": F.lit(None).cast("decimal(18,6)"),
            "skipped": F.lit(None).cast("string"),
            "mismatch": F.lit(None).cast("string"),
        }
    )
    facts = {r.key: r.item_error for r in item_facts(judged, "key").collect()}
    assert facts.pop(99) == f"Line item 1: {PROBLEM_TEXTS[3]}"
    assert facts == {n: f"Line item -5: {text}" for n, text in enumerate(PROBLEM_TEXTS)}
