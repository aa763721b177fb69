"""Invoices made from trade tables (orders, lineitem, …), with a fixed share broken on purpose.

The rules are written down in FIXTURES.md. Items stay one row each; a document only ever receives
sums, counts and its flagged items, so an order holding a third of all lines is no special case.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import iso
from ..functions.text import fill, padded
from .. import fixed
from ..operators.intake import SIGNATURE, suffix, triage, unopenable_detail
from ..operators.mapping import (
    STORED,
    flagged_items,
    item_aggregates,
    item_counters,
    judged_lines,
    map_header,
    with_item_findings,
)
from ..operators.numbering import number_within
from ..operators.outcome import reject_taken_numbers
from ..operators.uniqueness import mark_first
from ..shared import stage
from ..sources.assembly import vat_of
from ..sources.responses import reject_unanswered
from .batch import intake_verdict, judge

AS_OF = "2006-01-01"
SHIFT_DAYS = 1826
CENTS = "decimal(18,2)"
# Sums of any number of lines; what no invoice can hold is rejected later, by reason.
WIDE = "decimal(30,2)"
# What an item has besides what its document takes from it.
UNSUMMED = ("description", "quantity", "unit_price")

# What orders the lines of an order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(n: int) -> Column:
    """True for the orders whose key is a multiple of `n`."""
    return F.col("order_key") % n == 0


def as_field(value: Column, confidence: Column | None = None) -> Column:
    text = value.cast("string")
    return F.struct(
        text.alias("value"),
        text.alias("content"),
        (F.lit(0.9) if confidence is None else confidence).alias("confidence"),
    )


def source_file() -> Column:
    return F.concat(
        F.lit("inv-"),
        padded(F.col("order_key")),
        F.when(every(151), ".txt").otherwise(".pdf"),
    )


def invoice_number() -> Column:
    key = F.col("order_key")
    return F.concat(F.lit("RE-"), F.when(every(97) & (key > 0), key - 1).otherwise(key))


def shifted(day: Column) -> Column:
    return F.date_add(day.cast("date"), F.when(every(89), 0).otherwise(SHIFT_DAYS))


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), *LINE_ORDER
    )


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line rows with their position inside the order."""
    return number_within(trade_lines(spark, sf_dir), "order_key", LINE_ORDER)


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered lines with the part's list price."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_retailprice"
    )
    return numbered_lines(spark, sf_dir).join(parts, "l_partkey", "left")


def raw_items(numbered: DataFrame) -> DataFrame:
    """The item fields as an analysis would have reported them."""
    position = F.col("position")
    listed_price = (position == 1) & (every(13) | every(139))
    quantity = F.when(every(139) & (position == 1), 0.0).otherwise(F.col("l_quantity"))
    item = F.struct(
        F.when(~every(29), as_field(F.concat(F.lit("Part "), F.col("l_partkey")))).alias(
            "Description"
        ),
        F.when(~(every(43) & (position >= 3)), as_field(quantity)).alias("Quantity"),
        F.when(listed_price, as_field(F.col("p_retailprice"))).alias("UnitPrice"),
        F.when(~(every(41) & (position == 2)), as_field(F.col("l_extendedprice"))).alias("Amount"),
    )
    return numbered.withColumn("item", item)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One judged row per item."""
    return judged_lines(raw_items(priced_lines(spark, sf_dir)))


def order_facts(first_supplier: Column) -> dict[str, Column]:
    """What a document takes from its line rows besides the item rules."""
    price = F.col("l_extendedprice").try_cast(CENTS)
    # A line beyond its type makes the sum unknown; it is not left out of it.
    whole = F.count(price) == F.count("l_extendedprice")
    return {
        "n_lines": F.count("*"),
        "lines_sum": F.when(whole, F.sum(price)).cast(WIDE),
        "first_ship": F.min("l_shipdate"),
        "first_supplier": first_supplier,
    }


def headers(
    spark: SparkSession,
    sf_dir: str,
    facts: DataFrame,
    customers: bool = False,
) -> DataFrame:
    """One document per order with its `fields`, joined to `facts` by order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(
            table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        .select(F.col("s_suppkey").alias("first_supplier"), "s_name", "n_name")
    )
    # As many facts as orders: never a side to broadcast, and already partitioned by order.
    documents = orders.join(facts.hint("merge"), "order_key", "left")
    documents = documents.join(suppliers, "first_supplier", "left")
    customer_name = customer_nation = F.lit(None).cast("string")
    if customers:
        nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("c_nation"))
        known = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        known = known.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nation")
        documents = documents.join(known, "o_custkey", "left")
        customer_name, customer_nation = F.col("c_name"), F.when(~every(3), F.col("c_nation"))

    none = F.col("n_lines").isNull()
    invoice_date = shifted(F.col("o_orderdate"))
    due_date = (
        F.when(every(7), None)
        .when(every(11), shifted(F.col("first_ship")))
        .otherwise(F.date_add(invoice_date, 14))
    )
    residue = F.col("order_key") % 20
    rate = (
        F.when(residue == 0, "0.35")
        .when(residue == 1, "0.00")
        .when(residue.isin(2, 3), "0.07")
        .when(residue != 4, "0.19")
        .cast("decimal(3,2)")
    )
    documents = documents.withColumn("tax", vat_of(F.col("lines_sum"), rate).cast(WIDE))
    extra = F.when(every(23), "1.00").when(every(31), "0.01").otherwise("0.00").cast(CENTS)
    gross = F.col("lines_sum") + F.coalesce("tax", F.lit(0).cast(WIDE)) + extra
    total = (
        F.when(none, F.col("o_totalprice").try_cast(CENTS))
        .when(every(101), -gross)
        .otherwise(gross)
        .cast("string")
    )
    others = F.lit(0.9) + (F.col("order_key") % 10) / F.lit(100.0)
    tax_id = F.concat(F.lit("DE"), padded(F.col("first_supplier")))

    fields = {
        "InvoiceId": as_field(invoice_number(), F.when(~every(19), 0.9)),
        "InvoiceDate": as_field(iso(invoice_date), others),
        "VendorName": F.when(
            ~every(113), as_field(F.when(none, "Supplier#none").otherwise(F.col("s_name")), others)
        ),
        "InvoiceTotal": as_field(F.when(every(127), "n/a").otherwise(total), others),
        "DueDate": F.when(due_date.isNotNull(), as_field(iso(due_date))),
        "VendorAddress": as_field(
            F.coalesce("n_name", F.lit("none")), F.when(every(37), 0.5).otherwise(0.9)
        ),
        "VendorTaxId": F.when(~none, as_field(tax_id)),
        "CustomerName": F.when(customer_name.isNotNull(), as_field(customer_name)),
        "CustomerAddress": F.when(customer_nation.isNotNull(), as_field(customer_nation)),
        "SubTotal": F.when(~none, as_field(F.col("lines_sum"))),
        "TotalTax": F.when(F.col("tax").isNotNull(), as_field(F.col("tax"))),
    }
    return documents.withColumns(
        {
            "source_file": source_file(),
            "order_time": F.col("o_orderdate").cast("timestamp"),
            "fields": F.struct(*(column.alias(name) for name, column in fields.items())),
        }
    ).drop("s_name", "n_name", "c_name", "c_nation", "o_custkey", "o_totalprice", "o_orderdate", "tax")


def named(documents: DataFrame) -> DataFrame:
    """The intake verdict these documents can have: a wrong file name."""
    ending = suffix(F.col("source_file"))
    wrong = F.lower(ending) != ".pdf"
    return documents.withColumns(
        {
            "stage": F.when(wrong, "preprocessing"),
            "reason": F.when(wrong, fill(fixed.WRONG_EXTENSION, suffix=ending)),
        }
    )


def header_documents(spark: SparkSession, sf_dir: str, customers: bool = False) -> DataFrame:
    """Documents for rules that look at no single item: lines are only summed, not numbered."""
    first_line = F.min(F.struct(*LINE_ORDER[:3]))
    aggregates = order_facts(first_line["l_suppkey"])
    facts = trade_lines(spark, sf_dir).groupBy("order_key").agg(
        *(column.alias(name) for name, column in aggregates.items())
    )
    return named(headers(spark, sf_dir, facts, customers))


def fact_aggregates(items: dict[str, Column]) -> list[Column]:
    first_supplier = F.max(F.when(F.col("position") == 1, F.col("l_suppkey")))
    return [column.alias(n) for n, column in (order_facts(first_supplier) | items).items()]


def facts_of(judged: DataFrame) -> DataFrame:
    """All facts of an order in one aggregation; unused ones are pruned by the optimizer."""
    return judged.groupBy("order_key").agg(*fact_aggregates(item_aggregates()))


def facts_of_written(judged: DataFrame) -> DataFrame:
    """The same of a written table, which can be read twice: numbers of all lines, lists of flagged ones."""
    facts = judged.groupBy("order_key").agg(*fact_aggregates(item_counters()))
    # Both are by order, and so is what they are joined to next.
    return facts.join(flagged_items(judged, "order_key").hint("merge"), "order_key", "left")


def written_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Judged lines, written once with what documents take from them, and with `more` columns."""
    needed = ("order_key", "l_suppkey", "l_shipdate", "l_extendedprice", "position", "line_total", "is_skipped")
    texts = ("problems", "skipped", "error", "mismatch")
    return stage(lines(spark, sf_dir).select(*needed, *texts, *more), "judged-lines", dictionary=False)


def judged_documents(
    spark: SparkSession, sf_dir: str, customers: bool = False, judged: DataFrame | None = None
) -> DataFrame:
    """All documents with warnings, reasons, issues and status, before numbers compete.

    `judged` is the lines' table once written, where there is one.
    """
    facts = facts_of(lines(spark, sf_dir)) if judged is None else facts_of_written(judged)
    documents = with_item_findings(named(headers(spark, sf_dir, facts, customers)))
    return judge(map_header(documents), F.lit(AS_OF).cast("date"))


def responses(spark: SparkSession, sf_dir: str, judged: DataFrame | None = None) -> DataFrame:
    """What the analysis would record per order: its fields, and facts on its items.

    `judged` is the lines' table once written, where there is one; for this alone it is not worth writing.
    """
    items = facts_of(lines(spark, sf_dir)) if judged is None else facts_of_written(judged)
    documents = headers(spark, sf_dir, items, customers=True)
    facts = ("n_items", "items_sum", "first_broken", "flagged_items")
    return documents.select("source_file", "order_key", "fields", *facts, "order_time")


def recorded_responses(spark: SparkSession, sf_dir: str, judged: DataFrame | None = None) -> DataFrame:
    """`responses`, written once."""
    return stage(responses(spark, sf_dir, judged), "responses", dictionary=False)


def judge_recorded(documents: DataFrame) -> DataFrame:
    """`evaluate` for documents with recorded fields and item facts."""
    mapped = map_header(with_item_findings(reject_unanswered(documents)))
    return judge(mapped, F.lit(AS_OF).cast("date"))


def item_rows(judged: DataFrame) -> DataFrame:
    """Items of all documents as rows: `source_file`, `order_key` and the stored columns."""
    kept = judged.filter(~F.col("is_skipped"))
    return kept.withColumn("source_file", source_file()).select("source_file", "order_key", *STORED)


def order_files(orders: DataFrame) -> DataFrame:
    """Document files, one per order, with the facts that triage looks at."""
    head = F.encode(F.when(every(149), "GIF89a").otherwise(f"{SIGNATURE}1.7"), "ISO-8859-1")
    files = orders.withColumn("order_key", F.col("o_orderkey")).select(
        source_file().alias("source_file"),
        F.col("o_orderdate").cast("timestamp").alias("file_time"),
        F.lit(True).alias("on_disk"),
        unopenable_detail(F.lit(4096), head).alias("open_error"),
        F.when(every(163), 0).otherwise(1).alias("page_count"),
        every(157).alias("is_encrypted"),
        F.lit(True).alias("has_text_layer"),
    )
    return intake_verdict(triage(files), F.col("file_time"))


def decided_documents(
    spark: SparkSession, sf_dir: str, *columns: str, customers: bool = False, judged: DataFrame | None = None
) -> DataFrame:
    """After the competition for invoice numbers: final stage and reason, plus `columns`.

    The judged documents are staged with these columns alone: the competition reads two of them,
    and looks up contested numbers only, without numbering and judging every line twice.
    """
    needed = dict.fromkeys(("source_file", "invoice_number", "stage", "reason", *columns))
    documents = judged_documents(spark, sf_dir, customers, judged).select(*needed)
    return reject_taken_numbers(mark_first(documents))


def stored_documents(
    spark: SparkSession, sf_dir: str, *columns: str, customers: bool = False, judged: DataFrame | None = None
) -> DataFrame:
    decided = decided_documents(spark, sf_dir, *columns, customers=customers, judged=judged)
    return decided.filter(F.col("reason").isNull())


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the stored documents: `source_file, invoice_number` and the item columns."""
    judged = written_lines(spark, sf_dir, *UNSUMMED)
    items = judged.filter(~F.col("is_skipped")).select("order_key", *STORED)
    parents = stored_documents(spark, sf_dir, "order_key", judged=judged)
    return items.join(
        parents.select("order_key", "source_file", "invoice_number"), "order_key"
    ).drop("order_key")
