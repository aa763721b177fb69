"""The registered queries: every operator over the whole given tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed
from ..functions import dates, money
from ..functions.text import clean_text as collapse_spaces, fill, joined
from ..operators import audit, intake, outcome, reporting
from ..operators.crosscheck import grand_total_mismatch, item_sum_mismatch
from ..operators.mapping import fields_read, judged_lines, map_header
from ..operators.uniqueness import mark_first
from ..shared import scratch_folder, stage, staging
from ..sources.assembly import document_totals
from ..sources.responses import first_document, parse_responses
from ..sources.store import as_text, derive_line_items, read_line_items, read_outcomes, stored_audit
from ..streaming.arrivals import joined_arrivals, retry_rejects, store_arrivals
from . import conversations, tables
from .batch import commit_run
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def amount(value: Column | str) -> Column:
    """Output form of a money column."""
    column = F.col(value) if isinstance(value, str) else value
    return column.cast("decimal(18,2)").cast("double")


def out_price(value: Column) -> Column:
    return F.bround(value, 8).cast("double")


# Documents and items from trade tables.


@query
def assemble_invoices(spark, sf_dir):
    prices = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_retailprice"
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    totals = document_totals(
        lines.join(prices, "l_partkey"), "l_orderkey", "l_quantity", "p_retailprice"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    date = F.col("o_orderdate").cast("date")
    totals = totals.hint("merge")
    return orders.join(totals, orders.o_orderkey == totals.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_key"),
        dates.iso(date).alias("invoice_date"),
        dates.iso(dates.due_date_of(date)).alias("due_date"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        amount("subtotal").alias("subtotal"),
        amount("vat_amount").alias("vat_amount"),
        amount("total_amount").alias("total_amount"),
    )


def _item_rows(items: DataFrame) -> DataFrame:
    return items.select(
        "source_file",
        "position",
        "description",
        "quantity",
        out_price(F.col("unit_price")).alias("unit_price"),
        amount("line_total").alias("line_total"),
    )


@query
def line_items_flat(spark, sf_dir):
    return _item_rows(tables.stored_lines(spark, sf_dir))


@query
def price_backfill(spark, sf_dir):
    usable = tables.lines(spark, sf_dir).filter(~F.col("is_skipped") & (F.col("problems") == ""))
    return _item_rows(usable.withColumn("source_file", tables.source_file()))


# Mapping.


@query
def map_fields(spark, sf_dir):
    headers = tables.header_documents(spark, sf_dir, customers=True)
    response = F.struct(F.array(F.struct("fields")).alias("documents"))
    recorded = headers.select("source_file", "stage", "reason", F.to_json(response).alias("json"))
    mapped = map_header(first_document(parse_responses(recorded, "json")))
    return mapped.select(
        "source_file",
        "invoice_number",
        dates.iso("invoice_date").alias("invoice_date"),
        dates.iso("due_date").alias("due_date"),
        "vendor_name",
        "vendor_address",
        "vendor_tax_id",
        "vendor_iban",
        "customer_name",
        "customer_address",
        amount("subtotal").alias("subtotal"),
        amount("vat_amount").alias("vat_amount"),
        amount("total_amount").alias("total_amount"),
    )


def _mapped(spark, sf_dir) -> DataFrame:
    return map_header(tables.header_documents(spark, sf_dir))


@query
def required_fields(spark, sf_dir):
    return (
        _mapped(spark, sf_dir)
        .filter(F.col("missing_fields").isNotNull())
        .select(
            "source_file",
            fill(fixed.MISSING_REQUIRED, fields=F.col("missing_fields")).alias("reason"),
        )
    )


@query
def confidence(spark, sf_dir):
    mean = F.col("confidence_mean")
    return _mapped(spark, sf_dir).select(
        "source_file",
        "confidence_score",
        (mean < fixed.CONFIDENCE_THRESHOLD).alias("is_low"),
        F.coalesce("address_warning", F.lit("")).alias("address_warning"),
    )


@query
def vat_rate(spark, sf_dir):
    return _mapped(spark, sf_dir).select(
        "source_file", F.round("vat_rate", 6).alias("vat_rate")
    )


@query
def skip_items(spark, sf_dir):
    facts = tables.judged_documents(spark, sf_dir)
    nothing = F.when(F.col("n_items") == 0, fixed.NO_ITEMS_EXTRACTED)
    found = F.concat(F.col("item_skips"), F.array_compact(F.array(nothing)))
    return facts.filter(F.size(found) > 0).select(
        "source_file", "n_items", joined(found).alias("warnings")
    )


@query
def model_rejects(spark, sf_dir):
    return (
        tables.judged_documents(spark, sf_dir)
        .filter(F.col("stage") == "unexpected")
        .select("source_file", outcome.full_reason().alias("reason"))
    )


@query
def item_constraints(spark, sf_dir):
    """What no stored item may have, one line of an order after the other: empty descriptions, missing,
    unreadable and negative quantities, prices out of range."""
    key, quantity = F.col("order_key"), F.col("l_quantity").cast("string")
    amount_text = F.col("l_extendedprice").cast("string")
    written = F.when(key % 7 == 0, "two").when(key % 11 == 0, F.concat(F.lit("-"), quantity)).otherwise(quantity)
    item = F.struct(
        tables.as_field(F.when(key % 3 == 0, "").otherwise("Part")).alias("Description"),
        tables.as_field(F.when(key % 5 != 0, written)).alias("Quantity"),
        tables.as_field(F.when(key % 13 == 0, "2000000000").otherwise(amount_text)).alias("UnitPrice"),
        tables.as_field(amount_text).alias("Amount"),
    )
    rows = tables.trade_lines(spark, sf_dir).select(key, F.col("l_linenumber").alias("position"), item.alias("item"))
    broken = judged_lines(rows).filter(F.col("error").isNotNull())
    return broken.select("order_key", "position", F.col("error").alias("reason"))


@query
def json_fields(spark, sf_dir):
    """Responses as JSON text around each event's own JSON: one document, none, or broken text."""
    key, props = F.col("event_id"), F.col("props")
    total = F.concat(F.lit('{"fields":{"InvoiceTotal":{"value":"'), F.get_json_object(props, "$.k"))
    document = F.concat(total, F.lit('","confidence":0.9}}}'))
    response = (
        F.when(key % 7 == 0, '{"documents":[]}')
        .when(key % 11 == 0, F.concat(F.lit('{"documents":['), document))
        .when(key % 5 == 0, F.concat(F.lit('{"documents":['), document, F.lit(","), document, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"documents":['), document, F.lit("]}")))
    )
    none = F.lit(None).cast("string")
    recorded = table(spark, sf_dir, "events").select(
        "event_id", none.alias("stage"), none.alias("reason"), response.alias("json")
    )
    read = first_document(parse_responses(recorded, "json"))
    return read.select(
        "event_id",
        F.when(
            F.col("reason").isNull(), amount(money.safe_decimal(F.col("fields.InvoiceTotal.value")))
        ).alias("total_amount"),
        F.coalesce(outcome.full_reason(), F.lit("")).alias("reason"),
    )


@query
def currency_values(spark, sf_dir):
    """One response per order line: amounts as objects and items under `value`, or both plain.

    Every 13th order has an object without an amount.
    """
    nested = F.col("l_linenumber") % 2 == 1

    def written(value: str) -> Column:
        text = F.when(F.col("l_orderkey") % 13 == 0, "null").otherwise(F.col(value).cast("string"))
        return F.when(nested, F.concat(F.lit('{"currency":"EUR","amount":'), text, F.lit("}"))).otherwise(text)

    item = F.format_string(
        '{"Quantity":{"value":%s},"Amount":{"value":%s}}', F.col("l_quantity").cast("string"), written("l_extendedprice")
    )
    items = F.when(nested, F.format_string('{"value":[{"value":%s}]}', item)).otherwise(F.format_string("[%s]", item))
    response = F.format_string(
        '{"documents":[{"fields":{"InvoiceTotal":{"value":%s},"Items":%s}}]}', written("o_totalprice"), items
    )
    none = F.lit(None).cast("string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rows = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    recorded = rows.select(
        "l_orderkey", "l_linenumber", none.alias("stage"), none.alias("reason"), response.alias("json")
    )
    read = first_document(parse_responses(recorded, "json"))
    first = F.try_element_at("fields.Items", F.lit(1))
    return read.select(
        "l_orderkey",
        "l_linenumber",
        F.size("fields.Items").alias("n_items"),
        amount(money.safe_decimal(F.col("fields.InvoiceTotal.value"))).alias("total_amount"),
        first["Quantity"]["value"].try_cast("double").alias("quantity"),
        amount(money.safe_decimal(first["Amount"]["value"])).alias("line_total"),
    )


# Cleaning and cross-checks.


@query
def clean_text(spark, sf_dir):
    """Runs of mixed spaces are put into every text first, then cleaned away again."""
    spaced = F.concat(F.lit("  "), F.replace(F.col("text"), F.lit(" "), F.lit("  \t ")), F.lit("\x1c\n"))
    cleaned = collapse_spaces(spaced)
    return table(spark, sf_dir, "documents").select(
        "doc_id", cleaned.alias("text"), F.length(cleaned).cast("bigint").alias("n_chars")
    )


@query
def line_total_check(spark, sf_dir):
    return (
        tables.lines(spark, sf_dir)
        .filter(F.col("mismatch").isNotNull())
        .select(
            tables.source_file().alias("source_file"), "position", F.col("mismatch").alias("warning")
        )
    )


@query
def grand_total_check(spark, sf_dir):
    return (
        _mapped(spark, sf_dir)
        .withColumn("warning", grand_total_mismatch())
        .filter(F.col("warning").isNotNull())
        .select("source_file", "warning")
    )


@query
def item_sum_check(spark, sf_dir):
    return (
        tables.judged_documents(spark, sf_dir)
        .withColumn("warning", item_sum_mismatch())
        .filter(F.col("warning").isNotNull())
        .select("source_file", "n_items", amount("items_sum").alias("items_sum"), "warning")
    )


def _accepted(spark, sf_dir) -> DataFrame:
    """Documents that passed intake and mapping."""
    return tables.judged_documents(spark, sf_dir).filter(F.col("reason").isNull())


@query
def warnings_ordered(spark, sf_dir):
    return _accepted(spark, sf_dir).select(
        "source_file",
        F.size("extraction_warnings").cast("bigint").alias("n_warnings"),
        F.col("n_new_warnings").cast("bigint").alias("n_new_warnings"),
        joined(F.col("extraction_warnings")).alias("extraction_warnings"),
    )


# Plausibility and outcome.


@query
def plausibility(spark, sf_dir):
    return _accepted(spark, sf_dir).select(
        "source_file",
        "validation_status",
        F.size("validation_issues").cast("bigint").alias("n_issues"),
        joined(F.col("validation_issues")).alias("validation_issues"),
    )


def _outcomes(spark, sf_dir) -> DataFrame:
    decided = tables.decided_documents(spark, sf_dir, "validation_status", "validation_issues")
    return outcome.outcomes(decided)


@query
def outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir).withColumn("n_issues", F.col("n_issues").cast("bigint"))


@query
def status_counts(spark, sf_dir):
    return outcome.summary(_outcomes(spark, sf_dir))


@query
def review_list(spark, sf_dir):
    listed = outcome.review_list(_outcomes(spark, sf_dir))
    return listed.withColumn("n_issues", F.col("n_issues").cast("bigint"))


@query
def failed_list(spark, sf_dir):
    return outcome.failed_list(_outcomes(spark, sf_dir))


# Uniqueness and stored tables.


@query
def dedup_batch(spark, sf_dir):
    columns = ("source_file", "invoice_number", "stage", "reason")
    judged = tables.judged_documents(spark, sf_dir).select(*columns)
    return (
        mark_first(judged)
        .filter(F.col("reason").isNull())
        .select("source_file", "invoice_number", "is_first")
    )


@query
def dedup_stored(spark, sf_dir):
    """All documents arrive while the numbers of every third order are stored already."""
    columns = ("order_key", "source_file", "invoice_number", "stage", "reason")
    judged = stage(tables.judged_documents(spark, sf_dir).select(*columns), "judged")
    stored = judged.filter(tables.every(3) & F.col("reason").isNull())
    return outcome.outcomes(
        outcome.reject_taken_numbers(mark_first(judged, stored)).withColumns(
            {
                "validation_status": F.lit("stored"),
                "validation_issues": F.array().cast("array<string>"),
            }
        )
    ).select("source_file", "outcome", F.coalesce("reason", F.lit("")).alias("reason"))


@query
def orphan_audit(spark, sf_dir):
    """Items of every order against the stored invoices: those of failed documents are strays."""
    key = F.col("order_key").alias("invoice_id")
    judged = tables.written_lines(spark, sf_dir)
    items = judged.select(key, "order_key", "position")
    invoices = tables.stored_documents(spark, sf_dir, "order_key", judged=judged).select(key)
    return audit.orphans(items, invoices).select(
        tables.source_file().alias("source_file"), "position"
    )


@query
def not_null_audit(spark, sf_dir):
    columns = tuple(n for n in audit.REQUIRED_INVOICE_COLUMNS if n != "validation_status")
    return audit.null_counts(_mapped(spark, sf_dir), columns)


@query
def joined_lists(spark, sf_dir):
    stored = tables.stored_documents(spark, sf_dir, "extraction_warnings", "validation_issues")
    return stored.select(
        "source_file",
        joined(F.col("extraction_warnings")).alias("extraction_warnings"),
        joined(F.col("validation_issues")).alias("validation_issues"),
    )


@query
def text_rendering(spark, sf_dir):
    columns = ("invoice_date", "due_date", "subtotal", "vat_amount", "total_amount")
    stored = tables.stored_documents(spark, sf_dir, *columns)
    return as_text(stored.select("source_file", "invoice_number", *columns))


# Intake.


@query
def triage(spark, sf_dir):
    return conversations.triaged(spark, sf_dir).select(
        "source_file", "is_valid", "page_count", "has_text_layer", "reason"
    )


@query
def triage_counts(spark, sf_dir):
    return intake.triage_counts(conversations.triaged(spark, sf_dir))


@query
def text_layer(spark, sf_dir):
    valid = conversations.triaged(spark, sf_dir).filter("is_valid").select("source_file")
    readable = conversations.pages(spark, sf_dir).join(valid, "source_file", "left_semi")
    return intake.text_layer(readable)


# Written values.


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


@query
def german_amount(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "order_key", money.german_amount(F.col("price")).alias("amount_text")
    )


@query
def date_rendering(spark, sf_dir):
    form = F.col("order_key") % 3
    return _orders(spark, sf_dir).select(
        "order_key", dates.written_date(F.col("day"), form).alias("date_text")
    )


@query
def due_date_rule(spark, sf_dir):
    due = dates.due_date_of(F.col("day"))
    return _orders(spark, sf_dir).select(
        "order_key", dates.iso(due).alias("due_date"), (due < F.col("day")).alias("is_early")
    )


@query
def locale_values(spark, sf_dir):
    """Amounts and dates as written on a document, read back, in every form and some that are none.

    Amounts are German with `EUR` or `€`, negative, or plain; `1.234` may be either and is not read.
    Every 17th amount is a word, every 19th date a day that does not exist.
    """
    key, price = F.col("order_key"), F.col("price")
    german, form = money.german_amount(price), key % 5
    text = (
        F.when(key % 17 == 0, "auf Anfrage")
        .when(form == 1, price.cast("string"))
        .when(form == 2, F.concat((key % 900 + 100).cast("string"), F.lit("."), (key % 800 + 100).cast("string")))
        .when(form == 3, F.replace(german, F.lit("EUR"), F.lit("€")))
        .when(form == 4, F.concat(F.lit("-"), german))
        .otherwise(german)
    )
    written = _orders(spark, sf_dir).select(
        "order_key",
        text.alias("amount_text"),
        F.when(key % 19 == 0, "31.02.2024").otherwise(dates.written_date(F.col("day"), key % 3)).alias("date_text"),
    )
    return written.select(
        "order_key",
        amount(money.parse_german_amount(F.col("amount_text"))).alias("amount"),
        dates.iso(dates.parse_written_date(F.col("date_text"))).alias("day"),
    )


# Reports.


@query
def review_queue(spark, sf_dir):
    stored = tables.stored_documents(spark, sf_dir, "validation_status", "validation_issues")
    return reporting.review_queue(stored).select(
        "source_file", "invoice_number", joined(F.col("validation_issues")).alias("validation_issues")
    )


@query
def review_rate(spark, sf_dir):
    stored = tables.stored_documents(spark, sf_dir, "validation_status", "confidence_score")
    return reporting.run_quality(stored).select(
        "n_invoices",
        "n_flagged",
        F.round("review_rate", 6).alias("review_rate"),
        F.round("mean_confidence", 6).alias("mean_confidence"),
    )


@query
def completeness(spark, sf_dir):
    filled = {
        "invoice_number": F.coalesce("invoice_number", F.lit("")) != "",
        "invoice_date": F.col("invoice_date").isNotNull(),
        "vendor_name": F.coalesce("vendor_name", F.lit("")) != "",
        "total_amount": F.col("total_amount").isNotNull(),
    }
    shares = reporting.completeness(_mapped(spark, sf_dir), filled)
    rounded = [F.round(n, 6).alias(n) for n in shares.columns if n.startswith("share_")]
    return shares.select("n_documents", *rounded)


@query
def calendar_rollup(spark, sf_dir):
    columns = ("invoice_date", "total_amount", "validation_status")
    months = reporting.calendar_rollup(tables.stored_documents(spark, sf_dir, *columns))
    return months.withColumn("total_amount", amount("total_amount"))


@query
def report_row(spark, sf_dir):
    columns = ("confidence_score", "validation_status")
    return reporting.report_row(tables.stored_documents(spark, sf_dir, *columns))


@query
def report_amounts(spark, sf_dir):
    columns = (
        "invoice_date due_date vendor_name vendor_address vendor_tax_id vendor_iban customer_name "
        "customer_address subtotal vat_amount vat_rate total_amount"
    ).split()
    return reporting.report_amounts(
        tables.stored_documents(spark, sf_dir, *columns, customers=True)
    )


@query
def report_items(spark, sf_dir):
    return reporting.report_items(tables.stored_lines(spark, sf_dir))


@query
def findings_list(spark, sf_dir):
    columns = ("extraction_warnings", "validation_issues")
    return reporting.findings_list(tables.stored_documents(spark, sf_dir, *columns))


# Store and stream.


def _committed_runs(spark, sf_dir) -> str:
    """Two runs over all orders, even keys first, with their items; returns the store's folder."""
    root = f"{scratch_folder(spark, 'runs')}/store"
    with staging(spark):
        judged = tables.written_lines(spark, sf_dir, *tables.UNSUMMED)
        responses = tables.recorded_responses(spark, sf_dir, judged)
        documents = tables.judge_recorded(tables.named(responses.withColumn("has_response", F.lit(True))))
        for run_id, residue in (("even", 0), ("odd", 1)):
            own = F.col("order_key") % 2 == residue
            commit_run(spark, documents.filter(own), root, run_id, tables.item_rows(judged).filter(own))
            derive_line_items(spark, root)
    return root


@query
def stored_items(spark, sf_dir):
    """The written items of both runs under their invoice's key."""
    items = read_line_items(spark, _committed_runs(spark, sf_dir))
    return items.select(
        "run_id",
        "invoice_id",
        "position",
        "description",
        "quantity",
        out_price(F.col("unit_price")).alias("unit_price"),
        amount("line_total").alias("line_total"),
    )


@query
def write_audit(spark, sf_dir):
    """What was counted while both runs were written; the tables are not read again."""
    return stored_audit(spark, _committed_runs(spark, sf_dir))


@query
def retried_rejects(spark, sf_dir):
    """Responses of every 53rd order come late: rejects first, then tried again when they are there."""
    root = f"{scratch_folder(spark, 'retries')}/store"
    with staging(spark):
        responses = tables.recorded_responses(spark, sf_dir).withColumn("has_response", F.lit(True))
        files = tables.named(responses.select("order_key", "source_file"))
        # What is read of them is sent to the files, not all that was recorded.
        responses = responses.withColumn("fields", fields_read())
        early = responses.filter(~tables.every(53)).drop("order_key")
        start = F.lit(f"{tables.AS_OF} 00:00:00").cast("timestamp")
        first = tables.judge_recorded(files.join(early, "source_file", "left"))
        commit_run(spark, first, root, "first", now=start)

        def answered(waiting: DataFrame) -> DataFrame:
            return tables.judge_recorded(waiting.join(responses, "source_file", "left"))

        later = start + F.expr("INTERVAL 1 HOUR")
        retry_rejects(spark, None, root, "again", now=later, judged=answered)
    return read_outcomes(spark, root).select(
        "run_id", "source_file", "outcome", F.coalesce("reason", F.lit("")).alias("reason")
    )


# How long the files of `arrival_stream` wait for their response, and the watermarks' delay.
PATIENCE, DELAY = "37 HOURS", "5 HOURS"


@query
def arrival_stream(spark, sf_dir):
    """Files and responses arrive as two streams, one file and one response per order.

    A response comes 0 to 19 hours and 30 minutes after its file, that of every 53rd order never. Time
    is that of the orders: a file without a response has its outcome once its wait is over.
    """
    schema = table(spark, sf_dir, "orders").schema
    # A pattern that only this name fits: a stream takes a single file in no other way.
    orders = spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parque[t]")
    folder = scratch_folder(spark, "arrivals")
    root = f"{folder}/store"
    with staging(spark):
        responses = tables.responses(spark, sf_dir)
        late = F.make_dt_interval(hours=(F.col("order_key") % 20).cast("int"), mins=F.lit(30))
        recorded = stage(
            responses.filter(~tables.every(53)).withColumn("response_time", F.col("order_time") + late).drop(
                "order_key", "order_time"
            ),
            "recorded",
            dictionary=False,
        )
        answers = spark.readStream.schema(recorded.schema).parquet(recorded.inputFiles()[0].rsplit("/", 1)[0])
        # Rows wait in the stream's state: they carry what is read of them.
        answers = answers.withColumn("fields", fields_read())
        arrived = joined_arrivals(tables.order_files(orders), answers, PATIENCE, DELAY)
        started = store_arrivals(arrived, root, f"{folder}/checkpoint", judged=tables.judge_recorded)
        started.awaitTermination()
    outcomes = read_outcomes(spark, root)
    return outcomes.select(
        "source_file", "outcome", F.coalesce("reason", F.lit("")).alias("reason"), F.col("n_issues").cast("bigint").alias("n_issues")
    )
