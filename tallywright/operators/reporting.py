"""Reports on stored invoices (Q1-Q9)."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.money import euro
from ..functions.text import or_dash, short_number

# Confidence bands in percent, and display formats.
HIGH_BAND = 80
MEDIUM_BAND = 60
DISPLAY_DATE = "dd MMM yyyy"
STATUS_LABELS = {"valid": "Valid", "needs_review": "Needs Review"}


def review_queue(invoices: DataFrame) -> DataFrame:
    """Stored invoices that a person should look at (Q1); sort the output where it is shown."""
    return invoices.filter(F.col("validation_status") == fixed.NEEDS_REVIEW)


def run_quality(invoices: DataFrame) -> DataFrame:
    """Share flagged and mean confidence of what was processed (Q2, Q3)."""
    flagged = F.col("validation_status") == fixed.NEEDS_REVIEW
    return invoices.agg(
        F.count("*").alias("n_invoices"),
        F.count_if(flagged).alias("n_flagged"),
        F.avg(F.when(flagged, 1.0).otherwise(0.0)).alias("review_rate"),
        F.avg("confidence_score").alias("mean_confidence"),
    )


def completeness(documents: DataFrame, present_by_name: dict[str, Column]) -> DataFrame:
    """Share of documents in which each required field is present, and all of them (Q4)."""
    every = F.lit(True)
    shares = []
    for name, is_present in present_by_name.items():
        every = every & is_present
        shares.append(F.avg(F.when(is_present, 1.0).otherwise(0.0)).alias(f"share_{name}"))
    complete = F.avg(F.when(every, 1.0).otherwise(0.0)).alias("share_complete")
    return documents.agg(F.count("*").alias("n_documents"), *shares, complete)


def calendar_rollup(invoices: DataFrame) -> DataFrame:
    """Invoices and totals by month; year and quarter are derived here, not stored (Q5)."""
    date = F.col("invoice_date")
    return (
        invoices.groupBy(
            F.year(date).alias("year"), F.quarter(date).alias("quarter"), F.month(date).alias("month")
        )
        .agg(
            F.count("*").alias("n_invoices"),
            F.sum("total_amount").alias("total_amount"),
            F.count_if(F.col("validation_status") == fixed.NEEDS_REVIEW).alias("n_flagged"),
        )
    )


def confidence_percent(score: Column) -> Column:
    return (score * 100).cast("int")


def report_row(invoices: DataFrame) -> DataFrame:
    """Confidence as a truncated percentage with its band, and the status label (Q6)."""
    percent = confidence_percent(F.col("confidence_score"))
    label = F.lit(None).cast("string")
    for status, shown in STATUS_LABELS.items():
        label = F.when(F.col("validation_status") == status, shown).otherwise(label)
    return invoices.select(
        "source_file",
        "invoice_number",
        percent.alias("confidence_percent"),
        F.when(percent >= HIGH_BAND, "high")
        .when(percent >= MEDIUM_BAND, "medium")
        .otherwise("low")
        .alias("confidence_band"),
        label.alias("status_label"),
    )


def shown_amount(value: Column) -> Column:
    """`€ 1,234.50`; absent and zero amounts are a dash."""
    return F.when(value != 0, euro(value)).otherwise("—")


def report_amounts(invoices: DataFrame) -> DataFrame:
    """Amounts, dates and texts as displayed (Q7)."""
    rate = F.col("vat_rate")
    return invoices.select(
        "source_file",
        F.date_format("invoice_date", DISPLAY_DATE).alias("invoice_date"),
        F.coalesce(F.date_format("due_date", DISPLAY_DATE), F.lit("—")).alias("due_date"),
        or_dash(F.col("vendor_name")).alias("vendor_name"),
        or_dash(F.col("vendor_address")).alias("vendor_address"),
        or_dash(F.col("vendor_tax_id")).alias("vendor_tax_id"),
        or_dash(F.col("vendor_iban")).alias("vendor_iban"),
        or_dash(F.col("customer_name")).alias("customer_name"),
        or_dash(F.col("customer_address")).alias("customer_address"),
        shown_amount(F.col("subtotal")).alias("subtotal"),
        shown_amount(F.col("vat_amount")).alias("vat_amount"),
        F.when(rate != 0, F.concat(F.lit("("), (rate * 100).cast("int").cast("string"), F.lit("%)")))
        .otherwise("")
        .alias("vat_rate"),
        shown_amount(F.col("total_amount")).alias("total_amount"),
    )


def report_items(lines: DataFrame) -> DataFrame:
    """One display row per stored item: columns of the item plus its document (Q8)."""
    return lines.select(
        "source_file",
        "position",
        "description",
        short_number(F.col("quantity")).alias("quantity"),
        euro(F.col("unit_price")).alias("unit_price"),
        euro(F.col("line_total")).alias("line_total"),
    )


def findings_list(invoices: DataFrame) -> DataFrame:
    """Warnings, then issues, one row each; a single `none` row without findings (Q9)."""

    def tagged(column: str, kind: str) -> Column:
        return F.transform(
            column, lambda text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
        )

    nothing = F.array(
        F.struct(F.lit("none").alias("kind"), F.lit("No warnings or issues found").alias("text"))
    )
    found = F.concat(tagged("extraction_warnings", "warning"), tagged("validation_issues", "issue"))
    return invoices.select(
        "source_file",
        F.posexplode(F.when(F.size(found) > 0, found).otherwise(nothing)).alias("_at", "_finding"),
    ).select(
        "source_file",
        (F.col("_at") + 1).alias("seq"),
        F.col("_finding.kind").alias("kind"),
        F.col("_finding.text").alias("finding"),
    )
