"""Cleaning and arithmetic cross-checks."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.money import cents, two_places
from ..functions.text import clean_text, fill, present

CLEANED = ("vendor_name", "customer_name", "vendor_address", "customer_address")


def grand_total_mismatch(tolerance: str = fixed.ROUNDING_TOLERANCE) -> Column:
    """Subtotal plus VAT against the total (X3); null when they agree or one is absent."""
    expected = cents(F.col("subtotal") + F.col("vat_amount"))
    actual = cents(F.col("total_amount"))
    difference = F.abs(expected - actual)
    return F.when(
        difference > F.lit(tolerance).cast("decimal(18,2)"),
        fill(
            fixed.GRAND_TOTAL_MISMATCH,
            expected=two_places(expected),
            actual=two_places(actual),
            difference=two_places(difference),
        ),
    )


def item_sum_mismatch(tolerance: str = fixed.ROUNDING_TOLERANCE) -> Column:
    """Sum of the kept items against the subtotal (X4); not checked without items."""
    items, subtotal = cents(F.col("items_sum")), cents(F.col("subtotal"))
    return F.when(
        (F.col("n_items") > 0)
        & (F.abs(items - subtotal) > F.lit(tolerance).cast("decimal(18,2)")),
        fill(
            fixed.ITEM_SUM_MISMATCH, items_sum=two_places(items), subtotal=two_places(subtotal)
        ),
    )


def clean_parties(df: DataFrame) -> DataFrame:
    """Collapse whitespace in the four name and address columns, where present in `df`."""
    return df.withColumns({n: clean_text(F.col(n)) for n in CLEANED if n in df.columns})


def cross_check(df: DataFrame, tolerance: str = fixed.ROUNDING_TOLERANCE) -> DataFrame:
    """Append the arithmetic warnings to the mapping warnings: items first, then totals."""
    before = F.col("extraction_warnings")
    after = F.concat(
        before,
        F.col("item_mismatches"),
        present(grand_total_mismatch(tolerance), item_sum_mismatch(tolerance)),
    )
    return df.withColumns(
        {"extraction_warnings": after, "n_new_warnings": F.size(after) - F.size(before)}
    )
