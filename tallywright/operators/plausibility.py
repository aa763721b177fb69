"""Business plausibility of a checked invoice: issues and status."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.dates import iso
from ..functions.money import fixed_places, short_score, two_places
from ..functions.text import fill, present


def issues(
    as_of: Column,
    threshold: float = fixed.CONFIDENCE_THRESHOLD,
    vat_rates: Sequence[float] = fixed.VAT_RATES,
    vat_rate_tolerance: float = fixed.VAT_RATE_TOLERANCE,
    first_year: int = fixed.FIRST_PLAUSIBLE_YEAR,
) -> Column:
    """All issues that apply, in their fixed order."""
    score, rate, total = F.col("confidence_score"), F.col("vat_rate"), F.col("total_amount")
    date, due = F.col("invoice_date"), F.col("due_date")
    n_warnings = F.size("extraction_warnings")
    known_rate = F.lit(False)
    for known in vat_rates:
        known_rate = known_rate | (F.abs(rate - F.lit(known)) <= vat_rate_tolerance)
    return present(
        F.when(
            score < threshold,
            fill(fixed.LOW_SCORE, score=short_score(score), threshold=F.lit(str(threshold))),
        ),
        F.when(n_warnings > 0, fill(fixed.HAS_WARNINGS, count=n_warnings)),
        F.when(F.year(date) < first_year, fill(fixed.IMPLAUSIBLE_YEAR, year=F.year(date))),
        F.when(
            date > F.date_add(as_of, fixed.FUTURE_GRACE_DAYS),
            fill(fixed.FUTURE_DATE, date=iso(date)),
        ),
        F.when(due < date, fill(fixed.DUE_BEFORE_INVOICE, due=iso(due), date=iso(date))),
        F.when(
            rate.isNotNull() & ~known_rate,
            fill(fixed.UNKNOWN_VAT_RATE, rate=fixed_places(rate, 3)),
        ),
        F.when(total <= 0, fill(fixed.NOT_POSITIVE, total=two_places(total))),
        F.when(F.col("n_items") == 0, fixed.HAS_NO_ITEMS),
    )


def assess(df: DataFrame, as_of: Column | None = None, **limits) -> DataFrame:
    """Add `validation_issues` and `validation_status`; `as_of` is today unless given."""
    found = issues(F.current_date() if as_of is None else as_of, **limits)
    return df.withColumn("validation_issues", found).withColumn(
        "validation_status",
        F.when(F.size("validation_issues") == 0, fixed.VALID).otherwise(fixed.NEEDS_REVIEW),
    )
