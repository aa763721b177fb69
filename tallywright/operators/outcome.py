"""One outcome per file, and the run summary."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.text import fill


def reject_taken_numbers(df: DataFrame) -> DataFrame:
    """After `mark_first`: a document that lost its number fails."""
    lost = F.col("reason").isNull() & ~F.col("is_first")
    return df.withColumns(
        {
            "stage": F.when(lost, "unexpected").otherwise(F.col("stage")),
            "reason": F.when(lost, fixed.NUMBER_TAKEN).otherwise(F.col("reason")),
        }
    ).drop("is_first")


def full_reason() -> Column:
    """Reason with the prefix of the stage that failed (R2)."""
    stage, reason = F.col("stage"), F.col("reason")
    text = F.when(reason.isNull(), None)
    for name, template in fixed.STAGE_PREFIX.items():
        text = text.when(stage == name, fill(template, reason=reason))
    return text


def outcomes(df: DataFrame) -> DataFrame:
    """`source_file, outcome, stage, reason, n_issues` for every file."""
    failed = F.col("reason").isNotNull()
    return df.select(
        "source_file",
        F.when(failed, fixed.FAILED).otherwise(F.col("validation_status")).alias("outcome"),
        F.when(failed, F.col("stage")).alias("stage"),
        full_reason().alias("reason"),
        F.when(failed, 0).otherwise(F.size("validation_issues")).alias("n_issues"),
    )


def summary_columns() -> dict[str, Column]:
    """Total, valid, needs review, failed, as aggregates over outcome rows."""
    outcome = F.col("outcome")
    return {
        "total_files": F.count("*"),
        "valid": F.count_if(outcome == fixed.VALID),
        "needs_review": F.count_if(outcome == fixed.NEEDS_REVIEW),
        "failed": F.count_if(outcome == fixed.FAILED),
    }


def summary(outcome_rows: DataFrame) -> DataFrame:
    """One row of counts, zeros for an empty run."""
    return outcome_rows.agg(*(column.alias(name) for name, column in summary_columns().items()))


def review_list(outcome_rows: DataFrame) -> DataFrame:
    return outcome_rows.filter(F.col("outcome") == fixed.NEEDS_REVIEW).select(
        "source_file", "n_issues"
    )


def failed_list(outcome_rows: DataFrame) -> DataFrame:
    return outcome_rows.filter(F.col("outcome") == fixed.FAILED).select("source_file", "reason")
