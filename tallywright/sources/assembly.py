"""Invoice arithmetic for documents built from line rows (G1)."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import cents

# Fixed value: the standard rate documents are built with.
STANDARD_RATE = "0.19"


def vat_of(subtotal: Column, rate: Column) -> Column:
    return cents(subtotal * rate)


def document_totals(
    lines: DataFrame, key: str, quantity: str, unit_price: str, rate: str = STANDARD_RATE
) -> DataFrame:
    """Per document: item count, subtotal, VAT and total; sums only, so any document size works.

    An amount beyond its type is null; it ends no job.
    """
    line_total = F.col(quantity).try_cast("decimal(18,6)") * F.col(unit_price).try_cast("decimal(18,6)")
    vat = vat_of(F.col("subtotal"), F.lit(rate).cast("decimal(5,4)"))
    return (
        lines.groupBy(key)
        .agg(
            F.count("*").alias("n_items"),
            F.sum(cents(line_total)).try_cast("decimal(18,2)").alias("subtotal"),
        )
        .withColumn("vat_amount", vat.try_cast("decimal(18,2)"))
        .withColumn("total_amount", (F.col("subtotal") + F.col("vat_amount")).try_cast("decimal(18,2)"))
    )
