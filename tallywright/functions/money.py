"""Amounts: safe parsing, half-even rounding, renderings."""

from pyspark.sql import Column, functions as F

from ..schema import AMOUNT


def safe_decimal(text: Column, kind: str = AMOUNT) -> Column:
    """Text to decimal; what cannot be read becomes null instead of failing the job."""
    return text.try_cast(kind)


def too_large(text: Column, limit: float) -> Column:
    """A readable number that the target type cannot hold."""
    return F.coalesce(F.abs(text.try_cast("double")) >= F.lit(limit), F.lit(False))


def parse_german_amount(text: Column) -> Column:
    """`1.234,56 EUR` to 1234.56; a plain `119.00` stays what it is.

    Anything else is null, also `1.234`, which may be either.
    """
    bare = F.regexp_replace(F.trim(text), r"\s*(EUR|€)$", "")
    german = bare.rlike(r"^-?(\d{1,3}(\.\d{3})+,\d+|\d+(,\d+)?)$")
    plain = bare.rlike(r"^-?\d+\.\d+$") & ~bare.rlike(r"^-?\d{1,3}\.\d{3}$")
    written = F.when(german, F.translate(bare, ",.", ".")).when(plain, bare)
    return safe_decimal(written)


def german_amount(value: Column) -> Column:
    """1234.56 to `1.234,56 EUR`."""
    return F.concat(F.translate(F.format_number(cents(value), 2), ",.", ".,"), F.lit(" EUR"))


def euro(value: Column) -> Column:
    """1234.5 to `€ 1,234.50`; null stays null."""
    return F.concat(F.lit("€ "), F.format_number(cents(value), 2))


def cents(value: Column) -> Column:
    return F.bround(value, 2)


def two_places(value: Column) -> Column:
    return cents(value).cast("decimal(38,2)").cast("string")


def fixed_places(value: Column, places: int) -> Column:
    """A double with a fixed number of places, half-even on its decimal text."""
    return F.bround(value.cast("decimal(28,12)"), places).cast(f"decimal(28,{places})").cast("string")


def short_score(value: Column) -> Column:
    """Score with up to four places, at least one: `0.75`, `1.0`."""
    return F.regexp_replace(fixed_places(value, 4), r"(\.\d+?)0+$", "$1")
