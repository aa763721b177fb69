"""Text expressions: cleaning, message building, joined lists."""

from string import Formatter

from pyspark.sql import Column, functions as F

# Every Unicode space plus the four separator controls that Java's class leaves out.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
NOT_WHITESPACE = r"(?U)[^\s\x1c-\x1f]"


def clean_text(value: Column) -> Column:
    """Collapse each run of whitespace to one space and trim; null stays null."""
    return F.trim(F.regexp_replace(value, WHITESPACE, " "))


def has_text(value: Column) -> Column:
    return F.coalesce(value.rlike(NOT_WHITESPACE), F.lit(False))


def fill(template: str, **values: Column) -> Column:
    """`fill("due {d}", d=col)`: a message template as one concat of literals and columns."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def present(*messages: Column) -> Column:
    """Array of the messages that are not null, in the given order."""
    return F.array_compact(F.array(*messages))


def joined(messages: Column) -> Column:
    """List as one text with `; ` between entries; an empty list becomes null."""
    return F.when(F.size(messages) > 0, F.concat_ws("; ", messages))


def or_dash(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("—"))


def short_number(value: Column) -> Column:
    """Number with six significant digits and no padding: `23`, `2.5`, `1.23457e+06`."""
    scientific = F.format_string("%.5e", value)
    exponent = F.element_at(F.split(scientific, "e"), -1).cast("int")
    plain = scientific.try_cast("decimal(24,12)").cast("string")
    return (
        F.when(value.isNull(), None)
        .when(value == 0, "0")
        .when(
            (exponent < -4) | (exponent >= 6), F.regexp_replace(scientific, r"\.?0+e", "e")
        )
        .otherwise(F.regexp_replace(plain, r"\.?0+$", ""))
    )


def padded(key: Column, width: int = 9) -> Column:
    """A key as text with leading zeros; longer keys stay whole."""
    text = key.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
