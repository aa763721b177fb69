"""Dates: safe parsing, due date rule, renderings."""

from pyspark.sql import Column, functions as F

# Written date formats, in the order the samples cycle through them.
DATE_FORMATS = ("dd.MM.yyyy", "yyyy-MM-dd", "dd/MM/yyyy")
ISO = "yyyy-MM-dd"

# Payment term in days and the last day of month a due date may fall on.
TERM_DAYS = 14
LAST_DUE_DAY = 28


def safe_date(text: Column) -> Column:
    """What is plainly ISO is cast, which takes a fraction of the time of a pattern."""
    plain = text.rlike(r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z")
    return F.when(plain, text.try_cast("date")).otherwise(F.try_to_date(text, ISO))


def parse_written_date(text: Column) -> Column:
    """Any of the written formats; a slash date is day first."""
    return F.coalesce(*(F.try_to_date(text, form) for form in DATE_FORMATS))


def written_date(value: Column, form_index: Column) -> Column:
    """Render with the format number `form_index` (0 German, 1 ISO, 2 slash)."""
    choice = F.when(form_index == 0, F.date_format(value, DATE_FORMATS[0]))
    for number, form in enumerate(DATE_FORMATS[1:], start=1):
        choice = choice.when(form_index == number, F.date_format(value, form))
    return choice


def due_date_of(invoice_date: Column) -> Column:
    """Same month, two weeks on, never after the 28th."""
    day = F.least(F.dayofmonth(invoice_date) + TERM_DAYS, F.lit(LAST_DUE_DAY))
    return F.make_date(F.year(invoice_date), F.month(invoice_date), day)


def iso(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")
