"""Recorded analysis fields to typed invoice columns.

The header rules work on one `fields` struct per document. The item rules are written once, as
functions from a column to a column, and used in two ways: over the array inside a document
(`item_facts_in_place`, no shuffle) and over a table with one row per item (`item_facts`, partial
aggregation, so the items of a very long document are never gathered in one place).
"""

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed
from ..functions.dates import parse_written_date, safe_date
from ..functions.money import (
    cents,
    fixed_places,
    parse_german_amount,
    safe_decimal,
    too_large,
    two_places,
)
from ..functions.text import fill, present
from ..schema import AMOUNT, AMOUNT_LIMIT, LINE_ITEM, PRICE, PRICE_LIMIT

REQUIRED_CONFIDENCES = ("InvoiceId", "InvoiceDate", "VendorName", "InvoiceTotal")


def _field(name: str) -> Column:
    return F.col(f"fields.{name}")


def _confidence(name: str) -> Column:
    return F.coalesce(_field(name)["confidence"], F.lit(0.0))


# What `map_header` reads of each field.
READ = {
    **dict.fromkeys(REQUIRED_CONFIDENCES, ("value", "confidence")),
    **dict.fromkeys(("DueDate", "VendorTaxId", "CustomerName", "SubTotal", "TotalTax"), ("value",)),
    "VendorAddress": ("content", "confidence"),
    "CustomerAddress": ("content",),
}


def fields_read() -> Column:
    """`fields` as far as `map_header` reads them, for rows that are kept or sent until then."""

    def read(name: str) -> Column:
        members = F.struct(*(_field(name)[member].alias(member) for member in READ[name]))
        return F.when(_field(name).isNotNull(), members).alias(name)

    # A response without fields has none of them either way.
    return F.when(F.col("fields").isNotNull(), F.struct(*map(read, READ)))


def read_written_values(df: DataFrame) -> DataFrame:
    """Fill a missing `value` of dates and amounts from the raw `content` as written."""

    def with_value(field: Column, parsed: Callable[[Column], Column]) -> Column:
        value = F.coalesce(field["value"], parsed(field["content"]).cast("string"))
        return F.when(field.isNotNull(), field.withField("value", value))

    def with_prices(item: Column) -> Column:
        for name in ("UnitPrice", "Amount"):
            item = item.withField(name, with_value(item[name], parse_german_amount))
        return item

    fields = F.col("fields")
    for name in ("InvoiceDate", "DueDate"):
        fields = fields.withField(name, with_value(_field(name), parse_written_date))
    for name in ("InvoiceTotal", "SubTotal", "TotalTax"):
        fields = fields.withField(name, with_value(_field(name), parse_german_amount))
    fields = fields.withField("Items", F.transform(_field("Items"), with_prices))
    return df.withColumn("fields", fields)


def map_header(df: DataFrame, threshold: float = fixed.CONFIDENCE_THRESHOLD) -> DataFrame:
    """Replace `fields` by typed columns and the header's own findings."""
    invoice_number = _field("InvoiceId")["value"]
    vendor_name = _field("VendorName")["value"]
    invoice_date = safe_date(_field("InvoiceDate")["value"])
    total_text = _field("InvoiceTotal")["value"]
    subtotal_text = _field("SubTotal")["value"]
    vat_text = _field("TotalTax")["value"]
    total, subtotal, vat = (safe_decimal(t) for t in (total_text, subtotal_text, vat_text))

    unusable = {
        "invoice_number": F.coalesce(invoice_number, F.lit("")) == "",
        "invoice_date": invoice_date.isNull(),
        "vendor_name": F.coalesce(vendor_name, F.lit("")) == "",
        "total_amount": total.isNull() & ~too_large(total_text, AMOUNT_LIMIT),
    }
    missing = F.concat_ws(", ", *(F.when(unusable[n], n) for n in fixed.REQUIRED_FIELDS))
    oversized = F.concat_ws(
        ", ",
        *(
            F.when(too_large(text, AMOUNT_LIMIT), name)
            for name, text in (
                ("subtotal", subtotal_text),
                ("vat_amount", vat_text),
                ("total_amount", total_text),
            )
        ),
    )
    mean = sum((_confidence(name) for name in REQUIRED_CONFIDENCES[1:]), _confidence("InvoiceId"))
    mean = mean / F.lit(float(len(REQUIRED_CONFIDENCES)))
    address_confidence = _confidence("VendorAddress")

    return df.withColumns(
        {
            "invoice_number": invoice_number,
            "invoice_date": invoice_date,
            "due_date": safe_date(_field("DueDate")["value"]),
            "vendor_name": vendor_name,
            "vendor_address": _field("VendorAddress")["content"],
            "vendor_tax_id": _field("VendorTaxId")["value"],
            "vendor_iban": F.lit(None).cast("string"),
            "customer_name": _field("CustomerName")["value"],
            "customer_address": _field("CustomerAddress")["content"],
            "subtotal": subtotal,
            "vat_amount": vat,
            "vat_rate": F.when(
                (subtotal > 0) & (vat != 0), F.try_divide(vat, subtotal).cast("double")
            ),
            "total_amount": total,
            "confidence_mean": mean,
            "confidence_score": F.bround(mean, 4),
            "missing_fields": F.nullif(missing, F.lit("")),
            "oversized_fields": F.nullif(oversized, F.lit("")),
            "address_warning": F.when(
                _field("VendorAddress").isNotNull() & (address_confidence < threshold),
                fill(
                    fixed.LOW_ADDRESS_CONFIDENCE, confidence=fixed_places(address_confidence, 2)
                ),
            ),
        }
    ).drop("fields")


# Items, one at a time: raw -> parsed -> priced -> judged -> worded. Each step reads the values so
# far by name and returns the new ones: columns of a table, or members of an entry inside `transform`.

Values = dict[str, Column]
Read = Callable[[str], Column]

STORED = ("position", "description", "quantity", "unit_price", "line_total")
PARSED = (
    *("position", "description", "has_quantity", "quantity", "exact_quantity"),
    *("given_price", "line_total", "oversized"),
)


def parse_item(position: Column, raw: Column) -> Values:
    """Typed values of one raw item, with defaults for absent fields."""
    quantity = F.when(raw["Quantity"].isNull(), fixed.DEFAULT_QUANTITY).otherwise(
        raw["Quantity"]["value"]
    )
    description = F.when(
        raw["Description"].isNull(), fill(fixed.DEFAULT_DESCRIPTION, position=position)
    ).otherwise(raw["Description"]["value"])
    price, total = raw["UnitPrice"]["value"], raw["Amount"]["value"]
    values = (
        position.cast("int"),
        description,
        quantity.isNotNull(),
        quantity.try_cast("double"),
        safe_decimal(quantity),
        safe_decimal(price, PRICE),
        safe_decimal(total),
        too_large(price, PRICE_LIMIT) | too_large(total, AMOUNT_LIMIT),
    )
    return dict(zip(PARSED, values, strict=True))


def price_item(read: Read) -> Values:
    """The unit price, back-calculated from the total where it is absent."""
    derivable = (
        read("given_price").isNull()
        & read("line_total").isNotNull()
        & (read("quantity") != 0)
        & ~read("oversized")
    )
    derived = F.try_divide(read("line_total"), read("exact_quantity")).try_cast(PRICE)
    return {
        "unit_price": F.when(derivable, derived).otherwise(read("given_price")),
        "derivable": F.coalesce(derivable, F.lit(False)),
    }


# What no stored item may have (E18), in reporting order.
PROBLEMS = (
    "description is empty",
    "quantity is not a number",
    "quantity is missing",
    "quantity is not greater than 0",
    "amount is out of range",
)
# Every text `problems` can be, sorted: the place of one says as much as its text, in a number.
PROBLEM_TEXTS = sorted(
    ", ".join(some) for n in range(1, len(PROBLEMS) + 1) for some in combinations(PROBLEMS, n)
)
BROKEN_ITEM = "Line item {position}: {problems}"


def judge_item(read: Read) -> Values:
    """Whether an item is left out (E14) and what no stored item may have."""
    unit_price, line_total, quantity = read("unit_price"), read("line_total"), read("quantity")
    unreadable = read("has_quantity") & quantity.isNull() & line_total.isNotNull()
    unfit = read("oversized") | (read("derivable") & unit_price.isNull())
    is_skipped = (unit_price.isNull() | line_total.isNull()) & ~unreadable & ~unfit
    found = (
        F.coalesce(read("description"), F.lit("")) == "",
        unreadable,
        ~read("has_quantity"),
        quantity <= 0,
        unfit | (quantity.isNotNull() & read("exact_quantity").isNull()),
    )
    texts = (F.when(has, text) for has, text in zip(found, PROBLEMS, strict=True))
    problems = F.concat_ws(", ", *texts)
    return {"is_skipped": is_skipped, "problems": F.when(is_skipped, "").otherwise(problems)}


def word_item(read: Read, tolerance: str = fixed.ROUNDING_TOLERANCE) -> Values:
    """The texts about one item, null where there is nothing to say."""
    position, description = read("position"), read("description")
    expected = cents(read("exact_quantity") * read("unit_price"))
    actual = cents(read("line_total"))
    differs = F.abs(expected - actual) > F.lit(tolerance).cast("decimal(18,2)")
    sound = ~read("is_skipped") & (read("problems") == "")
    return {
        "skipped": F.when(
            read("is_skipped"),
            fill(
                fixed.ITEM_SKIPPED,
                position=position,
                description=F.coalesce(description, F.lit("None")),
            ),
        ),
        "error": F.when(
            read("problems") != "",
            fill(BROKEN_ITEM, position=position, problems=read("problems")),
        ),
        "mismatch": F.when(
            sound & differs,
            fill(
                fixed.LINE_TOTAL_MISMATCH,
                position=position,
                description=description,
                expected=two_places(expected),
                actual=two_places(actual),
            ),
        ),
    }


def judge_entries(entries: Column, tolerance: str = fixed.ROUNDING_TOLERANCE) -> Column:
    """Array of `(position, item)` to array of judged items, through all steps."""

    def members(values: Values) -> Column:
        return F.struct(*(column.alias(name) for name, column in values.items()))

    def extended(step: Callable[[Read], Values], carried: tuple[str, ...]):
        return lambda line: members(
            {name: line[name] for name in carried} | step(lambda name: line[name])
        )

    lines = F.transform(entries, lambda e: members(parse_item(e["position"], e["item"])))
    lines = F.transform(lines, extended(price_item, PARSED))
    lines = F.transform(lines, extended(judge_item, (*STORED, "exact_quantity")))
    word = extended(lambda read: word_item(read, tolerance), (*STORED, "is_skipped", "problems"))
    return F.transform(lines, word)


def judged_lines(items: DataFrame, tolerance: str = fixed.ROUNDING_TOLERANCE) -> DataFrame:
    """For a table with one row per item: `position` and the raw `item` become judged columns.

    Each step but the wording is unpacked from an array of one, by generated code. Unpacking is where filters on
    judged columns and merged projections stop: further down, each would repeat all the parsing it depends on.
    `judge_entries` would do the same by calling its functions on one row after the other.
    """
    others = [name for name in items.columns if name not in ("position", "item")]

    def step(rows: DataFrame, values: Values, carried: tuple[str, ...] = ()) -> DataFrame:
        members = [column.alias(name) for name, column in values.items()]
        return rows.select(*others, *carried, F.inline_outer(F.array(F.struct(*members))))

    def read(name: str) -> Column:
        return F.col(name)

    rows = step(items, parse_item(F.col("position"), F.col("item")))
    rows = step(rows, price_item(read), PARSED)
    rows = step(rows, judge_item(read), (*STORED, "exact_quantity"))
    # Texts are plain columns: queries that show none have none made.
    texts = (column.alias(name) for name, column in word_item(read, tolerance).items())
    return rows.select(*others, *STORED, "is_skipped", "problems", *texts)


# What a finding about an item is, in the flagged list of its document.
SKIPPED, BROKEN, MISMATCHED = "skipped", "error", "mismatch"


def item_counters() -> Values:
    """Facts about all items of a document, as aggregates over judged item rows that are numbers.

    Numbers combine in generated code, without sorting the rows. So the first broken item is its
    position and the place of its problems among `PROBLEM_TEXTS`; `with_item_findings` words it.
    """
    counted = ~F.col("is_skipped")
    place = F.array_position(F.array(*map(F.lit, PROBLEM_TEXTS)), F.col("problems")) - 1
    code = F.col("position").cast("bigint") * len(PROBLEM_TEXTS) + place
    return {
        "n_items": F.count_if(counted),
        "items_sum": F.sum(F.when(counted, F.col("line_total"))).cast("decimal(38,6)"),
        "first_broken": F.min(F.when(F.col("problems") != "", code)),
    }


def _finding() -> tuple[Column, Column]:
    """The kind of an item's finding, null without one, and the finding."""
    kind = F.coalesce(
        *(F.when(F.col(name).isNotNull(), name) for name in (SKIPPED, BROKEN, MISMATCHED))
    )
    text = F.coalesce(SKIPPED, BROKEN, MISMATCHED).alias("text")
    return kind, F.struct("position", kind.alias("kind"), text)


def item_aggregates() -> Values:
    """The counters, and the list of flagged items; the others do not enter it.

    An item has at most one finding, so its position orders the list.
    """
    kind, finding = _finding()
    return item_counters() | {"flagged_items": F.collect_list(F.when(kind.isNotNull(), finding))}


def flagged_items(lines: DataFrame, key: str) -> DataFrame:
    """`key, flagged_items` of the documents that have any: the list alone, from a table once written.

    A list among the aggregates would have all rows sorted; here only flagged ones are.
    """
    kind, finding = _finding()
    return lines.filter(kind.isNotNull()).groupBy(key).agg(F.collect_list(finding).alias("flagged_items"))


def with_item_findings(facts: DataFrame) -> DataFrame:
    """Split `flagged_items` into the texts of each kind, in item order; absent means none."""
    none = F.array().cast("array<string>")

    def texts(kind: str) -> Column:
        of_kind = F.filter(F.sort_array("flagged_items"), lambda found: found["kind"] == kind)
        found = F.transform(of_kind, lambda entry: entry["text"])
        return F.when(F.size("flagged_items") > 0, found).otherwise(none)

    first, known = F.col("first_broken"), len(PROBLEM_TEXTS)
    problems = F.element_at(F.array(*map(F.lit, PROBLEM_TEXTS)), (F.pmod(first, F.lit(known)) + 1).cast("int"))
    position = F.floor((first - F.pmod(first, F.lit(known))) / known).cast("int")
    return facts.withColumns(
        {
            "n_items": F.coalesce("n_items", F.lit(0).cast("bigint")),
            "item_error": F.when(first.isNotNull(), fill(BROKEN_ITEM, position=position, problems=problems)),
            "item_skips": texts(SKIPPED),
            "item_mismatches": texts(MISMATCHED),
        }
    ).drop("flagged_items", "first_broken")


def item_facts(lines: DataFrame, key: str = "source_file") -> DataFrame:
    aggregates = [column.alias(name) for name, column in item_aggregates().items()]
    return with_item_findings(lines.groupBy(key).agg(*aggregates))


def item_facts_in_place(
    df: DataFrame, items: Column, tolerance: str = fixed.ROUNDING_TOLERANCE
) -> DataFrame:
    """The same facts for documents that carry their raw items as an array; adds `line_items`."""
    entries = F.transform(
        items, lambda raw, i: F.struct((i + 1).alias("position"), raw.alias("item"))
    )
    judged = df.withColumn("_lines", judge_entries(entries, tolerance))

    def messages(name: str) -> Column:
        found = F.array_compact(F.transform("_lines", lambda line: line[name]))
        return F.coalesce(found, F.array().cast("array<string>"))

    wide = "decimal(38,6)"
    stored = F.transform("_kept", lambda line: F.struct(*(line[n].alias(n) for n in STORED)))
    no_items = F.array().cast(T.ArrayType(LINE_ITEM))
    return (
        judged.withColumn("_kept", F.filter("_lines", lambda line: ~line["is_skipped"]))
        .withColumns(
            {
                "n_items": F.greatest(F.size("_kept"), F.lit(0)).cast("bigint"),
                "items_sum": F.aggregate(
                    "_kept",
                    F.lit(0).cast(wide),
                    lambda total, line: (
                        total + F.coalesce(line["line_total"], F.lit(0).cast(AMOUNT))
                    ).cast(wide),
                ),
                "item_error": F.try_element_at(messages("error"), F.lit(1)),
                "item_skips": messages("skipped"),
                "item_mismatches": messages("mismatch"),
                "line_items": F.coalesce(stored, no_items),
            }
        )
        .drop("_lines", "_kept")
    )


def extraction_warnings(threshold: float = fixed.CONFIDENCE_THRESHOLD) -> Column:
    """Warnings of the mapping step in their fixed order (E8, E14, E15, E9: E16)."""
    mean = F.col("confidence_mean")
    return F.concat(
        present(F.col("address_warning")),
        F.col("item_skips"),
        present(
            F.when(F.col("n_items") == 0, fixed.NO_ITEMS_EXTRACTED),
            F.when(
                mean < threshold,
                fill(
                    fixed.LOW_MEAN_CONFIDENCE,
                    confidence=fixed_places(mean, 2),
                    threshold=F.lit(str(threshold)),
                ),
            ),
        ),
    )


def reject_unmappable(df: DataFrame) -> DataFrame:
    """Set `stage` and `reason` where mapping fails and no earlier stage did."""
    score = F.col("confidence_score")
    broken = F.coalesce(
        F.col("item_error"),
        fill("amount is out of range: {fields}", fields=F.col("oversized_fields")),
        F.when((score < 0) | (score > 1) | F.isnan(score), "confidence_score is not within 0 and 1"),
    )
    missing = F.col("missing_fields")
    open_case = F.col("reason").isNull()
    return df.withColumns(
        {
            "stage": F.when(open_case & missing.isNotNull(), "extraction")
            .when(open_case & broken.isNotNull(), "unexpected")
            .otherwise(F.col("stage")),
            "reason": F.when(
                open_case & missing.isNotNull(), fill(fixed.MISSING_REQUIRED, fields=missing)
            )
            .when(open_case & broken.isNotNull(), broken)
            .otherwise(F.col("reason")),
        }
    )
