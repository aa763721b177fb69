"""The base cases of the cross-checks and the plausibility checks, then the edges."""

import json

import pytest
from pyspark.sql import functions as F

from documents import ABSENT, ARITHMETIC, PLAUSIBLE, field, fields, item, judged, response
from tallywright.sources.responses import first_document, parse_responses

CASES = {
    "plausible": response(PLAUSIBLE),
    "low confidence": response(PLAUSIBLE, confidence=0.5),
    "swapped dates": response(PLAUSIBLE, date="2024-06-15", due="2024-06-01"),
    "future": response(PLAUSIBLE, date="2024-07-31", due=ABSENT),
    "tomorrow": response(PLAUSIBLE, date="2024-07-02", due=ABSENT),
    "odd rate": response(PLAUSIBLE, vat="35.00", total="135.00"),
    "zero rate": response(PLAUSIBLE, vat="0.00", total="100.00"),
    "reduced rate": response(PLAUSIBLE, vat="7.00", total="107.00"),
    "rate 0.1949": response(PLAUSIBLE, vat="19.49", total="119.49"),
    "rate 0.1951": response(PLAUSIBLE, vat="19.51", total="119.51"),
    "negative total": response(PLAUSIBLE, total="-50.00", subtotal=ABSENT, vat=ABSENT),
    "no items": response(PLAUSIBLE, items=[]),
    "old": response(PLAUSIBLE, date="1999-12-31", due=ABSENT),
    "arithmetic": response(ARITHMETIC),
    "bad line": response(
        ARITHMETIC,
        items=[item("Bad item", "2.0", "50.00", "999.00")],
        subtotal="999.00",
        vat="189.81",
        total="1188.81",
    ),
    "bad total": response(ARITHMETIC, total="500.00"),
    "one cent": response(ARITHMETIC, total="141.62"),
    "five cents": response(ARITHMETIC, total="141.66"),
    "six cents": response(ARITHMETIC, total="141.67"),
    "bad sum": response(ARITHMETIC, items=[item("Item A", "2.0", "50.00", "100.00")]),
    "half even": response(
        ARITHMETIC,
        items=[item("x", "1", "2.345", "2.40"), item("y", "1", "116.60", "116.60")],
    ),
    "blank vendor": response(PLAUSIBLE, vendor="   "),
    "empty vendor": response(PLAUSIBLE, vendor=""),
    "wide spaces": response(
        PLAUSIBLE, vendor=" A  B\x1cC\n", customer="D \t E"
    ),
    "unreadable total": response(PLAUSIBLE, total="abc"),
    "all missing": json.dumps({"documents": [{"fields": {"Items": []}}]}),
    "zero total": response(PLAUSIBLE, total="0"),
    "huge total": response(PLAUSIBLE, total="2000000000000"),
    "not recognized": json.dumps({"documents": []}),
    "no documents": "{}",
    "corrupt": '{"documents": [',
    "two documents": json.dumps(
        {"documents": [{"fields": fields(PLAUSIBLE)}, {"fields": fields(PLAUSIBLE, number="B")}]}
    ),
    "backfilled": response(PLAUSIBLE, items=[item("x", "3", ABSENT, "100.00")]),
    "defaults": response(
        PLAUSIBLE,
        items=[item("x", "1", "60.00", "60.00"), item(ABSENT, ABSENT, ABSENT, "40.00")],
    ),
    "gap": response(
        PLAUSIBLE,
        items=[item("a", "1", "60.00"), item("b", "1", "100.00", "100.00"), item(None, "1", "5.00")],
    ),
    "zero quantity priced": response(PLAUSIBLE, items=[item("x", "0", "5.00", "100.00")]),
    "zero quantity unpriced": response(PLAUSIBLE, items=[item("x", "0", ABSENT, "100.00")]),
    "negative quantity": response(PLAUSIBLE, items=[item("x", "-2", ABSENT, "100.00")]),
    "empty description": response(
        PLAUSIBLE, items=[item("a", "1", "1", "1"), item("", "1", "99.00", "99.00")]
    ),
    "null description": response(PLAUSIBLE, items=[item(None, "1", "100.00", "100.00")]),
    "null quantity priced": response(PLAUSIBLE, items=[item("x", None, "100.00", "100.00")]),
    "null quantity unpriced": response(PLAUSIBLE, items=[item("x", None, ABSENT, "100.00")]),
    "text quantity": response(PLAUSIBLE, items=[item("x", "two", ABSENT, "100.00")]),
    "huge price": response(PLAUSIBLE, items=[item("x", "1", "5000000000", "100.00")]),
    "first broken item": response(
        PLAUSIBLE,
        items=[item("", "1", "1", "1"), item("b", "-1", "1", "1"), item("c", "0", "1", "1")],
    ),
    "mean just below": response(PLAUSIBLE, confidence=0.8, number_confidence=0.79984),
    "confidence above one": response(PLAUSIBLE, confidence=1.5),
    "no confidence": response(PLAUSIBLE, number_confidence=None),
    "weak address": response(
        PLAUSIBLE, more={"VendorAddress": field("Main St 1", 0.505, content="Main  St\n1")}
    ),
    "everything": response(
        PLAUSIBLE,
        confidence=0.5,
        date="1999-01-02",
        due="1999-01-01",
        items=[item("x", "1")],
        vat="50.00",
        total="-3",
        more={"VendorAddress": field("a", 0.1)},
    ),
}


@pytest.fixture(scope="module")
def rows(spark):
    return judged(spark, CASES)


def issues(row):
    return "; ".join(row.validation_issues)


def warnings(row):
    return "; ".join(row.extraction_warnings)


def test_clean_document_is_valid(rows):
    row = rows["plausible"]
    assert (row.reason, row.validation_status) == (None, "valid")
    assert row.validation_issues == [] and row.extraction_warnings == []
    assert abs(row.vat_rate - 0.19) < 1e-12


@pytest.mark.parametrize(
    ("case", "text"),
    [
        ("low confidence", "Confidence score 0.5 is below threshold 0.8"),
        ("swapped dates", "due_date 2024-06-01 is before invoice_date 2024-06-15 - dates may be swapped"),
        ("future", "invoice_date 2024-07-31 is in the future"),
        ("odd rate", "vat_rate 0.350 does not match a standard German rate (0%, 7%, 19%)"),
        ("rate 0.1951", "vat_rate 0.195 does not match"),
        ("negative total", "total_amount -50.00 is not a positive value"),
        ("zero total", "total_amount 0.00 is not a positive value"),
        ("no items", "Invoice has no line items"),
        ("old", "invoice_date year 1999 looks implausible"),
    ],
)
def test_issue_is_found(rows, case, text):
    assert rows[case].validation_status == "needs_review"
    assert text in issues(rows[case])


def test_known_rates_pass(rows):
    for case in ("zero rate", "reduced rate", "plausible", "rate 0.1949"):
        assert "vat_rate" not in issues(rows[case])
    assert rows["zero rate"].vat_rate is None


def test_one_day_ahead_is_not_the_future(rows):
    assert rows["tomorrow"].validation_status == "valid"


def test_a_warning_forces_review(rows):
    row = rows["bad total"]
    assert row.validation_status == "needs_review"
    assert row.validation_issues == ["1 extraction/transformation warning(s) present"]


def test_text_is_cleaned(rows):
    assert rows["arithmetic"].vendor_name == "Test Vendor GmbH"
    assert rows["arithmetic"].customer_name is None
    assert (rows["wide spaces"].vendor_name, rows["wide spaces"].customer_name) == ("A B C", "D E")


def test_consistent_arithmetic_has_no_warnings(rows):
    for case in ("arithmetic", "one cent", "five cents"):
        assert rows[case].extraction_warnings == []


def test_arithmetic_warnings(rows):
    assert rows["bad line"].extraction_warnings == [
        "Line item 1 ('Bad item'): quantity x unit_price = 100.00, but extracted line_total = 999.00"
    ]
    assert rows["bad total"].extraction_warnings == [
        "subtotal + VAT = 141.61, but extracted total_amount = 500.00 (difference: 358.39)"
    ]
    assert "(difference: 0.06)" in warnings(rows["six cents"])
    assert rows["bad sum"].extraction_warnings == [
        "Sum of line items (100.00) does not match extracted subtotal (119.00)"
    ]
    assert rows["bad sum"].n_new_warnings == 1


def test_cents_are_rounded_half_even(rows):
    # 2.345 is 2.34 here, six cents from 2.40; rounded half up it would be within tolerance.
    assert rows["half even"].extraction_warnings == [
        "Line item 1 ('x'): quantity x unit_price = 2.34, but extracted line_total = 2.40"
    ]


def test_required_fields(rows):
    missing = "Missing required field(s): "
    assert rows["all missing"].reason == (
        missing + "invoice_number, invoice_date, vendor_name, total_amount"
    )
    assert rows["empty vendor"].reason == missing + "vendor_name"
    assert rows["unreadable total"].reason == missing + "total_amount"
    assert rows["unreadable total"].stage == "extraction"
    assert rows["blank vendor"].reason is None and rows["blank vendor"].vendor_name == ""
    assert rows["zero total"].reason is None


def test_unusable_responses(rows):
    not_recognized = "analysis did not recognize this file as an invoice"
    assert rows["not recognized"].reason == not_recognized
    assert rows["no documents"].reason == not_recognized
    assert rows["corrupt"].reason == "the recorded analysis response is not readable"


def test_only_the_first_document_counts(rows):
    assert rows["two documents"].invoice_number == "TEST-001"


def test_price_is_derived_from_the_total(rows):
    line = rows["backfilled"].line_items[0]
    assert str(line.unit_price) == "33.3333333333"
    assert rows["backfilled"].validation_status == "valid"


def test_item_defaults(rows):
    line = rows["defaults"].line_items[1]
    assert (line.position, line.description, line.quantity) == (2, "Item 2", 1.0)
    assert rows["defaults"].validation_status == "valid"


def test_skipped_items_leave_gaps(rows):
    row = rows["gap"]
    assert [line.position for line in row.line_items] == [2]
    assert row.extraction_warnings == [
        "Line item 1 ('a') had incomplete pricing - skipped",
        "Line item 3 ('None') had incomplete pricing - skipped",
    ]


def test_zero_or_missing_quantity_without_price_is_skipped(rows):
    for case in ("zero quantity unpriced", "null quantity unpriced"):
        assert rows[case].reason is None
        assert rows[case].extraction_warnings[-1] == "No line items were extracted"


@pytest.mark.parametrize(
    ("case", "text"),
    [
        ("zero quantity priced", "Line item 1: quantity is not greater than 0"),
        ("negative quantity", "Line item 1: quantity is not greater than 0"),
        ("empty description", "Line item 2: description is empty"),
        ("null description", "Line item 1: description is empty"),
        ("null quantity priced", "Line item 1: quantity is missing"),
        ("text quantity", "Line item 1: quantity is not a number"),
        ("huge price", "Line item 1: amount is out of range"),
        ("first broken item", "Line item 1: description is empty"),
        ("huge total", "amount is out of range: total_amount"),
        ("confidence above one", "confidence_score is not within 0 and 1"),
    ],
)
def test_model_rejects(rows, case, text):
    assert (rows[case].stage, rows[case].reason) == ("unexpected", text)


def test_raw_mean_warns_where_the_rounded_score_does_not(rows):
    row = rows["mean just below"]
    assert row.confidence_score == 0.8
    assert row.extraction_warnings == [
        "Average confidence 0.80 is below threshold 0.8 - recommend manual review"
    ]
    assert row.validation_issues == ["1 extraction/transformation warning(s) present"]


def test_missing_confidence_counts_as_zero(rows):
    assert rows["no confidence"].confidence_score == 0.7125


def test_address_confidence(rows):
    row = rows["weak address"]
    assert row.vendor_address == "Main St 1"
    assert row.extraction_warnings == [
        "vendor_address has low confidence (0.50) - verify against source PDF"
    ]


def test_order_of_warnings_and_issues(rows):
    row = rows["everything"]
    starts = ["vendor_address has", "Line item 1", "No line items", "Average conf", "subtotal + VAT"]
    assert [a.startswith(b) for a, b in zip(row.extraction_warnings, starts, strict=True)] == [True] * 5
    starts = ["Confidence", "5 extraction", "invoice_date year", "due_date", "vat_rate", "total_amount", "Invoice has"]
    assert [a.startswith(b) for a, b in zip(row.validation_issues, starts, strict=True)] == [True] * 7


def test_written_values_are_read_on_request(spark):
    written = fields(
        PLAUSIBLE,
        date=ABSENT,
        total=ABSENT,
        more={
            "InvoiceDate": {"content": "05/01/2024", "confidence": 0.9},
            "InvoiceTotal": {"content": "1.234,56 EUR", "confidence": 0.9},
        },
    )
    text = json.dumps({"documents": [{"fields": written}]})
    plain = judged(spark, {"a": text})["a"]
    assert plain.reason == "Missing required field(s): invoice_date, total_amount"
    row = judged(spark, {"a": text}, read_written=True)["a"]
    assert (str(row.invoice_date), str(row.total_amount)) == ("2024-01-05", "1234.560000")


def test_thresholds_are_arguments(spark):
    row = judged(spark, {"a": CASES["six cents"]}, tolerance="0.10", threshold=0.99)["a"]
    assert row.extraction_warnings == [
        "Average confidence 0.95 is below threshold 0.99 - recommend manual review"
    ]


def test_input_columns_stay_as_they_were(spark):
    from tallywright.operators.crosscheck import clean_parties

    before = spark.createDataFrame([("  a  b ",)], "vendor_name string")
    clean_parties(before)
    assert before.first().vendor_name == "  a  b "


def test_short_numbers(spark):
    from tallywright.functions.text import short_number

    values = [23.0, 2.5, 1234567.0, 0.5, 100.0, 1000000.0, 0.0001, 0.00001, 123456.7, 0.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    shown = [row[0] for row in frame.select(short_number(F.col("v"))).collect()]
    assert shown == [f"{v:g}" for v in values]


def test_written_amounts_and_long_keys(spark):
    from tallywright.functions.money import parse_german_amount
    from tallywright.functions.text import padded

    written = {"1.234,56 EUR": 1234.56, "119.00": 119.0, "1234.56": 1234.56, "1.234": None, "1,234.56": None}
    written |= {"auf Anfrage": None, "-5,00 EUR": -5.0, "12": 12.0, "": None, "1.23,4": None}
    df = spark.createDataFrame(list(written.items()), "text string, amount double")
    got = df.withColumn("got", parse_german_amount(F.col("text")).cast("double"))
    assert all(r.got == r.amount for r in got.collect())
    keys = spark.createDataFrame([(7,), (123456789012,), (123456789999,)], "k long")
    assert [r[0] for r in keys.select(padded(F.col("k"))).collect()] == [
        "000000007", "123456789012", "123456789999"
    ]


def test_recorded_shapes_of_amounts_and_items(spark):
    item = '{"Description":{"value":"a"},"Amount":{"value":%s}}'
    bodies = {
        "plain": '{"InvoiceTotal":{"value":"7"},"Items":[' + item % "5" + "]}",
        "nested": '{"InvoiceTotal":{"value":{"amount":7}},"Items":{"value":[{"value":'
        + item % '{"symbol":"x","amount":5}' + "},null]}}",
        "bare": '{"InvoiceTotal":{"value":{"symbol":"x"}},"Items":{"value":null}}',
        "none": '{"InvoiceTotal":null}',
        "broken": '{"InvoiceTotal":{"value":"7"},"Items":"text"}',
    }
    rows = [(name, '{"documents":[{"fields":' + body + "}]}") for name, body in bodies.items()]
    recorded = spark.createDataFrame(rows, "name string, json string").selectExpr(
        "name", "json", "CAST(NULL AS string) stage", "CAST(NULL AS string) reason"
    )
    read = {r.name: r for r in first_document(parse_responses(recorded, "json")).collect()}
    amounts = {n: [i and i.Amount.value for i in r.fields.Items or []] for n, r in read.items() if n != "broken"}
    assert amounts == {"plain": ["5"], "nested": ["5", None], "bare": [], "none": []}
    totals = {n: r.fields.InvoiceTotal and r.fields.InvoiceTotal.value for n, r in read.items()}
    assert totals == {"plain": "7", "nested": "7", "bare": None, "none": None, "broken": "7"}
    assert {n for n, r in read.items() if r.reason} == {"broken"}


def test_written_prices_of_items_are_read_on_request(spark):
    def written(text):
        return {"content": text, "confidence": 0.9}

    items = [
        {"Description": {"value": "a"}, "Quantity": {"value": "2"}, "UnitPrice": written("40,00 EUR"), "Amount": written("80.00")},
        {"Description": {"value": "b"}, "Amount": written("20,00 €")},
        {"Description": {"value": "c"}, "UnitPrice": written("5,00"), "Amount": written("auf Anfrage")},
    ]
    text = json.dumps({"documents": [{"fields": fields(PLAUSIBLE, items=items)}]})
    row = judged(spark, {"a": text}, read_written=True)["a"]
    found = [(x.position, float(x.unit_price), float(x.line_total)) for x in row.line_items]
    assert found == [(1, 40.0, 80.0), (2, 20.0, 20.0)]
    assert row.extraction_warnings == ["Line item 3 ('c') had incomplete pricing - skipped"]
    assert judged(spark, {"a": text})["a"].line_items == []
