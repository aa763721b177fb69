"""The eight sample documents: built from literal values, written in local form, read back."""

from datetime import date

from pyspark.sql import functions as F

from documents import judged
from tallywright.functions import dates, money
from tallywright.sources.assembly import STANDARD_RATE, document_totals

# Unit prices of the item pool, and the sample documents as (number, first and last item
# of the pool, day, month, year, date format).
PRICES = [1200.00, 850.00, 299.00, 1899.00, 450.00, 89.00, 320.00, 625.00, 149.00, 199.00, 780.00, 540.00]
POOL = [(f"good number {n}", price) for n, price in enumerate(PRICES, 1)]
SAMPLES = [
    ("RE-2024-0091", 0, 3, 5, 1, 2024, 0),
    ("RE-2024-0092", 2, 4, 12, 2, 2024, 1),
    ("RE-2024-0093", 1, 5, 20, 3, 2024, 2),
    ("RE-2024-0094", 4, 6, 8, 4, 2024, 0),
    ("RE-2024-0095", 3, 6, 15, 5, 2024, 1),
    ("RE-2024-0096", 6, 11, 3, 6, 2024, 2),
    ("RE-2024-0097", 5, 7, 22, 7, 2024, 0),
    ("RE-2024-0098", 8, 12, 30, 8, 2024, 1),
]


def test_seven_of_eight_samples_are_valid(spark):
    import json

    lines = spark.createDataFrame(
        [(n, text, 1.0, price) for n, a, b, *_ in SAMPLES for text, price in POOL[a:b]],
        "number string, description string, quantity double, unit_price double",
    )
    headers = spark.createDataFrame(
        [(n, date(y, m, d), form) for n, _, _, d, m, y, form in SAMPLES],
        "number string, day date, form int",
    )
    totals = document_totals(lines, "number", "quantity", "unit_price", STANDARD_RATE)
    due = dates.due_date_of(F.col("day"))
    written = headers.join(totals, "number").select(
        "number",
        dates.written_date(F.col("day"), F.col("form")).alias("day"),
        dates.written_date(due, F.col("form")).alias("due"),
        *(money.german_amount(F.col(n)).alias(n) for n in ("subtotal", "vat_amount", "total_amount")),
    )
    rows = {r.number: r for r in written.collect()}
    assert (rows["RE-2024-0091"].day, rows["RE-2024-0093"].day) == ("05.01.2024", "20/03/2024")
    assert rows["RE-2024-0091"].total_amount == "2.795,31 EUR"

    def as_read(text):
        return {"content": text, "confidence": 0.93}

    responses = {}
    for number, a, b, *_ in SAMPLES:
        row = rows[number]
        items = [
            {
                "Description": {"value": text},
                "Quantity": {"value": "1"},
                "UnitPrice": {"value": str(price)},
                "Amount": {"value": str(price)},
            }
            for text, price in POOL[a:b]
        ]
        named = {
            "InvoiceId": {"value": number, "confidence": 0.93},
            "VendorName": {"value": "Vendor", "confidence": 0.93},
            "InvoiceDate": as_read(row.day),
            "DueDate": as_read(row.due),
            "SubTotal": as_read(row.subtotal),
            "TotalTax": as_read(row.vat_amount),
            "InvoiceTotal": as_read(row.total_amount),
            "Items": items,
        }
        responses[number] = json.dumps({"documents": [{"fields": named}]})
    result = judged(spark, responses, as_of="2025-01-01", read_written=True)
    flagged = {n: r.validation_issues for n, r in result.items() if r.validation_status != "valid"}
    assert flagged == {
        "RE-2024-0098": [
            "due_date 2024-08-28 is before invoice_date 2024-08-30 - dates may be swapped"
        ]
    }
