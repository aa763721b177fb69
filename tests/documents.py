"""Recorded responses for tests, built from plain values."""

import json

from pyspark.sql import functions as F

from tallywright.plans.batch import evaluate
from tallywright.sources.responses import parse_responses

ABSENT = object()


def field(value, confidence=0.95, content=None):
    if value is ABSENT:
        return None
    text = None if value is None else str(value)
    return {"value": text, "content": content or text, "confidence": confidence}


def item(description="Item A", quantity="1.0", unit_price=ABSENT, amount=ABSENT):
    values = {
        "Description": description,
        "Quantity": quantity,
        "UnitPrice": unit_price,
        "Amount": amount,
    }
    return {name: field(value) for name, value in values.items() if value is not ABSENT}


# The two base documents the checks are defined on.
PLAUSIBLE = {
    "number": "TEST-001",
    "date": "2024-06-01",
    "due": "2024-06-15",
    "vendor": "Test Vendor GmbH",
    "customer": ABSENT,
    "items": [item("Test item", "1.0", "100.00", "100.00")],
    "subtotal": "100.00",
    "vat": "19.00",
    "total": "119.00",
    "confidence": 0.95,
}
ARITHMETIC = PLAUSIBLE | {
    "due": ABSENT,
    "vendor": "  Test   Vendor GmbH  ",
    "items": [item("Item A", "2.0", "50.00", "100.00"), item("Item B", "1.0", "19.00", "19.00")],
    "subtotal": "119.00",
    "vat": "22.61",
    "total": "141.61",
}


def fields(base, **changes):
    values = base | changes
    confidence = values["confidence"]
    named = {
        "InvoiceId": field(values["number"], values.get("number_confidence", confidence)),
        "InvoiceDate": field(values["date"], confidence),
        "VendorName": field(values["vendor"], confidence),
        "InvoiceTotal": field(values["total"], confidence),
        "DueDate": field(values["due"]),
        "CustomerName": field(values["customer"]),
        "SubTotal": field(values["subtotal"]),
        "TotalTax": field(values["vat"]),
    } | values.get("more", {})
    named = {name: content for name, content in named.items() if content is not None}
    return named | {"Items": values["items"]}


def response(base, **changes):
    return json.dumps({"documents": [{"fields": fields(base, **changes)}]})


def judged(spark, responses, as_of="2024-07-01", **options):
    """Evaluate `{name: json text}`; returns rows by name."""
    rows = [(name, None, None, text) for name, text in responses.items()]
    recorded = spark.createDataFrame(
        rows, "source_file string, stage string, reason string, json string"
    )
    documents = parse_responses(recorded, "json")
    result = evaluate(documents, F.lit(as_of).cast("date"), **options)
    return {row.source_file: row for row in result.collect()}
