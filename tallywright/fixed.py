"""Thresholds and the wording of every reason, warning and issue.

These must stay as they are for results to match; everything else in the package is free to change.
"""

# Thresholds.
CONFIDENCE_THRESHOLD = 0.8
ROUNDING_TOLERANCE = "0.05"
VAT_RATES = (0.0, 0.07, 0.19)
VAT_RATE_TOLERANCE = 0.005
FIRST_PLAUSIBLE_YEAR = 2000
FUTURE_GRACE_DAYS = 1

# Names of the required fields, in reporting order.
REQUIRED_FIELDS = ("invoice_number", "invoice_date", "vendor_name", "total_amount")

# Intake reasons.
MISSING_FILE = "File does not exist on disk"
WRONG_EXTENSION = "Expected a .pdf file, got '{suffix}'"
UNOPENABLE = "Could not open file - it may be corrupted: {detail}"
NO_PAGES = "PDF has no pages"
ENCRYPTED = "PDF is password protected"
INTAKE_OK = "OK"

# Mapping reasons and warnings.
NO_RESPONSE = "no analysis response was recorded for this file"
CORRUPT_RESPONSE = "the recorded analysis response is not readable"
NOT_RECOGNIZED = "analysis did not recognize this file as an invoice"
MISSING_REQUIRED = "Missing required field(s): {fields}"
LOW_ADDRESS_CONFIDENCE = (
    "vendor_address has low confidence ({confidence}) - verify against source PDF"
)
ITEM_SKIPPED = "Line item {position} ('{description}') had incomplete pricing - skipped"
NO_ITEMS_EXTRACTED = "No line items were extracted"
LOW_MEAN_CONFIDENCE = (
    "Average confidence {confidence} is below threshold {threshold} - recommend manual review"
)
DEFAULT_DESCRIPTION = "Item {position}"
DEFAULT_QUANTITY = "1.0"

# Cross-check warnings.
LINE_TOTAL_MISMATCH = (
    "Line item {position} ('{description}'): quantity x unit_price = {expected}, "
    "but extracted line_total = {actual}"
)
GRAND_TOTAL_MISMATCH = (
    "subtotal + VAT = {expected}, but extracted total_amount = {actual} (difference: {difference})"
)
ITEM_SUM_MISMATCH = "Sum of line items ({items_sum}) does not match extracted subtotal ({subtotal})"

# Plausibility issues and statuses.
LOW_SCORE = "Confidence score {score} is below threshold {threshold}"
HAS_WARNINGS = "{count} extraction/transformation warning(s) present"
IMPLAUSIBLE_YEAR = "invoice_date year {year} looks implausible"
FUTURE_DATE = "invoice_date {date} is in the future"
DUE_BEFORE_INVOICE = "due_date {due} is before invoice_date {date} - dates may be swapped"
UNKNOWN_VAT_RATE = "vat_rate {rate} does not match a standard German rate (0%, 7%, 19%)"
NOT_POSITIVE = "total_amount {total} is not a positive value"
HAS_NO_ITEMS = "Invoice has no line items"
VALID = "valid"
NEEDS_REVIEW = "needs_review"
FAILED = "failed"

# How a failed file's reason starts, by stage.
STAGE_PREFIX = {
    "preprocessing": "Preprocessing failed: {reason}",
    "extraction": "Extraction failed: {reason}",
    "unexpected": "Unexpected error: {reason}",
}
NUMBER_TAKEN = "UNIQUE constraint failed: invoices.invoice_number"
