"""Column types shared by every step."""

from pyspark.sql import types as T

AMOUNT = "decimal(18,6)"
PRICE = "decimal(19,10)"
# Anything this large does not fit the types above and is rejected with a reason, never nulled.
AMOUNT_LIMIT = 1e12
PRICE_LIMIT = 1e9

FIELD = "struct<value:string,content:string,confidence:double>"

HEADER_FIELDS = (
    "InvoiceId",
    "InvoiceDate",
    "VendorName",
    "InvoiceTotal",
    "DueDate",
    "VendorAddress",
    "VendorTaxId",
    "CustomerName",
    "CustomerAddress",
    "SubTotal",
    "TotalTax",
)
ITEM_FIELDS = ("Description", "Quantity", "UnitPrice", "Amount")


def _struct(members: dict[str, str]) -> str:
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in members.items()) + ">"


RAW_ITEM = _struct(dict.fromkeys(ITEM_FIELDS, FIELD))
RAW_FIELDS = _struct(dict.fromkeys(HEADER_FIELDS, FIELD) | {"Items": f"array<{RAW_ITEM}>"})
# As recorded: items stay text until their shape is known, a list or a field whose value is a list.
RECORDED_ITEM = _struct(dict.fromkeys(ITEM_FIELDS, FIELD) | {"value": RAW_ITEM})
RECORDED_FIELDS = _struct(dict.fromkeys(HEADER_FIELDS, FIELD) | {"Items": "string"})
DOCUMENTS = f"array<struct<fields:{RECORDED_FIELDS}>>"

# A file as Spark lists and reads it.
FILE = "path string, modificationTime timestamp, length long, content binary"

# One recorded answer of the field analysis.
RESPONSE = f"source_file string, documents {DOCUMENTS}, _corrupt_record string"

LINE_ITEM = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("unit_price", T.DecimalType(19, 10)),
        T.StructField("line_total", T.DecimalType(18, 6)),
    ]
)

# The nested table: one row per stored invoice, items inside, so one write commits both.
STORED_INVOICE = T.StructType(
    [
        T.StructField("invoice_id", T.StringType()),
        T.StructField("invoice_number", T.StringType()),
        T.StructField("invoice_date", T.DateType()),
        T.StructField("due_date", T.DateType()),
        T.StructField("vendor_name", T.StringType()),
        T.StructField("vendor_address", T.StringType()),
        T.StructField("vendor_tax_id", T.StringType()),
        T.StructField("vendor_iban", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("customer_address", T.StringType()),
        T.StructField("line_items", T.ArrayType(LINE_ITEM)),
        T.StructField("subtotal", T.DecimalType(18, 6)),
        T.StructField("vat_rate", T.DoubleType()),
        T.StructField("vat_amount", T.DecimalType(18, 6)),
        T.StructField("total_amount", T.DecimalType(18, 6)),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("extraction_warnings", T.ArrayType(T.StringType())),
        T.StructField("validation_status", T.StringType()),
        T.StructField("validation_issues", T.ArrayType(T.StringType())),
        T.StructField("source_file", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

OUTCOME = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("n_issues", T.IntegerType()),
    ]
)
