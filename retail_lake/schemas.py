"""Explicit schemas and column types, so that no read ever infers one.

Landing columns are all text, numbers inside the nested order items included:
JSON numbers keep their digits when read as text, so a price reaches
``decimal`` without passing through ``double``.
"""

from pyspark.sql import types as T

MONEY = "decimal(18,2)"
PRICE = "decimal(24,6)"  # of one unit: finer than amounts, which alone are rounded
RATE = "decimal(5,4)"

CORRUPT = "_corrupt_record"
BATCH = "batch_id"
INGESTED = "_ingest_ts"
CHUNK = "chunk"
PART_NO = "part_no"  # optional: the source's own number of a product, where ids may coincide
SOURCE_FILE = "_source_file"


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column names of the three source systems.
RAW_CUSTOMERS = _text(
    "customer_id", "full_name", "email", "country", "city", "segment", "signup_date"
)
RAW_PRODUCTS = _text(
    "product_id", "product_name", "category", "brand", "unit_price", "unit_cost"
)
# ``line_no`` is optional: a source that cuts large orders into several documents
# numbers the lines itself; otherwise the position in the document counts.
ORDER_ITEM = _text("product_id", "quantity", "unit_price", "discount_pct", "line_no")
RAW_ORDERS = (
    _text("order_id", "customer_id", "order_ts", "channel", "payment_method", "status")
    .add("items", T.ArrayType(ORDER_ITEM))
    .add(CHUNK, T.LongType())  # optional: the document's number within its delivery of the order
)
