"""Star schema: customer, product and date dimensions around a line-grain sales fact."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions import columns as c

# This status, and the columns of the four tables below.
REALIZED = "completed"


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "full_name", "email", "country", "city", "segment", "signup_date"
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "category", "brand", "unit_price", "unit_cost"
    )


def dim_date(order_items: DataFrame) -> DataFrame:
    """The days on which anything was ordered. At most one row per calendar day
    leaves each task, so this stays small whatever the number of lines."""
    days = order_items.where(F.col("order_date").isNotNull()).select("order_date").distinct()
    day = F.col("order_date")
    return days.select(
        c.date_key(day).alias("date_key"),
        day,
        *[column.alias(name) for name, column in c.calendar(day).items()],
    )


def fact_sales(order_items: DataFrame) -> DataFrame:
    """One row per accepted order line, whatever the order's status."""
    return order_items.select(
        "order_item_id",
        "order_id",
        "customer_id",
        "product_id",
        c.date_key(F.col("order_date")).alias("date_key"),
        "order_ts",
        "channel",
        "payment_method",
        "status",
        "quantity",
        "unit_price",
        "discount_pct",
        "gross_amount",
        "net_amount",
    )


def realized(fact: DataFrame) -> DataFrame:
    """Sales that came through: neither returned nor cancelled."""
    return fact.where(F.col("status") == REALIZED)
