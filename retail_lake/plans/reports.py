"""The four business questions, as SQL over the published marts."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Titles and columns of the reports. Names in braces are marts.
REPORTS = {
    "Total revenue & orders": """
        SELECT sum(revenue) AS total_revenue, sum(orders) AS total_orders
        FROM {mart_daily_sales}""",
    "Top 5 categories by revenue": """
        SELECT category, revenue, units_sold
        FROM {mart_sales_by_category}
        ORDER BY revenue DESC NULLS LAST, category
        LIMIT 5""",
    "Monthly revenue trend": """
        SELECT year, month, sum(revenue) AS revenue
        FROM {mart_daily_sales}
        GROUP BY year, month
        ORDER BY year, month""",
    "Top 5 customers by lifetime value": """
        SELECT full_name, country, segment, lifetime_value
        FROM {mart_top_customers}
        ORDER BY lifetime_value DESC NULLS LAST, customer_id
        LIMIT 5""",
}


def report(spark: SparkSession, title: str, marts: Mapping[str, DataFrame]) -> DataFrame:
    """Answer one question; ``marts`` maps mart names to published tables."""
    sql = REPORTS[title]
    return spark.sql(sql, **{name: df for name, df in marts.items() if f"{{{name}}}" in sql})
