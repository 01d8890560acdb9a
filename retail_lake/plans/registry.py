"""Named queries over the supplied tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.functions.columns import month_key
from retail_lake.operators.conform import REASON
from retail_lake.operators.keyed import unmatched
from retail_lake.plans import marts, silver, star
from retail_lake.plans.jobs import SERVED, Thresholds, quality_results, refresh_marts, run
from retail_lake.plans.lake import Lake, new_run_id, scratch_folder, write_table
from retail_lake.plans.reports import report
from retail_lake.schemas import BATCH, INGESTED, PART_NO, RAW_CUSTOMERS, RAW_ORDERS, SOURCE_FILE
from retail_lake.sources import samples
from retail_lake.sources.landing import read_csv, read_json_lines, with_lineage

Query = Callable[[SparkSession, str], DataFrame]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customers(samples.customers(spark, sf_dir))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.products(samples.products(spark, sf_dir)).drop(PART_NO)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.order_items(samples.order_events(spark, sf_dir))


def _dedup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First delivered events, with the number of items of each order."""
    events = silver.first_events(samples.order_events(spark, sf_dir))
    header = ("order_id", "customer_id", "order_ts", "channel", "payment_method", "status")
    return events.groupBy(*header).agg(F.sum(F.size("items").cast("bigint")).alias("items"))  # over documents


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sales(_lines(spark, sf_dir))


def _mart_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return marts.DAILY_SALES.build(star.fact_sales(lines), star.dim_date(lines))


def _mart_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = star.dim_product(_products(spark, sf_dir))
    return marts.SALES_BY_CATEGORY.build(_fact(spark, sf_dir), dimension)


def _mart_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = star.dim_customer(_customers(spark, sf_dir))
    return marts.TOP_CUSTOMERS.build(_fact(spark, sf_dir), dimension)


def _report(title: str, mart: marts.Mart, build: Query) -> Query:
    return lambda spark, sf_dir: report(spark, title, {mart.name: build(spark, sf_dir)})


def _dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "customers": _customers(spark, sf_dir),
        "products": _products(spark, sf_dir),
        "order_items": _lines(spark, sf_dir),
    }
    return quality_results(tables, Thresholds())


def _dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched(_lines(spark, sf_dir), _products(spark, sf_dir), "product_id")


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = silver.quarantine(
        samples.customers(spark, sf_dir), samples.products(spark, sf_dir), samples.order_events(spark, sf_dir)
    )
    return rejected.groupBy("source", REASON).agg(F.count(F.lit(1)).alias("rejected"))


def _bronze_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and ingest stamps per source file and batch, as bronze would hold them: lines
    of the order export, however many documents hold them."""
    raw = {
        "customers.csv": samples.customers(spark, sf_dir),
        "products.csv": samples.products(spark, sf_dir),
        "orders.json": samples.order_events(spark, sf_dir).select("order_id", BATCH, F.explode_outer("items")),
    }
    per_source = [
        with_lineage(df, name)
        .groupBy(F.col(SOURCE_FILE).alias("source_file"), BATCH)
        .agg(F.count(F.lit(1)).alias("row_count"), F.count(INGESTED).alias("stamped"))
        for name, df in raw.items()
    ]
    return reduce(DataFrame.unionByName, per_source)


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers conformed from CSV files."""
    path = f"{scratch_folder(spark, 'csv_roundtrip')}/customers.csv"
    samples.write_csv_export(samples.customers(spark, sf_dir), path)
    return silver.customers(read_csv(spark, path, RAW_CUSTOMERS))


def _csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers conformed from files whose columns come in two orders, one of them
    with a column more."""
    path = f"{scratch_folder(spark, 'csv_reordered')}/customers.csv"
    raw = samples.customers(spark, sf_dir)
    samples.write_csv_export(raw.where(F.col(BATCH) == 1), path)
    turned = raw.where(F.col(BATCH) == 2).select(*reversed(raw.columns), F.lit("x").alias("note"))
    samples.write_csv_export(turned, path, mode="append")
    return silver.customers(read_csv(spark, path, RAW_CUSTOMERS))


def _json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines conformed from nested JSON Lines files."""
    path = f"{scratch_folder(spark, 'json_roundtrip')}/orders.json"
    samples.write_json_export(samples.order_events(spark, sf_dir), path)
    return silver.order_items(read_json_lines(spark, path, RAW_ORDERS))


def _layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and the sum of the main amount, of every published table after a full
    run from landing files."""
    folder = scratch_folder(spark, "layer_roundtrip")
    samples.write_landing(spark, sf_dir, f"{folder}/landing")
    lake = Lake(spark, f"{folder}/lake", name=f"roundtrip_{new_run_id()}")
    run(lake, f"{folder}/landing", limits=Thresholds(min_order_items=1))
    return _published_totals(lake)


def _incremental_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a run over the first of several deliveries and one that adds the
    others, which bring new keys beside redelivered ones."""
    folder = scratch_folder(spark, "incremental_roundtrip")
    samples.write_landing(spark, sf_dir, f"{folder}/landing", staggered=True)
    lake = Lake(spark, f"{folder}/lake", name=f"incremental_{new_run_id()}")
    limits = Thresholds(min_order_items=1)
    run(lake, f"{folder}/landing", ("bronze", "silver"), limits, batches=[1])
    run(lake, f"{folder}/landing", limits=limits, batches=[2, 3], incremental=True)
    return _published_totals(lake)


def _published_totals(lake: Lake) -> DataFrame:
    published = {
        "silver": {"customers": None, "products": "unit_price", "order_items": "net_amount"},
        "served": dict(zip(SERVED, (None, "unit_price", None, "net_amount", "revenue", "revenue", "lifetime_value"))),
    }
    counts = [
        lake.table(layer, name)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(amount) if amount else F.lit(None)).cast("decimal(38,2)").alias("amount"),
        )
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "row_count", "amount")
        for layer, tables in published.items()
        for name, amount in tables.items()
    ]
    lake.unregister()
    return reduce(DataFrame.unionByName, counts)


def _mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and the sum of the main amount, of the marts recomputed from a star schema
    that was published without them."""
    lake = Lake(spark, scratch_folder(spark, "mart_refresh"), name=f"refresh_{new_run_id()}")
    run_id = new_run_id()
    tables = {
        "dim_customer": star.dim_customer(_customers(spark, sf_dir)),
        "dim_product": star.dim_product(_products(spark, sf_dir)),
        "fact_sales": _fact(spark, sf_dir),
    }
    staged = lake.stage_all("gold", tables, run_id)
    # The days are read from the written fact: made of the lines, they would take the lines' scans
    # and shuffles a second time.
    fact = next(lake.load(s) for s in staged if s.table == "fact_sales")
    dates = star.dim_date(fact.withColumn("order_date", F.to_date("order_ts")))
    staged.append(lake.stage("gold", "dim_date", dates, run_id))
    lake.publish(staged)
    refresh_marts(lake, new_run_id())
    amounts = {mart.name: F.sum(mart.measures[-1]).cast("decimal(38,2)") for mart in marts.MARTS}
    refreshed = lake.tables("gold", amounts)
    lake.unregister()
    totals = [
        refreshed[name].agg(F.count(F.lit(1)).alias("row_count"), amount.alias("amount")).select(F.lit(name).alias("mart"), "row_count", "amount")
        for name, amount in amounts.items()
    ]
    return reduce(DataFrame.unionByName, totals)


def _partition_pruned_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals of March 1997, reading that month's partition only."""
    path = f"{scratch_folder(spark, 'order_items')}/order_items"
    day = F.col("order_date")
    events = silver.by_month(silver.first_events(samples.order_events(spark, sf_dir)))
    lines = silver.conformed_lines(events).accepted.withColumn("order_month", month_key(day))
    write_table(lines, path, partition_by=("order_month",), gathered=True)
    month = spark.read.parquet(path).where(F.col("order_month") == 199703)
    return month.groupBy(day).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_amount").alias("net_amount")
    )


QUERIES: dict[str, Query] = {
    "clean_customers": _customers,
    "clean_products": _products,
    "dedup_orders": _dedup_orders,
    "order_lines": _lines,
    "dim_customer": lambda s, d: star.dim_customer(_customers(s, d)),
    "dim_product": lambda s, d: star.dim_product(_products(s, d)),
    "dim_date": lambda s, d: star.dim_date(_lines(s, d)),
    "fact_sales": _fact,
    "realized_sales": lambda s, d: star.realized(_fact(s, d)),
    "mart_daily": _mart_daily,
    "mart_category": _mart_category,
    "mart_top_customers": _mart_top_customers,
    "bi_total": _report("Total revenue & orders", marts.DAILY_SALES, _mart_daily),
    "bi_top_categories": _report(
        "Top 5 categories by revenue", marts.SALES_BY_CATEGORY, _mart_category
    ),
    "bi_monthly": _report("Monthly revenue trend", marts.DAILY_SALES, _mart_daily),
    "bi_top_customers": _report(
        "Top 5 customers by lifetime value", marts.TOP_CUSTOMERS, _mart_top_customers
    ),
    "dq_checks": _dq_checks,
    "dq_orphans": _dq_orphans,
    "quarantine": _quarantine,
    "bronze_audit": _bronze_audit,
    "csv_roundtrip": _csv_roundtrip,
    "csv_reordered": _csv_reordered,
    "json_roundtrip": _json_roundtrip,
    "layer_roundtrip": _layer_roundtrip,
    "incremental_roundtrip": _incremental_roundtrip,
    "mart_refresh": _mart_refresh,
    "partition_pruned_month": _partition_pruned_month,
}
