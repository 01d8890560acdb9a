"""Marts and reports: known totals, invariants, hot keys and plan shapes."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retail_lake.operators.keyed import unmatched
from retail_lake.plans import marts, silver, star
from retail_lake.plans.registry import QUERIES
from retail_lake.sources import samples
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def lines(spark):
    return silver.order_items(samples.order_events(spark, SMALL))


def only(df, *expressions):
    return df.selectExpr(*expressions).first()


def test_known_totals(spark, lines):
    row = only(lines, "count(*)", "count(distinct order_id)", "sum(gross_amount)", "sum(net_amount)")
    assert tuple(row) == (5990, 1473, Decimal("138345712.71"), Decimal("131336856.97"))
    assert samples.customers(spark, SMALL).count() == 162
    assert samples.products(spark, SMALL).count() == 205
    assert silver.products(samples.products(spark, SMALL)).count() == 188
    assert QUERIES["mart_daily"](spark, SMALL).count() == 440


def test_line_keys_are_unique(lines):
    assert only(lines, "count(*) = count(distinct order_item_id)")[0]


def test_marts_agree_on_revenue(spark):
    total = only(QUERIES["realized_sales"](spark, SMALL), "sum(net_amount)")[0]
    assert only(QUERIES["mart_daily"](spark, SMALL), "sum(revenue)")[0] == total
    assert only(QUERIES["mart_category"](spark, SMALL), "sum(revenue)")[0] == total


@pytest.mark.parametrize("layout", [1, 7])
def test_cutting_orders_into_documents_changes_nothing(spark, lines, tmp_path, layout):
    for name in ("lineitem", "orders", "part"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").repartition(layout).write.parquet(str(tmp_path / f"{name}.parquet"))
    cut = silver.order_items(samples.order_events(spark, str(tmp_path), chunk_items=3))
    assert cut.exceptAll(lines).count() == 0 and lines.exceptAll(cut).count() == 0


def test_cutting_orders_that_repeat_lines_changes_nothing(spark, tmp_path):
    """Every line twice under one number, in other quantities."""
    for name in ("lineitem", "orders", "part"):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            table = table.unionByName(table.withColumn("l_quantity", F.col("l_quantity") + 1))
        table.repartition(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    whole, cut = (silver.order_items(samples.order_events(spark, str(tmp_path), chunk_items=n)) for n in (100_000, 3))
    assert whole.count() > 11_900
    assert cut.exceptAll(whole).count() == 0 and whole.exceptAll(cut).count() == 0


def test_documents_stay_small(spark):
    documents = samples.order_events(spark, SMALL, chunk_items=3)
    assert documents.agg(F.max(F.size("items"))).first()[0] <= 3


def test_lines_are_scanned_once(spark):
    lines = QUERIES["order_lines"](spark, SMALL)
    lines.collect()  # a shuffle read twice is known as one when it runs
    plan = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", plan)) == 1


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_results_do_not_depend_on_partitioning(spark, partitions):
    expected = sorted(map(tuple, QUERIES["mart_top_customers"](spark, SMALL).collect()), key=str)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted(map(tuple, QUERIES["mart_top_customers"](spark, SMALL).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected


def fact_frame(spark, *rows):
    schema = "order_id string, customer_id string, product_id string, date_key int, status string, quantity int, net_amount decimal(18,2)"
    return spark.createDataFrame([(*r[:6], Decimal(r[6])) for r in rows], schema)


def test_category_mart_keeps_orphans_in_a_null_group(spark):
    fact = fact_frame(
        spark,
        ("O1", "C1", "P1", 20240101, "completed", 1, "5"),
        ("O1", "C1", "P9", 20240101, "completed", 2, "7"),
        ("O2", "C1", "P1", 20240101, "returned", 1, "5"),
    )
    products = spark.createDataFrame([("P1", "Home")], "product_id string, category string")
    got = {r["category"]: (r["orders"], r["units_sold"], r["revenue"]) for r in marts.SALES_BY_CATEGORY.build(fact, products).collect()}
    assert got == {"Home": (1, 1, Decimal("5.00")), None: (1, 2, Decimal("7.00"))}
    assert [tuple(r) for r in unmatched(fact, products, "product_id").collect()] == [("P9", 1)]


def test_daily_mart_keeps_undated_sales_in_a_null_group(spark):
    fact = fact_frame(
        spark,
        ("O1", "C1", "P1", None, "completed", 1, "5"),
        ("O2", "C1", "P1", 20240102, "completed", 1, "5"),
    )
    days = spark.sql("SELECT date'2024-01-02' AS order_date")
    rows = marts.DAILY_SALES.build(fact, star.dim_date(days)).collect()
    assert {(r["order_date"] and str(r["order_date"]), r["year"], r["orders"]) for r in rows} == {
        (None, None, 1),
        ("2024-01-02", 2024, 1),
    }


def test_top_customers_break_ties_and_keep_unknown_ones(spark):
    fact = fact_frame(
        spark,
        *[(f"O{i}", f"C{i:03d}", "P1", 20240101, "completed", 1, "5") for i in range(150)],
        ("O999", None, "P1", 20240101, "completed", 1, "9"),
    )
    customers = spark.createDataFrame(
        [(f"C{i:03d}", "n", "c", "s") for i in range(0, 150, 2)],
        "customer_id string, full_name string, country string, segment string",
    )
    rows = marts.TOP_CUSTOMERS.build(fact, customers).collect()
    assert {r["customer_id"] for r in rows} == {None, *(f"C{i:03d}" for i in range(99))}
    named = {r["customer_id"]: r["full_name"] for r in rows}
    assert (named["C002"], named["C003"], named[None]) == ("n", None, None)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_leave_each_task_as_few_rows(spark):
    """A third of all events are copies of one order, a third of all lines one product."""
    copies = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('O', id)) AS order_id",
        "'C1' AS customer_id", "'2024-01-01T00:00:00' AS order_ts", "'web' AS channel",
        "'upi' AS payment_method", "'completed' AS status",
        "array(named_struct('product_id', if(id % 3 = 1, 'P1', concat('P', id)), 'quantity', '1',"
        " 'unit_price', '2.00', 'discount_pct', '0')) AS items",
        "cast(id % 5 AS int) AS batch_id",
    )
    events = silver.first_events(copies.repartition(8))
    assert events.count() == 20_001
    plan = events._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    lines = silver.order_items(copies.repartition(8))
    held = unmatched(lines, spark.createDataFrame([("P2",)], "product_id string"), "product_id")
    hot = held.orderBy(F.desc("rows")).first()
    assert tuple(hot) == ("P1", 10_000)


def test_hot_product_is_split_where_the_dimension_is_too_large_to_broadcast(spark):
    lines = spark.range(300_000).selectExpr(
        "concat('O', id) AS order_id", "if(id % 3 = 0, 'P0', concat('P', id % 1000)) AS product_id",
        "'completed' AS status", "cast(1 AS int) AS quantity", "cast(2 AS decimal(18,2)) AS net_amount",
    )
    products = spark.range(1000).selectExpr("concat('P', id) AS product_id", "concat('K', id % 7) AS category")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        mart = marts.SALES_BY_CATEGORY.build(lines.repartition(8), products)
        plan = final_plan(mart)
        units = mart.agg(F.sum("units_sold")).first()[0]
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in plan
    assert units == 300_000


def test_no_query_multiplies_tables(spark):
    for name in ("mart_daily", "mart_category", "mart_top_customers", "dq_orphans", "quarantine"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_status_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    QUERIES["fact_sales"](spark, SMALL).write.parquet(path)
    products = silver.products(samples.products(spark, SMALL))
    mart = marts.SALES_BY_CATEGORY.build(spark.read.parquet(path), products)
    plan = mart._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(node for node in plan if "FileScan parquet" in node and "net_amount" in node)
    assert "EqualTo(status,completed)" in scan
    columns = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert sorted(c.split(":")[0] for c in re.split(r",(?=[a-z_]+:)", columns)) == [
        "net_amount", "order_id", "product_id", "quantity", "status",
    ]


def test_month_filter_prunes_partitions(spark):
    plan = QUERIES["partition_pruned_month"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*order_month[^\]]*199703", plan)
