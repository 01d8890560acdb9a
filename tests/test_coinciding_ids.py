"""Products whose ids coincide, as the samples' do from 100,000 parts on."""

import pytest
from pyspark.sql import functions as F

from retail_lake.operators import expect
from retail_lake.operators.keyed import unseen
from retail_lake.plans import marts, silver
from retail_lake.plans.oracle import ORACLES
from retail_lake.plans.registry import QUERIES
from tests.conftest import SMALL
from tests.oracle import TABLES, actual, connect, expected
from tests.test_marts import fact_frame
from tests.test_silver import products_frame


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with every part once more under a number above 100,000, which half
    of the lines name."""
    path = tmp_path_factory.mktemp("coinciding")
    for name in TABLES:
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "part":
            again = table.withColumn("p_partkey", F.col("p_partkey") + 100_000)
            again = again.withColumn("p_retailprice", F.col("p_retailprice") + 1)
            table = table.unionByName(again)
        if name == "lineitem":
            table = table.withColumn("l_partkey", F.col("l_partkey") + F.col("l_linenumber") % 2 * 100_000)
        table.coalesce(1).write.parquet(str(path / f"{name}.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def con(folder, tmp_path_factory):
    links = tmp_path_factory.mktemp("links")
    for name in TABLES:  # the folder's single files, by the names that the SQL reads
        file = next(f for f in (tmp_path_factory.getbasetemp() / folder / f"{name}.parquet").iterdir() if f.suffix == ".parquet")
        (links / f"{name}.parquet").symlink_to(file)
    with connect(str(links)) as connection:
        yield connection


@pytest.mark.parametrize(
    "name",
    [
        "bi_top_categories", "clean_products", "dim_product", "dq_checks",
        "incremental_roundtrip", "layer_roundtrip", "mart_category", "mart_refresh",
    ],
)
def test_products_that_share_an_id_are_all_kept(spark, folder, con, name):
    assert actual(QUERIES[name](spark, folder)) == expected(con, ORACLES[name])


def test_the_number_tells_products_apart(spark):
    rows = [("P1", "A", "H", "X", "1", "1", 1), ("P1", "B", "H", "X", "1", "1", 1), ("P1", "B", "H", "X", "1", "1", 2)]
    raw = products_frame(spark, *rows)
    assert silver.products(raw).count() == 1
    numbered = silver.products(raw.withColumn("part_no", F.col("product_name")))
    assert sorted(r["part_no"] for r in numbered.collect()) == ["A", "B"]


def test_unique_over_several_columns(spark):
    df = spark.sql("SELECT * FROM VALUES ('P1', '1'), ('P1', '2'), ('P1', null), (null, '1') AS t(id, no)")
    row = expect.evaluate(df, expect.unique("id", "no")).first()
    assert tuple(row) == ("unique[id, no]", True, "4 rows / 4 distinct")
    assert not expect.evaluate(df.unionAll(df), expect.unique("id", "no")).first()["passed"]


def test_unseen_keys_of_several_columns(spark):
    known = spark.sql("SELECT * FROM VALUES ('P1', '1'), ('P2', null) AS t(id, no)")
    new = spark.sql("SELECT * FROM VALUES ('P1', '1'), ('P1', '2'), ('P2', null), (null, '1') AS t(id, no)")
    assert sorted(map(tuple, unseen(new, known, "id", "no").collect()), key=str) == [("P1", "2"), (None, "1")]


def test_rows_of_one_attribute_meet_lines_once(spark):
    """However many products share an id, a line meets one row of each category."""
    fact = fact_frame(spark, ("O1", "C1", "P1", 20240101, "completed", 2, "5"), ("O2", "C1", "P2", 20240101, "completed", 1, "3"))
    products = spark.range(1000).selectExpr("'P1' AS product_id", "concat('K', id % 2) AS category")
    mart = marts.SALES_BY_CATEGORY.build(fact, products)
    got = {r["category"]: (r["orders"], r["units_sold"], str(r["revenue"])) for r in mart.collect()}
    assert got == {"K0": (1, 1000, "2500.00"), "K1": (1, 1000, "2500.00"), None: (1, 1, "3.00")}
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    assert "_times" in plan and dict(mart.dtypes)["revenue"] == "decimal(28,2)"
