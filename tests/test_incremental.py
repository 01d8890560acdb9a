"""Runs that add deliveries to a published lake, against one run over all of them."""

import os

import pytest
from pyspark.sql import functions as F

from retail_lake.operators.expect import ExpectationsFailed
from retail_lake.operators.keyed import unseen
from retail_lake.plans import jobs
from retail_lake.plans.jobs import SERVED, Thresholds
from retail_lake.plans.lake import Lake, new_run_id
from retail_lake.sources import samples
from tests.conftest import SMALL
from tests.oracle import canonical

LOW = Thresholds(min_order_items=100)
REJECTED = ("rejected_customers", "rejected_products", "rejected_items", "keyless_lines", "unreadable_events")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("staggered"))
    samples.write_landing(spark, SMALL, folder, staggered=True)
    return folder


def made(spark, folder):
    return Lake(spark, str(folder), name=f"t_{new_run_id()}")


@pytest.fixture(scope="module")
def whole(spark, landing, tmp_path_factory):
    lake = made(spark, tmp_path_factory.mktemp("whole"))
    jobs.run(lake, landing, limits=LOW)
    yield lake
    lake.unregister()


def files(lake):
    return {
        (os.path.join(at, name), os.stat(os.path.join(at, name)).st_mtime_ns)
        for at, _, names in os.walk(f"{lake.root}/silver")
        for name in names
    }


@pytest.fixture(scope="module")
def added(spark, landing, tmp_path_factory):
    """A lake after a run over the first delivery and one that adds the second and third,
    its silver files after either run, and the rows that the later one wrote."""
    lake = made(spark, tmp_path_factory.mktemp("added"))
    jobs.run(lake, landing, limits=LOW, batches=[1])
    first = files(lake)
    rows = jobs.run(lake, landing, limits=LOW, batches=[2, 3], incremental=True)
    yield lake, first, files(lake), rows
    lake.unregister()


def contents(df):
    return canonical(df.collect(), df.columns)


def test_added_deliveries_give_what_one_run_gives(whole, added):
    lake = added[0]
    tables = [("silver", name) for name in ("customers", "products", "order_items")] + [("served", name) for name in SERVED]
    for layer, name in tables:
        assert contents(lake.table(layer, name)) == contents(whole.table(layer, name)), name
    for name in REJECTED:  # their records hold ingest times
        reasons = lambda x, name=name: x.table("silver", name).groupBy("reject_reason").count()
        assert contents(reasons(lake)) == contents(reasons(whole)), name
    checks = lake.table("silver", "quality")
    assert contents(checks) == contents(whole.table("silver", "quality"))


def test_earlier_files_stay_and_only_touched_months_get_new_ones(added):
    lake, first, then, rows = added
    assert first < then
    months = {x.split("order_month=")[1].split("/")[0] for x, _ in then - first if "verdict=accepted" in x}
    assert months == {"199703"}
    march = lake.table("silver", "order_items").where(F.date_trunc("month", "order_date") == "1997-03-01")
    assert 0 < rows["silver.order_items"] == march.count()
    assert lake.table("silver", "customers").count() > rows["silver.customers"] > 0


def test_views_show_all_parts(spark, added):
    lake = added[0]
    for name in ("customers", "order_items"):
        assert contents(spark.table(lake.qualified("silver", name))) == contents(lake.table("silver", name))


def test_adding_nothing_or_an_earlier_delivery(spark, landing, added):
    lake, _, then, _ = added
    assert jobs.run(lake, stages=["silver"], limits=LOW, incremental=True) == {}
    assert files(lake) == then
    before = contents(lake.table("bronze", "customers"))
    with pytest.raises(ValueError, match="delivery 2 of .* does not come after"):
        jobs.run(lake, landing, stages=["bronze"], batches=[2], incremental=True)
    assert contents(lake.table("bronze", "customers")) == before


def test_a_failed_gate_can_be_followed_by_another_try(spark, landing, whole, tmp_path):
    lake = made(spark, tmp_path)
    jobs.run(lake, landing, ("bronze", "silver"), LOW, batches=[1])
    before = contents(lake.table("silver", "order_items"))
    with pytest.raises(ExpectationsFailed, match="min_rows"):
        jobs.run(lake, landing, ("bronze", "silver"), batches=[2, 3], incremental=True)
    assert contents(lake.table("silver", "order_items")) == before
    jobs.run(lake, stages=["silver"], limits=LOW, incremental=True)
    assert contents(lake.table("silver", "order_items")) == contents(whole.table("silver", "order_items"))
    jobs.run(lake, landing, ["bronze"], LOW)
    with pytest.raises(ValueError, match="in full"):
        jobs.run(lake, stages=["silver"], limits=LOW, incremental=True)
    lake.unregister()


def test_incremental_from_the_start(spark, landing, whole, tmp_path):
    lake = made(spark, tmp_path)
    for batch in (1, 2, 3):
        jobs.run(lake, landing, ("bronze", "silver"), LOW, batches=[batch], incremental=True)
    for name in ("customers", "products", "order_items"):
        assert contents(lake.table("silver", name)) == contents(whole.table("silver", name)), name
    # Folders of all parts of the last publication stay.
    lake.expire(keep=1, older_than=0)
    assert contents(lake.table("silver", "order_items")) == contents(whole.table("silver", "order_items"))
    lake.unregister()


def test_parts_of_different_columns_and_without_rows(spark, tmp_path):
    lake = made(spark, tmp_path)
    rows = [spark.sql("SELECT 1 AS id, CAST(NULL AS int) AS m"), spark.sql("SELECT 2 AS id, 5 AS m, 'x' AS note"), spark.sql("SELECT 3 AS id, 6 AS m").limit(0)]
    for df in rows:
        lake.publish([lake.stage("gold", "t", df, "r", ["m"])], add_to=["t"])
    assert sorted(map(tuple, lake.table("gold", "t").select("id", "m", "note").collect())) == [(1, None, None), (2, 5, "x")]
    assert dict(lake.table("gold", "t").dtypes)["m"] == "int" == dict(spark.table(lake.qualified("gold", "t")).dtypes)["m"]
    assert lake.published("gold")["t"].rows == 2 and len(lake.published("gold")["t"].parts) == 2
    lake.publish([lake.stage("gold", "t", rows[0], "r")])
    assert lake.table("gold", "t").count() == 1
    lake.unregister()


def test_unseen_keys_by_brute_force_without_moving_what_was_published(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5)], "k string, v int")
    old = spark.createDataFrame([("b", 0)] * 50 + [("z", 0), (None, 0)], "k string, w int")
    found = unseen(new, old, "k")
    assert sorted(r["v"] for r in found.collect()) == [1, 4, 5]
    assert unseen(new, old.limit(0), "k").count() == 5 and unseen(new.limit(0), old, "k").count() == 0


def test_a_small_delivery_shuffles_no_published_rows(spark, tmp_path):
    spark.range(100_000).selectExpr("concat('o', id) AS k", "id AS w").write.parquet(str(tmp_path / "old"))
    spark.range(10).selectExpr("concat('o', id * 20000) AS k", "id AS v").write.parquet(str(tmp_path / "new"))
    found = unseen(spark.read.parquet(str(tmp_path / "new")), spark.read.parquet(str(tmp_path / "old")), "k")
    assert found.count() == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [k" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan
