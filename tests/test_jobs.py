"""Staged runs over landing files: publishing, repeating, failing and refreshing."""

import json

import pytest
from pyspark.sql import functions as F

from retail_lake.operators.expect import ExpectationsFailed
from retail_lake.plans import jobs, silver
from retail_lake.plans.jobs import SERVED, Thresholds
from retail_lake.plans.lake import Lake, NotPublished, new_run_id, replace_partitions, scratch_folder, write_table
from retail_lake.plans.reports import REPORTS
from retail_lake.sources import samples
from retail_lake.sources.landing import read_csv, read_json_lines
from retail_lake.schemas import RAW_CUSTOMERS, RAW_ORDERS
from tests.conftest import SMALL
from tests.oracle import canonical

LOW = Thresholds(min_order_items=100)


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))
    samples.write_landing(spark, SMALL, folder)
    return folder


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, str(tmp_path / "lake"), name=f"t_{new_run_id()}")
    yield made
    made.unregister()


@pytest.fixture(scope="module")
def full(spark, landing, tmp_path_factory):
    made = Lake(spark, str(tmp_path_factory.mktemp("lake")), name=f"t_{new_run_id()}")
    rows = jobs.run(made, landing, limits=LOW)
    yield made, rows
    made.unregister()


def contents(df):
    return canonical(df.collect(), df.columns)


def test_full_run_publishes_every_table(full):
    lake, rows = full
    assert rows["bronze.customers"] == samples.customers(lake.spark, SMALL).count()
    assert all(lake.table(*name.split(".")).count() == n for name, n in rows.items())
    assert rows["silver.products"] == 188
    assert rows["gold.fact_sales"] == 5990
    for name in SERVED:
        assert lake.table("served", name).count() == rows[f"gold.{name}"]


def test_bronze_carries_lineage(full):
    lake, _ = full
    row = lake.table("bronze", "customers").agg(
        F.count("_ingest_ts").alias("n"), F.min("_source_file").alias("f"), F.max("batch_id").alias("b")
    ).first()
    assert row["n"] == lake.table("bronze", "customers").count() and row["f"].endswith(".csv") and row["b"] == 2


def test_rejected_rows_are_kept(full):
    lake, rows = full
    reasons = lake.table("silver", "rejected_products").groupBy("reject_reason").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"unparsable_price": 4, "non_positive_price": 8, "missing_key": 5}
    kept = lake.table("silver", "order_items").count()
    turned_away = lake.table("silver", "rejected_items").count()
    assert (rows["silver.order_items"], rows["silver.rejected_items"]) == (kept, turned_away) and kept == 5990
    reasons = lake.table("silver", "rejected_items").select("reject_reason").distinct().collect()
    assert {r[0] for r in reasons} == {"no_items", "non_positive_quantity"}
    assert lake.table("gold", "orphan_products").agg(F.sum("rows")).first()[0] == 389


def test_gate_results_are_kept(full):
    lake, _ = full
    checks = lake.table("silver", "quality").collect()
    assert len(checks) == 7 and all(r["passed"] for r in checks)


def test_running_again_gives_the_same_tables(spark, full, landing, lake):
    before, _ = full
    jobs.run(lake, landing, limits=LOW)
    jobs.run(lake, landing, limits=LOW)
    for name in SERVED:
        assert contents(lake.table("served", name)) == contents(before.table("served", name)), name


def test_stages_can_run_one_by_one(full, landing, lake):
    before, _ = full
    for stage in jobs.STAGES:
        jobs.run(lake, landing, stages=[stage], limits=LOW)
    name = "mart_sales_by_category"
    assert contents(lake.table("served", name)) == contents(before.table("served", name))


def test_failing_gate_leaves_the_published_tables_alone(landing, lake):
    jobs.run(lake, landing, stages=["bronze", "silver"], limits=LOW)
    before = contents(lake.table("silver", "customers"))
    with pytest.raises(ExpectationsFailed, match=r"min_rows\[order_items\]"):
        jobs.run(lake, landing, stages=["silver", "gold"], limits=Thresholds())
    assert contents(lake.table("silver", "customers")) == before
    assert not lake.spark.catalog.databaseExists(lake.database("gold"))


def test_a_repeated_run_id_leaves_published_rows_alone(landing, lake):
    jobs.run(lake, landing, stages=["bronze", "silver"], limits=LOW, run_id="same")
    before = contents(lake.table("silver", "order_items"))
    with pytest.raises(ExpectationsFailed) as failed:
        jobs.run(lake, stages=["silver"], limits=Thresholds(), run_id="same")
    assert len(failed.value.results) == 7 and sum(not r["passed"] for r in failed.value.results) == 1
    assert contents(lake.table("silver", "order_items")) == before


def test_another_session_finds_what_was_published(spark, full):
    lake, _ = full
    other = Lake(spark.newSession(), lake.root, name=f"t_{new_run_id()}")
    try:
        other.spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert contents(other.table("gold", "mart_daily_sales")) == contents(lake.table("gold", "mart_daily_sales"))
        jobs.run(other, stages=["serve"])
        assert {t: contents(df) for t, df in jobs.reports(other).items()} == {t: contents(df) for t, df in jobs.reports(lake).items()}
    finally:
        other.unregister()


def test_expired_versions_go_and_published_ones_stay(landing, lake):
    for _ in range(3):
        jobs.run(lake, landing, stages=["bronze"])
    versions = lambda: {r["path"] for r in lake._log("bronze").collect()}
    assert len(versions()) == 9
    assert lake.expire(keep=1) == []  # too young
    assert len(lake.expire(keep=1, older_than=0)) == 6
    assert lake.table("bronze", "customers").count() > 0


def test_other_time_zones_are_refused(landing, lake):
    lake.spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            jobs.run(lake, landing)
    finally:
        lake.spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    names = RAW_CUSTOMERS.names
    values = {name: f"{name}-1" for name in names}
    (folder / "a.csv").write_text(",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n")
    turned = ["note", *reversed(names)]
    (folder / "b.csv").write_text(",".join(turned) + "\nhi," + ",".join(values[n] for n in turned[1:]) + "\nshort,row\n")
    rows = read_csv(spark, str(folder), RAW_CUSTOMERS)
    sound = rows.where("_corrupt_record is null").select(*names, "note").collect()
    assert sorted((r["note"] or "", *r[:-1]) for r in sound) == [("", *values.values()), ("hi", *values.values())]
    rejected = silver.rejected_customers(rows).collect()
    assert [r["reject_reason"] for r in rejected] == ["malformed_row"] and "short,row" in rejected[0]["record"]
    (folder / "c.csv").write_text("customer_id,full_name\n1,A\n")
    with pytest.raises(ValueError, match="no column email"):
        read_csv(spark, str(folder), RAW_CUSTOMERS)


def test_gate_can_be_told_to_report_only(landing, lake):
    jobs.run(lake, landing, stages=["bronze", "silver"], limits=Thresholds(fail_on_error=False))
    failed = lake.table("silver", "quality").where("not passed").collect()
    assert [r["check"] for r in failed] == ["min_rows[order_items]"]


def test_missing_tables_are_errors(spark, lake):
    with pytest.raises(NotPublished, match="customers"):
        jobs.run(lake, stages=["gold"])
    with pytest.raises(NotPublished, match="dim_customer"):
        jobs.serve(lake)
    with pytest.raises(ValueError, match="landing"):
        jobs.run(lake, stages=["bronze"])
    with pytest.raises(ValueError, match="unknown"):
        jobs.run(lake, stages=["platinum"])


def test_refreshing_marts_changes_nothing(full):
    lake, _ = full
    name = "mart_daily_sales"
    before = contents(lake.table("served", name))
    assert {s.table for s in jobs.refresh_marts(lake, new_run_id())} == {
        "mart_daily_sales", "mart_sales_by_category", "mart_top_customers",
    }
    assert contents(lake.table("gold", name)) == before


def test_reports_over_served_marts(full):
    lake, _ = full
    answers = jobs.reports(lake)
    assert set(answers) == set(REPORTS)
    total = answers["Total revenue & orders"].first()
    daily = lake.table("served", "mart_daily_sales").selectExpr("sum(revenue)", "sum(orders)").first()
    assert tuple(total) == tuple(daily)
    months = [tuple(r)[:2] for r in answers["Monthly revenue trend"].collect()]
    assert months == sorted(months)
    best = [r["lifetime_value"] for r in answers["Top 5 customers by lifetime value"].collect()]
    assert len(best) == 5 and best == sorted(best, reverse=True)
    assert answers["Top 5 categories by revenue"].count() == 5


def test_another_storage_format(spark, landing, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), name=f"t_{new_run_id()}", fmt="orc")
    try:
        rows = jobs.run(lake, landing, limits=LOW)
        assert lake.table("served", "fact_sales").count() == rows["gold.fact_sales"] == 5990
    finally:
        lake.unregister()


def test_single_file_exports(spark, tmp_path, lake):
    """The plain layout: one file per source, no batch folders."""
    landing = tmp_path / "exports"
    landing.mkdir()
    (landing / "customers.csv").write_text(
        "customer_id,full_name,email,country,city,segment,signup_date\n"
        "C1,Mira Holt,MIRA@POST.EXAMPLE,,Nelson,retail,2022-11-30\n"
        'C2,"Vik, Jon",jon@post.example,"",Bergen,trade,2022-12-24\n'
    )
    (landing / "products.csv").write_text(
        "product_id,product_name,category,brand,unit_price,unit_cost\nP1,Widget,Home,OXO,12.5,5\n"
    )
    order = {
        "order_id": "O1", "customer_id": "C1", "order_ts": "2024-03-01T10:00:00", "channel": "web",
        "payment_method": "upi", "status": "completed",
        "items": [{"product_id": "P1", "quantity": 2, "unit_price": 10.1, "discount_pct": 0.1}],
    }
    (landing / "orders.json").write_text(f"{json.dumps(order)}\n{json.dumps(order)}\n{{broken\n")
    jobs.run(lake, str(landing), limits=Thresholds(min_order_items=1))
    countries = {r["country"] for r in lake.table("served", "dim_customer").collect()}
    assert countries == {"Unknown"}
    assert [str(r["revenue"]) for r in lake.table("served", "mart_daily_sales").collect()] == ["18.18"]
    assert lake.table("bronze", "customers").select("_source_file").distinct().first()[0] == "customers.csv"
    events = lake.table("silver", "unreadable_events").collect()
    assert [r["reject_reason"] for r in events] == ["unreadable_event"]
    assert "{broken" in events[0]["record"]


def test_csv_reader_takes_every_column_as_text(spark, tmp_path):
    (tmp_path / "c.csv").write_text("customer_id,full_name,email,country,city,segment,signup_date\n001,A,,,,,2023\n")
    row = read_csv(spark, str(tmp_path / "c.csv"), RAW_CUSTOMERS).first()
    assert (row["customer_id"], row["country"], row["signup_date"]) == ("001", None, "2023")


def test_json_numbers_keep_their_digits(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"order_id":"O1","items":[{"unit_price":0.10,"quantity":3}]}\n')
    item = read_json_lines(spark, str(tmp_path / "o.json"), RAW_ORDERS).first()["items"][0]
    assert (item["unit_price"], item["quantity"], item["product_id"]) == ("0.10", "3", None)


def test_replacing_one_partition_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.sql("SELECT explode(array(1, 2)) AS m, 'old' AS v"), path, partition_by=["m"])
    replace_partitions(spark.sql("SELECT 2 AS m, 'new' AS v"), path, ["m"])
    assert {(r["m"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "old"), (2, "new")}


def test_scratch_folders_lie_in_the_shared_folder(spark):
    assert scratch_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def _write_customers(folder, files):
    names = RAW_CUSTOMERS.names
    folder.mkdir()
    for n in range(files):
        own = names if n % 2 else names[::-1]
        values = {name: f'"{name}, {n}"' for name in names}
        (folder / f"{n:04}.csv").write_text("\n".join([",".join(f'"{x}"' for x in own), ",".join(values[x] for x in own)]) + "\n")


def test_headers_take_as_many_jobs_for_many_files_as_for_few(spark, tmp_path):
    counts = []
    for files in (100, 500):  # Spark lists more than 32 files by a job
        folder = tmp_path / f"customers{files}"
        _write_customers(folder, files)
        df, jobs = jobs_of(spark, f"headers-{files}", lambda folder=folder: read_csv(spark, str(folder), RAW_CUSTOMERS))
        counts.append(jobs)
        rows = df.collect()
        assert len(rows) == files
        assert all(r[name] == f"{name}, {int(r['_source_file'][:4])}" for r in rows for name in RAW_CUSTOMERS.names)
    assert counts[0] == counts[1]


def test_csv_files_without_lines_and_leading_blank_lines(spark, tmp_path):
    folder = tmp_path / "customers.csv"
    _write_customers(folder, 1)
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\n\n" + ",".join(RAW_CUSTOMERS.names) + "\n\n" + ",".join("x" * len(RAW_CUSTOMERS)) + "\n")
    rows = read_csv(spark, str(folder), RAW_CUSTOMERS).collect()
    assert sorted(r["customer_id"] for r in rows) == ["customer_id, 0", "x"]
    (tmp_path / "none.csv").mkdir()
    (tmp_path / "none.csv" / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="holds no line"):
        read_csv(spark, str(tmp_path / "none.csv"), RAW_CUSTOMERS)


def test_the_current_version_comes_without_the_history(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), name="history")
    for n in range(6):
        lake.publish([lake.stage("gold", f"t{n % 2}", spark.range(n + 1), f"run{n}")])
    assert {name: s.rows for name, s in lake.published("gold").items()} == {"t0": 5, "t1": 6}
    assert len(lake._latest("gold")) == 2  # of 11 rows
    assert len(lake.expire(keep=2, older_than=0)) == 3
    log = lake._log("gold")
    assert sorted({r["version"] for r in log.collect()}) == [5, 6]
    lake.publish([lake.stage("gold", "t2", spark.range(9), "later")])
    assert {name: lake.table("gold", name).count() for name in ("t0", "t1", "t2")} == {"t0": 5, "t1": 6, "t2": 9}
    lake.unregister()
