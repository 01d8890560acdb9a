"""The staged batch job: bronze, silver with its quality gate, gold, serve.

Each stage reads what the stage before published, and publishes only when all of
its own writes and checks are through, so stages can run alone, again, or not at
all, and a run can be repeated without effect on its result.

An incremental run lands further deliveries beside those landed before and adds their
rows to silver, whose earlier files it leaves alone. Of a key that was published the
first delivery stays, so nothing published ever changes, and the result is that of one
run over all deliveries. Gold is made anew from silver.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from retail_lake.functions.columns import month_key
from retail_lake.operators import expect
from retail_lake.operators.conform import REASON, RECORD
from retail_lake.operators.keyed import unmatched, unseen
from retail_lake.plans import silver, star
from retail_lake.plans.lake import Lake, NotPublished, Staged, Version, new_run_id
from retail_lake.plans.marts import MARTS, build_marts
from retail_lake.plans.reports import REPORTS, report
from retail_lake.schemas import BATCH
from retail_lake.sources.landing import landing_tables

STAGES = ("bronze", "silver", "gold", "serve")
SOURCES = ("customers", "products", "orders")
DIMENSIONS = ("dim_customer", "dim_product", "dim_date")
SERVED = (*DIMENSIONS, "fact_sales", *(mart.name for mart in MARTS))


@dataclass(frozen=True)
class Thresholds:
    """Limits of the quality gate."""

    max_null_ratio: float = 0.02
    max_unknown_amounts: float = 0.02
    min_order_items: int = 10_000
    fail_on_error: bool = True


def quality_results(tables: Mapping[str, DataFrame], limits: Thresholds) -> DataFrame:
    """The gate's checks over silver customers, products and order_items, in one
    aggregation per table. Where products have numbers, id and number are unique together."""
    customers = expect.evaluate(tables["customers"], expect.unique("customer_id"))
    products = expect.evaluate(
        tables["products"], expect.unique(*silver.product_key(tables["products"])), expect.non_negative("unit_price")
    )
    order_items = expect.evaluate(
        tables["order_items"],
        expect.not_null("customer_id", limits.max_null_ratio),
        expect.not_null("net_amount", limits.max_unknown_amounts),
        expect.non_negative("net_amount"),
        expect.min_rows(limits.min_order_items, "order_items"),
    )
    return customers.unionByName(products).unionByName(order_items)


def build_bronze(
    lake: Lake,
    landing: str,
    run_id: str,
    batch_id: int = 1,
    batches: Sequence[int] | None = None,
    incremental: bool = False,
) -> list[Staged]:
    """Land the source exports as they are, with lineage; of the given deliveries only,
    where ``batches`` names some. An incremental run adds them to what was landed and
    refuses a delivery that does not come after all of a source's earlier ones."""
    tables = landing_tables(lake.spark, landing, batch_id)
    if batches is not None:
        tables = {name: df.where(F.col(BATCH).isin(*batches)) for name, df in tables.items()}
    staged = lake.stage_all("bronze", tables, run_id)
    if incremental:
        landed = lake.published("bronze")
        for part in staged:
            _later(lake, landed.get(part.table), part)
    lake.publish(staged, add_to=SOURCES if incremental else ())
    return staged


def _later(lake: Lake, landed: Version | None, part: Staged) -> None:
    first = lake.load(part).agg(F.min(BATCH)).first()[0]
    last = lake.load(landed).agg(F.max(BATCH)).first()[0] if landed else None
    if None not in (first, last) and first <= last:
        raise ValueError(f"delivery {first} of {part.table} does not come after {last}, which was landed")


def build_silver(
    lake: Lake, run_id: str, limits: Thresholds = Thresholds(), incremental: bool = False
) -> list[Staged]:
    """Conform bronze, keep what was rejected, and publish if the gate lets it.

    An incremental run conforms the parts of bronze that silver has not taken yet, less
    the keys it has, and adds the rows; without such parts it does nothing. The gate
    judges the tables as a whole in either case.
    """
    source = lake.published("bronze")
    if missing := [name for name in SOURCES if name not in source]:
        raise NotPublished(f"not published in bronze: {', '.join(missing)}")
    before = lake.published("silver") if incremental else {}
    new = _not_taken(lake, source, before)
    if not any(new.values()):
        return []
    raw = {name: _loaded(lake, source[name], new[name]) for name in SOURCES}
    tables = {
        "customers": silver.customers(raw["customers"]),
        "products": silver.products(raw["products"]),
        "order_items": _labelled_lines(_new_orders(lake, raw["orders"], before)),
        "rejected_customers": silver.rejected_customers(raw["customers"]),
        "rejected_products": silver.rejected_products(raw["products"]),
        "keyless_lines": silver.keyless_lines(raw["orders"]),
        "unreadable_events": silver.unreadable_events(raw["orders"]),
        "taken": lake.spark.createDataFrame([(n, p.path) for n in SOURCES for p in new[n]], _TAKEN).coalesce(1),
    }
    if "customers" in before:
        tables["customers"] = unseen(tables["customers"], lake.load(before["customers"]), "customer_id")
    if "products" in before:
        known = lake.load(before["products"])
        key = [name for name in silver.product_key(tables["products"]) if name in known.columns]
        tables["products"] = unseen(tables["products"], known, *key)
    layout = {"order_items": ("verdict", "order_month")}
    verdicts = {v: F.col("verdict") == v for v in ("accepted", "rejected")}
    staged = lake.stage_all("silver", tables, run_id, layout, {"order_items": verdicts}, gathered=layout)
    written = {s.table: s for s in staged}
    written |= _by_verdict(written["order_items"])

    whole = {name: before.get(name, Version(())).added(written[name]) for name in ("customers", "products", "order_items")}
    checked = {name: lake.load(version) for name, version in whole.items()}
    checks = lake.stage("silver", "quality", quality_results(checked, limits), run_id)
    expect.gate(lake.load(checks).collect(), limits.fail_on_error)

    lake.publish([*written.values(), checks], add_to=written if incremental else ())
    return [*written.values(), checks]


#: The parts of bronze that silver is made of.
_TAKEN = "source string, path string"


def _not_taken(lake: Lake, source: Mapping[str, Version], before: Mapping[str, Version]) -> dict[str, list[Staged]]:
    """The parts of each source that published silver, if given, does not hold. What is
    read here is a row per source and run."""
    taken: set[Row] = set(lake.load(before["taken"]).collect()) if before else set()
    parts = {name: {(name, p.path): p for p in source[name].parts} for name in SOURCES}
    if any((r["source"], r["path"]) not in parts[r["source"]] for r in taken):
        raise ValueError("bronze was landed anew since silver was made; run silver in full")
    return {name: [p for mark, p in found.items() if mark not in taken] for name, found in parts.items()}


def _loaded(lake: Lake, version: Version, parts: Sequence[Staged]) -> DataFrame:
    """The rows of the given parts of a version; with none, no rows of its columns."""
    return lake.load(Version(tuple(parts))) if parts else lake.load(version).where(F.lit(False))


def _new_orders(lake: Lake, raw_orders: DataFrame, before: Mapping[str, Version]) -> DataFrame:
    """Documents of orders that silver has not met. It met an order too whose lines it
    rejected, all of them perhaps: those of the first delivery stay rejected."""
    parts = {p.path: p for name in ("order_items", "rejected_items") if name in before for p in before[name].parts}
    if not parts:
        return raw_orders
    met = Version(tuple(replace(p, columns=("order_id",), where=None) for p in parts.values()))
    return unseen(raw_orders, lake.load(met), "order_id")


def _labelled_lines(raw_orders: DataFrame) -> DataFrame:
    """Accepted and rejected order lines together, so that one pass writes both:
    accepted ones by month, so that a month's readers open its files only. Their documents
    are gathered by month."""
    lines = silver.conformed_lines(silver.by_month(silver.first_events(raw_orders))).labelled
    return lines.withColumns(
        {
            "verdict": F.when(F.col(REASON).isNull(), "accepted").otherwise("rejected"),
            "order_month": month_key(F.col("order_date")),
        }
    )


def _by_verdict(written: Staged) -> dict[str, Staged]:
    sound = tuple(c for c in written.columns if c not in (REASON, RECORD, "verdict"))
    return {
        "order_items": replace(
            written, columns=sound, where="verdict = 'accepted'", rows=written.tallies["accepted"]
        ),
        "rejected_items": replace(
            written,
            table="rejected_items",
            columns=(REASON, RECORD),
            where="verdict = 'rejected'",
            rows=written.tallies["rejected"],
        ),
    }


def build_gold(lake: Lake, run_id: str) -> list[Staged]:
    """Star schema and marts from published silver. Marts read the written fact."""
    source = lake.tables("silver", ("customers", "products", "order_items"))
    tables = {
        "dim_customer": star.dim_customer(source["customers"]),
        "dim_product": star.dim_product(source["products"]),
        "dim_date": star.dim_date(source["order_items"]),
        "fact_sales": star.fact_sales(source["order_items"]),
    }
    staged = lake.stage_all("gold", tables, run_id)
    written = {s.table: lake.load(s) for s in staged}
    orphans = unmatched(written["fact_sales"], written["dim_product"], "product_id")
    results = {**build_marts(written["fact_sales"], written), "orphan_products": orphans}
    staged += lake.stage_all("gold", results, run_id)
    lake.publish(staged)
    return staged


def refresh_marts(lake: Lake, run_id: str) -> list[Staged]:
    """Recompute the marts alone, from the published star schema."""
    star_tables = lake.tables("gold", (*DIMENSIONS, "fact_sales"))
    marts = build_marts(star_tables["fact_sales"], star_tables)
    staged = lake.stage_all("gold", marts, run_id)
    lake.publish(staged)
    return staged


def serve(lake: Lake) -> dict[str, str]:
    """Offer the gold tables in the database that reports and BI tools read.

    The views show gold itself, so nothing is copied and nothing can go stale; a
    missing gold table is an error.
    """
    lake.tables("served", SERVED)
    lake.register("gold")
    lake.create_database("served")
    views = {name: lake.qualified("served", name) for name in SERVED}
    for name, view in views.items():
        gold = lake.qualified("gold", name)
        lake.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {gold}")
    return views


def run(
    lake: Lake,
    landing: str | None = None,
    stages: Sequence[str] = STAGES,
    limits: Thresholds = Thresholds(),
    batch_id: int = 1,
    run_id: str | None = None,
    batches: Sequence[int] | None = None,
    incremental: bool = False,
) -> dict[str, int]:
    """Run the given stages in their order; returns the rows written per table.

    ``batches`` restricts the bronze stage to these deliveries; an incremental run adds
    what it lands to bronze and silver instead of replacing them.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    if "bronze" in stages and landing is None:
        raise ValueError("the bronze stage needs a landing folder")
    if (zone := lake.spark.conf.get("spark.sql.session.timeZone")) not in ("UTC", "Etc/UTC"):
        raise ValueError(f"times without offset are UTC; set spark.sql.session.timeZone to UTC, not {zone}")
    run_id = run_id or new_run_id()
    staged: list[Staged] = []
    if "bronze" in stages:
        staged += build_bronze(lake, landing, run_id, batch_id, batches, incremental)
    if "silver" in stages:
        staged += build_silver(lake, run_id, limits, incremental)
    if "gold" in stages:
        staged += build_gold(lake, run_id)
    if "serve" in stages:
        serve(lake)
    return {f"{s.layer}.{s.table}": s.rows for s in staged}


def reports(lake: Lake) -> dict[str, DataFrame]:
    """Every report over the served marts, by title."""
    marts = lake.tables("served", [mart.name for mart in MARTS])
    return {title: report(lake.spark, title, marts) for title in REPORTS}
