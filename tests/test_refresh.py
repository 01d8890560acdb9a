"""How often a refresh of the marts makes the order lines."""

from retail_lake.plans import marts
from retail_lake.plans.lake import Lake
from retail_lake.plans.registry import QUERIES
from tests.conftest import SMALL


def test_one_table_of_the_star_schema_is_made_of_the_lines(spark, monkeypatch):
    made, staged = {}, {}
    stage = Lake.stage

    def recorded(lake, layer, table, df, *args, **kwargs):
        made[table] = any("lineitem" in file for file in df.inputFiles())
        staged[table] = stage(lake, layer, table, df, *args, **kwargs)
        staged[f"{table} rows"] = lake.load(staged[table])
        return staged[table]

    monkeypatch.setattr(Lake, "stage", recorded)
    QUERIES["mart_refresh"](spark, SMALL).collect()
    assert [table for table, of_lines in made.items() if of_lines] == ["fact_sales"]
    assert {"dim_customer", "dim_product", "dim_date", *(mart.name for mart in marts.MARTS)} < set(made)
    days = staged["dim_date rows"]
    expected = QUERIES["dim_date"](spark, SMALL)
    assert days.dtypes == expected.dtypes
    assert sorted(map(tuple, days.collect())) == sorted(map(tuple, expected.collect()))
