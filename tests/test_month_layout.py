"""What is moved and written for lines laid out by month."""

from pathlib import Path

import pyarrow.parquet as pq

from retail_lake.plans import registry
from retail_lake.plans.jobs import _labelled_lines
from retail_lake.sources import samples
from tests.conftest import SMALL


def test_documents_and_not_lines_are_gathered_by_month(spark, monkeypatch):
    written = []
    write_table = registry.write_table

    def recorded(df, path, **layout):
        written.append((df, path))
        write_table(df, path, **layout)

    monkeypatch.setattr(registry, "write_table", recorded)
    registry.QUERIES["partition_pruned_month"](spark, SMALL)
    lines, path = written[0]
    _gathered_before_explode(lines)
    files = list(Path(path.removeprefix("file:")).rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files}) > 70  # a month's lines are still one file
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_silver_gathers_documents_too(spark):
    _gathered_before_explode(_labelled_lines(samples.order_events(spark, SMALL)))


def _gathered_before_explode(lines):
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("Generate posexplode") < plan.find("RebalancePartitions [_month")
