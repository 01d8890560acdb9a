"""Parts whose keys repeat: the samples' products are all delivered once, and all stay."""

import os

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.parquet as pq
import pytest

from retail_lake.plans.oracle import ORACLES
from retail_lake.plans.registry import QUERIES
from tests.conftest import SMALL
from tests.oracle import TABLES, actual, connect, expected


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The small tables with some parts once more, row by row as they are, and some under
    the same key at another price."""
    path = tmp_path_factory.mktemp("repeated")
    for name in TABLES:
        if name != "part":
            os.symlink(f"{SMALL}/{name}.parquet", path / f"{name}.parquet")
    parts = pq.read_table(f"{SMALL}/part.parquet")
    price = parts.schema.get_field_index("p_retailprice")
    dearer = parts.set_column(price, "p_retailprice", pa.compute.add(parts["p_retailprice"], 1.0))
    pq.write_table(pa.concat_tables([parts, parts.slice(0, 50), dearer.slice(30, 50)]), path / "part.parquet")
    return str(path)


@pytest.mark.parametrize(
    "name",
    ["clean_products", "dim_product", "dq_checks", "incremental_roundtrip", "layer_roundtrip", "mart_category"],
)
def test_parts_of_one_key_are_all_kept(spark, folder, name):
    with connect(folder) as con:
        assert actual(QUERIES[name](spark, folder)) == expected(con, ORACLES[name])
