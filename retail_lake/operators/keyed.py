"""One row per key under an order without ties, and keys a dimension lacks."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lake.schemas import BATCH, INGESTED


def arrival_order(df: DataFrame, keys: Sequence[str] = ()) -> list[Column]:
    """First delivered first: batch, ingest time, then the whole content but ``keys``.

    All rows of one load share a batch and an ingest time, so without the
    content the winner among them would be arbitrary. Rows that still tie are
    copies of each other.
    """
    arrival = [c for c in (BATCH, INGESTED) if c in df.columns]
    content = [c for c in df.columns if c not in (*arrival, *keys)]
    return [F.col(c).asc_nulls_last() for c in [*arrival, *content]]


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The first row of every key (NULL counts as a key value).

    Spark limits each key to one row per map task before the shuffle
    (``WindowGroupLimit``), so a key with any number of copies sends one row
    per task and never gathers in one.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or arrival_order(df, keys)))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def unmatched(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact keys missing from a dimension, with the number of rows they hold.

    Rows are counted per key before the anti join, so a hot key crosses the
    shuffle as one row per task. NULL keys are unmatched too.
    """
    held = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return held.join(dimension.select(key), key, "left_anti")


def unseen(df: DataFrame, published: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows of ``df`` whose key (a column of both) ``published`` lacks; rows without a key stay.
    In ``more`` columns of a key NULL is a value.

    The published keys are cut to those that ``df`` touches first. That semi join
    broadcasts the touched keys where Spark finds them small, so that a small delivery
    shuffles nothing of what was published, of which only the key column is read.
    """
    touched = df.select(key, *more).distinct()
    known = published.select(key, *more).join(touched, _same_key(published, touched, key, *more), "left_semi").distinct()
    return df.join(known, _same_key(df, known, key, *more), "left_anti")


def _same_key(one: DataFrame, other: DataFrame, key: str, *more: str) -> Column:
    return reduce(Column.__and__, [one[name].eqNullSafe(other[name]) for name in more], one[key] == other[key])
