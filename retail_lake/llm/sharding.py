"""Weighted rendezvous hashing of stable keys over shards, in built-in functions only.

Each key draws a number for every shard from their common hash and goes to the
shard of least ``-ln(number) / weight``. A further shard draws its own numbers and
changes no other, so it takes keys only into itself, about its share of them.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_lake.llm.common import renamed, stored, table

SHARDS = 40
#: Size of a record besides its text.
OVERHEAD = 16


def draw(key: Column, shard: int, weight: float = 1.0) -> Column:
    """The key's bid for a shard and the shard; the least bid wins."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard).cast("bigint")), 11)  # 53 of them
    number = (bits.cast("double") + 0.5) / float(1 << 53)
    return F.struct((-F.ln(number) / weight).alias("bid"), F.lit(shard).alias("shard"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key of any type. NULL is a key like others. Equal bids go to the
    smaller shard. A shard of weight 0 gets nothing."""
    bids = [draw(key, shard, weight) for shard, weight in enumerate(weights) if weight > 0]
    if not bids:
        raise ValueError("no shard has a weight above 0")
    return (bids[0] if len(bids) == 1 else F.least(*bids)).getField("shard")


def assign(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard") -> DataFrame:
    """``df`` with its rows' shards (a column of that name is replaced); no shuffle."""
    return df.withColumn(shard, shard_of(df[key], weights))


def numbered(df: DataFrame, shard: str, slot: str) -> DataFrame:
    """Rows of each shard numbered from 0 without a gap, in the order of the input.

    A task numbers its own rows of a shard; the counts of the tasks before it are
    added. A shard's rows never meet in one task, nor do rows of one key.
    """
    pinned = stored(df.withColumn("_row", F.monotonically_increasing_id()), "shards")
    pinned = pinned.withColumn("_task", F.shiftright("_row", 33))  # how Spark composes these ids
    counts = pinned.groupBy(shard, "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(shard, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy(shard, "_task").orderBy("_row")) - 1
    return (
        pinned.withColumn("_own", own)
        .join(bases, [shard, "_task"])
        .withColumn(slot, (F.col("_base") + F.col("_own")).cast("bigint"))
        .drop("_row", "_task", "_own", "_base")
    )


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; the rows of a large one are split over files."""
    df.hint("rebalance", shard).write.partitionBy(shard).parquet(path)


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 equal shards by ``doc_id``. NULL texts have no bytes."""
    docs = renamed(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    text = F.coalesce("text", F.lit(""))
    sharded = assign(docs, "doc_id", [1.0] * SHARDS)
    # The grown layout has one more bidder; the winner among the others is known.
    key = F.col("doc_id")
    grown = shard_of(key, [1.0] * (SHARDS + 1))
    narrow = sharded.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        grown.alias("grown_shard"),
    )
    return numbered(narrow, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
