"""Exact duplicates, combined in three steps that all compare full contents.

Rows are grouped by digest and whole normalised text: first within each task (the
partial aggregation sends one row per task and content), then within salts of a
digest, last across the salts' winners. No group of copies, however large, meets
in one task. Rows find their group again by the digest alone; only digests that
turn out to stand for several contents are matched by content as well.
"""

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.llm.common import renamed, stored, table
from retail_lake.llm.segments import byte_slices

SALTS = 16
DIGEST, CONTENT = "_digest", "_content"

#: Lower-cases A-Z and nothing else.
_LOWER = bytes.maketrans(bytes(range(ord("A"), ord("Z") + 1)), bytes(range(ord("a"), ord("z") + 1)))


def sha256(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


def digested(
    df: DataFrame, keep: Sequence[str], text: str = "text", content: bool = False, digest: Callable[[bytes], bytes] = sha256
) -> DataFrame:
    """The columns ``keep`` with the digest of the normalised text, and on request the
    normalised text itself; NULL counts as empty."""
    df = df.select(*keep, *([] if text in keep else [text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.translate(_LOWER) for t in byte_slices(batch.column(text))]
            columns = {name: batch.column(name) for name in keep}
            columns[DIGEST] = pa.array(map(digest, texts), pa.binary())
            if content:
                columns[CONTENT] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    fields = [df.schema[name] for name in keep] + [T.StructField(DIGEST, T.BinaryType())]
    return df.mapInArrow(run, T.StructType(fields + [T.StructField(CONTENT, T.BinaryType())] * content))


def groups(contents: DataFrame) -> DataFrame:
    """Digest, content, greatest ``doc_id`` and number of rows of every content."""
    salt = (F.spark_partition_id() % SALTS).alias("_salt")
    salted = contents.groupBy(DIGEST, salt, CONTENT).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return salted.groupBy(DIGEST, CONTENT).agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def exact_duplicates(df: DataFrame, keep: Sequence[str], digest: Callable[[bytes], bytes] = sha256) -> DataFrame:
    """The columns ``keep`` of every row of ``(doc_id, text)`` with ``_digest``,
    ``keep_id``, ``group_size`` and ``kept``, none of which ``keep`` may name.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty. The
    row with the greatest ``doc_id`` stays; rows that repeat both id and text are one
    document and share the flag. NULL ids stay only where their group has no other.
    """
    contents = digested(renamed(df, doc_id="doc_id", text="text"), ["doc_id"], content=True, digest=digest)
    winners = stored(groups(contents).drop(CONTENT), "winners")
    several = winners.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select(DIGEST)
    several = stored(several, "ambiguous-digests")
    found = digested(df, keep, digest=digest)
    if several.isEmpty():
        labelled = found.join(winners, DIGEST)
    else:
        clear = found.join(several, DIGEST, "left_anti").join(winners, DIGEST)
        contested = digested(df, keep, content=True, digest=digest).join(several, DIGEST)
        whole = groups(contents.join(several, DIGEST))
        labelled = clear.unionByName(contested.join(whole, [DIGEST, CONTENT]).drop(CONTENT))
    return labelled.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def survivors(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that stay, with its own columns."""
    inner = df.toDF(*[c if c in ("doc_id", "text") else f"own_{n}" for n, c in enumerate(df.columns)])
    return exact_duplicates(inner, inner.columns).where("kept").select(*inner.columns).toDF(*df.columns)


def op8_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex(DIGEST)).alias("text_sha256"))


_NORMALISED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256({_NORMALISED}) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY {_NORMALISED})"""
