"""Reading, shared intermediate tables, and text columns as flat byte buffers.

Inside a Python task a text column is one contiguous UTF-8 buffer with offsets,
exactly as Arrow delivers it. Working on those buffers with numpy costs a few
nanoseconds a byte and no Python object per row.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from retail_lake.plans.lake import scratch_folder

#: Bytes of text that a task works on at once; a longer text is worked on alone.
CHUNK_BYTES = 4 << 20
#: Rows that a task works on at once.
CHUNK_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, fixes
    what a later recomputation could order differently, and outlives executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; whatever else the
    table holds, clashing names included, stays behind."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows, from 0) and bytes of a text or binary column;
    NULL counts as empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if kind == pa.large_binary() else "", kind))
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def runs(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows ``[first, last)`` of about ``most`` bytes together and at most
    ``CHUNK_ROWS``, at least one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), first + CHUNK_ROWS, rows)
        yield first, last
        first = last


def pieces(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, offsets, bytes)`` of runs of rows; offsets start at 0."""
    offsets, data = text_bytes(column)
    for first, last in runs(offsets, most):
        part = offsets[first : last + 1]
        yield first, last, part - part[0], data[part[0] : part[-1]]


def sections(
    column: pa.Array, inside: np.ndarray, most: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool, bool]]:
    """Like ``pieces``, but a text of more than ``most`` bytes comes in sections, each cut
    behind a byte that is not ``inside`` a word (a table of 256 flags), so that no word
    is cut. The last two items tell whether the section begins and ends its texts."""
    for first, last, offsets, data in pieces(column, most):
        start = 0
        while len(data) - start > most and last - first == 1:
            size = _last_outside(inside, data, start, most)
            if start + size >= len(data):
                break
            yield first, last, np.array([0, size]), data[start : start + size], start == 0, False
            start += size
        yield first, last, offsets - np.minimum(offsets, start), data[start:], start == 0, True


def _last_outside(inside: np.ndarray, data: np.ndarray, start: int, most: int) -> int:
    """Bytes up to the last one outside a word among the next ``most``; where they all
    belong to one word, up to its end."""
    at = start
    while at < len(data):
        outside = np.flatnonzero(~inside[data[at : at + most]])
        if len(outside):
            return at + int(outside[-1 if at == start else 0]) + 1 - start
        at += most
    return len(data) - start


def distinct(values: np.ndarray) -> np.ndarray:
    """Ascending distinct values, by sorting (``np.unique`` hashes, which is far slower here)."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values
