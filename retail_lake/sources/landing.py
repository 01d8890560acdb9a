"""Readers of the landing files and the lineage columns they carry from there on."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.schemas import (
    BATCH,
    CORRUPT,
    INGESTED,
    RAW_CUSTOMERS,
    RAW_ORDERS,
    RAW_PRODUCTS,
    SOURCE_FILE,
)


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their header, the names in their first line that is not
    empty. One job reads the first lines of all files, however many there are, and a
    small one parses each distinct one; a file without any line has no header."""
    start = F.col("_metadata.file_block_start") == 0
    lines = spark.read.text(path).where(start & (F.trim("value") != ""))
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    first = lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    by_line = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    found: dict[tuple[str, ...], list[str]] = {}
    for row in by_line:  # a row per distinct header, with the paths that the reader is given
        names = tuple(spark.read.csv(row["files"][0], header=True).columns)
        found[names] = sorted([*found.get(names, []), *row["files"]])
    return found


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Delimited text with a header line; every column stays text.

    Columns are taken by name, each file by its own header, so their order may differ
    from file to file. A file that lacks a column of ``schema`` is an error; columns
    beyond it are kept as they are named. A row that does not have its header's number
    of fields is kept whole in ``_corrupt_record``. Files of one header are one read, and
    files without a line hold no rows.
    """
    found = headers(spark, path)
    parts = []
    for header in sorted(found):
        same = found[header] if len(found) > 1 else [path]
        if missing := [name for name in schema.names if name not in header]:
            raise ValueError(f"{found[header][0]} has no column {', '.join(missing)}")
        own = T.StructType([T.StructField(name, T.StringType()) for name in (*header, CORRUPT)])
        reader = spark.read.schema(own).option("columnNameOfCorruptRecord", CORRUPT)
        if len(found) > 1 and any("=" in file.removeprefix(path) for file in same):
            reader = reader.option("basePath", path)
        rows = reader.csv(same, header=True, mode="PERMISSIVE")
        others = [name for name in rows.columns if name not in schema.names]
        parts.append(rows.select(*schema.names, *others, F.col("_metadata.file_name").alias(SOURCE_FILE)))
    if not parts:
        raise ValueError(f"{path} holds no line")
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per line. A line that does not parse is kept whole in
    ``_corrupt_record`` instead of vanishing into a row of NULLs."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def with_lineage(df: DataFrame, source_file: str | Column, batch_id: int | None = None) -> DataFrame:
    """Append ingest time, and source file and batch number unless rows carry them (as
    they do when a landing folder has ``batch_id=<n>`` subfolders)."""
    added = {INGESTED: F.current_timestamp()}
    if SOURCE_FILE not in df.columns:
        added[SOURCE_FILE] = F.lit(source_file) if isinstance(source_file, str) else source_file
    if batch_id is not None and BATCH not in df.columns:
        added[BATCH] = F.lit(batch_id)
    return df.withColumns(added)


def landing_tables(spark: SparkSession, landing: str, batch_id: int = 1) -> dict[str, DataFrame]:
    """The three source exports under ``landing``, unchanged but for their lineage."""
    raw = {
        "customers": read_csv(spark, f"{landing}/customers.csv", RAW_CUSTOMERS),
        "products": read_csv(spark, f"{landing}/products.csv", RAW_PRODUCTS),
        "orders": read_json_lines(spark, f"{landing}/orders.json", RAW_ORDERS),
    }
    file_name = F.col("_metadata.file_name")
    return {name: with_lineage(df, file_name, batch_id) for name, df in raw.items()}
