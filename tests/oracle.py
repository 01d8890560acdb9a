"""Comparison of a Spark result with DuckDB's, regardless of row order."""

import duckdb

# The supplied tables.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([str(row[i]) for i in order] for row in rows)


def expected(con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), canonical(cursor.fetchall(), columns)


def actual(df):
    return sorted(df.columns), canonical(df.collect(), df.columns)
