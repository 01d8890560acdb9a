"""Near-duplicate embeddings over an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the pairs of their words
form a grid of cells. A vector lies in the cell of its nearest words. For its
neighbours it visits cells by the multi-sequence algorithm, the nearest first,
where the distance to a cell is that to the planes that part it from the vector's
own words. A neighbour just similar enough, displaced in a random direction, lies
beyond such a plane at distance ``t`` with the probability of a normal deviate
beyond ``t * sqrt(dimensions) / displacement``; the traversal ends where that falls
below what the target recall leaves open. Pairs met are verified in double
precision. As either of two vectors may find the other, few links are missed: see
the README for measured recall.

Vectors of different lengths never link; each length has a grid of its own, and all
are searched in one pass. The codebooks are fitted on a bounded sample (about
``SAMPLE`` vectors of a length); all vectors are indexed. Equal vectors are one class from the start. Large cells and the queries
they receive are dealt over blocks, so that a dense cell is the work of many tasks;
a block sends sums of links and a spanning set of edges, never all its pairs.
"""

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm.common import renamed, stored, table
from retail_lake.llm.components import components
from retail_lake.llm.shingles import mixed

LEAST_COSINE = 0.95
TARGET_RECALL = 0.999
#: Vectors the codebooks of a length are fitted on, and words of a codebook.
SAMPLE, LEAST_WORDS, MOST_WORDS = 20_000, 4, 1024
#: Vectors a cell has on average where these words allow it: a vector travels once for
#: each cell that it visits, so larger cells save more of the shuffle than they cost in
#: products.
CELL = 1024
#: Vectors of a cell, and queries to it, that one block compares.
MEMBERS, QUERIES = 2048, 4096
#: Up to so many vectors of a length share one cell.
FEW = 64
ROUNDS = 12

_ROW = "vec_id bigint, d1 bigint, d2 bigint, vector binary"
_VISITS = "id bigint, weight bigint, vector binary, home bigint, cells array<bigint>"
_FOUND = "a bigint, n bigint, b bigint"


def _rows(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    """Each vector as bytes with a digest of them; NULL where it can link with nothing."""
    kind = np.float64 if wide else np.float32
    for batch in batches:
        out, digests = [], np.zeros((len(batch), 2), np.uint64)
        for n, values in enumerate(batch.column("embedding").to_pylist()):
            vector = None
            if values and None not in values:
                x = np.asarray(values, kind)
                if np.isfinite(x).all() and x.any():
                    vector = x.tobytes()
                    bits = x.view(np.uint64 if wide else np.uint32).astype(np.uint64)
                    place = mixed(np.arange(len(bits), dtype=np.uint64) + np.uint64(1))
                    digests[n] = mixed(bits ^ place).sum(dtype=np.uint64), mixed(bits * np.uint64(3) + place).sum(dtype=np.uint64)
            out.append(vector)
        yield pa.RecordBatch.from_pydict(
            {"vec_id": batch.column("vec_id"), "d1": pa.array(digests[:, 0].view(np.int64)), "d2": pa.array(digests[:, 1].view(np.int64)), "vector": pa.array(out, pa.binary())}
        )


def _units(column, kind: type) -> np.ndarray:
    """Vectors of one length, scaled to length 1 in double precision."""
    if not len(column):
        return np.zeros((0, 0))
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codebook(points: np.ndarray, words: int) -> np.ndarray:
    """Lloyd's algorithm from evenly chosen points; words that lose all stay put."""
    distinct = np.unique(points, axis=0)
    words = min(words, len(distinct))
    book = np.random.default_rng(0).permutation(distinct)[:words]
    for _ in range(ROUNDS):
        nearest = _squares(points, book).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=words)
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, points)
        book = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], book)
    return book


def _squares(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ book.T + (book**2).sum(1), 0)


def beyond(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest words, and squared distances to the planes between them and others."""
    squares = _squares(points, book)
    own = squares.argmin(axis=1)
    apart = np.sqrt(_squares(book, book))[own]
    planes = (squares - squares.min(axis=1, keepdims=True)) / np.maximum(2 * apart, 1e-12)
    planes[np.arange(len(points)), own] = 0
    return own, planes**2


def multi_sequence(first: np.ndarray, second: np.ndarray, most: float) -> list[tuple[int, int]]:
    """Pairs of indices by ascending ``first[i] + second[j]``, up to ``most``."""
    order1, order2 = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    s1, s2 = first[order1].tolist(), second[order2].tolist()
    found, heap, seen = [], [(s1[0] + s2[0], 0, 0)], {(0, 0)}
    while heap and heap[0][0] <= most:
        _, i, j = heapq.heappop(heap)
        found.append((int(order1[i]), int(order2[j])))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(s1) and b < len(s2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (s1[a] + s2[b], a, b))
    return found


@dataclass(frozen=True)
class Grid:
    """The cells of one length: both codebooks, the number of the first cell, and the
    greatest squared distance at which a cell is visited."""

    first: np.ndarray
    second: np.ndarray
    base: int
    most: float


def grids(classes: DataFrame, kind: type, least: float, target: float) -> dict[int, Grid]:
    """The grid of every length of which more than ``FEW`` classes ``(id, vector, size)``
    occur; the vectors of any other length share one cell, which needs no words.

    Codebooks are fitted side by side, each on its length's sample in one task. A
    length's have ``LEAST_WORDS`` to ``MOST_WORDS`` words, so they stay far smaller than
    its vectors.
    """
    lengths = classes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW)
    words = F.greatest(F.lit(LEAST_WORDS), F.least(F.lit(MOST_WORDS), F.ceil(F.sqrt(F.col("n") / CELL))))
    lengths = lengths.withColumn("words", words)
    sample = classes.join(lengths, "size").where(F.pmod(F.xxhash64("id"), F.col("n")) < SAMPLE)

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        x, words = _units(group.column("vector"), kind), group.column("words")[0].as_py()
        half = x.shape[1] // 2
        books = [codebook(part, words) for part in (x[:, :half], x[:, half:])]
        return pa.table({"size": group.column("size").slice(0, 1)} | {n: pa.array([book.tobytes()], pa.binary()) for n, book in zip(("first", "second"), books, strict=True)})

    fitted = sample.select("size", "words", "id", "vector").groupBy("size").applyInArrow(fit, "size int, first binary, second binary")
    out, base = {}, 0
    for r in sorted(fitted.collect(), key=lambda r: r["size"]):
        dimensions = r["size"] // np.dtype(kind).itemsize
        half = dimensions // 2
        second = np.frombuffer(r["second"]).reshape(-1, dimensions - half)
        first = np.frombuffer(r["first"]).reshape(-1, half) if half else np.zeros((1, 0))
        deviation = math.sqrt(max(0.0, 2 - 2 * least) / dimensions)
        out[r["size"]] = Grid(first, second, base, (NormalDist().inv_cdf(target) * deviation) ** 2)
        base += len(first) * len(second)
    return out


def _visits(batches: Iterator[pa.RecordBatch], held, kind: type) -> Iterator[pa.RecordBatch]:
    """Each vector's own cell, and all cells it visits, that one included. The one cell
    of a length without a grid has the negative length as its number."""
    for batch in batches:
        sizes = batch.column("size").to_numpy().astype(np.int64)
        homes = -sizes
        cells = [[home] for home in homes.tolist()]
        for size, grid in held.value.items():
            half, words = grid.first.shape[1], len(grid.second)
            rows = np.flatnonzero(sizes == size)
            for at in (rows[n : n + 2048] for n in range(0, len(rows), 2048)):
                part = _units(batch.column("vector").take(pa.array(at)), kind)
                own1, s1 = beyond(part[:, :half], grid.first)
                own2, s2 = beyond(part[:, half:], grid.second)
                homes[at] = grid.base + own1 * words + own2
                for n, a, b in zip(at.tolist(), s1, s2, strict=True):
                    cells[n] = [grid.base + i * words + j for i, j in multi_sequence(a, b, grid.most)]
        columns = {n: batch.column(n) for n in ("id", "weight", "vector")}
        yield pa.RecordBatch.from_pydict(columns | {"home": pa.array(homes), "cells": pa.array(cells, pa.list_(pa.int64()))})


def spanning(a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links of ``a`` (rows) and ``b`` (columns) connect:
    all of few, else a star for each component."""
    rows, columns = np.nonzero(linked)
    if len(rows) <= 2 * (len(a) + len(b)):
        return list(zip(a[rows].tolist(), b[columns].tolist(), strict=True))
    top = np.iinfo(np.int64).max
    low_a, low_b = a.copy(), np.where(linked.any(axis=0), b, top)
    while True:
        new_b = np.minimum(low_b, np.where(linked, low_a[:, None], top).min(axis=0))
        new_a = np.minimum(low_a, np.where(linked, new_b[None, :], top).min(axis=1))
        if (new_a == low_a).all() and (new_b == low_b).all():
            break
        low_a, low_b = new_a, new_b
    stars = [(x, y) for x, y in zip(a.tolist(), low_a.tolist(), strict=True)]
    stars += [(x, y) for x, y in zip(b.tolist(), low_b.tolist(), strict=True) if y != top]
    return [(x, y) for x, y in stars if x != y]


def _compare(queries: pa.Table, members: pa.Table, kind: type, least: float) -> pa.Table:
    """Links between the queries to a cell and a block of its members. A query counts
    its own; it counts for the member as well if that does not visit the query's cell."""
    a, b = queries.column("id").to_numpy(), members.column("m_id").to_numpy()
    if not len(a) or not len(b):
        return pa.table({n: pa.array([], pa.int64()) for n in ("a", "n", "b")})
    homes, weights = queries.column("home").to_numpy(), queries.column("weight").to_numpy()
    linked = (_units(queries.column("vector"), kind) @ _units(members.column("m_vector"), kind).T >= least) & (a[:, None] != b)
    counts = linked @ members.column("m_weight").to_numpy()
    back = np.zeros(len(b), np.int64)
    foreign = np.unique(homes[linked.any(axis=1) & (homes != members.column("m_cell")[0].as_py())])
    if len(foreign):
        cells = members.column("m_cells").combine_chunks()
        row = np.repeat(np.arange(len(b)), cells.value_lengths().to_numpy())
        visited = cells.flatten().to_numpy()
        for home in foreign:
            returns = np.zeros(len(b), bool)
            returns[row[visited == home]] = True
            mine = homes == home
            back += np.where(returns, 0, linked[mine].T @ weights[mine])
    edges = spanning(a, b, linked)
    ids = np.concatenate([a[counts > 0], b[back > 0], np.array([x for x, _ in edges], np.int64)])
    sums = np.concatenate([counts[counts > 0], back[back > 0], np.zeros(len(edges), np.int64)])
    other = [None] * int((counts > 0).sum() + (back > 0).sum()) + [y for _, y in edges]
    return pa.table({"a": pa.array(ids), "n": pa.array(sums), "b": pa.array(other, pa.int64())})


def links(classes: DataFrame, kind: type, least: float, target: float) -> DataFrame:
    """Sums of links ``(a, n)`` and edges ``(a, b)`` between classes ``(id, weight, vector,
    size)``, those of all lengths in one pass."""
    held = classes.sparkSession.sparkContext.broadcast(grids(classes, kind, least, target))
    placed = stored(classes.mapInArrow(lambda b: _visits(b, held, kind), _VISITS), "cells")
    asked = placed.select("id", "weight", "vector", "home", F.explode("cells").alias("cell"))
    sizes = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("member_blocks"))
    loads = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("query_blocks"))
    dealt = stored(sizes.join(loads, "cell"), "blocks")
    block = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    queries = asked.join(dealt, "cell").withColumn("qb", block("query_blocks")).withColumn("mb", every("member_blocks"))
    members = placed.withColumnRenamed("home", "cell").join(dealt, "cell").withColumn("mb", block("member_blocks")).withColumn("qb", every("query_blocks"))
    keys = ["cell", "mb", "qb"]
    left = queries.select(*keys, "id", "weight", "vector", "home")
    theirs = [f"m_{k}" for k in keys]  # both sides stem from one table, so names must differ
    right = members.select(*[F.col(k).alias(t) for k, t in zip(keys, theirs, strict=True)], *[F.col(c).alias(f"m_{c}") for c in ("id", "weight", "vector", "cells")])
    compare = lambda q, m: _compare(q, m, kind, least)
    return stored(left.groupBy(*keys).cogroup(right.groupBy(*theirs)).applyInArrow(compare, _FOUND), "vector-links")


def near_duplicates(df: DataFrame, least: float = LEAST_COSINE, target: float = TARGET_RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``(vec_id, embedding)``.

    Vectors that are NULL, empty or zero, or hold NULL or non-finite components, link
    with nothing, and vectors of different lengths not with each other. Repeated rows are one class and link with each other; a class
    without any id links with nothing else. Other columns are not read.
    """
    wide = dict(df.dtypes)["embedding"] != "array<float>"
    kind = np.float64 if wide else np.float32
    rows = renamed(df, vec_id="vec_id", embedding="embedding")
    rows = stored(rows.mapInArrow(lambda b: _rows(b, wide), _ROW), "vectors")
    rows = rows.withColumn("size", F.octet_length("vector"))
    classes = stored(
        rows.where("vector is not null").groupBy("d1", "d2", "size").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector")),
        "vector-classes",
    )
    found = links(classes.where("id is not null").select("id", "weight", "vector", "size"), kind, least, target)
    sums = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    reached = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    named = (
        classes.drop("vector").join(sums, "id", "left").join(reached, "id", "left")
        .select("d1", "d2", "size", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    usable = rows.where("vector is not null").select("vec_id", "d1", "d2", "size")
    linked = usable.join(named, ["d1", "d2", "size"], "left").select("vec_id", "n_links", "component_id")
    alone = rows.where("vector is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


# All pairs, hence for small tables; vectors of one length are taken for granted.
OP3_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= {LEAST_COSINE}),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN counted ON vec_id = counted.a"""
