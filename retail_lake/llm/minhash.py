"""Near-duplicate documents by one-permutation MinHash.

Every distinct shingle is hashed once; the hash's high bits choose one of the bins
and each bin keeps its least hash. Empty bins borrow from non-empty ones by
independent probes (optimal densification), so that any bin of two sets agrees
with the probability of their Jaccard similarity. Bands of bins form buckets.

Documents of equal sets are one class from the start. In each bucket only the star
around its least class is compared, never all pairs. Stars found to be one
component settle their bucket. Where a bucket still spans several components, it gets
a new star, around a class outside its largest component and with the classes of the
other components only: a row per member. Components are found anew after each such
round, so that a class that a star joins to others leaves all its buckets at once.
What ``ROUNDS`` of these leave apart is mostly unlike; there each class outside the
largest component meets those of other components, every pair in the first bucket
that it shares and in no other. Links inside a component decide nothing, so none that
matters is left out. All links are confirmed on the full sets.

Before texts are fetched, pairs are sifted without loss: every set has a bitmap of
parities, in which each element flips one bit. Two bitmaps differ in no more bits
than the sets differ in elements, so a pair whose bitmaps differ in more bits than
similar sets of their sizes may differ in elements is none.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm.common import pieces, renamed, stored, table, text_bytes
from retail_lake.llm.components import components
from retail_lake.llm.shingles import mixed, shingle_sets

BANDS = 32
ROWS = 5
#: A link has intersection / union of at least PERCENT / 100.
PERCENT = 75
#: Further stars of a bucket that spans several components.
ROUNDS = 1
#: Bits of a set's parity bitmap; with more, the sieve outgrows what the JVM compiles.
PARITIES = 1024
#: Ids that may be broadcast to fetch texts (16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
_SIGNATURE = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, parity array<bigint>"


def densified(bounds: np.ndarray, shingles: np.ndarray, bins: int) -> np.ndarray:
    """Signatures, a row per set of at least one shingle (others stay zero)."""
    rows, sizes = len(bounds) - 1, np.diff(bounds)
    least, filled = np.zeros((rows, bins), np.uint64), np.zeros((rows, bins), bool)
    row = np.repeat(np.arange(rows), sizes)
    # The bin grows with the hash, so in an ascending set a bin's least comes first.
    bin_ = (((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(row), bool)
    first[1:] = (bin_[1:] != bin_[:-1]) | (row[1:] != row[:-1])
    least[row[first], bin_[first]] = shingles[first]
    filled[row[first], bin_[first]] = True
    out = least.copy()
    r, b = np.nonzero(~filled & (sizes > 0)[:, None])
    attempt = 0
    while len(r):
        attempt += 1
        probe = mixed(np.arange(bins, dtype=np.uint64) + np.uint64(attempt << 20)) % np.uint64(bins)
        source = probe.astype(np.int64)[b]
        hit = filled[r, source]
        out[r[hit], b[hit]] = least[r[hit], source[hit]]
        r, b = r[~hit], b[~hit]
    return out


def parities(bounds: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """A row of ``PARITIES`` bits, as 64-bit numbers, for each set."""
    rows = len(bounds) - 1
    bit = (shingles % np.uint64(PARITIES)).astype(np.int64) + np.repeat(np.arange(rows) * PARITIES, np.diff(bounds))
    odd = (np.bincount(bit, minlength=rows * PARITIES) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, PARITIES), axis=1, bitorder="little").view(np.int64)


def signatures(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Set size, a 128-bit digest of the set, and its buckets. Sets of one or two
    shingles are similar to no other set, so they need no bucket."""
    salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))
    place = mixed(np.arange(1 << 10, (1 << 10) + rows, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        for first, last, offsets, data in pieces(batch.column("text")):
            bounds, shingles = shingle_sets(offsets, data)
            sizes = np.diff(bounds)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (mixed(shingles + salt[0]), mixed(shingles ^ salt[1]))]
            d1, d2 = (mixed((s[bounds[1:]] - s[bounds[:-1]]) + sizes.astype(np.uint64)) for s in sums)
            some = np.flatnonzero(sizes > 2)
            packed = np.concatenate([[0], np.cumsum(sizes[some])])
            chosen = shingles[np.repeat(sizes > 2, sizes)]
            signature = densified(packed, chosen, bands * rows).reshape(len(some), bands, rows)
            keys = mixed((signature * place).sum(axis=2, dtype=np.uint64) + salt)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(first, last - first),
                    "n_shingles": pa.array(sizes),
                    "d1": pa.array(d1.view(np.int64)),
                    "d2": pa.array(d2.view(np.int64)),
                    "bands": _lists(np.where(sizes > 2, bands, 0), keys),
                    "parity": _lists(np.where(sizes > 2, PARITIES // 64, 0), parities(packed, chosen)),
                }
            )


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel().view(np.int64)))


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs ``(a, b)`` whose full sets are similar enough. Rows of one ``a`` follow
    each other, so its set is made once for all of them."""
    for batch in batches:
        a = batch.column("a").to_numpy()
        head = np.ones(len(a), bool)
        head[1:] = a[1:] != a[:-1]
        which = np.cumsum(head) - 1
        left = _sets(batch.column("text_a").take(pa.array(np.flatnonzero(head))))
        keep, row, held = np.zeros(len(a), bool), 0, None
        for right in _sets(batch.column("text_b")):
            if held is None or held[0] != which[row]:
                held = (which[row], next(left))
            x, y = (held[1], right) if len(held[1]) >= len(right) else (right, held[1])
            common = 0
            if len(y):
                found = np.searchsorted(x, y)
                common = int((x[np.minimum(found, len(x) - 1)] == y).sum())
            keep[row] = common and 100 * common >= percent * (len(x) + len(y) - common)
            row += 1
        kept = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_pydict({n: batch.column(n).take(kept) for n in ("a", "b")})


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for _, _, offsets, data in pieces(texts):
        bounds, shingles = shingle_sets(offsets, data)
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield shingles[start:end]


def may_link(one: str, other: str, percent: int) -> Column:
    """Whether sets of the columns ``n_*`` and ``parity_*`` can be similar enough, by
    their sizes and parity bitmaps. Sets of sizes n and m whose similarity reaches t
    differ in at most (n + m) (1 - t) / (1 + t) elements."""
    n, m = F.col(f"n_{one}"), F.col(f"n_{other}")
    bits = sum(
        (F.bit_count(F.get(f"parity_{one}", F.lit(i)).bitwiseXOR(F.get(f"parity_{other}", F.lit(i)))) for i in range(PARITIES // 64)),
        F.lit(0),
    )
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (bits * (100 + percent) <= (n + m) * (100 - percent))


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs ``(a, b)`` that are links. Only texts that occur in
    a pair are kept for it."""
    pairs = stored(pairs, "pairs")
    needed = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair-ids")
    few = needed.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(needed) if few else needed, "doc_id")
    texts = stored(texts.groupBy("doc_id").agg(F.min("text").alias("text")), "texts")
    at = lambda end: texts.select(F.col("doc_id").alias(end), F.col("text").alias(f"text_{end}"))
    both = pairs.join(at("b"), "b").join(at("a"), "a").select("a", "b", "text_a", "text_b")
    return stored(both.mapInArrow(lambda x: _confirm(x, percent), "a bigint, b bigint"), "links")


def near_duplicates(
    df: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``(doc_id, text)``.

    A row without words, or with NULL or empty text, links with nothing. Rows of
    equal shingle sets, repeated rows included, are one class, named by its least
    id; a class of NULL ids only links with nothing else. Ids are taken to be
    unique otherwise. Other columns are not read.
    """
    docs = renamed(df, doc_id="doc_id", text="text")
    signed = stored(docs.mapInArrow(lambda x: signatures(x, bands, rows), _SIGNATURE), "signatures")
    classes = stored(
        signed.where("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity")),
        "classes",
    )
    members = classes.where("rep is not null").select("rep", F.posexplode("bands").alias("band", "bucket"))
    centers = (
        members.groupBy("bucket")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("last"))
        .where("a < last")
        .drop("last")
    )
    shared = stored(members.join(centers, "bucket").select("bucket", "band", "rep", "a"), "buckets")
    sets = classes.where("rep is not null").select("rep", "n", "parity", "bands")
    star = shared.where("rep != a").select("a", F.col("rep").alias("b")).distinct()
    star = star.join(_of(sets, "a"), "a").join(_of(sets, "b"), "b").where(may_link("a", "b", percent))
    links = confirmed(star.select("a", "b").distinct(), docs, percent)
    found, turn = components(links), 0
    while not (split := _split(shared, found, sets)).isEmpty():
        turn += 1
        pairs = _star(split, turn, percent) if turn <= ROUNDS else _remaining(split, percent)
        links = links.unionByName(confirmed(pairs, docs, percent))
        found = components(links)
        if turn > ROUNDS:
            break
    found = found.select(F.col("node").alias("rep"), "component")

    named = classes.join(found, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    return (
        signed.join(named, ["d1", "d2"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _of(sets: DataFrame, end: str) -> DataFrame:
    return sets.select(F.col("rep").alias(end), F.col("n").alias(f"n_{end}"), F.col("parity").alias(f"parity_{end}"))


def _split(shared: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of buckets that span several components, with theirs and the largest."""
    labelled = shared.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "band", "rep", "a", F.coalesce("component", "rep").alias("component")
    )
    sizes = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = (
        sizes.groupBy("bucket")
        .agg(F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("bucket", F.col("top.component").alias("largest"))
    )
    return stored(labelled.join(largest, "bucket").join(sets, "rep"), "split-buckets")


def _star(split: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each bucket's new centre, a class outside the largest component, with the
    classes of other components."""
    outside = split.where("component != largest and rep != a")
    columns = ["n", "parity", "component"]
    centre = outside.groupBy("bucket").agg(F.min_by(F.struct("rep", *columns), F.xxhash64(F.lit(turn), "rep")).alias("c"))
    centre = centre.select("bucket", F.col("c.rep").alias("x"), *[F.col(f"c.{n}").alias(f"{_ALIAS[n]}_x") for n in columns])
    other = split.select("bucket", *_named("y"))
    return _pairs(centre.join(other, "bucket").where("of_x != of_y").where(may_link("x", "y", percent)))


def _remaining(split: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components, at least one of them outside the largest;
    pairs of a bucket's first star are left out. A pair that shares several buckets is
    taken in that of the first band."""
    one = split.where("component != largest").select("bucket", "band", *_named("x"), "a", F.col("bands").alias("bands_x"))
    other = split.select("bucket", *_named("y"), "largest", F.col("bands").alias("bands_y"))
    before = F.arrays_overlap(F.slice("bands_x", F.lit(1), F.col("band")), F.slice("bands_y", F.lit(1), F.col("band")))
    return _pairs(
        one.join(other, "bucket")
        .where("of_x != of_y and (of_y = largest or x < y) and x != a and y != a")
        .where(may_link("x", "y", percent) & ~before)
    )


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


_ALIAS = {"rep": "", "n": "n", "parity": "parity", "component": "of"}


def _named(end: str) -> list[Column]:
    return [F.col(name).alias(f"{alias}_{end}" if alias else end) for name, alias in _ALIAS.items()]


def survivors(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that stay: one of every component, and every row whose text
    has no words. Of rows that repeat an id and its text, all stay or none."""
    found = near_duplicates(df)
    dropped = found.where("not kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return df.join(dropped, df["doc_id"] == dropped["_dropped"], "left_anti")


def op2_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


# All pairs with a common shingle, hence for small tables.
OP2_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM one x JOIN one y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id <= coalesce(b, doc_id) AS kept
FROM sets LEFT JOIN least ON doc_id = a"""
