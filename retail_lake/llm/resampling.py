"""Importance resampling of documents towards a target distribution.

Features are runs of consecutive words, hashed to buckets by the CRC-32 of their text.
The log ratio of a bucket's share in the target and in the corpus is its gain; a
document's weight is the sum of its features' gains, and documents are drawn without
replacement by adding Gumbel noise to their weights.

Words are not hashed one by one. A dictionary of words, each between two delimiters, is
compiled to an Aho-Corasick automaton whose keys carry the word's CRC and length. A scan
of many texts at once emits these payloads, and payloads of adjacent words compose to
the CRC of their run: the CRC of a text followed by another is the first one's, shifted
by the second one's length, plus the second one's. The dictionary is fitted on a bounded
sample and holds frequent words; a word it lacks has its payload computed on the spot,
so no result depends on the sample.
"""

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm.common import renamed, sections, stored, table

WORDS = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
#: The dictionary: words at most, documents of each side it is fitted on, longest word.
DICTIONARY, SAMPLE, LONGEST = 50_000, 2_000, 64
#: Gains are whole numbers of a thousandth; so is the noise.
SCALE = 1000

_COUNTS = "bucket bigint, n bigint"
_WEIGHED = "doc_id bigint, n_features bigint, n_words bigint, weight bigint"

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_INSIDE[0x80:] = True
_BLANK = 0x20
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[ord("A") : ord("Z") + 1] += 32
_CLEAN[~_INSIDE] = _BLANK
#: CRC of a blank, which joins the words of a run.
_JOINT = zlib.crc32(b" ")


# -- composing checksums ---------------------------------------------------------------


def _table_lookup(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & 255]
    for k in range(1, 4):
        out = out ^ tables[k][(crc >> np.uint32(8 * k)) & 255]
    return out


@lru_cache(maxsize=64)
def _shift_tables(power: int) -> np.ndarray:
    """Four tables, for the bytes of a CRC, that shift it by ``2**power`` zero bytes."""
    if power == 0:
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):  # the reflected polynomial of CRC-32
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1).astype(np.uint32)
        values = np.arange(256, dtype=np.uint32)
        return np.stack([byte, values, values << np.uint32(8), values << np.uint32(16)])
    half = _shift_tables(power - 1)
    return np.stack([_table_lookup(half, half[k]) for k in range(4)])


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of texts followed by others, from both CRCs and the others' lengths."""
    out, power = first.copy(), 0
    while (rest := length >> power).any():
        odd = (rest & 1).astype(bool)
        out[odd] = _table_lookup(_shift_tables(power), out[odd])
        power += 1
    return out ^ second


# -- scanning --------------------------------------------------------------------------


@lru_cache(maxsize=2)
def automaton(words: tuple[bytes, ...]) -> ahocorasick.Automaton:
    """Words between delimiters with their payload, ``length << 32 | CRC``. Bytes are
    scanned as Latin-1 characters, so that places are bytes."""
    out = ahocorasick.Automaton()
    for word in words:
        out.add_word(f" {word.decode('latin-1')} ", len(word) << 32 | zlib.crc32(word))
    out.make_automaton()
    return out


def _spread(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The cleaned texts one after another, with a delimiter around each."""
    rows, sizes = len(offsets) - 1, np.diff(offsets)
    out = np.full(len(data) + rows + 1, _BLANK, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), sizes)] = _CLEAN[data]
    return out


def payloads(offsets: np.ndarray, data: np.ndarray, words: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, CRC and length of every word, in the order of the texts."""
    spread = _spread(offsets, data)
    inside = spread != _BLANK
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    row = np.searchsorted(offsets + np.arange(len(offsets)), starts - 1, side="right") - 1
    packed = np.full(len(starts), -1, np.int64)
    if words:
        hits = automaton(words).iter(spread.tobytes().decode("latin-1"))
        found = np.fromiter(chain.from_iterable(hits), np.int64).reshape(-1, 2)
        packed[np.searchsorted(ends, found[:, 0])] = found[:, 1]
    rest = np.flatnonzero(packed < 0)
    if len(rest):
        flat = spread.tobytes()
        own = pa.array([flat[a:b] for a, b in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)], pa.binary()).dictionary_encode()
        crcs = np.array([zlib.crc32(w) for w in own.dictionary.to_pylist()], np.int64)
        packed[rest] = (ends - starts)[rest] << 32 | crcs[own.indices.to_numpy()]
    return row, (packed & 0xFFFFFFFF).astype(np.uint32), packed >> 32


def features(row: np.ndarray, crc: np.ndarray, length: np.ndarray, words: int, seen: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Row and CRC of all runs of 1 to ``words`` adjacent words of one row. Runs within
    the first ``seen`` words are left out: a section before has had them."""
    rows, crcs = [row[seen:]], [crc[seen:]]
    run, blank = crc, np.full(len(crc), _JOINT, np.uint32)
    follower = joined_crc(blank, crc, length) if words > 1 else blank
    for n in range(2, words + 1):
        if len(run) < 2:
            break
        run = joined_crc(run[:-1], follower[n - 1 :], length[n - 1 :] + 1)
        whole = row[: len(run)] == row[n - 1 :]
        whole[: max(seen - n + 1, 0)] = False
        rows.append(row[: len(run)][whole])
        crcs.append(run[whole])
    return np.concatenate(rows), np.concatenate(crcs)


def scanned(column: pa.Array, words: int, dictionary: tuple[bytes, ...]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """``(first row, last row, row, CRC of each feature, words of each row, ends)`` for
    runs of texts; a long text comes in sections, of which the last one ends it."""
    held = None
    for first, last, offsets, data, begins, ends in sections(column, _INSIDE):
        row, crc, length = payloads(offsets, data, dictionary)
        n_words = np.bincount(row, minlength=last - first)
        seen = 0
        if not begins and words > 1:  # runs may begin in the section before
            seen = len(held[0])
            row, crc, length = np.concatenate([np.zeros(seen, np.int64), row]), *(np.concatenate(x) for x in zip(held, (crc, length), strict=True))
        held = (crc[len(crc) - min(words - 1, len(crc)) :], length[len(crc) - min(words - 1, len(crc)) :])
        yield first, last, *features(row, crc, length, words, seen), n_words, ends


# -- counting and scoring --------------------------------------------------------------


def _tallied(batches: Iterator[pa.RecordBatch], words: int, buckets: int, dictionary) -> Iterator[pa.RecordBatch]:
    """A task's count of each bucket that occurs."""
    counts = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, _, _, crc, _, _ in scanned(batch.column("text"), words, dictionary.value):
            counts += np.bincount(crc % buckets, minlength=buckets)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(some), "n": pa.array(counts[some])})


def bucket_counts(texts: DataFrame, words: int, buckets: int, dictionary) -> np.ndarray:
    """Features of all texts in each bucket: ``buckets`` numbers, summed by Spark."""
    counts = texts.mapInArrow(lambda b: _tallied(b, words, buckets, dictionary), _COUNTS)
    rows = counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # a row per bucket at most
    out = np.zeros(buckets, object)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight."""
    buckets, s_all, t_all = len(source), int(sum(source)), int(sum(target))
    ratio = lambda s, t: (t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))
    return np.array([math.floor(SCALE * math.log(ratio(int(s), int(t)))) for s, t in zip(source, target, strict=True)], np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], words: int, gain, dictionary) -> Iterator[pa.RecordBatch]:
    gain, dictionary = gain.value, dictionary.value
    for batch in batches:
        sums = None
        for first, last, row, crc, n_words, ends in scanned(batch.column("text"), words, dictionary):
            weight = np.zeros(last - first, np.int64)
            np.add.at(weight, row, gain[crc % len(gain)])
            new = np.stack([np.bincount(row, minlength=last - first), n_words, weight])
            sums = new if sums is None else sums + new
            if ends:
                columns = {n: pa.array(x) for n, x in zip(("n_features", "n_words", "weight"), sums, strict=True)}
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(first, last - first), **columns})
                sums = None


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the texts with their number, a row for each word of a run of texts."""
    for batch in batches:
        for _, _, offsets, data, _, _ in sections(batch.column("text"), _INSIDE):
            words = pa.array(_spread(offsets, data).tobytes().split(), pa.binary())
            counts = pa.Table.from_arrays([words], ["word"]).group_by("word").aggregate([([], "count_all")])
            short = counts.filter(pc.less_equal(pc.binary_length(counts.column("word")), LONGEST))
            for part in short.to_batches():
                yield pa.RecordBatch.from_arrays([part.column("word"), part.column("count_all")], ["word", "n"])


def dictionary_of(*texts: DataFrame, most: int = DICTIONARY, sample: int = SAMPLE) -> tuple[bytes, ...]:
    """The most frequent words of a bounded sample of each table of ``(doc_id, text)``:
    the documents of least hashed id. At most ``most`` words of ``LONGEST`` bytes."""
    if not most:
        return ()
    parts = []
    for df in texts:
        ids = df.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        parts.append(df.join(F.broadcast(ids.distinct()), "doc_id").select("text"))  # at most ``sample`` ids
    sampled = parts[0]
    for part in parts[1:]:
        sampled = sampled.unionByName(part)
    counts = sampled.mapInArrow(_frequent, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "word").limit(most).collect()
    return tuple(sorted(bytes(r["word"]) for r in rows))


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise of a document, drawn from the seed and its id (NULL: an empty one)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-SCALE * F.ln(-F.ln((drawn + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    words: int = WORDS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    dictionary: int = DICTIONARY,
) -> DataFrame:
    """``(doc_id, n_features, n_words, weight, score, rank)`` for each row of
    ``(doc_id, text)``; ``target`` has ``(doc_id, text)`` as well.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred
    (rounded down) of highest score are drawn and ranked from 1, ties by smaller
    ``doc_id``; the others have no rank. NULL and empty texts have no features and weight
    0. Rows that repeat an id count and are drawn each on its own; a NULL id comes last
    among equals. With an empty target every feature counts as unseen there; an empty
    table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    docs, target = (renamed(df, doc_id="doc_id", text="text") for df in (docs, target))
    held = spark.sparkContext.broadcast(dictionary_of(docs, target, most=dictionary))
    source, aim = (bucket_counts(df.select("text"), words, buckets, held) for df in (docs, target))
    gain = spark.sparkContext.broadcast(gains(source, aim))
    weighed = docs.mapInArrow(lambda b: _weighed(b, words, gain, held), _WEIGHED)
    scored = stored(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "weights")
    return ranked(scored, F.col("n_words") >= least_words, percent)


def ranked(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """Rank the ``percent`` in a hundred of highest score among the eligible rows.

    An approximate quantile, lower than the true one by more than its error, parts the
    rows that may be drawn from the rest. Only these are sorted, by ranges, and numbered
    within each range; the sizes of the ranges before are added.
    """
    n = scored.where(eligible).count()
    drawn = percent * n // 100
    nobody = F.lit(None).cast("bigint").alias("rank")
    if not drawn:
        return scored.select("*", nobody)
    quantile = max(0.0, 1 - drawn / n - 0.002)
    bar = scored.where(eligible).agg(F.percentile_approx("score", quantile, 10_000)).first()[0]  # error: n / 10,000
    may = F.coalesce(eligible & (F.col("score") >= bar), F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    front = scored.where(may).orderBy(*order).withColumn("_row", F.monotonically_increasing_id())
    front = stored(front.withColumn("_range", F.shiftright("_row", 33)), "resampled")  # how Spark composes these ids
    sizes = {r["_range"]: r["n"] for r in front.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per task
    before, pairs = 0, []
    for part in sorted(sizes):
        pairs += [F.lit(part).cast("bigint"), F.lit(before).cast("bigint")]
        before += sizes[part]
    rank = F.element_at(F.create_map(*pairs), F.col("_range")) + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    front = front.withColumn("rank", F.when(rank <= drawn, rank)).drop("_row", "_range")
    return front.unionByName(scored.where(~may).select("*", nobody))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = renamed(table(spark, sf_dir, "benchmark"), doc_id="item_id", text="text")
    found = resampled(table(spark, sf_dir, "documents"), target)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 by its table, made of the polynomial, over each distinct word's bytes.
OP13_SQL = r"""
WITH polynomial AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) r(b))),
texts AS (
  SELECT doc_id, 0 AS side, text FROM documents UNION ALL SELECT item_id, 1, text FROM benchmark),
parted AS (
  SELECT row_number() OVER () AS r, doc_id, side, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
words AS (SELECT r, side, unnest(w) AS word FROM parted),
hexed AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM words),
hashed AS (
  SELECT word, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2),
        lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
      lambda c, x: xor(t[xor(c % 256, x) + 1], c // 256)), 4294967295) % 10000 AS bucket
  FROM hexed, polynomial),
counts AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
  FROM words JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM counts, sums),
weighed AS (
  SELECT r, sum(gain) AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM parted LEFT JOIN weighed USING (r) WHERE side = 0),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)"""
