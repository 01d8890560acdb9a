"""URL filters by a cascade of Bloom filters.

The first level encodes the listed keys, the second those other keys of the corpus
that the first takes for listed, the third those listed keys that the second takes
for unlisted, and so on until no key is mistaken. A key of the corpus is looked up
level by level until one rejects it: exact for every key the cascade was built
over, with a few bits a listed key and no join.

Building it groups the distinct keys of the corpus; looking up reads the levels,
which are broadcast after a check of their size (``MAX_BYTES``).
"""

import hashlib
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.llm.common import renamed, stored, table
from retail_lake.llm.shingles import mixed

#: Bits a key on the first level, and on the others.
FIRST_BITS, NEXT_BITS = 10, 4
#: Greatest size of all levels together.
MAX_BYTES = 256 << 20

# Rules as (action, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Hosts blocked, with their subdomains, where no rule fits: each name under every domain.
BLOCKED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_HOSTS = tuple(f"{name}.example.{domain}" for name in BLOCKED_NAMES for domain in ("com", "net", "org"))


@dataclass(frozen=True)
class Level:
    words: np.ndarray  # of 64 bits
    hashes: int
    number: int

    def places(self, h1: np.ndarray, h2: np.ndarray) -> Iterator[np.ndarray]:
        return places(h1, h2, len(self.words) * 64, self.hashes, self.number)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for at in self.places(h1, h2):
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def places(h1: np.ndarray, h2: np.ndarray, bits: int, hashes: int, number: int) -> Iterator[np.ndarray]:
    """Bit numbers of keys given by two 64-bit hashes. They differ from level to level,
    so that two keys mistaken for each other on one are told apart on another."""
    base = mixed(h1 + np.uint64(number))
    for i in range(hashes):
        yield (base + np.uint64(i) * (h2 | np.uint64(1))) % np.uint64(bits)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key is listed. The level that rejects a key tells its side; a
        key that none rejects is on the side of the last."""
        listed = np.full(len(h1), len(self.levels) % 2 == 1)
        open_ = np.arange(len(h1))
        for n, level in enumerate(self.levels):
            passed = level.has(h1[open_], h2[open_])
            listed[open_[~passed]] = n % 2 == 1
            open_ = open_[passed]
        return listed


def hashes(keys: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every key."""
    digests = b"".join(hashlib.blake2b(key.encode("utf-8", "replace"), digest_size=16).digest() for key in keys)
    both = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _level(keys: DataFrame, count: int, bits_a_key: int, number: int) -> Level:
    """A filter of the keys ``(h1, h2)``. Each task sets its own bits; only words with
    a bit set come together, so what reaches the driver is bounded by the filter."""
    size = max(1, math.ceil(count * bits_a_key / 64))
    if size * 8 > MAX_BYTES:
        raise ValueError(f"a level of {size * 8} bytes is too large to broadcast")
    hashes = max(1, round(bits_a_key * math.log(2)))

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = _unsigned(batch.column("h1")), _unsigned(batch.column("h2"))
            at = np.unique(np.concatenate([*places(h1, h2, size * 64, hashes, number), np.zeros(0, np.uint64)]))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "mask": pa.array(mask.view(np.int64))})

    found = keys.select("h1", "h2").mapInArrow(masks, "word bigint, mask bigint")
    found = found.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(size, np.uint64)
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return Level(words, hashes, number)


_HASHED = "h1 bigint, h2 bigint"


def _hashed(keys: Iterable[str]) -> pa.RecordBatch:
    h1, h2 = hashes(keys)
    return pa.RecordBatch.from_pydict({"h1": pa.array(h1.view(np.int64)), "h2": pa.array(h2.view(np.int64))})


def hashed_keys(keys: DataFrame) -> DataFrame:
    """The hashes of the column ``key``, each distinct one of a batch once; NULL keys
    are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _hashed({k for k in batch.column("key").to_pylist() if k is not None})

    return keys.select("key").mapInArrow(run, _HASHED)


def build(universe: DataFrame, listed: DataFrame) -> Cascade:
    """The cascade for the hashed keys of ``universe``, of which those of ``listed``
    are listed.

    Repeats are fine. Listed keys outside the universe count as part of it. Nothing
    listed gives a cascade that lists nothing.
    """
    marked = universe.select("h1", "h2", F.lit(False).alias("listed")).unionByName(listed.select("h1", "h2", F.lit(True).alias("listed")))
    keys = stored(marked.groupBy("h1", "h2").agg(F.max("listed").alias("listed")), "keys")
    inside, outside = keys.where("listed"), keys.where("not listed")
    levels: list[Level] = []
    used = 0
    while count := inside.count():
        levels.append(level := _level(inside, count, NEXT_BITS if levels else FIRST_BITS, len(levels)))
        used += level.words.nbytes
        if used > MAX_BYTES or len(levels) > 200:
            raise ValueError("the cascade is too large to broadcast")
        inside, outside = stored(_passing(outside, level), "mistaken-keys"), inside
    return Cascade(tuple(levels))


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(level)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held.value.has(_unsigned(batch.column("h1")), _unsigned(batch.column("h2")))))

    return keys.mapInArrow(passing, keys.schema)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for NULL and where there is no ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidates(host: str, path: str, lengths: Sequence[int], labels: int) -> list[str]:
    """Every key that could list a URL: the host's last labels, up to as many as a listed
    host has, each with the path's start of each of the lengths; the longest first, then
    the longest host. Deeper hosts give no more keys than others."""
    last = host.rsplit(".", labels)[-labels:]
    domains = [".".join(last[n:]) for n in range(len(last))]
    keys = {(len(d) + n, len(d), d + path[:n]) for d in domains for n in lengths if n <= len(path)}
    return [key for *_, key in sorted(keys, reverse=True)]


def judged(df: DataFrame, url: str, rules: Sequence[tuple[str, str]], blocked_hosts: Sequence[str]) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (the longest that fits, else NULL) and
    ``verdict``; columns of those names are replaced. Without a rule the verdict is
    block for a blocked host or its subdomains, and allow otherwise, for NULL and
    malformed URLs too."""
    spark = df.sparkSession
    lengths = sorted({len(r) - r.find("/") if "/" in r else 0 for _, r in rules} | {0})
    labels = max((key.split("/")[0].count(".") + 1 for key in [r for _, r in rules] + list(blocked_hosts)), default=1)
    parts = df.withColumns({"host": host(df[url]), "path": path(df[url])}).drop("rule", "verdict")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = set(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True))
            yield _hashed({key for h, p in urls for key in candidates(h, p, lengths, labels)})

    universe = stored(parts.select("host", "path").mapInArrow(keys, _HASHED).distinct(), "url-keys")
    listing = lambda keys: hashed_keys(spark.createDataFrame([(k,) for k in keys], "key string"))
    any_rule = build(universe, listing([r for _, r in rules]))
    blocking = build(universe, listing([r for a, r in rules if a == "block"] + list(blocked_hosts)))
    held = spark.sparkContext.broadcast((any_rule, blocking))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_of, blocked = held.value
        for batch in batches:
            found = [candidates(h, p, lengths, labels) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            flat = [key for keys in found for key in keys]
            row = np.repeat(np.arange(len(found)), [len(keys) for keys in found])
            h1, h2 = hashes(flat)
            hits = np.flatnonzero(rule_of.lists(h1, h2))
            ruled, first = np.unique(row[hits], return_index=True)  # the longest comes first
            bad = blocked.lists(h1, h2)
            block = np.zeros(len(found), bool)
            block[row[bad]] = True
            block[ruled] = bad[hits[first]]
            rule: list[str | None] = [None] * len(found)
            for n, at in zip(ruled.tolist(), hits[first].tolist(), strict=True):
                rule[n] = flat[at]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["rule"] = pa.array(rule, pa.string())
            columns["verdict"] = pa.array(["block" if b else "allow" for b in block.tolist()], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    kind = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return parts.mapInArrow(judge, kind)


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = renamed(table(spark, sf_dir, "pages"), page_id="page_id", url="url")
    return judged(pages, "url", RULES, BLOCKED_HOSTS).select("page_id", "host", "path", "rule", "verdict")


def _op4_sql() -> str:
    fits = [
        f"WHEN (host = '{r.split('/', 1)[0]}' OR ends_with(host, '.{r.split('/', 1)[0]}')) AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{r}'"
        for _, r in sorted(RULES, key=lambda rule: -len(rule[1]))
    ]
    blocks = ", ".join(f"'{r}'" for a, r in RULES if a == "block")
    listed = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in BLOCKED_HOSTS)
    return f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
ruled AS (SELECT *, CASE {" ".join(fits)} END AS rule FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({blocks}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


OP4_SQL = _op4_sql()
