"""How far sources of a language differ, by hash-consed segment trees over term ids.

The kept terms of a language are dealt over blocks by their hash. In a block they are
numbered, frequent ones first, and every source has a segment tree over these numbers
whose leaves are its counts. All trees of a task share their nodes: a node is known by
its two children, a leaf by its count, so equal subtrees (long runs of absent terms
above all) are one node, made once. Two trees are compared by walking both at once
from their roots, level by level, for many pairs of trees together; equal pairs of
nodes, under equal totals, are one entry of the level and priced once.

The same walk compares each source with its language. There a pair of nodes also
carries the largest price below it, and the terms that stand out are found by going
down only where that reaches the tenth largest of the source.

A task holds the counts of at most two blocks of sources for one block of terms, however
many documents, sources or terms there are; sums over blocks of terms are aggregated.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_lake.llm.common import renamed, sections, stored, table

#: A term is kept if at least so many documents of its language hold it.
LEAST_DOCS = 10
#: Shares are whole numbers of a billionth.
DIGITS = 9
#: Terms reported for each source.
TOP = 10
#: Terms and sources of a block, on average.
TERMS, SOURCES = 512, 64
#: Pairs of trees walked together.
TOGETHER = 512

_COUNTED = "lang string, source string, term string, n bigint, docs bigint"
_PRICED = "lang string, source string, part string, item string, value bigint"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_LETTER[0x80:] = True


def _words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row of every term, and the terms as a dictionary column."""
    letter = _LETTER[data]
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[offsets] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1] | starts_text[1:-1]
    at = np.flatnonzero(first)
    letters = _LOWER[data[letter]]
    begins = (np.cumsum(letter) - 1)[at] if len(at) else np.zeros(0, np.int64)
    bounds = np.append(begins, len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return np.searchsorted(offsets, at, side="right") - 1, words.dictionary_encode()


def _runs(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ascending, how often each occurs, and the sum of its weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(new, len(keys)))
    sums = sizes if weights is None else np.add.reduceat(weights[order], new) if len(new) else sizes
    return keys[new], sizes, sums


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run of texts, occurrences and documents of every term in each group, and
    for each group a row without a term. A text too long for one run counts as one
    document through all its sections."""
    long: dict[bytes, int] = {}
    for batch in batches:
        names = pa.table({n: batch.column(n) for n in ("lang", "source")})
        for first, last, offsets, data, begins, ends in sections(batch.column("text"), _LETTER):
            row, words = _words(offsets, data)
            held = names.slice(first, last - first)
            if begins and ends:
                groups, of = _groups(held)
                yield _rows(groups, *_summed(row, words, of), words.dictionary)
                continue
            _, _, n = _runs(words.indices.to_numpy().astype(np.int64))
            for word, k in zip(words.dictionary.to_pylist(), n.tolist(), strict=True):
                long[word] = long.get(word, 0) + k
            if ends:
                n = np.fromiter(long.values(), np.int64, len(long))
                nothing, index = np.zeros(len(long), np.int64), np.arange(len(long))
                yield _rows(held, nothing, index, n, np.ones(len(long), np.int64), pa.array(list(long), pa.large_binary()))
                long = {}


def _groups(held: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Distinct groups of the rows, and the number of each row's group."""
    codes = [held.column(n).combine_chunks().dictionary_encode() for n in held.column_names]
    lang, source = (c.indices.to_numpy().astype(np.int64) for c in codes)
    size = max(len(codes[1].dictionary), 1)
    keys, of = np.unique(lang * size + source, return_inverse=True)
    parts = (keys // size, keys % size)
    return pa.table({n: c.dictionary.take(pa.array(k)) for n, c, k in zip(held.column_names, codes, parts, strict=True)}), of


def _summed(row: np.ndarray, words: pa.DictionaryArray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Group, word, occurrences and documents of each distinct group and word."""
    size = max(len(words.dictionary), 1)
    in_rows, n, _ = _runs(row * size + words.indices.to_numpy())
    keys, docs, sums = _runs(of[in_rows // size] * size + in_rows % size, n)
    return keys // size, keys % size, sums, docs


def _rows(groups: pa.Table, group: np.ndarray, word: np.ndarray, n: np.ndarray, docs: np.ndarray, terms: pa.Array) -> pa.RecordBatch:
    """Rows of ``_COUNTED``: a row for each word of a group, and one without a term for
    each group."""
    which = np.concatenate([group, np.arange(len(groups))])
    none = np.zeros(len(groups), np.int64)
    term = terms.take(pa.array(word)).view(pa.large_string()).cast(pa.string())
    return pa.RecordBatch.from_pydict(
        {
            **{name: groups.column(name).combine_chunks().take(pa.array(which)) for name in ("lang", "source")},
            "term": pa.concat_arrays([term, pa.nulls(len(groups), pa.string())]),
            "n": pa.array(np.concatenate([n, none])),
            "docs": pa.array(np.concatenate([docs, none])),
        }
    )


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(10**DIGITS * (count + 2) / total)`` by long division, three digits at a
    time, exact for totals below 9 * 10**15."""
    rest, out = count + 2, np.zeros_like(count)
    for _ in range(DIGITS // 3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


class Forest:
    """Segment trees of equal shape that share equal nodes. ``counts`` has a row for each
    tree; -1 stands for a leaf that is no term."""

    def __init__(self, counts: np.ndarray):
        leaves, ids = np.unique(counts, return_inverse=True)
        self.leaves, ids = leaves, ids.reshape(counts.shape)
        #: From the leaves up: each node's children, as nodes of the level below.
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        self.sizes = [len(leaves)]
        while ids.shape[1] > 1:
            keys = ids[:, ::2].astype(np.int64) * self.sizes[-1] + ids[:, 1::2]
            nodes, ids = np.unique(keys, return_inverse=True)
            ids = ids.reshape(keys.shape)
            self.children.append((nodes // self.sizes[-1], nodes % self.sizes[-1]))
            self.sizes.append(len(nodes))
        self.roots = ids[:, 0]


class Walk:
    """The distinct pairs of nodes that a simultaneous walk through pairs of trees
    ``(a, b)`` meets, level by level. ``totals`` belong to the trees; pairs of nodes
    under different totals are different."""

    def __init__(self, forest: Forest, a: np.ndarray, b: np.ndarray, totals: np.ndarray):
        both, of = np.unique(np.stack([totals[a], totals[b]]), axis=1, return_inverse=True)
        self.forest, self.totals = forest, both
        level = len(forest.children)
        #: For each pair of trees, and then for each pair of nodes twice, the pair below.
        self.met: list[np.ndarray] = []
        pair = self._distinct(of.ravel(), forest.roots[a], forest.roots[b], level)
        while level:
            of, x, y = pair
            level -= 1
            (left, right) = forest.children[level]
            pair = self._distinct(np.concatenate([of, of]), np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]]), level)
        of, x, y = pair
        self.x, self.y = forest.leaves[x], forest.leaves[y]
        self.p, self.q = (share(np.maximum(n, 0), np.maximum(t[of], 1)) for n, t in ((self.x, both[0]), (self.y, both[1])))
        self.price = np.where(self.x < 0, 0, (self.p - self.q) ** 2 // (self.p + self.q))

    def _distinct(self, of: np.ndarray, x: np.ndarray, y: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.forest.sizes[level]
        keys, place = np.unique((of * size + x) * size + y, return_inverse=True)
        self.met.append(place)
        return keys // (size * size), keys // size % size, keys % size

    def up(self, prices: np.ndarray, combine) -> list[np.ndarray]:
        """Each level's values from those of the distinct pairs of leaves, roots first."""
        levels = [prices]
        for place in self.met[:0:-1]:
            left, right = np.split(levels[-1][place], 2)
            levels.append(combine(left, right))
        return levels[::-1]

    def sums(self) -> np.ndarray:
        """The price of every pair of trees."""
        return self.up(self.price, np.add)[0][self.met[0]]

    def largest(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tree pair, leaf and price of the leaves where the first tree has a count and the
        larger share: for each pair the ``most`` dearest and all that equal the last."""
        stands_out = (self.x > 0) & (self.p > self.q)
        best = self.up(np.where(stands_out, self.price, -1), np.maximum)
        tree, node, leaf = np.arange(len(self.met[0])), self.met[0], np.zeros(len(self.met[0]), np.int64)
        for depth, values in enumerate(best):
            kept = _leading(tree, values[node], most)
            tree, node, leaf = tree[kept], node[kept], leaf[kept]
            if depth + 1 < len(best):
                place, size = self.met[depth + 1], len(values)
                tree = np.concatenate([tree, tree])
                leaf = np.concatenate([2 * leaf, 2 * leaf + 1])
                node = np.concatenate([place[node], place[node + size]])
        return tree, leaf, best[-1][node]


def _leading(group: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Entries of a value not below 0 that are among the ``most`` largest of their group,
    or equal the last of these."""
    order = np.lexsort((-value, group))
    g, v = group[order], value[order]
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(g)))
    least = np.repeat(np.where(size >= most, v[np.minimum(start + most, start + size) - 1], 0), size)
    return order[(v >= least) & (v >= 0)]


def _compare(rows: pa.Table, top: int) -> pa.Table:
    """Prices of all pairs of sources of one task, and the terms that stand out in the
    sources of a single block. Rows without a term name the sources."""
    marks = rows.filter(pc.is_null(rows.column("term"))).sort_by("source")
    rows = rows.filter(pc.is_valid(rows.column("term")))
    lang, sources = marks.column("lang")[0].as_py(), marks.column("source").combine_chunks()
    part = marks.column("part").to_numpy()
    alone = bool(marks.column("i")[0] == marks.column("j")[0])
    size = marks.column("n")[0].as_py()

    names = rows.select(["term", "total"]).group_by("term").aggregate([("total", "max")])
    names = names.sort_by([("total_max", "descending"), ("term", "ascending")])
    terms = names.column("term").combine_chunks()
    leaves = 1 << max(size - 1, 0).bit_length()
    counts = np.zeros((len(sources) + 1, leaves), np.int64)
    counts[:, size:] = -1
    tree = pc.index_in(rows.column("source"), sources).to_numpy()
    leaf = pc.index_in(rows.column("term"), terms).to_numpy()
    counts[tree, leaf] = rows.column("n").to_numpy()
    counts[-1, : len(terms)] = names.column("total_max").to_numpy()
    totals = np.append(marks.column("group_total").to_numpy(), marks.column("lang_total")[0].as_py())
    forest = Forest(counts)

    a, b = np.triu_indices(len(sources), 1)
    if not alone:
        a, b = a[part[a] != part[b]], b[part[a] != part[b]]
    values = [np.zeros(0, np.int64)]
    for start in range(0, len(a), TOGETHER):
        values.append(Walk(forest, a[start : start + TOGETHER], b[start : start + TOGETHER], totals).sums())
    value = np.concatenate(values)
    own, item = sources.take(pa.array(np.concatenate([a, b]))), sources.take(pa.array(np.concatenate([b, a])))
    found = [_priced(lang, own, "pair", item, np.concatenate([value, value]))]
    if alone and size:
        each = np.arange(len(sources))
        tree, leaf, value = Walk(forest, each, np.full(len(each), len(sources)), totals).largest(top)
        number = np.argsort(np.argsort(np.array(terms.cast(pa.binary()).to_pylist(), object))) if len(terms) else np.zeros(0, np.int64)
        order = np.lexsort((number[leaf], -value, tree))
        tree, leaf, value = tree[order], leaf[order], value[order]
        rank = np.arange(len(tree)) - np.searchsorted(tree, tree)
        tree, leaf, value = (x[rank < top] for x in (tree, leaf, value))
        found.append(_priced(lang, sources.take(pa.array(tree)), "term", terms.take(pa.array(leaf)), value))
    return pa.concat_tables(found)


def _priced(lang: str, source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> pa.Table:
    same = lambda text: pa.array([text] * len(value), pa.string())
    return pa.table({"lang": same(lang), "source": source, "part": same(part), "item": item, "value": pa.array(value, pa.int64())})


def audit(df: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, terms: int = TERMS, sources: int = SOURCES) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` over the documents ``(text, lang, source)``.

    Part ``pair`` has every other source of the language with its divergence, part ``term``
    the ``top`` terms of which the source has a larger share than its language. NULL
    counts as an empty text or name. A source without kept terms is compared like any
    other; where a language keeps no term all divergences are 0. Repeated rows count as
    so many documents. Other columns are not read; an empty table gives no rows.
    """
    named = df.select(*[F.coalesce(df[c].cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = named.mapInArrow(counted, _COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = stored(counts, "term-counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    kept = stored(kept.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    held = stored(counts.drop("docs").join(kept, ["lang", "term"]), "held-terms")

    own = held.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    groups = counts.select("lang", "source").distinct()
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / sources).alias("parts")).join(of_lang, "lang", "left")
    blocks = blocks.select(
        "lang",
        "parts",
        F.greatest(F.lit(1), F.ceil(F.coalesce("v", F.lit(0)) / terms)).alias("blocks"),
        (F.coalesce("lang_n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("lang_total"),
        (2 * F.coalesce("v", F.lit(0))).alias("least_total"),
    )
    groups = groups.join(own, ["lang", "source"], "left").join(blocks, "lang")
    groups = groups.withColumns(
        {
            "part": F.pmod(F.xxhash64("source"), "parts"),
            "group_total": F.coalesce("group_n", F.lit(0)) + F.col("least_total"),
        }
    )
    groups = stored(groups.drop("group_n", "least_total"), "source-groups")

    block = F.pmod(F.xxhash64("term"), "blocks").alias("block")
    sizes = kept.join(groups.select("lang", "blocks").distinct(), "lang").groupBy("lang", block).agg(F.count(F.lit(1)).alias("size"))
    marks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).join(sizes, ["lang", "block"], "left")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    columns = ("lang", "block", "source", "part", "parts", "term", "n", "total", "group_total", "lang_total")
    nothing = {"term": F.lit(None).cast("string"), "n": F.coalesce("size", F.lit(0)), "total": F.lit(0).cast("bigint")}
    marks = marks.withColumns(nothing).select(*columns)
    rows = held.join(groups, ["lang", "source"]).withColumn("block", block).select(*columns).unionByName(marks)
    rows = rows.withColumn("other", other).withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    priced = rows.drop("parts", "other").groupBy("lang", "block", "i", "j").applyInArrow(lambda t: _compare(t, top), _PRICED)
    priced = stored(priced, "divergences")

    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    best = priced.where("part = 'term'").select("*", place).where(F.col("rank") <= top)
    return pairs.select("*", place).unionByName(best)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
sums AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (coalesce(sums.n, 0) + 2 * v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (total + 2) // (sizes.n + 2 * v) AS q
  FROM sources JOIN kept USING (lang) JOIN sizes USING (lang)
    LEFT JOIN sums USING (lang, source) LEFT JOIN c USING (lang, source, term)),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= 10"""
