"""License texts in documents, in built-in functions only.

Base labels come from phrases whose words stand consecutively. Further labels come
from an exact set-similarity join of text blocks with license templates: a block
meets a template if it contains at least ``CONTAINED`` of the template's distinct
words. Blocks are lines and windows over the words of the whole text, whatever its
line breaks, so that a hard-wrapped header is met too. Tokens are ordered by how many blocks of the corpus hold them, the rarest
first. A template of ``s`` tokens of which ``need`` must occur has one among its
first ``s - need + 1`` in common with the block's corresponding first ones (prefix
filter); a block of fewer than ``need`` tokens cannot meet it (length filter); and
what follows the common token on either side must suffice (positional filter).

Words that no template has are in no intersection, so blocks are reduced to the
templates' words when they are cut. Templates are a bounded parameter: their words
and index are literals and a checked broadcast.
"""

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm.common import renamed, stored, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Blocks are lines, the longer ones cut into windows that overlap by half, and such
#: windows over all words of the text: any stretch of half as many lies in one.
#: Templates of more than half a window's words have windows of their own, see ``width``.
BLOCK_WORDS = 64
CONTAINED = 0.9
#: Tokens of all templates together.
MOST_TOKENS = 10_000

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Templates by label: what the method finds besides the phrases.
TEMPLATES = (
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-sa", "licensed under the creative commons attribution sharealike license"),
    ("gpl", "licensed under the gnu general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mpl-2", "subject to the terms of the mozilla public license"),
)


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def places(words: Column, phrase: Sequence[str]) -> Column:
    """Where the phrase's words stand consecutively, in ascending order."""
    rest = F.size(words) - len(phrase)
    here = lambda i: F.lit(True) if not phrase else _all(F.get(words, i + k) == w for k, w in enumerate(phrase))
    holds_all = _all(F.array_contains(words, w) for w in sorted(set(phrase)))
    return F.when(holds_all & (rest >= 0), F.filter(F.sequence(F.lit(0), rest), here)).otherwise(F.array().cast("array<int>"))


def _all(conditions) -> Column:
    first, *others = conditions
    for other in others:
        first = first & other
    return first


def width(text: str) -> int:
    """Words of the windows for a template: twice its own at least, in powers of two."""
    words = BLOCK_WORDS
    while words < 2 * len(text.split()):
        words *= 2
    return words


def blocks(lines: Column, words: Column, vocabulary: Sequence[str], least: int, most: int) -> Column:
    """The distinct words of every block of at most ``most`` words that are in the
    vocabulary, where they are ``least`` or more. ``words`` are those of all lines."""
    known = F.array(*map(F.lit, vocabulary))
    step = most // 2

    def cut(line: Column) -> Column:
        more = F.ceil((F.size(line) - most) / step).cast("int")
        parts = F.transform(F.sequence(F.lit(0), more), lambda k: F.slice(line, k * step + 1, most))
        return F.when(F.size(line) > most, parts).otherwise(F.array(line))

    across = F.when(F.size(lines) > 1, F.array(words)).otherwise(F.slice(F.array(words), 1, 0))
    reduced = F.transform(F.flatten(F.transform(F.concat(lines, across), cut)), lambda b: F.array_intersect(b, known))
    return F.filter(reduced, lambda b: F.size(b) >= least)


def needed(tokens: Sequence[str], contained: float) -> int:
    """How many of a template's distinct words a block must contain."""
    return max(1, math.ceil(contained * len(tokens) - 1e-9))


def scan(
    df: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    contained: float = CONTAINED,
) -> DataFrame:
    """For each row of ``(doc_id, text)``: words, phrase places, labels and the best
    containment (1 where a phrase stands, 0 where nothing was found).

    NULL and empty texts have no words and no labels. Rows are told apart by their
    place in the input, so repeated and NULL ids are fine. Other columns are not read.
    """
    sets: dict[int, list[tuple[str, list[str]]]] = {}  # by width
    for label, text in templates:
        sets.setdefault(width(text), []).append((label, sorted(set(text.split()))))
    sets = sets or {BLOCK_WORDS: []}
    if sum(len(tokens) for some in sets.values() for _, tokens in some) > MOST_TOKENS:
        raise ValueError("the templates are too large to be held by every task")

    def cut_for(most: int) -> Column:
        vocabulary = sorted({t for _, tokens in sets[most] for t in tokens})
        least = min((needed(tokens, contained) for _, tokens in sets[most]), default=1)
        return blocks(F.col("lines"), F.col("words"), vocabulary, least, most).alias(f"blocks{most}")

    docs = renamed(df, doc_id="doc_id", text="text")
    lines = F.transform(F.split(lowered(F.col("text")), "\n"), lambda line: F.regexp_extract_all(line, F.lit(WORD), F.lit(0)))
    worded = docs.select("doc_id", lines.alias("lines")).withColumn("words", F.flatten("lines"))
    found = worded.withColumns({f"at{i}": places(F.col("words"), p.split()) for i, p in enumerate(phrases)})
    base = [F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]
    all_places = F.concat(*[F.col(f"at{i}") for i in range(len(phrases))])
    cut = stored(
        found.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("bigint").alias("n_words"),
            F.size(all_places).cast("bigint").alias("n_base"),
            F.array_min(all_places).cast("bigint").alias("first_word"),
            F.array_max(all_places).cast("bigint").alias("last_word"),
            F.array_sort(F.array_distinct(F.array_compact(F.array(*base)))).alias("base"),
            *map(cut_for, sets),
        ),
        "license-blocks",
    )
    found_by = lambda most: contained_templates(cut.select("row", F.posexplode(f"blocks{most}").alias("block", "tokens")), sets[most], contained)
    matches = reduce(DataFrame.unionByName, map(found_by, sets))
    best = matches.groupBy("row").agg(F.max("share").alias("share"), F.collect_set("label").alias("more"))
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return cut.join(best, "row", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def contained_templates(blocks: DataFrame, sets: Sequence[tuple[str, Sequence[str]]], contained: float) -> DataFrame:
    """``(row, block, label, share)`` for every block ``(row, block, tokens)`` and
    template of which it contains the share ``contained`` or more."""
    spark = blocks.sparkSession
    counted = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count().collect()  # the vocabulary at most
    often = {r["token"]: r["count"] for r in counted}
    order = sorted({t for _, tokens in sets for t in tokens}, key=lambda t: (often.get(t, 0), t))
    rank = {t: n for n, t in enumerate(order)}
    index = []
    for number, (label, tokens) in enumerate(sets):
        ordered = sorted(tokens, key=rank.get)
        need = needed(ordered, contained)
        index += [(t, at, number, label, need, ordered) for at, t in enumerate(ordered[: len(ordered) - need + 1])]
    kind = "token string, at int, template int, label string, need int, template_tokens array<string>"
    prefixes = F.broadcast(spark.createDataFrame(index, kind))  # MOST_TOKENS rows at most
    least = min((need for *_, need, _ in index), default=1)

    # An intersection keeps the order of its first argument: the global one.
    ordered = blocks.withColumn("tokens", F.array_intersect(F.array(*map(F.lit, order)), "tokens")).where(F.size("tokens") >= least)
    first = F.slice("tokens", F.lit(1), F.size("tokens") - (least - 1))
    left, right = F.size("tokens") - F.col("place"), F.size("template_tokens") - F.col("at")
    candidates = (
        ordered.select("row", "block", "tokens", F.posexplode(first).alias("place", "token"))
        .join(prefixes, "token")
        .where(F.size("tokens") >= F.col("need"))  # length
        .where(F.col("place") <= F.size("tokens") - F.col("need"))  # prefix of this template's need
        .where(F.least(left, right) >= F.col("need"))  # position
    )
    share = F.size(F.array_intersect("tokens", "template_tokens"))
    return (
        candidates.withColumn("common", share)
        .where("common >= need")
        .groupBy("row", "block", "template")
        .agg(F.first("label").alias("label"), F.max(F.col("common") / F.size("template_tokens")).alias("share"))
        .drop("template")
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
