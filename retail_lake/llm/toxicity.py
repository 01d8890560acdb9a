"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its
features (words, and the first four, five and six bytes of words); the document's
score is the noisy-or of its sentences. Only documents are labelled, and training
maximises the likelihood of their labels, so the model finds out which sentences
made a document toxic. A sentence without any learnt feature scores exactly 0, so
length alone never makes a document toxic.

Training uses a bounded sample: at most ``POSITIVE`` toxic and ``NEGATIVE`` other
documents, those of least hashed id among the rows labels may be learnt from, and no
more distinct texts than both together where ids repeat.

A long text is scored section by section, in bounded memory: sections end between
words, and a sentence that goes on in the next one is scored with the features of both.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.llm.common import CHUNK_BYTES, distinct, pieces, renamed, sections, stored, table
from retail_lake.llm.shingles import mixed

POSITIVE, NEGATIVE = 2000, 8000
#: Score from which a document counts as toxic.
THRESHOLD = 0.7
#: A feature occurs in so many toxic sample documents and such a share of them at
#: least, and is so many times as frequent among them as among the others.
LEAST_DOCS, LEAST_SHARE, LIFT = 3, 0.002, 8.0
#: Log-odds of a sentence without features, against which scores are measured.
BIAS = -4.0
PREFIXES = (4, 5, 6)
EPOCHS, RATE, L1 = 150, 0.2, 2e-4

_rng = np.random.Generator(np.random.PCG64(7))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KIND = _rng.integers(1, 1 << 63, len(PREFIXES) + 1, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_LETTER[0x80:] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Bags:
    """Features of a run of texts: for each word its sentence and a row of feature
    keys (0: none); for each sentence its text and where it starts."""

    sentence: np.ndarray
    keys: np.ndarray
    text: np.ndarray
    start: np.ndarray


def bags(offsets: np.ndarray, data: np.ndarray) -> Bags:
    letter = _LETTER[data]
    opens = np.zeros(len(data) + 1, bool)  # a sentence starts here
    opens[offsets] = True
    opens[1:] |= _END[data]
    opens = opens[:-1]
    start = np.flatnonzero(opens)
    text = np.searchsorted(offsets, start, side="right") - 1
    first = letter.copy()
    first[1:] &= ~letter[:-1] | opens[1:]
    at = np.flatnonzero(first)
    if not len(at):
        return Bags(np.zeros(0, np.int64), np.zeros((0, len(_KIND)), np.uint64), text, start)
    solid = np.flatnonzero(letter)
    begins = np.searchsorted(solid, at)
    sizes = np.diff(np.append(begins, len(solid)))
    place = np.arange(len(solid)) - np.repeat(begins, sizes)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(sizes.max()), _BASE)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[_LOWER[data[solid]]] * powers[place], dtype=np.uint64)])
    keys = np.zeros((len(at), len(_KIND)), np.uint64)
    keys[:, 0] = mixed(sums[begins + sizes] - sums[begins] + _KIND[0])
    for n, width in enumerate(PREFIXES, 1):
        enough = sizes >= width
        keys[enough, n] = mixed(sums[begins[enough] + width] - sums[begins[enough]] + _KIND[n])
    return Bags(np.searchsorted(start, at, side="right") - 1, keys, text, start)


@dataclass
class Model:
    keys: np.ndarray  # ascending
    weights: np.ndarray

    def __post_init__(self):
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.keys >> np.uint64(42)] = True

    def known(self, found: Bags) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ``(sentence, feature number)`` of the features the model knows."""
        word, kind = np.nonzero(self.maybe[found.keys >> np.uint64(42)])
        key = found.keys[word, kind]
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        size = max(len(self.keys), 1)
        both = distinct(found.sentence[word[hit]] * size + at[hit])
        return both // size, both % size

    def log_clear(self, sentence: np.ndarray, feature: np.ndarray, sentences: int) -> np.ndarray:
        """For each sentence the log of one minus its score."""
        z = BIAS + np.bincount(sentence, self.weights[feature], sentences)
        return np.logaddexp(0, BIAS) - np.logaddexp(0, z)


@dataclass
class Judged:
    """Scores and offending sentences of the rows ``first`` to ``last``."""

    first: int
    last: int
    score: np.ndarray
    offending: pa.ListArray


def judged(column: pa.Array, model: Model, most: int = CHUNK_BYTES) -> Iterator[Judged]:
    """All texts of a column in turn, those of more than ``most`` bytes in sections. Only
    sentences with known features are remembered from section to section."""
    for first, last, offsets, data, begins, ends in sections(column, _LETTER, most):
        if begins:
            known, base, size, open_ = [], 0, 0, None
        found = bags(offsets, data)
        sentence, feature = model.known(found)
        start, upto = found.start + size, np.append(found.start[1:], len(data)) + size
        # A sentence ends with its text at the latest.
        upto = np.minimum(upto, offsets[found.text + 1] + size)
        if open_ is not None and len(start):  # the first sentence here goes on from before
            start[0] = open_
            base -= 1
            for part in known:  # and ends here, as far as known
                part[3][part[0] == base] = upto[0]
        known.append([sentence + base, feature, start[sentence], upto[sentence], found.text[sentence]])
        base += len(start)
        size += len(data)
        if len(data):
            open_ = None if _END[data[-1]] else int(start[-1])
        if ends:
            yield _judged(first, last, offsets if begins else np.array([0, size]), known, model)


def _judged(first: int, last: int, offsets: np.ndarray, known: list[list[np.ndarray]], model: Model) -> Judged:
    sentence, feature, start, upto, text = (np.concatenate(x) for x in zip(*known, strict=True))
    n = max(len(model.keys), 1)
    pairs, at = np.unique(sentence * n + feature, return_index=True)
    which, place, counts = np.unique(pairs // n, return_inverse=True, return_counts=True)
    row = at[np.cumsum(counts) - counts] if len(at) else at
    log_q = model.log_clear(place, pairs % n, len(which))
    score = np.clip(-np.expm1(np.bincount(text[row], log_q, last - first)), 0.0, 1.0) + 0.0
    own = -np.expm1(log_q)
    bad = own >= THRESHOLD
    of = text[row][bad]
    spans = pa.StructArray.from_arrays(
        [pa.array(start[row][bad] - offsets[of]), pa.array(upto[row][bad] - offsets[of]), pa.array(own[bad])], names=["start", "end", "score"]
    )
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=last - first))]).astype(np.int32)
    return Judged(first, last, score, pa.ListArray.from_arrays(pa.array(ends), spans))


def _candidates(toxic: list[Bags], other: list[Bags]) -> np.ndarray:
    """Feature keys frequent among toxic texts, and more so than among the others."""
    texts = [sum(len(distinct(p.text)) for p in parts) for parts in (toxic, other)]
    seen = [distinct(keys.ravel()) for part in toxic for keys in np.split(part.keys, _turns(part))]
    keys, n = np.unique(np.concatenate([*seen, np.zeros(0, np.uint64)]), return_counts=True)
    often = (n >= max(LEAST_DOCS, LEAST_SHARE * texts[0])) & (keys > 0)
    keys, n = keys[often], n[often]
    model, against = Model(keys, np.zeros(len(keys))), np.zeros(len(keys))
    for part in other:
        sentence, feature = model.known(part)
        once = distinct(part.text[sentence] * max(len(keys), 1) + feature) % max(len(keys), 1)
        against += np.bincount(once, minlength=len(keys))
    return keys[n / max(texts[0], 1) >= LIFT * (against + 1) / max(texts[1], 1)]


def _turns(part: Bags) -> np.ndarray:
    """Words at which another text begins."""
    of = part.text[part.sentence]
    return np.flatnonzero(of[1:] != of[:-1]) + 1


def fit(toxic: list[Bags], other: list[Bags]) -> Model:
    """Weights, none negative, that make the labels likeliest (Adam, with a
    proximal step for the L1 penalty that leaves few features)."""
    keys = _candidates(toxic, other)
    model = Model(keys, np.full(len(keys), 1.0))
    sentences, features, bag_of, labels = [], [], [], []
    n_sentences = n_bags = 0
    for parts, label in ((toxic, 1.0), (other, 0.0)):
        for part in parts:
            sentence, feature = model.known(part)
            which, place = np.unique(sentence, return_inverse=True)
            held, bag = np.unique(part.text[which], return_inverse=True)
            sentences.append(place + n_sentences)
            features.append(feature)
            bag_of.append(bag + n_bags)
            labels.append(np.full(len(held), label))
            n_sentences, n_bags = n_sentences + len(which), n_bags + len(held)
    if not n_bags or not len(keys):
        return Model(keys[:0], np.zeros(0))
    sentence, feature, bag, y = map(np.concatenate, (sentences, features, bag_of, labels))
    w, m, v = model.weights, np.zeros(len(keys)), np.zeros(len(keys))
    for step in range(1, EPOCHS + 1):
        z = BIAS + np.bincount(sentence, w[feature], n_sentences)
        log_q = np.logaddexp(0, BIAS) - np.logaddexp(0, z)
        q = np.exp(np.bincount(bag, log_q, n_bags))
        pull = np.where(y > 0, -q / np.maximum(1 - q, 1e-6), 1.0)
        slope = np.bincount(feature, (pull[bag] / (1 + np.exp(-z)))[sentence], len(keys)) / n_bags
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w = np.clip(w - L1 * RATE * 10, 0, 12)
    return Model(keys[w > 0], w[w > 0])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, list[Bags]] = {0: [], 1: []}
    for batch in batches:
        marks = batch.column("toxic").to_numpy()
        for label, into in parts.items():
            texts = batch.column("text").take(pa.array(np.flatnonzero(marks == label)))
            into.extend(bags(offsets, data) for _, _, offsets, data in pieces(texts))
    model = fit(parts[1], parts[0])
    yield pa.RecordBatch.from_pydict({"key": pa.array(model.keys.view(np.int64)), "weight": pa.array(model.weights, pa.float64())})


def may_learn(doc_id: Column) -> Column:
    """Whether a row's label may be learnt from; the others are held out."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, positive: int, negative: int) -> DataFrame:
    """``(text, toxic)`` to learn from, in the order of the texts' digests."""
    usable = renamed(labels, doc_id="doc_id", toxic="toxic").where(may_learn(F.col("doc_id")) & F.col("doc_id").isNotNull())
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    labelled = usable.where("toxic = 1").orderBy(*order).limit(positive)
    labelled = labelled.unionByName(usable.where("toxic = 0").orderBy(*order).limit(negative))
    texts = renamed(docs, doc_id="doc_id", text="text")
    marked = texts.join(F.broadcast(labelled), "doc_id")  # at most positive + negative labels
    once = marked.groupBy(F.sha2("text", 256).alias("same")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    return once.orderBy("same").limit(positive + negative).select("text", F.col("toxic").cast("int").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, positive: int = POSITIVE, negative: int = NEGATIVE) -> DataFrame:
    """The model as rows ``(key, weight)``, a few thousand at most. Labels other than
    0 and 1, rows held out and labels without a document are not learnt from; equal
    texts of the sample count once. Without toxic examples the model is empty."""
    bounded = sample(docs, labels, positive, negative).coalesce(1)  # bounded by the sample, hence one task
    return stored(bounded.mapInArrow(_train, "key bigint, weight double"), "toxicity-model")


def scored(df: DataFrame, model: DataFrame, keep: list[str], spans: bool = False) -> DataFrame:
    """The columns ``keep`` with the document's ``score``, and with ``spans`` the
    offending sentences: where each starts and ends (bytes of the UTF-8 text) and its
    own score, if that reaches ``THRESHOLD``. NULL and empty texts score 0."""
    rows = model.orderBy("key").collect()  # bounded: features frequent in a bounded sample
    keys = np.array([r.key for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    weights = np.array([r.weight for r in rows], float)
    held = df.sparkSession.sparkContext.broadcast((keys[order], weights[order]))
    df = df.select(*keep, *([] if "text" in keep else ["text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*held.value)
        for batch in batches:
            for part in judged(batch.column("text"), model):
                columns = {n: batch.column(n).slice(part.first, part.last - part.first) for n in keep}
                columns["score"] = pa.array(part.score)
                if spans:
                    columns["offending"] = part.offending
                yield pa.RecordBatch.from_pydict(columns)

    extra = [T.StructField("score", T.DoubleType())]
    if spans:
        extra.append(T.StructField("offending", T._parse_datatype_string("array<struct<start:bigint,end:bigint,score:double>>")))
    fields = [df.schema[name] for name in keep if name not in {e.name for e in extra}]
    return df.mapInArrow(run, T.StructType(fields + extra))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, with its own columns."""
    model = train(docs, labels)
    inner = docs.select(*[F.col(c).alias(f"c{i}") if c != "text" else F.col(c) for i, c in enumerate(docs.columns)])
    kept = scored(inner, model, inner.columns).where(F.col("score") < THRESHOLD).drop("score")
    return kept.toDF(*docs.columns)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = renamed(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, ["doc_id"], spans=True).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
        "offending",
    )
