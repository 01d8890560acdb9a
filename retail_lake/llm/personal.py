"""Personal data in texts: patterns, and a character-level BiLSTM-CRF that goes beyond them.

Four kinds are found by patterns with a check each (base spans). They are also the labels
of a tagger (see ``tagger``): it learns from base spans of a bounded sample of documents,
each in its surroundings and in varied spelling (``name (at) host dot com``, numbers with
other separators, defanged addresses, phone numbers without their plus). The tagger then
reads every text whole, in overlapping windows. A span whole in one window may be cut by
the edge of another, so the spans of all windows of a document are reconciled together:
pieces that an edge cut are joined, and of overlapping spans the set of greatest total
score stays. A span of the method is reported if it overlaps no base span, its characters
are likely enough on average, and what it spells out passes the check of its kind.

The sample: the ``SAMPLE`` documents of least hashed id that hold a digit or an at sign,
and of each at most ``PER_DOCUMENT`` pieces of text.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm.common import renamed, stored, table
from retail_lake.llm.tagger import BATCH, STEPS, Tagger, best_tags, posteriors

KINDS = ("email", "ip", "card", "phone")
SAMPLE, PER_DOCUMENT = 3000, 8
#: Characters of a window and of the overlap of two; a span of the method is no longer.
WINDOW, OVERLAP = 256, 48
#: Characters around a labelled span, and of a piece to train on.
AROUND, PIECE = 32, 96
#: Windows decoded together, and characters of the texts they come from.
TOGETHER, CHARACTERS = 2048, 2 << 20
#: Mean probability of a span's characters from which it counts.
LIKELY = 0.5
SEED = 12
#: Digits of a number from which it looks like a card's.
LEAST_CARD = 12

_SPAN = "struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>"
FOUND = f"doc_id bigint, spans array<{_SPAN}>"
_PIECES = "pick bigint, n int, kind string, before string, middle string, after string"

# The patterns of the four kinds. They are matched by parts (see ``base``),
# as the whole of the first two takes quadratic time on long runs.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_USER = re.compile(r"[A-Za-z0-9._%+-]")
_GROUPS = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # matches wherever it starts, so it never looks back
_CARD, _PHONE = re.compile(CARD), re.compile(PHONE)
_DIGITS = re.compile(r"[0-9]")


# -- patterns --------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def sound(kind: str, text: str) -> bool:
    """The check of a match of its kind's pattern."""
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in text.split("."))
    if kind == "card":
        digits = _digits(text)
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for host in _HOST.finditer(text):
        start = host.start()
        while start > done and _USER.match(text, start - 1):
            start -= 1
        if start < host.start():
            yield start, host.end()
            done = host.end()


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _GROUPS.finditer(text):
        ends = [run.start() - 1, *(m.start() for m in re.finditer(r"\.", run.group())), len(run.group())]
        ends = [ends[0], *(run.start() + x for x in ends[1:])]
        for k in range(0, len(ends) - 4, 4):
            yield ends[k] + 1, ends[k + 4]


def base(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans ``(start, end, kind)``, and matches outside them that fail their check by
    little: a number as long as a card's, parts of an address or a phone number too long."""
    found = [(*span, "email") for span in _emails(text)] + [(*span, "ip") for span in _addresses(text)]
    for kind, pattern in (("card", _CARD), ("phone", _PHONE)):
        found += [(*m.span(), kind) for m in pattern.finditer(text)]
    good = sorted((x for x in found if sound(x[2], text[x[0] : x[1]])), key=_place)
    rest = [x for x in found if not sound(x[2], text[x[0] : x[1]]) and not (x[2] == "card" and len(_digits(text[x[0] : x[1]])) < LEAST_CARD)]
    return good, [x for x in rest if not _meets(good, x[0], x[1])]


def _meets(spans: list[tuple], start: int, end: int) -> bool:
    """Whether any of the spans, in the order of their starts, overlaps this one. Of one
    kind they are disjoint, so few of those before can reach so far."""
    return any(x[1] > start for x in _near(spans, start, end))


def _near(spans: list[tuple], start: int, end: int) -> list[tuple]:
    i = bisect_left(spans, (end,))
    return spans[max(0, bisect_left(spans, (start,)) - 2 * len(KINDS)) : i]


def _place(span: tuple) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


# -- varied spelling -------------------------------------------------------------------

_AT = ("@", " @ ", "(at)", " (at) ", "[at]", " [at] ", " at ")
_DOT = (".", " . ", "(dot)", " (dot) ", "[dot]", " [dot] ", " dot ")
_AT_SIGN = re.compile(r" ?(?:@|\(at\)|\[at\]) ?| at ", re.I)
_DOT_SIGN = re.compile(r" ?(?:\(dot\)|\[dot\]) ?| dot | \. ", re.I)
_DEFANGED = re.compile(r" ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|,) ?| dot ", re.I)
_BARE_PHONE = re.compile(r"\(?[0-9][\x20()./0-9-]+[0-9]")
_GROUPED = re.compile(r"[0-9](?:[\x20./_-]?[0-9])+")


def varied(kind: str, text: str, rng: np.random.Generator) -> str:
    """Another spelling of a base span."""
    pick = lambda options: options[int(rng.integers(len(options)))]
    if kind == "email":
        user, host = text.split("@", 1)
        dot = pick(_DOT)
        return pick(_AT[1:] if dot == "." else _AT).join((user.replace(".", dot) if rng.random() < 0.5 else user, host.replace(".", dot)))
    if kind == "ip":
        return text.replace(".", pick(("[.]", "(.)", "[dot]", " dot ", ", ")))
    digits = _digits(text)
    if kind == "card":
        joint = pick((".", "/", "_", " ", "-"))
        return joint.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    joint, local = pick((" ", "-", ".", "/")), digits[-10:]
    head = f"({local[:3]}) " if rng.random() < 0.5 else local[:3] + joint
    return pick(("", "", "1 ", "1-")) + head + local[3:6] + joint + local[6:]


def spelled_out(kind: str, text: str) -> bool:
    """Whether a span of the method is what its kind says, in whatever spelling."""
    if kind == "email":
        plain = re.search(r" at ", text, re.I) and not _DOT_SIGN.search(text)
        joined = _DOT_SIGN.sub(".", _AT_SIGN.sub("@", text))
        return not plain and joined.count("@") == 1 and re.fullmatch(EMAIL, joined) is not None
    if kind == "ip":
        joined = _DEFANGED.sub(".", text)
        return re.fullmatch(IP, joined) is not None and sound("ip", joined)
    if kind == "card":
        return _GROUPED.fullmatch(text) is not None and sound("card", text)
    parts = len(re.findall(r"[0-9]+", text))
    return _BARE_PHONE.fullmatch(text) is not None and parts >= 3 and 10 <= len(_digits(text)) <= 15


def suspicious(text: str) -> bool:
    """Whether a text without base spans may hold one in another spelling."""
    numbers = any(spelled_out(kind, m.group()) for kind, p in (("phone", _BARE_PHONE), ("card", _GROUPED)) for m in p.finditer(text))
    signs = [m.group().strip().lower() for m in _AT_SIGN.finditer(text)]
    spelled = any(s != "at" for s in signs) or (signs and _DOT_SIGN.search(text))
    return bool(numbers or spelled or re.search(r"[0-9] ?(?:[\[(]\.[\])]|[\[(]?dot[\])]?) ?[0-9]", text, re.I))


# -- characters ------------------------------------------------------------------------

# Symbols: each letter whatever its case, all digits, each other ASCII sign, white space,
# characters beyond ASCII, and what lies beyond a text's end.
_SYMBOL = np.zeros(129, np.uint8)
for _code in range(128):
    _char = chr(_code)
    _SYMBOL[_code] = (
        _code - 97 if _char.islower() else _code - 65 if _char.isupper() else 26 if _char.isdigit() else 27 if _char.isspace() or _code < 32 or _code == 127 else 28 + _code - 33
    )
_BEYOND_ASCII, _NOTHING = 28 + 127 - 33, 28 + 128 - 33
_SYMBOL[128] = _BEYOND_ASCII
SYMBOLS = _NOTHING + 1


def symbols(text: str) -> np.ndarray:
    """The symbol of every character (code point)."""
    parts = (text[i : i + CHARACTERS].encode("utf-32-le", "surrogatepass") for i in range(0, max(len(text), 1), CHARACTERS))
    return np.concatenate([_SYMBOL[np.minimum(np.frombuffer(part, np.uint32), 128)] for part in parts])


# -- training --------------------------------------------------------------------------


def _pieces_of(text: str, pick: int) -> Iterator[tuple[str, str, str, str]]:
    """``(kind, before, middle, after)``: base spans in their surroundings, free of other
    matches, and pieces without a match (of no kind), some of them with digits or signs
    but none that may hold personal data in another spelling."""
    good, bad = base(text)
    taken = sorted([*good, *bad])
    rng = np.random.default_rng(pick % (1 << 32))
    starts, ends = [x[0] for x in taken], sorted(x[1] for x in taken)
    chosen = [good[i] for i in sorted(rng.permutation(len(good))[: PER_DOCUMENT // 2].tolist())]
    for start, end, kind in chosen:
        if sum(_meets([x], start, end) for x in _near(good, start, end)) > 1:
            continue
        i = bisect_left(ends, start + 1)
        left = max(start - AROUND, ends[i - 1] if i else 0)
        j = bisect_left(starts, end)
        right = min(end + AROUND, starts[j] if j < len(starts) else len(text))
        yield kind, text[left:start], text[start:end], text[end:right]
    signs = [m.start() for m in re.finditer(r"[0-9@+]", text)]
    spots = [signs[int(i)] for i in rng.integers(len(signs), size=2)] if signs else []
    spots += rng.integers(max(len(text), 1), size=PER_DOCUMENT // 2 - 2).tolist()
    for spot in spots:
        left = max(0, spot - int(rng.integers(PIECE)))
        piece = text[left : left + PIECE]
        if not _meets(taken, left, left + PIECE) and not suspicious(piece):
            yield "", "", piece, ""


def training_pieces(docs: DataFrame, sample: int) -> DataFrame:
    """Pieces to learn from, at most ``PER_DOCUMENT`` from each of ``sample`` documents."""
    pick = F.xxhash64("doc_id")
    holding = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
    ids = holding.select("doc_id").orderBy(pick, "doc_id").limit(sample).distinct()
    chosen = docs.join(F.broadcast(ids), "doc_id").select(pick.alias("pick"), "text")  # at most ``sample`` ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (pick, n, *piece)
                for pick, text in zip(batch.column("pick").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for n, piece in enumerate(_pieces_of(text or "", pick))
            ]
            names = ("pick", "n", "kind", "before", "middle", "after")
            types = (pa.int64(), pa.int32(), *[pa.string()] * 4)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))

    # A repeated id gives its pieces once: no more than PER_DOCUMENT rows of each id stay.
    return chosen.mapInArrow(cut, _PIECES).groupBy("pick", "n").agg(F.min(F.struct("kind", "before", "middle", "after")).alias("piece")).select("pick", "n", "piece.*")


def learn(pieces: list[tuple[str, str, str, str]], steps: int = STEPS, seed: int = SEED) -> Tagger | None:
    """A tagger from pieces ``(kind, before, middle, after)``; None without a span."""
    by_kind = {kind: [p for p in pieces if p[0] == kind] for kind in ("", *KINDS)}
    some = [kind for kind in KINDS if by_kind[kind]]
    if not some:
        return None
    rng, length = np.random.default_rng(seed), PIECE + AROUND // 2

    def draw(step: int) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.full((length, BATCH), _NOTHING, np.uint8), np.zeros((length, BATCH), np.int64)
        for k in range(BATCH):
            kind = some[int(rng.integers(len(some)))] if rng.random() < 0.6 or not by_kind[""] else ""
            options = by_kind[kind]
            _, before, middle, after = options[int(rng.integers(len(options)))]
            if kind and rng.random() < 0.6:
                middle = varied(kind, middle, rng)
            before = before[int(rng.integers(len(before) + 1)) :]
            text = symbols(before + middle + after)[:length]
            x[: len(text), k] = text
            if kind:
                y[len(before) : len(before) + len(middle), k] = 1 + KINDS.index(kind)
        return x, y

    return Tagger.fresh(SYMBOLS, 1 + len(KINDS), seed).fit(draw, steps)


def train(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> DataFrame:
    """The tagger's weights as a few rows ``(name, rows, data)``; none without spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        tagger = learn([(r["kind"], r["before"], r["middle"], r["after"]) for r in rows], steps)
        weights = tagger.weights if tagger else {}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(weights), pa.string()), pa.array([len(x) for x in weights.values()], pa.int64()), pa.array([x.tobytes() for x in weights.values()], pa.binary())],
            names=["name", "rows", "data"],
        )

    pieces = training_pieces(renamed(docs, doc_id="doc_id", text="text"), sample)
    ordered = pieces.repartition(1).sortWithinPartitions("pick", "n")  # bounded by the sample, hence one task
    return stored(ordered.mapInArrow(run, "name string, rows bigint, data binary"), "tagger")


@lru_cache(maxsize=2)
def _tagger(weights: tuple[tuple[str, int, bytes], ...]) -> Tagger:
    return Tagger({n: np.frombuffer(data, np.float64).reshape(rows, -1) for n, rows, data in weights}).single()


# -- decoding --------------------------------------------------------------------------


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and start of every window: a text's windows overlap, and cover it."""
    each = np.maximum(0, -(-(lengths - OVERLAP) // (WINDOW - OVERLAP))) + (lengths <= OVERLAP) * (lengths > 0)
    text = np.repeat(np.arange(len(lengths)), each)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)) * (WINDOW - OVERLAP)


def _runs(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, end, tag)`` of the runs of equal tags other than 0."""
    edges = np.flatnonzero(np.concatenate([[True], tags[1:] != tags[:-1], [True]]))
    return [(int(a), int(b), int(tags[a])) for a, b in zip(edges, edges[1:], strict=False) if tags[a]]


def decoded(texts: list[np.ndarray], tagger: Tagger) -> dict[int, list[tuple[int, int, str, float, bool, bool]]]:
    """Candidates of each text of symbols, from all its windows: ``(start, end, kind,
    score, cut at the left, cut at the right)``."""
    lengths = np.array([len(x) for x in texts], np.int64)
    flat = np.concatenate([*texts, np.full(WINDOW, _NOTHING, np.uint8)])
    begins = np.cumsum(lengths) - lengths
    text, start = windows(lengths)
    out: dict[int, list] = {}
    for a in range(0, len(text), TOGETHER):
        which, at = text[a : a + TOGETHER], start[a : a + TOGETHER]
        place = at + np.arange(WINDOW)[:, None]
        x = np.where(place < lengths[which], flat[np.minimum(place + begins[which], len(flat) - 1)], _NOTHING)
        scores = tagger.scores(x)
        tags = best_tags(scores, tagger.weights["trans"])
        hit = np.flatnonzero(tags.any(axis=0))
        if not len(hit):
            continue
        share = posteriors(scores[:, :, hit].astype(np.float64), tagger.weights["trans"].astype(np.float64))[0]
        for k, w in enumerate(hit.tolist()):
            t, s = int(which[w]), int(at[w])
            for i, j, tag in _runs(tags[:, w]):
                end = min(s + j, int(lengths[t]))
                if s + i < end:
                    score = float(share[i : end - s, tag, k].mean())
                    out.setdefault(t, []).append((s + i, end, KINDS[tag - 1], score, i == 0 and s > 0, j == WINDOW and end < lengths[t]))
    return out


def reconciled(candidates: list[tuple[int, int, str, float, bool, bool]], text: str, fixed: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
    """The method's spans of a whole text. Pieces of one kind that overlap where an edge
    cut one of them are joined. What overlaps a ``fixed`` span, fails its check or is
    unlikely goes; of the rest, the disjoint set of greatest total score stays."""
    joined: list[list] = []
    last: dict[str, list] = {}
    for start, end, kind, score, left, right in sorted(candidates):
        open_ = last.get(kind)
        if open_ and start < open_[1] and (left or open_[5]):
            size = open_[1] - open_[0], end - start
            open_[3] = (open_[3] * size[0] + score * size[1]) / sum(size)
            open_[5] = right if end >= open_[1] else open_[5]
            open_[1] = max(open_[1], end)
        else:
            last[kind] = [start, end, kind, score, left, right]
            joined.append(last[kind])
    spans = set()
    for start, end, kind, score, *_ in joined:
        piece = text[start:end]
        start, end = start + len(piece) - len(piece.lstrip()), end - len(piece) + len(piece.rstrip())
        if score >= LIKELY and not _meets(fixed, start, end) and spelled_out(kind, text[start:end]):
            spans.add((end, start, kind, score))
    ordered = sorted(spans)
    ends = [x[0] for x in ordered]
    best = [(0.0, 0, None)]  # total up to each span, and where it came from
    for n, (end, start, kind, score) in enumerate(ordered):
        before = bisect_left(ends, start + 1, 0, n)
        best.append(max((best[n][0], n, None), (best[before][0] + score, before, (start, end, kind, score)), key=lambda x: x[0]))
    out, n = [], len(ordered)
    while n:
        _, n, span = best[n]
        if span:
            out.append(span)
    return out[::-1]


def _spans(texts: list[str], tagger: Tagger | None) -> list[list[dict]]:
    """All spans of each text, in their order."""
    fixed = [base(text)[0] for text in texts]
    found = decoded([symbols(text) for text in texts], tagger) if tagger else {}
    out = []
    for n, text in enumerate(texts):
        spans = [(start, end, kind, 1.0, True) for start, end, kind in fixed[n]]
        if n in found:
            spans += [(*span, False) for span in reconciled(found[n], text, sorted(fixed[n]))]
        spans.sort(key=_place)
        out.append([dict(zip(("start", "end", "kind", "score", "base"), s, strict=True)) for s in spans])
    return out


def find(df: DataFrame, model: DataFrame | None = None) -> DataFrame:
    """``(doc_id, spans)`` for each row of ``(doc_id, text)``; a span has its kind, its
    start and end in code points, its score and whether it is a base span. Spans are in
    the order of their starts, then of their kinds.

    NULL and empty texts have none. Rows are read one by one, so repeated and NULL ids
    are kept as they are; other columns are not read. ``model`` comes from ``train``;
    without one, base spans only are found.
    """
    rows = model.orderBy("name").collect() if model is not None else []  # a few matrices of fixed size
    held = df.sparkSession.sparkContext.broadcast(tuple((r["name"], r["rows"], bytes(r["data"])) for r in rows))
    docs = renamed(df, doc_id="doc_id", text="text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(held.value) if held.value else None
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
        for batch in batches:
            ids, column, first = batch.column("doc_id"), batch.column("text"), 0
            lengths = np.cumsum(pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False))
            for _, same in groupby(range(len(batch)), key=lambda i: int(lengths[i]) // CHARACTERS):
                size = sum(1 for _ in same)
                texts = [text or "" for text in column.slice(first, size).to_pylist()]
                yield pa.RecordBatch.from_arrays([ids.slice(first, size), pa.array(_spans(texts, tagger), kind)], names=["doc_id", "spans"])
                first += size

    return docs.mapInArrow(run, FOUND)


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    base_spans = F.filter("spans", lambda s: s["base"])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter(base_spans, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(told(base_spans), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digest(find(docs, train(docs)))
