import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_lake.llm import personal
from retail_lake.llm.personal import KINDS, base, decoded, digest, find, learn, reconciled, symbols, windows
from retail_lake.llm.tagger import Tagger, best_tags, posteriors
from tests.conftest import SMALL
from tests.llm.conftest import ROWS, cluttered

PATTERNS = dict(zip(KINDS, (personal.EMAIL, personal.IP, personal.CARD, personal.PHONE), strict=True))


def plain_check(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        doubled = [int(d) if n % 2 == 0 else sum(divmod(2 * int(d), 10)) for n, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if plain_check(k, m.group())]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


SAMPLES = [
    "mail a.b+c@x-y.example.com, a@b@c.de and @b.c@d.e x@y",
    "1.2.3.4.5.6.7.8.9 and 256.1.1.1 or 010.000.0255.1 then 1..2.3.4",
    "card 4532 0151 1283 0366 or 4532015112830366, not 4532015112830367; 4532015112830366 12",
    "+1 (377) 555-0271 +49 (0) 30 123456 - +12 + 1234567890 +1234567890123456",
    "é漢字 4532-0151-1283-0366 漢@b.cd é+1 222 333 4444",
]


def test_base_spans_equal_the_plain_patterns():
    rng = np.random.default_rng(4)
    alphabet = list("0123456789" * 2 + "..@@ab-+ ()%é")
    texts = SAMPLES + ["".join(rng.choice(alphabet, int(n))) for n in rng.integers(0, 60, 3000)]
    for text in texts:
        assert base(text)[0] == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 500_000, "1" * 500_000, "1." * 250_000, "+1" + " " * 500_000, "a@" * 250_000):
        base(text)


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def test_the_digest_of_every_row(spark):
    rows = ROWS + [(200 + n, text) for n, text in enumerate(SAMPLES)]
    df = cluttered(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    got = sorted(str(list(r)) for r in digest(find(df)).collect())
    expected = []
    for doc_id, text in rows:
        spans = plain(text)
        counts = [sum(k == kind for *_, k in spans) for kind in KINDS]
        expected.append(str([doc_id, *counts, hashlib.sha256(told(spans).encode()).hexdigest(), told(spans)]))
    assert got == sorted(expected)
    assert digest(find(df.limit(0))).collect() == []


# -- the tagger ------------------------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(0)
    tagger = Tagger.fresh(7, 3, 1, 4)
    x, y = rng.integers(0, 7, (6, 5)).astype(np.uint8), rng.integers(0, 3, (6, 5))
    _, slope = tagger.loss(x, y)
    for name, w in tagger.weights.items():
        for _ in range(5):
            i = tuple(rng.integers(0, n) for n in w.shape)
            w[i] += 1e-5
            above = tagger.loss(x, y)[0]
            w[i] -= 2e-5
            below = tagger.loss(x, y)[0]
            w[i] += 1e-5
            assert (above - below) / 2e-5 == pytest.approx(slope[name][i], abs=1e-6)


def test_decoding_and_posteriors_equal_enumeration():
    rng = np.random.default_rng(1)
    scores, trans = rng.normal(0, 2, (5, 3, 4)), rng.normal(0, 1, (3, 3))
    share, _, whole = posteriors(scores, trans)
    best = best_tags(scores, trans)
    for w in range(4):
        total, sums = {}, np.zeros((5, 3))
        for path in itertools.product(range(3), repeat=5):
            total[path] = sum(scores[t, k, w] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in itertools.pairwise(path))
            for t, k in enumerate(path):
                sums[t, k] += np.exp(total[path])
        assert whole[w] == pytest.approx(np.log(sums[0].sum()))
        assert np.allclose(share[:, :, w], sums / sums[0].sum())
        assert tuple(best[:, w]) == max(total, key=total.get)


def test_windows_cover_texts_and_overlap():
    lengths = np.array([0, 1, 47, 48, 49, 256, 257, 464, 465, 5000])
    text, start = windows(lengths)
    for n, size in enumerate(lengths.tolist()):
        own = start[text == n]
        covered = np.zeros(size, int)
        for s in own:
            assert s < size
            covered[s : s + personal.WINDOW] += 1
        assert (covered > 0).all()
        assert (np.diff(own) == personal.WINDOW - personal.OVERLAP).all()


@pytest.fixture(scope="module")
def learnt():
    """A tagger and held-out base spans of other texts."""
    rng = np.random.default_rng(2)
    fill = lambda n: " ".join("".join(rng.choice(list("aeiounrstdh"), int(k))) for k in rng.integers(2, 8, n))

    def spans():
        n = lambda k: "".join(rng.choice(list("0123456789"), k))
        body = n(15)
        card = body + next(d for d in "0123456789" if personal.luhn(body + d))
        yield "email", f"{fill(1)}.{n(2)}@mail{n(1)}.example.com"
        yield "ip", ".".join(str(x) for x in rng.integers(0, 256, 4))
        yield "card", card
        yield "phone", f"+1 ({n(3)}) {n(3)}-{n(4)}"

    def pieces(count):
        for _ in range(count):
            for kind, middle in spans():
                yield kind, fill(4) + " ", middle, " " + fill(4)
            yield "", "", fill(12), ""
            yield "", "", f'{fill(4)} token = "{"".join(rng.choice(list("0123456789abcdef"), 40))}" {fill(3)}', ""

    tagger = learn(list(pieces(120)), steps=200)
    return tagger.single(), list(pieces(20)), fill


def method_spans(text, tagger):
    return reconciled(decoded([symbols(text)], tagger).get(0, []), text, base(text)[0])


def test_it_finds_what_the_patterns_miss(learnt):
    tagger, pieces, _ = learnt
    rng, hits, asked = np.random.default_rng(9), 0, 0
    for kind, before, middle, after in (p for p in pieces if p[0]):
        spelled = personal.varied(kind, middle, rng)
        text = before + spelled + after
        if not base(text)[0] and personal.spelled_out(kind, spelled):
            asked += 1
            hits += any(s[:3] == (len(before), len(before) + len(spelled), kind) for s in method_spans(text, tagger))
    assert asked >= 40
    assert hits >= 0.75 * asked


def test_it_leaves_clean_text_alone(learnt):
    tagger, pieces, fill = learnt
    texts = [p[2] for p in pieces if not p[0]] + [fill(400), "at dot (at) [dot] 12.5 % of 3,000 on 2024-01-02 at 10:30"]
    assert [method_spans(text, tagger) for text in texts] == [[] for _ in texts]


def test_spans_at_every_place_of_the_windows(learnt):
    tagger, _, fill = learnt
    spelled, lost = "ner.12 (at) mail3 (dot) example (dot) com", 0
    for shift in range(0, 420, 7):
        before = (fill(120) + " ")[-(shift + 1) :]
        text = before + spelled + " " + fill(120)
        lost += (len(before), len(before) + len(spelled), "email") not in [s[:3] for s in method_spans(text, tagger)]
    assert lost <= 6


def test_pieces_cut_by_an_edge_are_joined():
    text = "x" * 30 + "a" * 30 + "(at)b.de" + "y" * 30
    cut = [(30, 50, "email", 0.9, False, True), (45, 68, "email", 0.8, True, False)]
    assert [s[:3] for s in reconciled(cut, text, [])] == [(30, 68, "email")]
    assert reconciled(cut, text, [(60, 61, "ip")]) == []
    assert reconciled([(30, 50, "email", 0.9, False, True)], text, []) == []  # half an address is none


def test_overlapping_spans_keep_the_greatest_total():
    text = "377-555-0271 614-555-8001"
    whole, one, two = (0, 25, "card", 0.9, False, False), (0, 12, "phone", 0.6, False, False), (13, 25, "phone", 0.6, False, False)
    assert [s[:3] for s in reconciled([whole, one, two], text, [])] == [(0, 12, "phone"), (13, 25, "phone")]
    worse = (5, 25, "phone", 0.9, False, False)
    assert [s[:3] for s in reconciled([one, worse, two], text, [])] == [(0, 12, "phone"), (13, 25, "phone")]


def test_the_query_keeps_base_spans_and_adds_its_own(spark):
    fill = "the wooden house stood near the old river and nobody came "
    rows = [(n, f"{fill[n % 9:]}user{n}@mail{n % 7}.example.com {fill}+1 ({100 + n}) 555-{1000 + 7 * n} {fill[: n % 50]}10.{n % 256}.3.4 end") for n in range(120)]
    rows += [(1000 + n, f"{fill * n}{fill[n:]}({212 + 31 * n}) 555-{3141 + 577 * n} {fill * 8}") for n in range(6)]
    rows += [(1101, fill * 30), (1102, None), (1102, None)]
    docs = cluttered(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    model = personal.train(docs)
    got = {r["doc_id"]: r["spans"] for r in find(docs, model).collect()}
    for doc_id, text in rows:
        assert [(s["start"], s["end"], s["kind"]) for s in got[doc_id] if s["base"]] == plain(text)
    added = [text[s["start"] : s["end"]] for doc_id, text in rows for s in got[doc_id] if not s["base"]]
    assert set(added) <= {f"({212 + 31 * n}) 555-{3141 + 577 * n}" for n in range(6)}
    assert len(added) >= 4
    assert got[1101] == got[1102] == []


def test_without_personal_data_there_is_no_model(spark):
    docs = cluttered(spark.createDataFrame([(1, "nothing here"), (2, None), (3, "1 2 3")], "doc_id bigint, text string"))
    model = personal.train(docs, steps=5)
    assert model.count() == 0
    assert [r["spans"] for r in find(docs, model).collect()] == [[], [], []]
    assert personal.train(docs.where(F.lit(False)), steps=5).count() == 0


def test_the_registered_query_on_every_document(spark, small_docs):
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    rows = personal.op12_personal_data(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]])
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(k == kind for *_, k in spans) for kind in KINDS]
        assert r["base_sha256"] == hashlib.sha256(told(spans).encode()).hexdigest()
        assert set(told(spans).split(",")) <= set(r["spans"].split(","))
        for kind, start, end in (x.split(":") for x in r["spans"].split(",") if x):
            own = (int(start), int(end), kind)
            assert own in spans or personal.spelled_out(kind, texts[r["doc_id"]][own[0] : own[1]])
