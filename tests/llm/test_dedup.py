"""Exact and near duplicates against brute force over all pairs."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_lake.llm import embeddings, exact, minhash
from retail_lake.llm.components import components
from retail_lake.llm.registry import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.llm.conftest import ROWS, ascii_lower, cluttered, sentence
from tests.oracle import actual, connect, expected


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_near(rows):
    sets = {key: shingles(text) for key, text in rows}
    groups = Union(sets)
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                groups.join(a, b)
    return {k: (len(sets[k]), groups.find(k), groups.find(k) == k) for k in keys}


def near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}


def test_near_duplicates_of_all_documents(spark, small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert near(small_docs) == brute_near(rows)


@pytest.mark.parametrize("name", ["op2_minhash_near_duplicates", "op3_embedding_near_duplicates"])
def test_queries_match_their_sql(spark, name):
    with connect(SMALL) as con:
        assert actual(QUERIES[name](spark, SMALL)) == expected(con, ORACLES[name])


def test_near_duplicate_edge_cases(docs):
    """Repeated and NULL ids besides; a class with an id is named by it."""
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    unique = [(k, t) for k, t in dict(ROWS).items() if k is not None]
    expected = brute_near(unique)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == expected[r.doc_id]
    lost = sorted((r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is None and r.n_shingles != 21)
    assert lost == [(0, None, True), (4, None, True)]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None and r.n_shingles == 21] == [(17, False)]
    kept = minhash.survivors(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 5").count() == 0 and kept.where("doc_id = 4").count() == 1


def test_no_documents(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.survivors(no_docs).count() == 0
    assert exact.exact_duplicates(no_docs, ["doc_id"]).count() == 0
    assert exact.survivors(no_docs).columns == no_docs.columns


def test_links_beside_the_star_are_found(spark):
    """A group whose members mostly fail against its least document: chains, and
    documents near the threshold that link with some members only."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for key in range(120):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**9)}"
        rows.append((key, " ".join(words)))
    chain = list(base)
    for key in range(200, 230):
        chain[(key * 7) % 150] = f"chain{key}"
        rows.append((key, " ".join(chain)))
    rng.shuffle(rows)
    assert near(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute_near(rows)


def test_parity_bitmaps_never_reject_similar_sets():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for size in (3, 50, 1000, 3500):
        a, b = np.sort(rng.choice(pool, size, replace=False)), np.sort(rng.choice(pool, size, replace=False))
        bounds = np.array([0, len(a), len(a) + len(b)])
        x, y = minhash.parities(bounds, np.concatenate([a, b]))
        differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i + 1, i) for i in range(60)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (7, 7)] + [(9, 10), (10, 9)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {i: 0 for i in range(61)} | {1000: 1000} | {k: 1000 for k in range(1001, 1400)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_exact_duplicates_match_sql(spark):
    with connect(SMALL) as con:
        assert actual(exact.op8_exact_duplicates(spark, SMALL)) == expected(con, exact.OP8_SQL)


def brute_exact(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(ascii_lower(text), []).append(key)
    out = []
    for key, text in rows:
        same = groups[ascii_lower(text)]
        keep = max((k for k in same if k is not None), default=None)
        out.append((key, keep, len(same), key == keep, hashlib.sha256(ascii_lower(text).encode()).hexdigest()))
    return sorted(out, key=str)


def weak(content):
    """A digest that stands for several contents."""
    return bytes([len(content) % 3])


@pytest.mark.parametrize("digest", [exact.sha256, weak])
def test_exact_edge_cases_compare_contents(docs, digest):
    found = exact.exact_duplicates(docs, ["doc_id", "text"], digest).collect()
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, hashlib.sha256(ascii_lower(r.text).encode()).hexdigest()) for r in found]
    assert sorted(got, key=str) == brute_exact(ROWS)


def test_survivors_keep_their_columns(docs):
    kept = exact.survivors(docs.where("doc_id != 17"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [2, 3, 6, *range(8, 17)]
    assert kept.where("doc_id in (1, 4, 5, 7)").count() == 0
    assert {r.score for r in kept.select("score").collect()} == {"own score"}


def brute_vectors(rows, least=0.95):
    units = {}
    for key, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            units[key] = np.asarray(v, float) / np.linalg.norm(np.asarray(v, float))
    groups, links = Union([k for k, _ in rows]), {k: 0 for k, _ in rows}
    keys = list(units)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(units[a]) == len(units[b]) and units[a] @ units[b] >= least:
                groups.join(a, b)
                links[a] += 1
                links[b] += 1
    return {k: (links[k], groups.find(k), groups.find(k) == k) for k, _ in rows}


def vectors(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}


def test_vectors_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.op3_embedding_near_duplicates(spark, SMALL).collect()}
    assert found == brute_vectors(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vector_recall_in_dense_and_loose_groups(spark, kind, monkeypatch):
    """A tight group over several blocks, a loose one around the threshold, copies, a
    scaled copy, and vectors that link with nothing."""
    monkeypatch.setattr(embeddings, "MEMBERS", 40)
    monkeypatch.setattr(embeddings, "QUERIES", 40)
    monkeypatch.setattr(embeddings, "CELL", 8)
    rng = np.random.default_rng(5)
    center, loose = rng.normal(size=16), rng.normal(size=16)
    rows = [center + 0.05 * rng.normal(size=16) for _ in range(150)]
    rows += [loose + 0.22 * rng.normal(size=16) for _ in range(150)]
    rows += [rng.normal(size=16) for _ in range(300)]
    rows = [np.asarray(v, np.float32).tolist() for v in rows]
    rows += [rows[7], rows[7], (np.asarray(rows[400]) * 4).tolist()]
    rows += [None, [], [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [1.0] * 15 + [float("inf")], [1.0, 2.0]]
    rows = list(enumerate(rows))
    df = cluttered(spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>"))
    found, want = vectors(df), brute_vectors(rows)
    links = sum(n for n, _, _ in want.values())
    assert sum(n for n, _, _ in found.values()) >= 0.99 * links
    assert all(found[k][0] <= want[k][0] for k in want)
    assert all(found[k] == want[k] for k, v in rows if want[k][0] == 0 or k < 150)


@pytest.mark.parametrize("few, cell, block", [(1, 1, 2), (30, 8, 10), (64, 1024, 1024)])
def test_vectors_of_each_length_link_among_themselves(spark, monkeypatch, few, cell, block):
    """Lengths of many vectors and of few, one of a single component, with many cells a
    length and with one."""
    for name, value in (("FEW", few), ("CELL", cell), ("MEMBERS", block), ("QUERIES", 2 * block)):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(6)
    rows = []
    for size, n in ((8, 40), (16, 60), (24, 4)):
        center = rng.normal(size=size)
        rows += [center + 0.02 * rng.normal(size=size) for _ in range(n // 2)] + [rng.normal(size=size) for _ in range(n // 2)]
        rows += [rows[-n]]
    rows = [np.asarray(v, np.float32).tolist() for v in rows] + [[2.0], [3.0], [-1.0], [], None]
    rows = list(enumerate(rows))
    want: dict = {}
    for size in {len(v or []) for _, v in rows}:
        want |= brute_vectors([(k, v) for k, v in rows if len(v or []) == size])
    assert want[0][0] == 20 and want[102][0] == 2 and want[107][0] == 1
    assert vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")) == want


def test_small_tables_go_through_the_grid(spark, monkeypatch):
    """The query's own table is searched cell by cell: it has several, and vectors in most."""
    made, whole = [], embeddings.grids
    monkeypatch.setattr(embeddings, "grids", lambda *a: made.append(whole(*a)) or made[-1])
    embeddings.op3_embedding_near_duplicates(spark, SMALL).count()
    (grid,) = made[0].values()
    assert len(grid.first) > 1 and len(grid.second) > 1


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embeddings.near_duplicates(empty).count() == 0
    nothing = spark.createDataFrame([(1, None), (None, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, embeddings.near_duplicates(nothing).collect()), key=str) == [
        (1, 0, 1, True), (None, 1, None, True), (None, 1, None, True)
    ]


def test_multi_sequence_visits_in_order():
    first, second = np.array([0.3, 0.0, 0.1]), np.array([0.0, 0.25])
    found = embeddings.multi_sequence(first, second, 0.3)
    sums = [first[i] + second[j] for i, j in found]
    assert sums == sorted(sums) and len(found) == sum(a + b <= 0.3 for a in first for b in second)


def test_pairs_of_unlike_members_are_met_once_and_links_among_them_found(spark):
    """Documents of one family, most of them unlike each other: none of the links that
    brute force finds between components is lost."""
    rng = np.random.default_rng(8)
    root = [f"w{i}" for i in range(240)]
    rows = []
    for n in range(160):
        words = list(root)
        for at in rng.choice(240, 14, replace=False):  # about 0.55 alike
            words[at] = f"x{n}.{at}"
        rows.append((n, " ".join(words)))
        if n % 4 == 0:
            words[int(rng.integers(240))] = "changed"
            rows.append((1000 + n, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(236)} for d, t in rows}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert len(linked) >= 40
    assert sum(got[a] == got[b] for a, b in linked) >= 0.99 * len(linked)
    by_component = {}
    for d, c in got.items():
        by_component.setdefault(c, []).append(d)
    for members in by_component.values():  # nothing unlike is joined
        assert len(members) == 1 or all(any((min(m, o), max(m, o)) in set(linked) for o in members if o != m) for m in members)
