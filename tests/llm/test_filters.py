"""URL, toxicity and license filters, and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retail_lake.llm import licenses, toxicity, urls
from tests.conftest import SMALL
from tests.llm.conftest import ROWS, ascii_lower, cluttered
from tests.oracle import actual, connect, expected

URLS = [
    (1, "https://www.Example.com/en/x?y#z"),
    (2, "http://blog.example.com/en/"),
    (3, "http://a.net/es/"),
    (4, "http://a.net/es"),
    (5, "http://net/fr/1"),
    (6, "http://xcom/"),
    (7, "com/en/"),
    (8, None),
    (9, ""),
    (10, "http://"),
    (11, "http://spam-farm.example.org?q=http://x.com/"),
    (12, "ftp://A.B.C.com/p:q//r?"),
    (13, "http://x.net#/es/"),
    (14, "http://x.example.com./en/"),
    (15, "line\nbreak://h\n.com/é\n/x"),
    (15, "line\nbreak://h\n.com/é\n/x"),
    (None, "http://www.example.com/en/" + "long/" * 5000),
    (16, "http://" + "a." * 500_000 + "net/es/x"),
    (17, "http://" + "a." * 500_000 + "spam-farm.example.net"),
    (18, "http://casino-win.example.org." + "b" * 1_000_000),
    (19, "http://..net/es/"),
]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = ascii_lower(re.match(r"(?s)[^/?#]*", rest)[0])
        path = re.match(r"(?s)[^?#]*", rest[len(host):])[0]
    best = None
    for action, rule in urls.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(rule) > len(best[1])):
            best = (action, rule)
    if best:
        return host, path, best[1], best[0]
    blocked = any(host == h or host.endswith("." + h) for h in urls.BLOCKED_HOSTS)
    return host, path, None, "block" if blocked else "allow"


def test_urls_of_the_table(spark):
    with connect(SMALL) as con:
        assert actual(urls.op4_url_cascade(spark, SMALL)) == expected(con, urls.OP4_SQL)


def test_url_edge_cases(spark):
    df = cluttered(spark.createDataFrame(URLS, "page_id bigint, url string"))
    judged = urls.judged(df, "url", urls.RULES, urls.BLOCKED_HOSTS)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judged.collect()), key=str)
    assert got == sorted(((k, *brute_url(u)) for k, u in URLS), key=str)
    assert {r.score for r in judged.collect()} == {"own score"}
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert urls.judged(none, "url", urls.RULES, urls.BLOCKED_HOSTS).count() == 0


def test_deep_hosts_give_no_more_keys_than_a_listed_one_has_labels():
    deep = urls.candidates("a." * 500_000 + "net", "/es/x", [0, 4], 3)
    assert deep == ["a.a.net/es/", "a.net/es/", "a.a.net", "net/es/", "a.net", "net"]


@pytest.mark.parametrize("listed_share", [0.0, 0.02, 0.5, 1.0])
def test_the_cascade_is_exact_over_its_universe(spark, listed_share):
    keys = [f"host{i}.example/path/{i * 7919}" for i in range(20_000)]
    listed = {k for i, k in enumerate(keys) if i < listed_share * len(keys)}
    frame = lambda some: urls.hashed_keys(spark.createDataFrame([(k,) for k in some] + [(None,)], "key string"))
    cascade = urls.build(frame(keys), frame(listed))
    assert cascade.lists(*urls.hashes(keys)).tolist() == [k in listed for k in keys]
    assert sum(level.words.nbytes for level in cascade.levels) <= 64 + 4 * len(listed) + 0.2 * len(keys)


def brute_license(text):
    low = ascii_lower(text)
    words = re.findall(licenses.WORD, low)
    at, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        here = [i for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
        at += here
        base |= {label} if here else set()
    more, best = set(base), 0.0
    for line in low.split("\n"):
        all_ = re.findall(licenses.WORD, line)
        n = licenses.BLOCK_WORDS
        cut = math.ceil((len(all_) - n) / (n // 2)) + 1 if len(all_) > n else 1
        for block in (set(all_[k * n // 2 : k * n // 2 + n]) for k in range(cut)):
            for label, template in licenses.TEMPLATES:
                tokens = set(template.split())
                if len(tokens & block) >= math.ceil(licenses.CONTAINED * len(tokens) - 1e-9):
                    more.add(label)
                    best = max(best, len(tokens & block) / len(tokens))
    ends = (min(at), max(at)) if at else (None, None)
    return (len(words), len(at), *ends, ",".join(sorted(base)), ",".join(sorted(more)), 1.0 if at else best)


LICENSED = [
    (101, "under the mit license under the MIT-License\nApache License, Version 2.0"),
    (102, "License license under\nthe mit license"),
    (103, "CC BY NC " * 3),
    (104, "word " * 200 + "redistribution and use in source and binary forms with or without modification are permitted " + "word " * 100),
    (105, "Licensed under the GNU General Public"),
    (106, "KK under the mİt license éunder the mit license"),
]


def test_licenses_of_the_table_and_edge_cases(spark, docs, no_docs, small_docs):
    edge = docs.select("doc_id", "text").unionByName(spark.createDataFrame(LICENSED, "doc_id bigint, text string"))
    rows = ROWS + LICENSED
    got = sorted(map(tuple, licenses.scan(cluttered(edge)).collect()), key=str)
    assert got == sorted(((k, *brute_license(t)) for k, t in rows), key=str)
    table = {r.doc_id: r.text for r in small_docs.collect()}
    found = {r.doc_id: tuple(r)[1:] for r in licenses.op6_license_scan(spark, SMALL).collect()}
    assert found == {k: brute_license(t) for k, t in table.items()}
    assert licenses.scan(no_docs).count() == 0


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation"
BSD = (
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
    " * Redistribution and use in source and binary forms,\r\n * with or without\r\n *\r\n * modification, are\r\n * permitted",
)
MPL = "# The contents of this file are subject to the terms of the Mozilla Public\n# License"
BROKEN = "Redistribution and use in source and binary\n" + "word " * 80 + "\nforms with or without modification are permitted"


def sliding_license(text):
    """Labels and best share of the windows that begin at each of the text's words."""
    words = re.findall(licenses.WORD, ascii_lower(text))
    labels, best = set(), 0.0
    for at in range(len(words)):
        window = set(words[at : at + licenses.BLOCK_WORDS])
        for label, template in licenses.TEMPLATES:
            tokens = set(template.split())
            if len(tokens & window) >= math.ceil(licenses.CONTAINED * len(tokens) - 1e-9):
                labels.add(label)
                best = max(best, len(tokens & window) / len(tokens))
    return ",".join(sorted(labels)), best


def test_wrapped_license_headers(spark):
    """Wherever a header stands in the text, and wherever its lines break."""
    texts = [MIT, *BSD, MPL, BROKEN]
    texts += ["word " * n + "\n" + header + "\n" + "word\n" * 40 for header in (MIT, *BSD, MPL, BROKEN) for n in (1, 15, 31, 40, 63, 64, 200)]
    texts += ["\n".join(re.findall(licenses.WORD, "x " * n + template)) for _, template in licenses.TEMPLATES for n in (0, 30, 60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(df, phrases={"no such phrase": "none"}).collect()}
    want = [sliding_license(t) for t in texts]
    assert [want[i][0] for i in range(5)] == ["mit", "bsd", "bsd", "mpl-2", ""]
    assert [(got[i].labels, got[i].score) for i in range(len(texts))] == want


def test_long_templates_are_found_in_one_line(spark):
    """Verbatim, wherever the text's windows begin and end; short templates keep theirs."""
    long = {n: " ".join(f"grant{n}x" + "abcdefghij"[i // 10 % 10] + "abcdefghij"[i % 10] + "klm"[i // 100] for i in range(n)) for n in (41, 64, 72, 300)}
    templates = (*((f"long-{n}", t) for n, t in long.items()), ("mit", "released under the mit license"))
    far = "released under the " + "word " * 100 + "mit license"
    texts = [("word " * before + t + " word" * 50, f"long-{n}") for n, t in long.items() for before in (0, 16, 33, 150, 1000)] + [(far, "")]
    df = spark.createDataFrame(list(enumerate(t for t, _ in texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(df, templates=templates).collect()}
    assert [got[i] for i in range(len(texts))] == [(label, 1.0 if label else 0.0) for _, label in texts]


def test_license_scan_is_native(spark):
    plan = licenses.op6_license_scan(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def labelled(spark, n=600):
    """Clean texts, and toxic ones that hold one bad sentence among clean ones."""
    rng = random.Random(4)
    clean = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(50)) for _ in range(8))
    docs, labels = [], []
    for key in range(n):
        sentences = [clean() for _ in range(rng.randrange(1, 30))]
        toxic = key % 5 == 0
        if toxic:
            sentences.insert(rng.randrange(len(sentences) + 1), f"you {rng.choice(['gronk', 'snarf', 'blecch'])} {clean()}")
        docs.append((key, ". ".join(sentences) + "."))
        labels.append((key, 1, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_toxicity_and_located_sentences(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.scored(docs, model, ["doc_id", "text"], spans=True).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held]
    assert len(held) > 100
    assert [r.doc_id for r in held if (r.score >= toxicity.THRESHOLD) != (r.doc_id % 5 == 0)] == []
    for r in rows:
        if r.score >= toxicity.THRESHOLD:
            spans = [r.text.encode()[s.start : s.end].decode() for s in r.offending]
            assert len(spans) == 1 and re.search("gronk|snarf|blecch", spans[0])


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = labelled(spark, 300)
    changed = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [dict(toxicity.scored(docs, toxicity.train(docs, x), ["doc_id"]).collect()) for x in (labels, changed)]
    assert scores[0] == scores[1]


def brute_toxicity(text, weights):
    """Score and offending sentences, sentence by sentence, from the learnt weights."""
    data, clear, offending, start = text.encode(), 1.0, [], 0
    rest = 1 - 1 / (1 + math.exp(-toxicity.BIAS))
    for sentence in re.findall(rb"[^.!?\n]*[.!?\n]|[^.!?\n]+", data):
        words = set(re.findall(rb"[0-9a-z\x80-\xff]+", sentence.lower()))
        known = {k: w for k, w in weights.items() if any(k == word or (k[:1] == b"^" and len(k) > 1 and word.startswith(k[1:])) for word in words)}
        if known:
            own = 1 - (1 - 1 / (1 + math.exp(-toxicity.BIAS - sum(known.values())))) / rest
            clear *= 1 - own
            if own >= toxicity.THRESHOLD:
                offending.append((start, start + len(sentence), own))
        start += len(sentence)
    return 1 - clear, offending


def named_weights(model, texts):
    """The learnt weights by the words, or ``^`` and the beginnings of words, they stand for."""
    words = {w for t in texts for w in re.findall(rb"[0-9a-z\x80-\xff]+", ascii_lower(t or "").encode())}
    names = {w: 0 for w in words} | {b"^" + w[:n]: k for w in words for k, n in enumerate(toxicity.PREFIXES, 1) if len(w) >= n}
    listed = sorted(names)
    key = {}
    for name in listed:
        word, kind = (name, 0) if names[name] == 0 else (name[1:], names[name])
        data = np.frombuffer(word, np.uint8)
        key[int(toxicity.bags(np.array([0, len(data)]), data).keys[0, kind])] = name
    rows = model.collect()
    assert rows and all(r.key % (1 << 64) in key for r in rows)  # a weight without a word would be unknown
    return {key[r.key % (1 << 64)]: r.weight for r in rows}


def close(got, want):
    return len(got) == len(want) and all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, want, strict=True))


def test_the_toxicity_query_against_brute_force(spark, small_docs):
    """Scores, verdicts and spans of every row of the table, recomputed word by word."""
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    model = toxicity.train(small_docs.select("doc_id", "text"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    weights = named_weights(model, texts.values())
    rows = toxicity.op5_toxicity(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        score, offending = brute_toxicity(texts[r.doc_id] or "", weights)
        assert abs(r.score - score) < 1e-9 and r.predicted == int(r.score >= toxicity.THRESHOLD)
        assert close(r.offending, offending) and r.n_offending == len(offending)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert any(r.offending for r in rows)


def test_long_texts_score_as_their_sentences_do_wherever_they_are_cut(spark, monkeypatch):
    docs, labels = labelled(spark, 300)
    model = toxicity.train(docs, labels)
    bad = "you gronk and snarf, you " + "filler " * 50
    texts = [bad * n + ". alpha beta.\n\n" + bad + "!" + "\n" * 90 + "tail " * 30 for n in (1, 3)] + ["x" * 500, "." * 500, "alpha", bad + "é" * 300]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    whole = {r.doc_id: r for r in toxicity.scored(df, model, ["doc_id"], spans=True).collect()}
    keys = np.array([r.key for r in model.orderBy("key").collect()], np.int64).view(np.uint64)
    order = np.argsort(keys)
    weights = np.array([r.weight for r in model.orderBy("key").collect()])[order]
    for most in (16, 64, 100, 333):
        column, got = pa.array(texts), {}
        for part in toxicity.judged(column, toxicity.Model(keys[order], weights), most):
            for n in range(part.first, part.last):
                spans = part.offending.slice(n - part.first, 1)[0].as_py()
                got[n] = (part.score[n - part.first], [tuple(s.values()) for s in spans])
        for n in range(len(texts)):
            assert abs(got[n][0] - whole[n].score) < 1e-9
            assert close(got[n][1], whole[n].offending), (most, n)


def test_the_sample_is_bounded_whatever_ids_repeat(spark):
    docs, labels = labelled(spark, 60)
    often = docs.unionByName(docs.where("doc_id = 0 or doc_id = 2").crossJoin(spark.range(500)).select("doc_id", F.concat("text", F.col("id").cast("string")).alias("text")))
    assert toxicity.sample(often, labels, 5, 10).count() == 15


def test_toxicity_edge_cases(spark, docs, no_docs):
    _, labels = labelled(spark, 30)
    nothing = labels.where("false")
    odd = spark.createDataFrame([(None, 1, 1), (7, None, None), (9, 1, 5), (12, 0, 1), (12, 0, 0), (999, 1, 1)], labels.schema)
    for known in (nothing, odd):
        model = toxicity.train(docs.select("doc_id", "text"), known)
        rows = toxicity.scored(docs, model, ["doc_id", "kept"], spans=True).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert toxicity.accepted(docs, nothing).columns == docs.columns
    assert toxicity.accepted(docs, nothing).count() == len(ROWS)
    assert toxicity.accepted(no_docs, labels).count() == 0


def test_the_pipeline_does_what_its_stages_do(spark, small_docs):
    """Each stage against its plain meaning on what the stage before kept."""
    from tests.llm.test_dedup import brute_exact, brute_near
    from tests.llm.test_tokens import check_packing

    docs, columns = small_docs, small_docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns
        assert all(before[k] == r for k, r in after.items())
        texts = [(k, r.text) for k, r in before.items()]
        if name == "exact_dedup":
            assert set(after) == {k for k, _, _, kept, _ in brute_exact(texts) if kept}
        if name == "near_dedup":
            assert set(after) == {k for k, (_, _, kept) in brute_near(texts).items() if kept}
        if name == "toxicity":
            scores = dict(toxicity.scored(small_docs, toxicity.train(small_docs, spark.read.parquet(f"{SMALL}/labels.parquet")), ["doc_id"]).collect())
            assert set(after) == {k for k, score in scores.items() if score < toxicity.THRESHOLD}
    name, stage = corpus_pipeline.STAGES[-1]
    kept = {r.doc_id: r.text for r in docs.collect()}
    check_packing(stage(spark, docs, SMALL).collect(), kept)
    check_packing(corpus_pipeline.run(spark, SMALL).collect(), kept)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "packing"]


def test_the_pipeline_takes_edge_cases(spark, docs, no_docs):
    for start in (docs, no_docs):
        kept = start
        for name, stage in corpus_pipeline.STAGES:
            kept = corpus_pipeline.stored(stage(spark, kept, SMALL), name)
        assert (kept.count() > 0) == (start is docs)
