"""Decontamination: word subsequences, candidate recall and leaks against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import decontamination as d
from demandloom.llm.common import prepare, stage
from demandloom.llm.queries import QUERIES


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=70), st.lists(st.integers(0, 5), max_size=70))
def test_common_subsequence(a, b):
    assert d.common_subsequence(a, b) == brute_lcs(a, b)


def brute_leaks(docs, items):
    """Every item against every place of every document, by word subsequences alone."""
    out = set()
    for doc, text in docs:
        ids = d.word_hashes(text)
        for item, words in items.items():
            shared = np.isin(ids, np.array(words, np.uint32)).sum()
            if shared >= 0.4 * len(words):
                for a, b in d.passages(len(ids)):
                    if d.leaked(*d.checked(words, ids, a, b, d.RULES), d.RULES):
                        out.add((doc, item))
                        break
    return out


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = {r.item_id: d.word_hashes(r.text).tolist() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = brute_leaks(docs, items)
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_latent_decontamination"](spark, sf_dir).collect()}
    assert want and got <= want and len(got) >= 0.9 * len(want)
    texts = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    assert {(i, k) for i, t in docs for k, x in texts.items() if x in t} <= got


def test_candidate_recall_against_exact_cosines(spark, sf_dir):
    """Latent candidates against exact TF-IDF cosines of all passages with all of the benchmark's."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marked = stage(d.hashed(docs.select("doc_id", "text"), "ids"), "test")
    (index,) = d.indexes(marked, "ids", spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    owned = [np.array(w[a:b], np.uint32) for _, w in sorted(index.items.items()) for a, b in d.passages(len(w))]
    found = total = 0
    for r in marked.collect():
        ids = np.frombuffer(r.ids, np.uint32)
        weight = index.idf[ids & np.uint32(d.BUCKETS - 1)]
        for a, b in d.passages(len(ids)):
            part = Counter(ids[a:b].tolist())
            w = dict(zip(ids[a:b].tolist(), weight[a:b].tolist()))
            norm = d.length(ids[a:b], weight[a:b])
            latent = []
            for space in index.spaces:
                at, columns = d.known(ids[a:b], space.vocabulary)
                latent += (space.latent @ (weight[a:b][at] @ space.axes[columns]) / norm if len(at) else np.zeros(len(space.items))).tolist()
            for q, words in enumerate(owned):
                own = Counter(words.tolist())
                dot = sum(n * part[x] * w[x] ** 2 for x, n in own.items() if x in part)
                if dot:
                    size = d.length(words, index.idf[words & np.uint32(d.BUCKETS - 1)])
                    if dot / norm / size >= 0.4:
                        total += 1
                        found += latent[q] >= d.RULES.cosine
    assert total >= 10 and found >= 0.9 * total


def test_the_space_is_fitted_on_every_passage(spark, monkeypatch):
    """Axes of the index against the same iterations over all passages in one matrix; a bounded sample gave others."""
    prepare(spark)
    monkeypatch.setattr(d, "FIT_PASSAGES", 8, raising=False)  # the bound that once was
    monkeypatch.setattr(d, "FIT_WORDS", 50, raising=False)
    monkeypatch.setattr(d, "QUERIES", 4)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randint(0, 90)) if i % 9 else None) for i in range(120)]
    bench = spark.createDataFrame([(i, text(40)) for i in range(4)], "item_id long, text string")
    marked = stage(d.hashed(spark.createDataFrame(docs, "doc_id long, text string"), "ids").repartition(5), "test")
    (index,) = d.indexes(marked, "ids", bench)
    assert len(index.spaces) > 2
    blocks = [(s.vocabulary, []) for s in index.spaces]
    owned = [np.array(w[a:b], np.uint32) for _, w in sorted(index.items.items()) for a, b in d.passages(len(w))]
    blocks = [(v, owned[4 * k:4 * k + 4]) for k, (v, _) in enumerate(blocks)]
    start = np.random.default_rng(7)
    for space, (vocabulary, queries) in zip(index.spaces, blocks):
        dense = []
        for rows in ([d.word_hashes(t) for _, t in docs], queries):
            m = d.sparse_passages(rows, vocabulary, index.idf)
            ends = np.append(m.starts, len(m.columns))
            dense.append(np.array([np.bincount(m.columns[a:b], m.values[a:b], len(vocabulary)) for a, b in zip(ends, ends[1:])]))
        corpus, own = dense
        axes = np.linalg.qr(start.standard_normal((len(vocabulary), min(d.RANK, len(vocabulary), len(own) + 32))))[0]
        for _ in range(2):
            far, mine = corpus.T @ (corpus @ axes), own.T @ (own @ axes)
            axes = np.linalg.qr(mine + 0.1 * np.linalg.norm(mine) / np.linalg.norm(far) * far)[0]
        assert np.allclose(space.axes @ space.axes.T, axes @ axes.T, atol=2e-3)


def planted(rng, words, item):
    """Paraphrases: some words replaced, dropped or added, the ending kept."""
    out = []
    for k, w in enumerate(item):
        r = rng.random() if k < len(item) - 8 else 1
        if r < 0.12:
            out.append(rng.choice(words))
        elif r > 0.2 or r < 0.16:
            out.append(w)
        if rng.random() < 0.05:
            out.append(rng.choice(words))
    return out


def test_planted_paraphrases(spark):
    prepare(spark)
    rng = random.Random(4)
    words = ["".join(rng.choice(["an", "er", "ti", "ou", "sh", "le", "mo"]) for _ in range(rng.randint(2, 5))) for _ in range(3000)]
    common = ["the", "of", "and", "in", "to", "a"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(n)]
    items = {i: text(rng.choice([14, 30, 60, 150])) for i in range(30)}
    docs, want = [], set()
    for doc in range(240):
        body = text(rng.randint(5, 600))
        if doc % 4 == 0:
            item = rng.randrange(30)
            at = rng.randint(0, len(body))
            put = items[item] if doc % 8 else planted(rng, words, items[item])
            body[at:at] = [w.title() + rng.choice(["", ",", "."]) for w in put]
            want.add((doc, item))
        docs.append((doc, " ".join(body)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    for size in (700, d.ITEM_WORDS):
        got = {(r.doc_id, r.item_id) for r in d.leaks(df, bench, item_words=size).collect()}
        assert len(got & want) >= 0.98 * len(want) and not got - want
    kept = {r.doc_id for r in d.without_leaks(df, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in got}


def test_odd_rows(spark):
    prepare(spark)
    item = "what is the capital of the far northern province of uldania answer the city of merrow"
    rows = [(1, None), (2, ""), (3, "!!! ..."), (None, f"x {item} y"), (4, item.upper()), (4, item.upper()), (5, "w " * 60000 + item),
            (6, "something else")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS _ids", "map(1, 2) AS item_id")
    bench = spark.createDataFrame([(9, item), (8, None), (7, ""), (None, item)], "item_id long, text string").selectExpr("*", "1 AS ids")
    got = Counter((r.doc_id, r.item_id) for r in d.leaks(df, bench).collect())
    assert got == Counter([(doc, item) for doc in (None, 4, 4, 5) for item in (9, None)])
    clean = d.without_leaks(df, bench)
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 6]
    for a, b in ((df.limit(0), bench), (df, bench.limit(0)), (df.limit(0), bench.limit(0))):
        assert d.leaks(a, b).count() == 0 and d.without_leaks(a, b).count() == a.count()


def test_null_and_repeated_item_ids_are_searched(spark):
    """Each benchmark row counts: a null id, and two texts under one id."""
    prepare(spark)
    texts = [" ".join(f"{p}{k}x" for k in range(30)) for p in ("one", "two", "three")]
    bench = spark.createDataFrame(list(zip([None, 7, 7], texts)), "item_id long, text string")
    filler = " ".join(f"f{k}" for k in range(40))
    docs = spark.createDataFrame([(k, f"{filler} {t} {filler}") for k, t in enumerate(texts)] + [(9, filler)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.leaks(docs, bench).collect()}
    assert found == {(0, None), (1, 7), (2, 7)}
    assert [r.doc_id for r in d.without_leaks(docs, bench).collect()] == [9]


def test_all_parts_of_the_benchmark_take_one_python_worker(spark):
    """A second function over the same rows is a second worker beside the first, with memory of its own."""
    prepare(spark)
    texts = [" ".join(f"{p}{k}x" for k in range(30)) for p in ("one", "two", "three")]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([texts[2], "something else", texts[0], None])], "doc_id long, text string")
    clean = d.without_leaks(docs, bench, item_words=30)
    assert [r.doc_id for r in clean.orderBy("doc_id").collect()] == [1, 3]
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_no_passage_is_above_its_bound(spark, sf_dir):
    """Passages are dropped by what their words add at most; that is never less than a cosine, and few are left."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(300)
    marked = stage(d.hashed(docs.select("text"), "ids"), "test")
    (index,) = d.indexes(marked, "ids", spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    part = d.weigh([np.frombuffer(r.ids, np.uint32) for r in marked.collect()], index.idf)
    hit, column = d.known(part.word, index.vocabulary)
    bound = np.bincount(part.passage[hit], part.weight[hit] * index.most[column], len(part.norm)) / part.norm
    for number, space in enumerate(index.spaces):
        local = index.places[number][column]
        rows, local = hit[local >= 0], local[local >= 0]
        latent = np.zeros((len(part.norm), space.axes.shape[1]))
        np.add.at(latent, part.passage[rows], part.weight[rows, None] * space.axes[local])
        cosines = (latent @ space.latent.T / part.norm[:, None]).max(axis=1)
        assert (cosines <= np.maximum(bound, 0) + 1e-5).all()
    assert 0 < (bound >= d.RULES.cosine).mean() < 0.2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1 << 18), max_size=40), max_size=6))
def test_blocks_hold_each_bucket_once(texts):
    want = [[x % d.BUCKETS for x in t[a:a + d.BLOCK]] for t in texts for a in range(0, len(t), d.BLOCK)]
    got, n = d.block_buckets([np.array(t, np.uint32) for t in texts])
    assert n == len(want) and Counter(got.tolist()) == Counter(x for block in want for x in set(block))
