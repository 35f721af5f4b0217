"""Ranked search against scoring every document."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from demandloom.llm import lexical
from demandloom.llm.common import prepare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, best=50):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for d, c, size in counted:
            m = 100 - 50 + (50 * size * n) // total
            s = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0))
        for rank, (s, none, d) in enumerate(sorted(found)[:best], 1):
            out[(item, rank, None if none else d, -s)] += 1
    return out


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(map(tuple, df.collect()))


WORDS = [f"w{k}" for k in range(300)]


@pytest.mark.parametrize("chunk,block,short,part", [(64, 4, 2, 1 << 16), (1024, 128, 64, 40)])
def test_skewed_documents(spark, chunk, block, short, part):
    """Frequent and rare words, copies, near copies and ties, in many and in few blocks, queries in one and in many parts."""
    prepare(spark)
    rng = random.Random(3)
    draw = lambda n: " ".join(WORDS[min(299, int(rng.paretovariate(0.5)) - 1)] for _ in range(n))
    docs = [(k, draw(rng.choice([1, 5, 40, 200]))) for k in range(500)]
    docs += [(1000 + k, docs[7][1]) for k in range(150)] + [(2000 + k, docs[8][1] + f" w{k}") for k in range(100)]
    items = [(k, draw(12)) for k in range(25)] + [(90, docs[7][1]), (91, "w0"), (92, "unseen"), (93, "w250 w299")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(lexical.search(df, bench, chunk=chunk, block=block, short=short, part_terms=part)) == brute(docs, items)


def test_odd_rows(spark):
    """Nulls everywhere, empty and long texts, repeated ids, other scripts, signs, clashing columns."""
    prepare(spark)
    docs = [(1, None), (2, ""), (3, " .,;\n"), (None, "Alpha beta"), (4, "ALPHA-beta ß Ä"), (4, "alpha"), (5, "alpha " * 60_000), (6, "ÄÄ ä 日本 gamma"), (6, "ÄÄ ä 日本 gamma")]
    items = [(None, "alpha, BETA"), (7, "Ä 日本"), (7, "ä gamma"), (8, None), (9, "--"), (None, "alpha, BETA")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS uid", "'x' AS terms", "2 AS item", "3 AS n", "4 AS rank")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS doc_id")
    assert result(lexical.search(df, bench)) == brute(docs, items)
    assert lexical.search(df.limit(0), bench).count() == 0 == lexical.search(df, bench.limit(0)).count()
    assert lexical.search(df.where("doc_id < 4"), bench).count() == 0


def test_summaries_bound_every_member():
    rng = np.random.default_rng(1)
    weights = lexical.Weights(300, 9000, rng.integers(0, 5000, 80))
    rows = [(k, np.sort(rng.choice(80, 12, replace=False)), rng.integers(1, 10**6, 12)) for k in range(300)]
    found = lexical.index_chunk(rows, weights, lexical.directions(80), 16, 30)
    tops = lexical.dense(found["top_starts"], found["top_terms"], found["tops"], 80)
    x = lexical.dense(found["starts"], found["terms"], found["parts"], 80)
    ends = np.append(found["block_starts"][1:], len(found["members"]))
    listed = Counter()
    for b, (start, end) in enumerate(zip(found["block_starts"], ends)):
        own = found["members"][start:end]
        long = (x[:, found["block_terms"][b]] > 0).sum() > 30
        assert long == found["block_long"][b] and (tops[b] == x[own].max(axis=0) * long).all() and (x[own, found["block_terms"][b]] > 0).all()
        listed.update((int(found["block_terms"][b]), int(d)) for d in own)
    assert listed == Counter((int(t), k) for k, (_, own, _) in enumerate(rows) for t in own)
