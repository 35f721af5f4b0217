"""Fingerprints and components against brute force."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from demandloom.llm import simhash
from demandloom.llm.common import prepare
from demandloom.llm.queries import QUERIES

SMALL = {"sample": 64, "shard_rows": 16}


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items):
    """[(doc_id, fingerprint)] -> smallest reachable doc_id of each."""
    n = len(items)
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array([f for _, f in items], np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 3):
            a, b = root(i), root(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [low.get(root(i)) for i in range(n)]


def expected(docs):
    items = [(d, brute_fingerprint(t)) for d, t in docs]
    return Counter((d, f"{f:016x}", c) for (d, f), c in zip(items, brute_components(items)))


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in QUERIES["op9_simhash_components"](spark, sf_dir).collect())
    assert got == expected(docs)


def test_odd_rows(spark):
    prepare(spark)
    docs = [(9, None), (4, ""), (None, "a b"), (7, "A B"), (7, "A B"), (5, "one two three four É"), (6, "ONE two three four É"),
            (8, "w " * 50000), (None, "lonely words here now"), (3, "\x0b\x0c")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS _uid", "3 AS label")
    assert Counter(tuple(r) for r in simhash.components(df, **SMALL).collect()) == expected(docs)
    rows = simhash.representatives(df, **SMALL).collect()
    components = brute_components([(d, brute_fingerprint(t)) for d, t in docs])
    assert len(rows) == 5 and {r.doc_id for r in rows} == set(components)
    assert rows[0].__fields__ == df.columns
    assert simhash.components(df.limit(0)).count() == 0 and simhash.representatives(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_dense_and_chained_fingerprints(spark, seed):
    """Random points, a chain of one-bit steps, and a dense ball larger than a shard."""
    prepare(spark)
    rng = np.random.default_rng(seed)
    values = set(rng.integers(0, 2**64, 300, np.uint64).tolist())
    at = int(rng.integers(0, 2**63))
    for b in rng.permutation(64)[:40].tolist():
        at ^= 1 << b
        values.add(at)
    centre = int(rng.integers(0, 2**63))
    values |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    values = list(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    got = {r.fp: r.label for r in simhash.label(frame, "fp", **SMALL).collect()}
    want = brute_components(list(enumerate(values)))
    pairs = Counter((got[s], w) for s, w in zip(signed, want))
    assert len(got) == len(values) and len(pairs) == len(set(got.values())) == len(set(want))


def test_tree_search_joins_what_brute_force_joins():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**64, 400, np.uint64)
    values = np.unique(np.concatenate([base, base ^ np.uint64(1 << 9), base[:200] ^ np.uint64(0b10101)]))
    groups = simhash.Groups(len(values))
    old, simhash.DIRECT = simhash.DIRECT, 8
    try:
        simhash.search(values, np.arange(len(values)), np.arange(len(values)), 3, groups)
    finally:
        simhash.DIRECT = old
    want = brute_components(list(enumerate(values.tolist())))
    assert groups.label.tolist() == want
