"""The pipeline's near-duplicate stage against brute-force Jaccard of five-word shingles."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from demandloom.llm import jaccard
from demandloom.llm.common import prepare


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(docs):
    """The smallest doc_id of each component, every pair compared by its shared shingles."""
    sets = [shingle_set(t) for _, t in docs]
    holders, shared, parent = defaultdict(list), Counter(), list(range(len(docs)))
    for i, s in enumerate(sets):
        for g in s or {()}:  # texts without a word are one component
            shared.update((j, i) for j in holders[g])
            holders[g].append(i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), n in shared.items():
        if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
            parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted(low.values())


def test_stage_keeps_one_of_each_jaccard_component(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, df, "").collect())
    want = brute_kept([tuple(r) for r in df.collect()])
    assert len(want) < df.count() and got == want


def test_hot_group_in_blocks(spark):
    """Copies with one word changed each, alike mostly through the original, in many blocks; and odd rows."""
    prepare(spark)
    rng = random.Random(1)
    body = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    docs = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a B"), (6, "a b c")]
    docs += [(100 + k, " ".join(f"x{k}" if i == k % 60 else w for i, w in enumerate(body))) for k in range(300)]
    docs += [(1000, " ".join(body)), (1000, " ".join(body))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for cell in (jaccard.CELL, 2000):
        assert sorted(r.doc_id for r in jaccard.representatives(df, cell).collect()) == brute_kept(docs) == [1, 4, 6, 100]


def test_chain_of_classes_needs_the_buckets(spark):
    """Random overlaps in one family: hubs link some texts, pairs inside the buckets the rest; clashing columns and nulls stay."""
    prepare(spark)
    rng = random.Random(7)
    body = [f"v{i}" for i in range(120)]
    docs = []
    for k in range(400):
        words = list(body)
        for _ in range(rng.choice((1, 2, 3, 6, 9))):
            words[rng.randrange(120)] = f"y{rng.randrange(40)}"
        docs.append((k, " ".join(words)))
    docs += [(0, docs[0][1]), (None, docs[1][1]), (None, "only here under no id"), (None, "only here under no id")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, _fp int, fp int")
    for cell in (jaccard.CELL, 3000):
        rows = jaccard.representatives(df, cell).collect()
        assert rows[0].asDict().keys() == {"doc_id", "text", "_fp", "fp"}
        ids = [r.doc_id for r in rows]
        assert sorted(i for i in ids if i is not None) == brute_kept([d for d in docs if d[0] is not None])
        assert ids.count(None) == 1
    assert jaccard.representatives(df.limit(0)).count() == 0


def test_no_staged_copy_stays(spark, tmp_path):
    """Only the keys of dropped and repeated rows outlast the call."""
    import glob

    from demandloom.session import shared_dir

    prepare(spark)
    folder = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(folder + "/*"))
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f")], "doc_id long, text string")
    out = jaccard.representatives(df)
    left = {p.rsplit("/", 1)[1].split("-")[0] for p in set(glob.glob(folder + "/*")) - before}
    assert left == {"gone", "twice"} and [r.doc_id for r in out.collect()] == [1]


def test_recall_of_the_bands_at_the_limit():
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(3000):
        own = rng.integers(0, 1 << 63, 100).astype(np.uint64)
        other = np.concatenate([own[:89], rng.integers(0, 1 << 63, 11).astype(np.uint64)])  # 89 of 111: 0.802
        missed += not set(jaccard.bands(own)) & set(jaccard.bands(other))
    assert missed <= 3


def test_fingerprints_link_by_themselves(spark):
    """Without any bucket the vantage-point shards find the near copies; the exact sets refuse what only looks alike."""
    prepare(spark)
    rng = random.Random(3)
    texts, bodies = [], [[f"u{rng.randrange(10**6)}" for _ in range(400)] for _ in range(30)]
    for body in bodies:
        texts += [" ".join(body), " ".join([*body[:-1], "changed"]), " ".join([*body[:100], *reversed(body[100:])])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = jaccard.stage(docs.selectExpr("doc_id AS fp", "doc_id", "text"), "test")
    ids = jaccard.stage(jaccard.sketched(keyed), "test")
    # The third text of each body gets the first one's mark, so it is a candidate but no link.
    own = {r.fp: r.mark for r in ids.collect()}
    marks = jaccard.stage(spark.createDataFrame([(k, own[k - 2] if k % 3 == 2 else m) for k, m in own.items()], "fp long, mark long"), "test")
    sets_of = lambda wanted: jaccard.shingle_sets(keyed.join(wanted, "fp"))
    none = ids.selectExpr("fp", "mark AS band").limit(0)
    label = {r.fp: r.label for r in jaccard.candidate_links(none, marks, sets_of, jaccard.CELL).collect()}
    assert all(label[k] == label[k + 1] and label.get(k + 2) != label[k] for k in range(0, 90, 3))
    assert len({label[k] for k in range(0, 90, 3)}) == 30
