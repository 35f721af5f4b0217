"""Toxicity scores: held-out accuracy, misspellings, long texts, odd rows."""

from __future__ import annotations

from zlib import crc32

import numpy as np

from demandloom.llm import toxicity
from demandloom.llm.common import prepare
from demandloom.llm.queries import QUERIES

CLEAN = "the river rose in the night and the farmers moved their cattle to the hill before morning came".split()


def sample(n=600):
    """Texts of which every third holds one of three words in twenty."""
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for k in range(n):
        own = list(rng.choice(CLEAN, 60))
        if k % 3 == 0:
            for at in rng.integers(0, 60, 3):
                own[at] = str(rng.choice(["blockhead", "nincompoop", "scoundrel"]))
        texts.append(" ".join(own))
        labels.append(int(k % 3 == 0))
    return texts, labels


def probability(model, text):
    return model.probability(toxicity.raw_scores([text], model, {})[0])


def test_unseen_misspellings_and_long_texts():
    model = toxicity.learned(*sample())
    clean = " ".join(CLEAN * 4)
    assert probability(model, clean) < 0.1
    for bad in ("nincompoops", "blockheaad", "scoundrell", "Nincompoop,"):
        assert probability(model, clean.replace("cattle", bad)) > 0.3, bad
    long = " ".join(CLEAN * 2000)
    assert probability(model, long) < 0.1
    assert probability(model, " ".join([long, *["scoundrell nincompoop"] * 4, long])) > 0.3


def test_training_is_deterministic():
    a, b = (toxicity.learned(*sample(200)) for _ in range(2))
    assert (a.bucket == b.bucket).all() and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)


def test_ngrams_of_each_word():
    buckets, owner = toxicity.ngrams(["ab", "naïve", "", "x" * 1000])
    counts = np.bincount(owner, minlength=4).tolist()
    # "<ab>" has two 3-grams and one 4-gram; "<>" has none.
    assert counts == [3, 5 + 4 + 3 + 2, 0, 1000 + 999 + 998 + 997]
    alone, _ = toxicity.ngrams(["naïve"])
    assert buckets[owner == 1].tolist() == alone.tolist()


def test_windows_cover_the_text():
    for n in (1, 7, toxicity.WINDOW, toxicity.WINDOW + 1, 5 * toxicity.WINDOW + 3):
        values = np.arange(n, dtype=float)
        starts, means = toxicity.window_means(values)
        covered = np.zeros(n, bool)
        for a, m in zip(starts, means):
            part = values[a:a + toxicity.WINDOW]
            covered[a:a + toxicity.WINDOW] = True
            assert np.isclose(part.mean(), m)
        assert covered.all()


def test_query_on_held_out_documents(spark):
    """Fold, columns, and accuracy on the fold that gave no labels."""
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op12_subword_toxicity"](spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
               for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    ranks = np.searchsorted(np.sort(good), bad) / len(good)
    assert ranks.mean() > 0.9
    assert np.mean(np.array(good) >= 0.3) < 0.06


def test_odd_rows(spark):
    prepare(spark)
    docs = [(None, "nothing"), (1, None), (2, ""), (3, "... \n"), (4, "x" * 300_000), (5, "a " * 100_000), (6, "scoundrel"), (6, "scoundrel")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS toxic", "'a' AS score", "false AS held_out", "0 AS hash")
    texts, marks = sample(300)
    texts_df = spark.createDataFrame([(100 + k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(100 + k, None if k == 5 else m, 1) for k, m in enumerate(marks)] + [(None, 1, 0), (101, 0, 0), (7777, 1, 0)],
                                   "doc_id long, toxic int, quality int")
    model = toxicity.fit(texts_df, labels)
    got = toxicity.scores(df, labels, model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    none = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(none) == 1 and next(r.score for r in rows if r.doc_id == 6) > none.pop()
    assert toxicity.scores(df.limit(0), labels, model).count() == 0
    unlabelled = toxicity.scores(df, labels.limit(0)).collect()
    assert len(unlabelled) == 8 and {r.score for r in unlabelled} == {0.5}


def test_fit_sample_is_bounded(spark):
    prepare(spark)
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id) AS text").union(
        spark.range(300).selectExpr("7L", "concat('again ', id)"))
    labels = spark.range(500).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    kept = toxicity.fit_rows(docs, labels, texts=50)
    assert kept.count() == 50 and kept.count() == toxicity.fit_rows(docs.repartition(9), labels, texts=50).intersectAll(kept).count()
