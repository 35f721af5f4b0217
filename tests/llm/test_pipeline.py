"""The pipeline, stage by stage, against brute force on the smallest sample."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from demandloom.llm import decontamination, packing, pii, quality
from demandloom.llm.common import prepare, stage
from test_basic import brute_lines
from test_decontamination import brute_leaks
from test_jaccard import brute_kept
from test_packing import check_pieces


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Input of each stage and the last result."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], sf_dir), name))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_quality(steps):
    docs = [(r.doc_id, r.text, r.source) for r in steps[0].collect()]
    judged, _ = brute_lines(docs, quality.RULES)
    assert Counter(d for d, _ in texts(steps[1])) == Counter(r[0] for r in judged.elements() if r[-1])


def test_near_duplicates(steps):
    before = texts(steps[1])
    kept = brute_kept(before)
    assert len(kept) < len(before) and sorted(d for d, _ in texts(steps[2])) == kept


def test_decontamination(spark, sf_dir, steps):
    before = texts(steps[2])
    items = {r.item_id: decontamination.word_hashes(r.text).tolist() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    leaking = {d for d, _ in brute_leaks(before, items)}
    assert leaking and sorted(d for d, _ in texts(steps[3])) == sorted(d for d, _ in before if d not in leaking)


def test_personal_data(steps):
    before, after = dict(texts(steps[3])), dict(texts(steps[4]))
    assert before.keys() == after.keys()
    model = pii.fit(steps[3])
    for d, text in before.items():
        assert after[d] == pii.masked(text, pii.find(text, model, {})[1])
        assert not pii.base_spans(after[d])


def test_packing(steps):
    from tokenizers import Tokenizer
    from demandloom.llm.tokens import END_ID, default_path
    tokenizer = Tokenizer.from_file(default_path())
    docs = defaultdict(list)
    for d, t in texts(steps[4]):
        docs[d].append(t)
    check_pieces(steps[5].collect(), docs, lambda t: tokenizer.encode(t, add_special_tokens=False).ids + [END_ID])
    assert steps[5].columns[:7] == packing.PIECES.replace(" long", "").replace(" double", "").split(", ")[:7]


def test_run_gives_the_same_rows(spark, sf_dir, steps):
    key = lambda df: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf_dir)) == key(steps[5])


def test_odd_documents(spark, sf_dir):
    prepare(spark)
    body = " ".join(f"word{k}x" for k in range(80))
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, body + " end a", "en", None, 5), (3, body + " x@y.org b", None, "b", None),
            (3, body + " x@y.org b", None, "b", None), (4, "w " * 50000, "en", "a", 100000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS _uid", "map('a', 1) AS fp", "array(2) AS _ids", "'q' AS host")
    docs = df
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
        assert docs.columns == df.columns
    assert all("@" not in r.text for r in docs.collect()) and docs.count() >= 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= 1
    empty = df.limit(0)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, empty, sf_dir).count() == 0
