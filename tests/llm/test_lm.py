"""Language-model scores: unigrams by brute force, the model by its definition and on held-out texts."""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from demandloom.llm import lm
from demandloom.llm.common import prepare
from demandloom.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(docs):
    out = [crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    counts, end = Counter(), 0
    for (_, t), held in zip(docs, out):
        if not held:
            counts.update(words_of(t))
            end += 1
    n, v = sum(counts.values()) + end, len(counts) + (end > 0)
    rows = []
    for (d, t), held in zip(docs, out):
        c = [counts[w] for w in words_of(t)] + [end]
        rows.append((d, held, len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c)))
    return rows


def compare(rows, docs):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:5], round(r[5], 3))
    got = sorted([tuple(r)[:6] for r in rows], key=key)
    want = sorted(brute_base(docs), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op8_attention_scores"](spark, sf_dir).collect()
    compare(rows, docs)
    again = {r.doc_id: r.score for r in QUERIES["op8_attention_scores"](spark, sf_dir).collect()}
    assert again == {r.doc_id: r.score for r in rows}


def test_odd_rows_and_small_samples(spark):
    """Few frequent words and few fit texts: the split between them and rare words changes no count."""
    prepare(spark)
    docs = [(1, None), (2, ""), (3, "A b a B"), (3, "A b a B"), (None, "x É é \x0bend"), (4, "w " * 40000), (5, "z" * 5000),
            (6, "never seen here"), (7, "it's a.b,c ... 💡 x|y"), (11, "never again b"), *[(100 + i, f"a b common {i}") for i in range(40)]]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS doc", "2 AS held_out", "3 AS n").repartition(4)
    compare(lm.scores(df, fit_texts=6, hot_words=2, steps=3).collect(), docs)
    compare(lm.scores(df, fit_texts=1000, steps=3).collect(), docs)
    assert lm.scores(df.limit(0), steps=3).count() == 0
    held = [(d, "only held out") for d in range(100) if lm.held_out(d)]
    compare(lm.scores(spark.createDataFrame(held, "doc_id long, text string"), steps=3).collect(), held)


@pytest.fixture(scope="module")
def encoder():
    return lm.subwords(lm.tokenizer_path())


def test_ids_stand_for_the_words(encoder):
    for text in ("hello, world. it's 3.14 a.b,c ... x", "É ç 日本語 💡, naïve! ", "w" * 2000, "don't ..., a1, 1a. -x- ?", ""):
        words = lm.text_words(text)
        ids = encoder.encode(words)
        assert ids[-1] == encoder.end
        assert encoder.encoding.decode(ids[:-1].tolist()) == "".join(" " + w.decode() for w in words)
        whole = encoder.encoding.encode_ordinary("".join(" " + w.decode() for w in words))
        assert len(text) > 400 or ids[:-1].tolist() == whole


def naive_score(w, vocabulary, within, ids):
    """One position after the other, with the previous block and the own block's earlier ids as keys."""
    rows = [lm.OWN_IDS + lm.CLASSES, *vocabulary.rows[ids[:-1]]]
    total = 0.0
    for t, target in enumerate(ids):
        first = t // lm.BLOCK * lm.BLOCK - lm.BLOCK
        keys = [rows[j] if j >= 0 else lm.OWN_IDS + lm.CLASSES for j in range(first, t + 1)]
        x = w["embedding"][keys].astype(float)
        q = x[-1] @ w["query"] / math.sqrt(lm.WIDTH)
        s = (x @ w["key"]) @ q + w["distance"][[len(keys) - 1 - j for j in range(len(keys))]]
        a = np.exp(s) / np.exp(s).sum()
        h = np.maximum(np.concatenate([x[-1], a @ (x @ w["value"])]) @ w["hidden"] + w["hidden_bias"], 0)
        logits = h @ w["out"] + w["bias"]
        total += (logits[vocabulary.classes[target]] - np.log(np.exp(logits).sum())) / math.log(10) + within[target]
    return total


def test_model_is_causal_normalised_and_learns(spark, encoder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    texts = [encoder.encode(lm.text_words(r.text)) for r in docs]
    train, held = texts[:700], texts[700:]
    vocabulary = lm.vocabulary_of(train, encoder.size)
    w = lm.train(lm.new_weights(), lm.fit_windows(train, vocabulary), 500)
    counts = np.bincount(np.concatenate(train), minlength=encoder.size) + 0.5
    within = np.log10(counts / np.bincount(vocabulary.classes, counts, lm.CLASSES)[vocabulary.classes])
    model = lm.Fitted(np.zeros(0), vocabulary, within, w)
    some = [held[0][:5], held[1][:16], held[2][:17], held[3][:100]]
    assert np.allclose(lm.batch_scores(model, some, limit=3), [naive_score(w, vocabulary, within, i) for i in some], rtol=1e-4)
    # Shares within the classes and class probabilities both sum to one.
    assert np.allclose(np.bincount(vocabulary.classes, 10 ** within, lm.CLASSES)[np.unique(vocabulary.classes)], 1)
    logits, _ = lm.forward(w, lm.windows(held[0], vocabulary)[0])
    assert np.isfinite(logits).all()
    unigram = np.log10(counts / counts.sum())
    n = sum(map(len, held))
    assert lm.batch_scores(model, held).sum() / n > sum(unigram[i].sum() for i in held) / n + 0.3
    # Shuffled words are less likely than the text.
    rng = np.random.default_rng(0)
    mixed = [np.append(rng.permutation(i[:-1]), i[-1:]) for i in held]
    assert lm.batch_scores(model, mixed).sum() < lm.batch_scores(model, held).sum()


def test_every_training_window_is_learned_from(spark, encoder):
    prepare(spark)
    docs = [(d, "short text") for d in range(60)] + [(100 + d, "some longer words " * 3000) for d in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    begin = lm.start(df, lm.tokenizer_path(), texts=4, steps=2)
    learned = lm._counted(df, begin).where("kind = 'windows'").groupBy().sum("n").head()[0]
    assert learned == sum(-(-len(encoder.encode(lm.text_words(t))) // lm.BLOCK) for d, t in docs if not lm.held_out(d))


def test_start_is_of_all_training_texts(spark, encoder):
    """Frequent words, classes and first weights are those of all training texts, however few a task holds at once."""
    prepare(spark)
    docs = [(d, f"one two word{d % 7} three, four five six.") for d in range(300)] + [(900 + d, f"rare tail{d} " * 9) for d in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    train = [t for d, t in docs if not lm.held_out(d)]
    counts = Counter(w for t in train for w in lm.text_words(t))
    hot = lm.frequent_words(df, 8)
    assert list(hot) == [w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:8]]
    want = lm.vocabulary_of([encoder.encode(lm.text_words(t)) for t in train], encoder.size)
    got = lm.start(df, lm.tokenizer_path(), texts=4)
    assert (got.vocabulary.classes == want.classes).all() and (got.vocabulary.rows == want.rows).all()
    again = lm.start(df.repartition(2), lm.tokenizer_path(), texts=4)
    assert all(np.array_equal(got.weights[k], again.weights[k]) for k in got.weights)


def test_first_weights_follow_the_counts(encoder):
    """Without a step of training the first weights beat the classes' shares alone."""
    texts = [encoder.encode(lm.text_words("the cat sat on the mat and the dog sat on the rug . " * 20)) for _ in range(4)]
    counts = np.bincount(np.concatenate(texts), minlength=encoder.size)
    profile, rank = np.zeros(encoder.size * lm.COLUMNS, np.float32), lm.ranks(counts)
    for ids in texts:
        np.add.at(profile, lm.neighbours(ids, rank), 1)
    profile = profile.reshape(-1, lm.COLUMNS)
    vocabulary = lm.classes_of(counts, profile)
    w = lm.first_weights(profile, vocabulary)
    plain = {k: v if k == "bias" else np.zeros_like(v) for k, v in w.items()}
    data = lm.fit_windows(texts, vocabulary)
    assert lm.gradients(w, *data)[0] < lm.gradients(plain, *data)[0] - 0.5


def test_a_stream_reads_every_block_once():
    """Texts as one stream of blocks, each read once, have the loss and the gradients of their windows, also where logits are cut off."""
    rng = np.random.default_rng(1)
    texts = [(rng.zipf(1.3, n).clip(1, 3000) - 1).astype(np.uint16) for n in (1, 5, 16, 17, 32, 700, 16, 33, 4000)]
    vocabulary = lm.vocabulary_of(texts, 3000)
    inputs, targets, mask, begins = lm.stream(texts, vocabulary)
    assert len(inputs) == sum(-(-len(t) // lm.BLOCK) + 1 for t in texts) and not mask[begins].any()
    plain = lm.fit_windows(texts, vocabulary)
    for weights, cut in ((lm.new_weights(), False), ({k: v * np.float32(1000 if k == "out" else 1) for k, v in lm.new_weights().items()}, True)):
        assert (lm.forward(weights, plain[0])[0].max() >= 60) == cut
        loss, g = lm.gradients(weights, inputs, targets[1:], mask[1:], lm.BLOCK)
        want, g_want = lm.gradients(weights, *plain)
        assert math.isclose(loss, want, rel_tol=1e-5)
        assert all(g[k].shape == weights[k].shape and np.allclose(g[k], g_want[k], atol=1e-4 * np.abs(g_want[k]).max()) for k in g)
        step = {k: np.float32(1e-3) * d for k, d in g.items()}
        down = lm.gradients({k: weights[k] - step[k] for k in g}, *plain)[0]
        assert cut or math.isclose(want - down, 1e-3 * sum(float((d * d).sum()) for d in g.values()), rel_tol=0.05)


def test_texts_together_have_the_words_and_ids_of_each(encoder):
    texts = ["", " a", None, "a ", " \t\n", "a\x1cb c\x0bd e f\u0085g", " x y z　", "É ç 日本語 💡, naïve! ", "a" * 400 + " " + "c" * 401 + " " + "é" * 900,
             "it's 3.14 a.b,c ... A-Z ÀB don't ..., a1, 1a. -x-"] * 2
    want = [lm.text_words(t) for t in texts]
    codes, sizes, words = lm.split_words(pa.array(texts, pa.string()))
    listed = words.to_pylist()
    assert len(set(listed)) == len(listed) and sizes.tolist() == [len(w) for w in want]
    assert [listed[c] for c in codes] == [w for ws in want for w in ws]
    ids, each, _ = encoder.texts(listed, codes, sizes)
    alone = [[i for x in ws for i in encoder.encode([x])[:-1]] + [encoder.end] for ws in want]
    assert each.tolist() == [len(a) for a in alone] and ids.tolist() == [i for a in alone for i in a]
    assert all(len(x) == 0 for x in lm.split_words(pa.array([], pa.string())))
