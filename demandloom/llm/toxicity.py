"""Toxicity scores from subword-bag embeddings.

A word is the bag of its character n-grams (with marked ends); each
n-gram has an embedding in one of ``BUCKETS`` rows. A window of words is the
average of its words, a word the average of its n-grams, and a linear softmax
on the average gives the two classes. Embeddings and softmax are trained
jointly in numpy, so a misspelling that training never saw shares the n-grams,
and thereby the vectors, of the word it hides.

A text is cut into windows of ``WINDOW`` words that overlap by half, over its
whole length; its score is that of its worst window, so a few words do not
vanish in a long text. Training works on the same windows: of each text, the
one that is worst under the weights so far. A fifth of the fit texts is kept
back to calibrate the probabilities.

The model is fitted on at most ``FIT_TEXTS`` labelled texts of at most
``FIT_CHARS`` characters, chosen by a hash of the doc_id, in one task; both
bounds are fixed, whatever the size of the table. Every text is scored where it
is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import texts_of

FOLDS, HELD_OUT = 4, 2
FIT_TEXTS, FIT_CHARS = 8000, 8_000
BUCKETS, WIDTH = 1 << 17, 16
NGRAMS = (3, 4, 5, 6)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
WINDOW = 200
#: Passes over the fit texts; in the first ones the window of a text is a draw of ``DRAWN`` of its words.
EPOCHS, WHOLE, DRAWN = 8, 2, 256
BATCH = 64
#: Step sizes of AdaGrad, and what its squared gradients start from.
RATE, SOFTMAX_RATE, FLOOR = 0.1, 0.02, 1e-3
#: Fixed factor on a window's average, so that one word of a window can decide with small weights.
SCALE = 100.0
#: Occurrences (one for each word and text) that an n-gram needs to be trained; rarer ones stay zero and say nothing.
LEAST = 10
SEED = 12
LIMIT = 0.3
#: Words whose scores a task remembers, and words that are cut into n-grams at once.
KNOWN, SLAB = 1 << 20, 1 << 15

WORD = re.compile(r"[^\W_]+(?:['*@$!0-9-]+[^\W_]+)*")


def words(text: str) -> list[str]:
    """Runs of letters and digits in lower case; signs inside a word stay."""
    return WORD.findall(text.lower())


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the n-grams of all words, word by word, and the number of the word that each belongs to."""
    marked = "".join(f"<{w}>" for w in texts)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 2)
    found = np.zeros((len(codes), len(NGRAMS)), np.int32)
    inside = np.zeros(found.shape, bool)
    hashed = codes + np.uint64(1)
    for n in range(2, min(max(NGRAMS), len(codes)) + 1):
        hashed = hashed[:-1] * FACTOR + codes[n - 1:]
        if n in NGRAMS:
            at = NGRAMS.index(n)
            found[:len(hashed), at] = ((hashed * FACTOR) >> np.uint64(40)).astype(np.int64) % BUCKETS
            inside[:len(hashed), at] = owner[:len(hashed)] == owner[n - 1:]
    return found[inside], np.repeat(owner, inside.sum(axis=1))


@dataclass(frozen=True)
class Model:
    """What scoring needs of the trained weights: each bucket's embedding times the softmax difference, bias, calibration."""

    bucket: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def learn(self, texts: list[str], known: dict[str, float]) -> None:
        """Add the words' scores to ``known``."""
        for at in range(0, len(texts), SLAB):
            part = texts[at:at + SLAB]
            buckets, owner = ngrams(part)
            n = np.maximum(np.bincount(owner, minlength=len(part)), 1)
            total = np.bincount(owner, self.bucket[buckets], len(part))
            known.update(zip(part, (SCALE * total / n).tolist()))

    def probability(self, logit: float) -> float:
        return sigmoid(self.shift + self.slope * (logit + self.bias))


def window_means(scores: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts and mean scores of the windows, half a window apart; the last one ends with the text."""
    last = max(0, len(scores) - size)
    starts = np.unique(np.append(np.arange(0, last + 1, size // 2), last))
    total = np.concatenate([[0.0], np.cumsum(scores)])
    ends = np.minimum(starts + size, len(scores))
    return starts, (total[ends] - total[starts]) / (ends - starts)


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -50, 50))))


def raw_scores(texts: list[str], model: Model, known: dict[str, float]) -> list[float]:
    """Mean score of the worst window of each text; no word: 0."""
    split = [words(t) for t in texts]
    if len(known) > KNOWN:
        known.clear()
    model.learn(sorted({w for own in split for w in own}.difference(known)), known)
    return [float(window_means(np.fromiter(map(known.__getitem__, own), float, len(own)))[1].max()) if own else 0.0
            for own in split]


def calibrate(model: Model, texts: list[str], labels: list[int], steps: int = 60) -> Model:
    """Logistic slope and shift of the model's logits on texts that it was not trained on. Without both classes: none."""
    if len(set(labels)) < 2:
        return model
    logits = np.array(raw_scores(texts, model, {})) + model.bias
    centre, spread = logits.mean(), logits.std() + 1e-9
    x, y = np.stack([np.ones(len(logits)), (logits - centre) / spread], axis=1), np.array(labels, float)
    w = np.array([0.0, 1.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - y) + w * [0, 1])
        w = w - step / max(1.0, np.abs(step).max())  # short steps: far from the optimum the curvature says little
    slope = float(w[1] / spread)
    return Model(model.bucket, model.bias, slope, float(w[0] - slope * centre)) if slope > 0 else model


def learned(texts: list[str], labels: list[int]) -> Model:
    """Trained on four of five texts, calibrated on the fifth."""
    train_on = [k for k in range(len(texts)) if k % 5]
    rest = range(0, len(texts), 5)
    model = train([texts[k] for k in train_on], [labels[k] for k in train_on])
    return calibrate(model, [texts[k] for k in rest], [labels[k] for k in rest])


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Joint training of embeddings and softmax by AdaGrad on one window of each text an epoch. Deterministic."""
    rng = np.random.default_rng(SEED)
    numbers: dict[str, int] = {}
    docs = [np.array([numbers.setdefault(w, len(numbers)) for w in words(t)], np.int64) for t in texts]
    kept = [k for k, d in enumerate(docs) if len(d)]
    y = np.array(labels, float)
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    bias = np.log(prior / (1 - prior))
    if not kept:
        return Model(np.zeros(BUCKETS), bias)
    names = list(numbers)
    texts_with = np.bincount(np.concatenate([np.unique(docs[k]) for k in kept]), minlength=len(names))
    slabs = range(0, len(names), SLAB)
    seen = np.zeros(BUCKETS)
    for at in slabs:
        buckets, owner = ngrams(names[at:at + SLAB])
        seen += np.bincount(buckets, texts_with[at + owner], BUCKETS)
    often = seen >= LEAST
    parts, full, sizes = [], [], []
    for at in slabs:
        buckets, owner = ngrams(names[at:at + SLAB])
        n = len(names[at:at + SLAB])
        parts.append(buckets[often[buckets]])
        full.append(np.bincount(owner, minlength=n))
        sizes.append(np.bincount(owner[often[buckets]], minlength=n))
    flat, full, sizes = np.concatenate(parts), np.concatenate(full), np.concatenate(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def per_word(rows: np.ndarray, words_of: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' rows for each word, over the number of all its n-grams."""
        out = np.zeros((len(words_of), *rows.shape[1:]), rows.dtype)
        some = sizes[words_of] > 0
        if some.any():
            out[some] = np.add.reduceat(rows, begin[some])
        return out / full[words_of].reshape(-1, *[1] * (rows.ndim - 1))

    embedding = (rng.uniform(-0.01, 0.01, (BUCKETS, WIDTH)) * often[:, None]).astype(np.float32)
    softmax = rng.normal(0, 0.1, (WIDTH, 2))
    offset = np.array([0.0, bias])
    seen_e, seen_w, seen_b = np.full(BUCKETS, FLOOR), np.full((WIDTH, 2), 1e-6), np.full(2, 1e-6)

    def gather(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat positions of the words' n-grams, and where each word's begin."""
        n = sizes[ids]
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        return np.repeat(starts[ids] - begin, n) + np.arange(n.sum()), begin

    for epoch in range(epochs):
        if epoch >= WHOLE:
            difference = embedding @ (softmax[:, 1] - softmax[:, 0])
            value = per_word(difference[flat], np.arange(len(names)), starts) * SCALE
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(kept)
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            windows = []
            for k in batch:
                d = docs[k]
                if epoch >= WHOLE:
                    first, means = window_means(value[d])
                    a = first[means.argmax()]
                    d = d[a:a + WINDOW]
                elif len(d) > DRAWN:
                    d = d[rng.integers(0, len(d), DRAWN)]
                windows.append(d)
            lengths = np.array([len(w) for w in windows])
            ids, inverse = np.unique(np.concatenate(windows), return_inverse=True)
            row = np.repeat(np.arange(len(batch)), lengths)
            share = np.zeros((len(batch), len(ids)))
            np.add.at(share, (row, inverse), SCALE / lengths[row])
            place, begin = gather(ids)
            buckets = flat[place]
            vectors = per_word(embedding[buckets], ids, begin)
            mean = share @ vectors
            out = mean @ softmax + offset
            out = np.exp(out - out.max(axis=1, keepdims=True))
            out /= out.sum(axis=1, keepdims=True)
            out[:, 1] -= y[batch]
            out[:, 0] -= 1 - y[batch]
            to_softmax, to_offset = mean.T @ out, out.sum(axis=0)
            to_words = share.T @ (out @ softmax.T) / full[ids][:, None]
            spread = np.repeat(np.arange(len(ids)), sizes[ids])
            gradient = np.stack([np.bincount(buckets, to_words[spread, k], BUCKETS) for k in range(WIDTH)], axis=1)
            seen_e += (gradient ** 2).mean(axis=1)
            embedding -= (rate * gradient / np.sqrt(seen_e)[:, None]).astype(np.float32)
            seen_w += to_softmax ** 2
            seen_b += to_offset ** 2
            softmax -= SOFTMAX_RATE * to_softmax / np.sqrt(seen_w)
            offset -= SOFTMAX_RATE * to_offset / np.sqrt(seen_b)
    return Model(embedding @ (softmax[:, 1] - softmax[:, 0]), float(offset[1] - offset[0]))


def fold(doc_id: Column) -> Column:
    """The fold of a document; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def fit_rows(docs: DataFrame, labels: DataFrame, texts: int = FIT_TEXTS, chars: int = FIT_CHARS) -> DataFrame:
    """text and toxic of the bounded sample: labelled documents outside the held-out fold.

    Of several labels of one document the highest counts; rows without a label
    or doc_id are left out. The sampled doc_ids are few enough to be sent to
    the tasks that read the documents, so no text is shuffled before the cut.
    """
    mark = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    chosen = (
        mark.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts)
    )
    found = docs.select("doc_id", "text").where(F.char_length("text") <= chars).join(F.broadcast(chosen), "doc_id")
    return found.orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(texts).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the sample, trained in one task of fixed size. Without a labelled text: even odds for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += texts_of(batch)
            marks += batch.column("toxic").to_pylist()
        model = learned(texts, marks)
        yield pa.RecordBatch.from_pydict({"bucket": [model.bucket.astype("<f8").tobytes()],
                                          "numbers": [[model.bias, model.slope, model.shift]]})

    row = fit_rows(docs, labels).coalesce(1).mapInArrow(run, "bucket binary, numbers array<double>").first()
    if row is None:
        return Model(np.zeros(BUCKETS), 0.0)
    return Model(np.frombuffer(bytes(row["bucket"]), "<f8"), *row["numbers"])


def scores(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Null and empty texts, and texts without a word, get the score of the bias.
    A null doc_id counts as the empty text for its fold. Repeated rows are
    scored each; extra columns are dropped. An empty table gives no rows.
    """
    model = model or fit(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            found = [model.probability(x) for x in raw_scores(texts_of(batch), model, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()),
                 pa.array([int(s >= LIMIT) for s in found], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    marked = docs.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "text")
    return marked.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
