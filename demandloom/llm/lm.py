"""Language-model scores of whole texts.

Two scores over the same tokens (words, then one end per text):

* ``base_score``: smoothed unigrams. All words are counted over all training
  documents. The most frequent ones are counted inside the tasks; all others
  meet in one shuffle by word. The split changes the cost, never a count.
* ``score``: a causal self-attention model on subword ids, in numpy. A word's
  ids come from a public tokenizer. The model predicts the class of the next id
  from the ids before it; an id's share within its class comes from its count
  in all training texts. Windows of two blocks overlap by one block, and each
  id is scored once, with the block before it and what stands before it in its
  own as context.

Training, all of it on all training texts: classes and first weights come from
counts of every id and its neighbours. From there every task goes over every
window of its own training documents, and the weights are averaged, first
after a quarter of the texts and again after the rest (data-parallel training
with rounds of parameter averaging). A small table is gone over several times.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import stage

FOLDS, HELD_OUT = 5, 1
#: Frequent words that are counted inside the tasks: a bound on what reaches the driver.
HOT_WORDS = (1 << 16) - 1
#: Training texts whose windows a task holds at once, and rounds of the k-means that makes the classes.
FIT_TEXTS, ROUNDS = 1500, 12
CLASSES, WIDTH, BLOCK = 64, 16, 16
#: Ids with an embedding of their own; all others have their class's.
OWN_IDS = 1024
RATE = 0.01
#: Windows of one training step of a task.
STEP_WINDOWS = 512
#: The tasks' weights are averaged after one text in so many, and again after all others.
FIRST_PART = 4
#: Steps of the busiest task, below which training goes over all texts again, and how often it goes over them at most.
LEAST_STEPS, PASSES = 500, 6
#: Bytes of the longest word that the tokenizer always gets whole; longer ones are cut into pieces of so many characters.
WORD_CHARS = 400


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def text_words(text: str | None) -> list[bytes]:
    """The words in lower case (A-Z only), as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of many texts as ``text_words`` has them: for each its place among the different ones, how many each text has, the different ones."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = parts.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
    sizes = np.diff(parts.offsets.to_numpy())
    nothing = pc.index(words, b"").as_py()  # white space at an end of a text gives an empty word
    if nothing >= 0:
        word = codes != nothing
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[word], minlength=len(sizes))
        codes = codes[word]
        codes = codes - (codes > nothing)
        words = pa.concat_arrays([words[:nothing], words[nothing + 1:]])
    return codes, sizes, words


def held_out(doc_id) -> bool:
    return crc32(str(doc_id).encode() if doc_id is not None else b"") % FOLDS == HELD_OUT


# --- subword ids ------------------------------------------------------------------------------


class Subwords:
    """Ids of words, each taken with a space before it, under a byte-level tokenizer; the last id ends a text."""

    def __init__(self, path: str, words: int = 600_000):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 2
        self.end = self.size - 1
        self.words = words
        self.seen: dict[bytes, bytes] = {}
        self.starts = np.zeros(self.size, bool)
        for token, i in ranks.items():
            self.starts[i] = token.startswith(b" ")

    def _learn(self, new: list[bytes]) -> None:
        """Many words go to the tokenizer at once; a token that begins with a space begins a word."""
        for at in range(0, len(new), 512):
            part = [w for w in new[at:at + 512] if len(w) <= WORD_CHARS]
            text = " " + b" ".join(part).decode("utf-8", "replace")
            if len(text.split()) == len(part):  # else a word holds other white space, which the tokenizer takes apart
                ids = np.array(self.encoding.encode_ordinary(text), np.uint16)
                cuts = np.flatnonzero(self.starts[ids])
                if len(cuts) == len(part):
                    raw, bounds = ids.tobytes(), [*(2 * cuts).tolist(), 2 * len(ids)]
                    self.seen.update(zip(part, map(raw.__getitem__, map(slice, bounds, bounds[1:]))))
        for word in new:
            if word not in self.seen:
                text = " " + word.decode("utf-8", "replace")
                pieces = [text] if len(word) <= WORD_CHARS else [text[a:a + WORD_CHARS] for a in range(0, len(text), WORD_CHARS)]
                self.seen[word] = np.array([i for p in pieces for i in self.encoding.encode_ordinary(p)], np.uint16).tobytes()

    def lookup(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of these different words."""
        found = list(map(self.seen.get, words))
        if None in found:
            new = [w for w, ids in zip(words, found) if ids is None]
            if len(self.seen) + len(new) > self.words:
                self.seen, new = {}, words  # full: begin anew, with all of these
            self._learn(new)
            found = list(map(self.seen.__getitem__, words))
        return found

    def encode(self, words: list[bytes]) -> np.ndarray:
        """The ids of the words in turn, then the end."""
        different = list(dict.fromkeys(words))
        found = dict(zip(different, self.lookup(different)))
        ids = np.frombuffer(b"".join(map(found.__getitem__, words)), np.uint16)
        return np.append(ids, np.uint16(self.end))


    def texts(self, words: list[bytes], codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """What ``encode`` gives for many texts of words given by their place in a list: all ids, how many each text has, the list's ids."""
        found = self.lookup(words)
        each = np.array([len(f) // 2 for f in found], np.int64)
        of_words = np.frombuffer(b"".join(found), np.uint16)
        many = each[codes]
        at = np.arange(many.sum()) + np.repeat((np.cumsum(each) - each)[codes] - (np.cumsum(many) - many), many)
        before = np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], np.cumsum(sizes)])]
        return np.insert(of_words[at], before[1:], self.end), np.diff(before) + 1, (of_words, each)


@cache
def subwords(path: str) -> Subwords:
    """One for each worker process."""
    return Subwords(path)


# --- the model --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """id -> class that is predicted, and id -> row of the embedding that is read."""

    classes: np.ndarray
    rows: np.ndarray


def new_weights(width: int = WIDTH, classes: int = CLASSES, seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {
        "embedding": 0.5 * rng.standard_normal((OWN_IDS + classes + 1, width)).astype(np.float32),  # the last row is the begin mark
        "distance": np.zeros(2 * BLOCK, np.float32),  # a bias for how far back a key is
        "query": normal(width, width), "key": normal(width, width), "value": normal(width, width),
        "hidden": normal(2 * width, 2 * width), "hidden_bias": np.zeros(2 * width, np.float32),
        "out": 0.1 * normal(2 * width, classes), "bias": np.zeros(classes, np.float32),
    }


#: Which of the 2 * BLOCK positions of a window a position of its second block may see, itself included.
_MASK = np.where(np.arange(2 * BLOCK)[None, :] <= np.arange(BLOCK)[:, None] + BLOCK, 0, -1e9).astype(np.float32)
_BACK = np.clip(np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :], 0, 2 * BLOCK - 1)


def windows(ids: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, 2 * BLOCK), targets (n, BLOCK) and their mask for one text.

    Position t predicts the class of id t from what stands before: the input
    row is shifted by one begin mark, so the key at its own position is the id
    before it.
    """
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.full((blocks + 1) * BLOCK, OWN_IDS + CLASSES, np.int64)
    padded[BLOCK + 1:BLOCK + n] = vocabulary.rows[ids[:-1]]
    inputs = np.lib.stride_tricks.as_strided(padded, (blocks, 2 * BLOCK), (BLOCK * 8, 8))
    targets = np.zeros(blocks * BLOCK, np.int64)
    targets[:n] = vocabulary.classes[ids]
    return inputs, targets.reshape(blocks, BLOCK), (np.arange(blocks * BLOCK) < n).reshape(blocks, BLOCK)


def stream(texts: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and their mask for many texts (n, BLOCK), and where each text begins.

    The blocks of a text stand in turn after one block of begin marks, so that a
    block and the one before it are a window of ``windows``, and what is
    computed for a block is there for both windows it is in. A begin block has
    no targets.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    blocks = 1 - (-sizes // BLOCK)
    begins = np.cumsum(blocks) - blocks
    ids = np.concatenate([np.zeros(0, np.uint16), *texts])
    at = np.arange(len(ids)) + np.repeat((begins + 1) * BLOCK - (np.cumsum(sizes) - sizes), sizes)
    rows = np.full(blocks.sum() * BLOCK + 1, OWN_IDS + CLASSES, np.int64)
    rows[at + 1] = vocabulary.rows[ids]
    rows[begins * BLOCK] = OWN_IDS + CLASSES  # where a text before ends with its block
    targets, mask = np.zeros(len(rows) - 1, np.int64), np.zeros(len(rows) - 1, bool)
    targets[at], mask[at] = vocabulary.classes[ids], True
    return rows[:-1].reshape(-1, BLOCK), targets.reshape(-1, BLOCK), mask.reshape(-1, BLOCK), begins


#: Windows that go through the model together, so that what is computed for them stays in a processor's cache.
NEAR = 128


class Pass:
    """The model over windows whose rows begin ``hop`` rows apart: logits (windows * BLOCK, classes) of their second blocks.

    With ``hop`` = BLOCK every block is read once and belongs to two windows.
    What depends on a row alone is looked up: its query, key, value and part of
    the hidden layer. Biases and sums go through the products as columns of
    ones. Logits and attention scores are limited to 60, so their exponentials
    are finite as they are; they are only cut off where a sum tells that one is
    larger.
    """

    LIMIT = np.float32(np.exp(60))

    def __init__(self, w: dict[str, np.ndarray]):
        self.width = width = w["query"].shape[0]
        self.scale = np.float32(1 / np.sqrt(width))
        self.embedding = embedding = w["embedding"]
        one, none = np.ones((len(embedding), 1), np.float32), np.zeros((width, 1), np.float32)
        self.ask = np.concatenate([w["hidden"][:width], w["query"] * self.scale], 1)
        self.read = np.concatenate([w["key"], w["value"]], 1)
        self.queries, self.keys = embedding @ self.ask[:, 2 * width:], embedding @ w["key"]
        self.values = np.concatenate([embedding @ w["value"], one], 1)
        self.own = np.concatenate([embedding @ self.ask[:, :2 * width] + w["hidden_bias"], one], 1)
        self.mix_hidden = np.concatenate([w["hidden"][width:], none], 1)
        self.out = np.concatenate([w["out"], w["bias"][None]])
        self.back = _MASK + w["distance"][_BACK]
        self.ones, self.minus = np.ones(self.out.shape[1], np.float32), np.full(width, -1, np.float32)
        self.tall = np.ones(NEAR * BLOCK, np.float32)

    @np.errstate(over="ignore", invalid="ignore")
    def forward(self, rows: np.ndarray, n: int, hop: int) -> tuple[np.ndarray, tuple]:
        width = self.width
        own = rows[BLOCK:] if hop == BLOCK else rows.reshape(n, hop)[:, BLOCK:].ravel()
        q = self.queries.take(own, axis=0, mode="clip").reshape(n, BLOCK, width)
        k, v = (np.lib.stride_tricks.as_strided(x, (n, 2 * BLOCK, x.shape[1]), (hop * x.strides[0], *x.strides))
                for x in (t.take(rows, axis=0, mode="clip") for t in (self.keys, self.values)))
        for cut in (False, True):
            a = q @ k.transpose(0, 2, 1)
            a += self.back
            if cut:
                np.minimum(a, 60, out=a)
            np.exp(a, out=a)
            mix = (a @ v).reshape(-1, width + 1)
            if mix[:, width].max() < self.LIMIT:
                break
        share = 1 / mix[:, width:]
        mix = mix[:, :width] * share
        active = self.own.take(own, axis=0, mode="clip")
        active += mix @ self.mix_hidden
        np.maximum(active, 0, out=active)
        return active @ self.out, (own, q, k, v, a, share, mix, active)

    @np.errstate(over="ignore")
    def exponentials(self, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """Of the logits, in place of them if none is cut off; their sums; whether one was cut off."""
        p = np.exp(logits)
        total = p @ self.ones
        if total.max() < self.LIMIT:
            return p, total, False
        np.minimum(logits, 60, out=logits)
        p = np.exp(logits)
        return p, p @ self.ones, True

    def log_shares(self, rows: np.ndarray, targets: np.ndarray, n: int, hop: int) -> np.ndarray:
        """Logarithm of every target's probability."""
        logits, _ = self.forward(rows, n, hop)
        goal = np.arange(0, logits.size, logits.shape[1]) + targets
        p, total, cut = self.exponentials(logits)
        return logits.ravel().take(goal) - np.log(np.maximum(total, np.float32(1e-37)))

    def backward(self, rows, targets, share_of, n: int, hop: int) -> tuple[np.ndarray, tuple]:
        """The loss of every target, and the gradient by piece; a target counts by its ``share_of``."""
        width = self.width
        logits, (own, q, k, v, a, share, mix, active) = self.forward(rows, n, hop)
        goal = np.arange(0, logits.size, logits.shape[1]) + targets
        p, total, cut = self.exponentials(logits)
        loss = np.log(total) - logits.ravel().take(goal)
        flat = p.ravel()
        flat[goal] -= total
        if cut:
            p *= logits < 60
        heavy = (share_of / total)[:, None]
        g_out = p.T @ (active * heavy)
        d = p @ self.out.T
        d *= heavy
        d *= active > 0
        x, x_own = self.embedding.take(rows, axis=0, mode="clip"), self.embedding.take(own, axis=0, mode="clip")
        d_own = np.empty((n * BLOCK, 3 * width), np.float32)  # of the hidden layer and of the query
        d_own[:, :2 * width] = d[:, :-1]
        d_mix = np.empty((n * BLOCK, width + 1), np.float32)
        plain = d @ self.mix_hidden.T
        plain *= share
        d_mix[:, :width] = plain
        np.matmul(plain * mix, self.minus, out=d_mix[:, width])
        d_mix, plain = d_mix.reshape(n, BLOCK, -1), plain.reshape(n, BLOCK, -1)
        d_s = d_mix @ v.transpose(0, 2, 1)
        d_s *= a
        d_kv = np.empty((n, 2 * BLOCK, 2 * width), np.float32)
        np.matmul(d_s.transpose(0, 2, 1), q, out=d_kv[..., :width])
        np.matmul(a.transpose(0, 2, 1), plain, out=d_kv[..., width:])
        if hop == BLOCK:
            halves = d_kv.reshape(n, 2, -1)
            d_kv = np.zeros((n + 1, halves.shape[2]), np.float32)
            d_kv[:-1] = halves[:, 0]
            d_kv[1:] += halves[:, 1]
        d_kv = d_kv.reshape(-1, 2 * width)
        np.matmul(d_s, k, out=d_own.reshape(n, BLOCK, -1)[..., 2 * width:])
        d_x = d_kv @ self.read.T
        if hop == BLOCK:
            d_x[BLOCK:] += d_own @ self.ask.T
        else:
            d_x.reshape(n, hop, width)[:, BLOCK:] += (d_own @ self.ask.T).reshape(n, BLOCK, width)
        return loss, (g_out, x_own.T @ d_own, mix.T @ d, self.tall[:n * BLOCK] @ d, d_s.sum(0), x.T @ d_kv, d_x)


def forward(w: dict[str, np.ndarray], inputs: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Class logits (windows * BLOCK, classes) of the second blocks of windows, and what the backward pass needs."""
    logits, kept = Pass(w).forward(inputs.ravel(), len(inputs), 2 * BLOCK)
    return np.minimum(logits, 60), kept


def gradients(w: dict[str, np.ndarray], inputs, targets, mask, hop: int = 2 * BLOCK) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss in nats over the masked targets, and the gradient of every weight.

    The inputs are windows (n, 2 * BLOCK) or, with ``hop`` = BLOCK, the blocks of
    ``stream``, whose targets and mask begin with the second block.
    """
    model, width, rows = Pass(w), w["query"].shape[0], inputs.ravel()
    targets, mask = targets.ravel(), mask.ravel()
    count = np.float32(max(1, int(mask.sum())))
    loss, sums, d_x, seen = 0.0, None, [], []
    for at in range(0, len(targets) // BLOCK, NEAR):
        n = min(NEAR, len(targets) // BLOCK - at)
        some, part = slice(at * BLOCK, (at + n) * BLOCK), rows[at * hop:at * hop + (n - 1) * hop + 2 * BLOCK]
        share_of = mask[some] / count
        losses, pieces = model.backward(part, targets[some], share_of, n, hop)
        loss += float(losses[mask[some]].sum() / count)
        sums = pieces[:-1] if sums is None else [s + p for s, p in zip(sums, pieces)]
        seen.append(part)
        d_x.append(pieces[-1])
    if sums is None:
        return 0.0, {k: np.zeros_like(v) for k, v in w.items()}
    out, ask, mix, hidden_bias, d_s, read = sums
    g = {"out": out[:, :-1].T, "bias": out[:, -1], "hidden": np.concatenate([ask[:, :2 * width], mix[:, :-1]]), "hidden_bias": hidden_bias[:-1],
         "distance": np.bincount(_BACK.ravel(), d_s.ravel(), 2 * BLOCK).astype(np.float32),
         "query": ask[:, 2 * width:] * model.scale, "key": read[:, :width], "value": read[:, width:]}
    seen, d_x = np.concatenate(seen), np.concatenate(d_x)
    order = np.argsort(seen.astype(np.uint16), kind="stable")
    ids = seen[order]
    cuts = np.flatnonzero(np.diff(ids, prepend=-1))
    g["embedding"] = np.zeros_like(w["embedding"])
    g["embedding"][ids[cuts]] = np.add.reduceat(d_x.take(order, axis=0), cuts)
    return loss, g


class Adam:
    def __init__(self, w: dict[str, np.ndarray], rate: float = RATE):
        self.w = {k: v.copy() for k, v in w.items()}
        self.rate, self.t = rate, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, d in g.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * d
            self.s[k] = 0.99 * self.s[k] + 0.01 * d * d
            step = (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.s[k] / (1 - 0.99**self.t)) + 1e-8)
            self.w[k] = (self.w[k] - self.rate * step).astype(np.float32)


#: Frequent ids that a profile tells apart, and its columns: what stands before and what follows, one of them or another.
MARKS = 128
COLUMNS = 2 * MARKS + 2


def most_frequent(counts: np.ndarray) -> np.ndarray:
    """The ids by falling count."""
    return np.argsort(-counts, kind="stable")


def neighbours(ids: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each id of a text the cells (id, column) of the profile for the id before it and the one after it."""
    ids = ids.astype(np.int64)
    return np.concatenate([ids[1:] * COLUMNS + rank[ids[:-1]], ids[:-1] * COLUMNS + MARKS + 1 + rank[ids[1:]]])


def ranks(counts: np.ndarray) -> np.ndarray:
    rank = np.full(len(counts), MARKS)
    rank[most_frequent(counts)[:MARKS]] = np.arange(min(MARKS, len(counts)))
    return rank


def vocabulary_of(texts: list[np.ndarray], size: int, classes: int = CLASSES, rounds: int = 12) -> Vocabulary:
    """The classes that the given texts alone tell."""
    counts = np.bincount(np.concatenate(texts), minlength=size) if texts else np.zeros(size, np.int64)
    profile, rank = np.zeros(size * COLUMNS, np.float32), ranks(counts)
    for ids in texts:
        np.add.at(profile, neighbours(ids, rank), 1)
    return classes_of(counts, profile.reshape(size, COLUMNS), classes, rounds)


def classes_of(counts: np.ndarray, profile: np.ndarray, classes: int = CLASSES, rounds: int = 12) -> Vocabulary:
    """A class for every id: ids that follow and are followed by the same frequent ids come together (k-means)."""
    used = np.flatnonzero(counts > 0)
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return Vocabulary(out, OWN_IDS + out)
    rows = np.sqrt(profile[used])
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    own = min(classes - 1, len(used))
    # Start from the most frequent ids; they differ most in use.
    centres = rows[most_frequent(counts[used])[:own]].copy()
    heavy = np.sqrt(counts[used])[:, None].astype(np.float32)
    for _ in range(rounds):
        best = (rows @ centres.T).argmax(1)
        for c in range(own):
            members = best == c
            if members.any():
                total = (rows[members] * heavy[members]).sum(0)
                centres[c] = total / max(float(np.linalg.norm(total)), 1e-9)
    out[used] = 1 + (rows @ centres.T).argmax(1)  # ids that no counted text has share class 0
    own_rows = OWN_IDS + out
    frequent = most_frequent(counts)[:OWN_IDS]
    frequent = frequent[counts[frequent] > 0]
    own_rows[frequent] = np.arange(len(frequent))
    return Vocabulary(out, own_rows)


def first_weights(profile: np.ndarray, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Weights that give, as far as the width goes, how often each class follows each of the most frequent ids.

    The logarithms of these shares, less those of the classes themselves, are
    factored: one side is the frequent ids' embedding, the other, with both
    signs through the hidden layer, the output. Attention starts small.
    """
    w = new_weights()
    follow = np.zeros((CLASSES, MARKS + 1))
    np.add.at(follow, vocabulary.classes, profile[:, :MARKS + 1])
    follow = follow.T + 0.5
    whole = np.log(follow.sum(0) / follow.sum())
    heavy = np.sqrt(follow.sum(1, keepdims=True))
    u, s, v = np.linalg.svd(heavy * (np.log(follow / follow.sum(1, keepdims=True)) - whole), full_matrices=False)
    scale = np.sqrt(s[:WIDTH] / heavy.mean())
    left = u[:, :WIDTH] * s[:WIDTH] / heavy / scale
    w["embedding"] = (0.2 * w["embedding"] + left[-1]).astype(np.float32)
    w["embedding"][:MARKS] = left[:-1]  # the most frequent ids have the first rows
    out, same = scale[:, None] * v[:WIDTH], np.eye(WIDTH)
    w["hidden"][:WIDTH] = np.concatenate([same, -same], 1)
    w["hidden"][WIDTH:] *= np.float32(0.3)
    w["out"] = np.concatenate([out, -out]).astype(np.float32)
    w["bias"] = whole.astype(np.float32)
    return w


def fit_windows(texts: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [windows(t, vocabulary) for t in texts]
    if not parts:
        return np.zeros((0, 2 * BLOCK), np.int64), np.zeros((0, BLOCK), np.int64), np.zeros((0, BLOCK), bool)
    return tuple(np.concatenate(p) for p in zip(*parts))


def train(w: dict[str, np.ndarray], data: tuple, steps: int, batch: int = 128, rate: float = RATE, seed: int = 5) -> dict:
    """Adam over shuffled batches of windows, the rate falling to a tenth. Deterministic."""
    adam, rng = Adam(w, rate), np.random.default_rng(seed)
    n = len(data[0])
    for step in range(steps if n else 0):
        adam.rate = rate * (1 - 0.9 * step / steps)
        pick = rng.integers(0, n, min(batch, n))
        adam.step(gradients(adam.w, *(part[pick] for part in data))[1])
    return adam.w


# --- on Spark ---------------------------------------------------------------------------------


def _fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % FOLDS == HELD_OUT


@dataclass(frozen=True)
class Start:
    """What every task starts from: frequent words, classes, first weights."""

    hot: dict[bytes, int]
    vocabulary: Vocabulary
    weights: dict[str, np.ndarray]
    path: str


def frequent_words(docs: DataFrame, most: int = HOT_WORDS) -> dict[bytes, int]:
    """A number for each of the most frequent words of all training texts.

    Every task counts its own texts and sends at most HOT_WORDS words; a task
    with very many different words forgets its rarest. Which words are listed
    changes the cost, never a count.
    """

    def added(held: list[pa.Table], most: int) -> pa.Table:
        """Equal words as one; of very many only the most frequent."""
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])
        return sums if len(sums) <= most else sums.take(np.argsort(-sums["n"].to_numpy(), kind="stable")[:most // 4])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pa.table({"word": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})]
        for batch in batches:
            codes, _, words = split_words(batch.column("text"))
            held.append(pa.table({"word": words, "n": np.bincount(codes, minlength=len(words))}))
            if sum(map(len, held[1:])) > 4 * HOT_WORDS:
                held = [added(held, 8 * HOT_WORDS)]
        counts = added(held, 8 * HOT_WORDS)
        counts = counts.take(np.argsort(-counts["n"].to_numpy(), kind="stable")[:HOT_WORDS]).combine_chunks()
        del held
        pa.default_memory_pool().release_unused()
        yield from counts.to_batches()

    rows = docs.where(~_fold(F.col("doc_id"))).select("text").mapInArrow(run, "word binary, n long")
    frequent = rows.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(most).toPandas()
    return {bytes(w): k for k, w in enumerate(frequent["word"])}


COUNTED = "kind string, word binary, doc long, n long, doc_id long, held_out boolean, ids binary, hot binary"
_ARROW = pa.schema([("kind", pa.string()), ("word", pa.binary()), ("doc", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()),
                    ("held_out", pa.bool_()), ("ids", pa.binary()), ("hot", pa.binary())])


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of the values, ``sizes`` of them an entry."""
    ends = np.concatenate([[0], np.cumsum(sizes) * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


def _rows(kind: str, size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * size, pa.string()) if f.name == "kind" else
         pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _ARROW], schema=_ARROW)


def _encoded(docs: DataFrame, hot_words: dict[bytes, int], path: str) -> DataFrame:
    """One pass over all texts, as rows of several kinds.

    ``doc``: a document's number, its subword ids and frequent words (16 bits
    each), its number of words. ``rare``: any other word of a document, its
    count negative where the document is held out. ``hot`` and ``id``: training
    counts of a task. ``train``: its number of training texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, frequent = subwords(path), shared.value
        hot, ids_seen = np.zeros(len(frequent), np.int64), np.zeros(encoder.size, np.int64)
        trained, number = 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            out = batch.column("held_out").to_numpy(zero_copy_only=False)
            codes, sizes, different = split_words(batch.column("text"))
            listed = different.to_numpy(zero_copy_only=False).tolist()
            numbers = number + np.arange(len(out))
            number += len(out)
            text = np.repeat(np.arange(len(out)), sizes)
            place = np.array([frequent.get(w, -1) for w in listed], np.int64)
            known = place[codes]
            of_text = np.bincount(text[known >= 0], minlength=len(out))
            pairs, rare_n = np.unique(text[known < 0] * max(1, len(listed)) + codes[known < 0], return_counts=True)
            rare_text, rare_code = np.divmod(pairs, max(1, len(listed)))
            ids, id_sizes, word_ids = encoder.texts(listed, codes, sizes)
            # A word's training count in the batch counts for each of its ids.
            counts = np.bincount(codes[~out[text]], minlength=len(listed))
            np.add.at(hot, place[place >= 0], counts[place >= 0])
            np.add.at(ids_seen, word_ids[0], np.repeat(counts, word_ids[1]))
            ids_seen[encoder.end] += (~out).sum()
            trained += int((~out).sum())
            yield _rows("rare", len(pairs), word=different.take(pa.array(rare_code)), doc=numbers[rare_text],
                        n=np.where(out[rare_text], -rare_n, rare_n))
            yield _rows("doc", len(out), doc=numbers, n=sizes, ids=_binary(ids, id_sizes),
                        hot=_binary(known[known >= 0].astype(np.uint16), of_text),
                        doc_id=batch.column("doc_id"), held_out=batch.column("held_out"))
        used, seen = np.flatnonzero(hot), np.flatnonzero(ids_seen)
        yield _rows("hot", len(used), doc=used, n=hot[used])
        yield _rows("id", len(seen), doc=seen, n=ids_seen[seen])
        yield _rows("train", 1, doc=[0], n=[trained])

    return docs.select("doc_id", "text", _fold(F.col("doc_id")).alias("held_out")).mapInArrow(run, COUNTED)


def _total(encoded: DataFrame, kind: str, size: int) -> np.ndarray:
    """The sum over all tasks of a kind of counts, by number."""
    rows = encoded.where(F.col("kind") == kind).groupBy("doc").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["doc"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def _learned(encoded: DataFrame) -> DataFrame:
    return encoded.where("kind = 'doc' AND NOT held_out")


def begun(encoded: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[Vocabulary, dict[str, np.ndarray]]:
    """Classes and first weights, from counts of all ids and their neighbours in all training texts.

    The neighbours are counted in the tasks and added up by cell. One task
    makes the classes of them; there are at most COLUMNS cells an id, however
    large the corpus.
    """
    rank = ranks(counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = np.zeros(len(counts) * COLUMNS, np.int32)
        for batch in batches:
            texts = [np.frombuffer(raw, np.uint16) for raw in batch.column("ids").to_pylist()]
            np.add.at(profile, np.concatenate([neighbours(t, rank) for t in texts]), np.int32(1))
        cells = np.flatnonzero(profile)
        for at in range(0, len(cells), 1 << 16):
            some = cells[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(profile[some].astype(np.int64))], ["cell", "n"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = np.zeros(len(counts) * COLUMNS, np.float32)
        for batch in batches:
            profile[batch.column("cell").to_numpy()] = batch.column("n").to_numpy()
        profile = profile.reshape(len(counts), COLUMNS)
        vocabulary = classes_of(counts, profile, rounds=rounds)
        fitted = pickle.dumps((vocabulary, first_weights(profile, vocabulary)))
        yield pa.RecordBatch.from_arrays([pa.array([fitted], pa.binary())], ["fitted"])

    cells = _learned(encoded).select("ids").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    row = cells.repartition(1).mapInArrow(fit, "fitted binary").head()
    return pickle.loads(bytes(row["fitted"])) if row else (classes_of(counts, np.zeros((len(counts), 0))), new_weights())


def start(docs: DataFrame, path: str, texts: int = FIT_TEXTS, hot_words: int = HOT_WORDS, steps: int = ROUNDS) -> Start:
    """Frequent words, id classes and first weights of all training texts.

    Nothing is sampled. ``steps`` limits the rounds of the k-means; ``texts``
    only has a part in training, see ``trained``.
    """
    hot = frequent_words(docs, hot_words)
    encoded = stage(_encoded(docs, hot, path), "counts")
    return Start(hot, *begun(encoded, _total(encoded, "id", subwords(path).size), steps), path)


def trained(texts: DataFrame, vocabulary: Vocabulary, weights: dict[str, np.ndarray], done: int = 0, held_texts: int = FIT_TEXTS) -> DataFrame:
    """Rows of the kinds ``windows``, how many a task has learned from, and ``weights``: what it has trained, and its steps.

    Each task goes over every window of its texts (ids) once. ``done`` steps
    were taken before; the rate falls with them. A task holds the windows of at
    most ``held_texts`` texts before it learns from them.
    """
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first = shared.value
        adam = Adam(first)
        held: list[np.ndarray] = []
        rest: tuple = ()  # blocks that were too few for a step, after one that only stands before them
        held_n = steps = learned = 0

        def learn(least: int) -> None:
            """Steps over the windows held, as long as they are that many."""
            nonlocal held, rest, held_n, steps, learned
            parts = stream(held, known)[:3]
            if rest:
                parts = tuple(map(np.concatenate, zip(rest, parts)))
            inputs, targets, mask = parts
            full, at = np.flatnonzero(mask[:, 0]), 0  # the others are begin blocks
            while len(full) - at >= least:
                some = full[at:at + STEP_WINDOWS]
                first, last = some[0], some[-1] + 1
                adam.rate = RATE / np.sqrt(1 + (done + steps) / 50)
                adam.step(gradients(adam.w, inputs[first - 1:last], targets[first:last], mask[first:last], BLOCK)[1])
                at, steps, learned = at + len(some), steps + 1, learned + len(some)
            held, held_n, rest = [], len(full) - at, ()
            if held_n:
                rest = tuple(p[full[at] - 1:].copy() for p in parts)
                rest[2][0] = False

        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                held.append(np.frombuffer(raw, np.uint16))
                held_n += -(-len(held[-1]) // BLOCK)
                if held_n >= 8 * STEP_WINDOWS or len(held) > held_texts:
                    learn(STEP_WINDOWS)
        if held_n:
            learn(1)
        yield _rows("windows", 1, doc=[0], n=[learned])
        flat = np.concatenate([adam.w[k].ravel() for k in sorted(adam.w)]).astype(np.float32)
        yield _rows("weights", 1, n=[steps], ids=[flat.tobytes()])

    return texts.select("ids").mapInArrow(run, COUNTED)


def _counted(docs: DataFrame, begin: Start) -> DataFrame:
    """All rows of ``_encoded`` and ``trained`` for the texts."""
    encoded = stage(_encoded(docs, begin.hot, begin.path), "counts")
    return encoded.unionByName(trained(_learned(encoded), begin.vocabulary, begin.weights))


@dataclass(frozen=True)
class Fitted:
    """What scoring needs, on every executor: bounded by the vocabulary, the frequent words and the model."""

    hot_counts: np.ndarray
    vocabulary: Vocabulary
    within: np.ndarray  # log10 of an id's share of its class
    weights: dict[str, np.ndarray]


def _averaged(rows: Iterable[tuple[int, bytes]], like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The tasks' weights, averaged by their number of steps."""
    total, sum_ = 0, None
    for steps, raw in rows:
        flat = np.frombuffer(raw, np.float32).astype(np.float64) * steps
        sum_ = flat if sum_ is None else sum_ + flat
        total += steps
    if not total:
        return like
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = (sum_[at:at + n] / total).reshape(like[k].shape).astype(np.float32)
        at += n
    return out


def batch_scores(fitted: Fitted, texts: list[np.ndarray], limit: int = NEAR) -> np.ndarray:
    """log10 probabilities of many texts; their windows go through the model together, ``limit`` at a time."""
    inputs, targets, mask, begins = stream(texts, fitted.vocabulary)
    model, rows, goal = Pass(fitted.weights), inputs.ravel(), targets.ravel()
    per = np.zeros(len(goal))
    for at in range(1, len(inputs), limit):
        n = min(limit, len(inputs) - at)
        some = slice(at * BLOCK, (at + n) * BLOCK)
        per[some] = model.log_shares(rows[(at - 1) * BLOCK:(at + n) * BLOCK], goal[some], n, BLOCK)
    per *= mask.ravel()
    shares = fitted.within[np.concatenate(texts)]
    ends = np.cumsum([len(t) for t in texts])
    return np.add.reduceat(per, begins * BLOCK) / np.log(10) + np.add.reduceat(shares, np.append(0, ends[:-1]))


SCORED = "doc long, doc_id long, held_out boolean, n_tokens long, hot_known long, hot_sum double, score double"


def _scored(rows: DataFrame, fitted: Fitted) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        logs, known = np.log10(model.hot_counts + 0.5), model.hot_counts > 0
        for batch in batches:
            hot = [np.frombuffer(h, np.uint16) for h in batch.column("hot").to_pylist()]
            texts = [np.frombuffer(i, np.uint16) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "doc_id", "held_out")),
                 pa.array([n + 1 for n in batch.column("n").to_pylist()], pa.int64()),
                 pa.array([int(known[h].sum()) for h in hot], pa.int64()),
                 pa.array([float(logs[h].sum()) for h in hot], pa.float64()),
                 pa.array(batch_scores(model, texts), pa.float64())],
                ["doc", "doc_id", "held_out", "n_tokens", "hot_known", "hot_sum", "score"])

    return rows.select("doc", "doc_id", "held_out", "n", "ids", "hot").mapInArrow(run, SCORED)


def scores(docs: DataFrame, path: str | None = None, fit_texts: int = FIT_TEXTS, hot_words: int = HOT_WORDS,
           steps: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Null text is empty: one token, the end. Null doc_id has the checksum of the
    empty text and is training. Repeated rows count and score each. An empty
    table gives no rows; with no training text every count is zero.

    A row is known by a number that it gets in the one pass that encodes the
    texts; what is counted, learned and scored by that number is staged with it.
    """
    path = path or tokenizer_path()
    frequent = frequent_words(docs, hot_words)
    counted = stage(_encoded(docs, frequent, path), "counts")
    hot, ids = _total(counted, "hot", len(frequent)), _total(counted, "id", subwords(path).size)
    texts_trained = int(_total(counted, "train", 1)[0])
    vocabulary, weights = begun(counted, ids, steps)
    done = 0
    for turn in range(2 * PASSES):
        first = turn % 2 == 0
        if first and turn and done >= LEAST_STEPS:
            break
        part = _learned(counted).where((F.pmod("doc", F.lit(FIRST_PART)) == 0) == F.lit(first))
        learned = stage(trained(part, vocabulary, weights, done, fit_texts), "weights").where("kind = 'weights'").select("n", "ids")
        # One small vector a task, streamed: the driver holds the running mean alone.
        done += int(learned.agg(F.max("n")).head()[0] or 0)
        weights = _averaged(((r["n"], r["ids"]) for r in learned.toLocalIterator()), weights)
    smooth = ids + 0.5
    of_class = np.bincount(vocabulary.classes, smooth, CLASSES)
    fitted = Fitted(hot, vocabulary, np.log10(smooth / of_class[vocabulary.classes]), weights)
    scored = stage(_scored(counted.where("kind = 'doc'"), fitted), "scores")

    # Rare words: one shuffle by word gives each word's training count beside its documents.
    by_word = Window.partitionBy("word")
    rare = counted.where("kind = 'rare'").select(
        "doc", F.abs("n").alias("n"), F.sum(F.greatest("n", F.lit(0))).over(by_word).alias("c"),
        F.min("doc").over(by_word).alias("first"))
    # A word has one row a document, so it is counted once, at its first document.
    rare = rare.select("doc", "n", "c", F.when((F.col("first") == F.col("doc")) & (F.col("c") > 0), 1).otherwise(0).alias("new"))
    by_doc = stage(rare.groupBy("doc").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("rare_sum"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum("new").alias("new")), "rare")
    total = scored.where("NOT held_out").agg(F.sum("n_tokens")).head()[0] or 0
    different = (by_doc.agg(F.sum("new")).head()[0] or 0) + int((hot > 0).sum()) + (texts_trained > 0)
    spread = np.log10(total + 0.5 * (different + 1))
    end = float(np.log10(texts_trained + 0.5))
    return scored.join(by_doc, "doc", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(texts_trained > 0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(float(spread)))
        .alias("base_score"),
        "score")
