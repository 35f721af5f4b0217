"""Ranked lexical search with per-term geometric blocking, exact.

1. ``forward``: one pass over the texts counts the terms of the queries in
   each document; document frequencies and lengths are counted over all
   documents.
2. ``build``: documents are range-sorted by a sketch of their weighted terms
   and stored in chunks of similar documents. In a chunk, the posting list of
   each term is clustered by the similarity of its documents into blocks; a
   block keeps its coordinatewise maximum over all query terms. A short list is
   blocks of one document, which need no other summary than the document.
3. ``search``: the product of a query and a block's summary bounds the score
   of every document in the block. A first pass scores the best block of every
   chunk, which gives each query a score that its last rank must reach. The
   second pass skips a block only if its bound is below that score, and scores
   the documents of all others in full.

The queries are the stated query set; they are worked on in parts of at most
``PART_TERMS`` different terms, which is what is sent to the tasks. The index
holds every document that has a query term. No task holds more than a chunk
and the best documents of each query.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from demandloom.llm.common import stage, texts_of

BEST = 50
#: Different terms of the queries of one part.
PART_TERMS = 1 << 16
#: Documents of a chunk, and postings that a block should hold.
CHUNK, BLOCK = 512, 128
#: Posting lists up to this length are left as single documents: a document's own row is its summary, and its score its bound.
SHORT = 64
#: Directions of the sketch, and how many of their signs order the documents.
DIRECTIONS, SIGNS = 32, 16
SEED = 11

# Digits, letters and all bytes of longer characters stay, only A-Z are lower-cased; every other byte separates terms.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


@dataclass(frozen=True)
class Part:
    """Some queries: number and id of each, its terms' numbers, and the number of every term."""

    items: list[tuple[int, object, np.ndarray]]
    vocabulary: dict[bytes, int]


def parts_of(benchmark: DataFrame, most: int = PART_TERMS) -> Iterator[Part]:
    """The queries in parts, read one after the other. A query with more terms than a part has is a part of its own."""
    items: list[tuple[int, object, list[bytes]]] = []
    seen: set[bytes] = set()

    def close() -> Part:
        numbers = {t: k for k, t in enumerate(sorted(seen))}
        return Part([(k, i, np.array(sorted(numbers[t] for t in own), np.int64)) for k, i, own in items], numbers)

    for number, row in enumerate(benchmark.select("item_id", "text").toLocalIterator()):
        own = sorted(set(terms_of(row["text"] or "")))
        if items and len(seen.union(own)) > most:
            yield close()
            items, seen = [], set()
        if own:
            items.append((number, row["item_id"], own))
            seen.update(own)
    if items:
        yield close()


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """uid, doc_id, number of terms, and the vocabulary's terms with their counts, of every document that has a term."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, found, counts = [], [], [], []
            for k, text in enumerate(texts_of(batch)):
                own = terms_of(text)
                if own:
                    counted = Counter(own)
                    pairs = sorted((vocabulary[t], c) for t, c in counted.items() if t in vocabulary)
                    rows.append(k)
                    sizes.append(len(own))
                    found.append([t for t, _ in pairs])
                    counts.append([c for _, c in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "n", "terms", "counts"])

    read = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, counts array<int>")
    return stage(read.withColumn("uid", F.monotonically_increasing_id()), "forward")


@dataclass(frozen=True)
class Weights:
    """Numbers of documents and terms of the collection, and each query term's weight."""

    documents: int
    terms: int
    term: np.ndarray

    def parts(self, counts: np.ndarray, n: int) -> np.ndarray:
        """The terms' shares of a score before their weight."""
        m = 50 + (50 * n * self.documents) // self.terms
        return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def weigh(rows: DataFrame, size: int) -> Weights:
    """Counted over all documents; one row per query term reaches the driver."""
    total = rows.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    n, found = total["documents"], np.zeros(size, np.int64)
    for row in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        found[row["term"]] = row["count"]
    return Weights(n, total["terms"] or 1, np.array([floor(1000 * log((2 * n + 2) / (2 * df + 1))) for df in found.tolist()], np.int64))


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, DIRECTIONS), np.float32)


def cluster(lists: list[np.ndarray], sketches: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list of each block, where it begins, members): every posting list cut at its most even sample of documents.

    A long list takes every so manieth document as a centre and each document goes to the centre most like it.
    """
    owners, sizes, members = [], [], []
    for k, own in enumerate(lists):
        centres = -(-len(own) // block)
        if centres > 1:
            picked = own[np.linspace(0, len(own) - 1, centres).astype(np.int64)]
            nearest = (sketches[own] @ sketches[picked].T).argmax(axis=1)
            own = own[np.argsort(nearest, kind="stable")]
            filled = np.bincount(nearest, minlength=centres)
            filled = filled[filled > 0]
        else:
            filled = np.array([len(own)])
        owners += [k] * len(filled)
        sizes.append(filled)
        members.append(own)
    sizes = np.concatenate(sizes)
    return np.array(owners), np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.concatenate(members)


INDEX = "documents int, chunk binary"
CODEC = "zstd"


def packed(found: dict) -> bytes:
    """The arrays of a chunk as one compressed value, so that a task unpacks one chunk at a time."""
    plain = pickle.dumps({k: v.astype(np.int32) if isinstance(v, np.ndarray) else v for k, v in found.items()}, 5)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, CODEC, asbytes=True)


def unpacked(chunk: bytes) -> dict:
    return pickle.loads(pa.decompress(chunk[8:], int.from_bytes(chunk[:8], "little"), CODEC, asbytes=True))


def dense(starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(starts), width), np.int32)
    sizes = np.diff(np.append(starts, len(columns)))
    out[np.repeat(np.arange(len(starts)), sizes), columns] = values
    return out


def index_chunk(rows: list[tuple], weights: Weights, axes: np.ndarray, block: int, short: int = SHORT) -> dict:
    """The stored arrays of one chunk; rows: (doc_id, terms, parts)."""
    sizes = np.array([len(t) for _, t, _ in rows])
    terms, parts = np.concatenate([t for _, t, _ in rows]), np.concatenate([p for _, _, p in rows])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    used, column = np.unique(terms, return_inverse=True)
    x = dense(starts, column, parts, len(used))
    sketches = x.astype(np.float32) @ (axes[used] * weights.term[used, None].astype(np.float32))
    sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)
    owner, begin, members = cluster([np.flatnonzero(c) for c in x.T], sketches, block)
    ends = np.append(begin[1:], len(members))
    long = np.array([np.count_nonzero(c) for c in x.T])[owner] > short
    kept, entries, tops = np.zeros(len(begin), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for b in np.flatnonzero(long):
        most = x[members[begin[b]:ends[b]]].max(axis=0)
        column = np.flatnonzero(most)
        kept[b] = len(column)
        entries.append(used[column])
        tops.append(most[column])
    return {"doc_ids": [d for d, _, _ in rows], "starts": starts, "terms": terms, "parts": parts, "block_terms": used[owner],
            "block_starts": begin, "block_long": long, "members": members, "top_starts": np.concatenate([[0], np.cumsum(kept)[:-1]]),
            "top_terms": np.concatenate(entries), "tops": np.concatenate(tops)}


def build(rows: DataFrame, weights: Weights, chunk: int = CHUNK, block: int = BLOCK, short: int = SHORT) -> DataFrame:
    """The stored index over the rows of ``forward``: one row per chunk of similar documents."""
    size = len(weights.term)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = directions(size)
        bits = 1 << np.arange(SIGNS, dtype=np.int64)[::-1]
        for batch in batches:
            codes, shares = [], []
            for n, terms, counts in zip(*[batch.column(c).to_pylist() for c in ("n", "terms", "counts")]):
                terms = np.array(terms, np.int64)
                own = weights.parts(np.array(counts, np.int64), n)
                shares.append(own.tolist())
                codes.append(int((((weights.term[terms] * own).astype(np.float32) @ axes[terms])[:SIGNS] > 0) @ bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id"), batch.column("terms"), pa.array(shares, pa.list_(pa.int32())), pa.array(codes, pa.int64())],
                ["uid", "doc_id", "terms", "parts", "code"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, held = directions(size), []

        def made(part: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"documents": pa.array([len(part)], pa.int32()),
                                               "chunk": [packed(index_chunk(part, weights, axes, block, short))]})

        for batch in batches:
            held += [(d, np.array(t, np.int64), np.array(p, np.int64)) for d, t, p in zip(
                *[batch.column(c).to_pylist() for c in ("doc_id", "terms", "parts")])]
            while len(held) >= chunk:
                yield made(held[:chunk])
                held = held[chunk:]
        if held:
            yield made(held)

    some = rows.where(F.size("terms") > 0).select("uid", "doc_id", "n", "terms", "counts")
    coded = some.mapInArrow(sketch, f"uid long, doc_id {kind}, terms array<int>, parts array<int>, code long")
    near = coded.repartitionByRange("code", "uid").sortWithinPartitions("code", "uid").select("doc_id", "terms", "parts")
    return stage(near.mapInArrow(chunks, INDEX), "index")


class Best:
    """The highest-scoring documents of each query that a task has seen: score descending, doc_id ascending, null last."""

    def __init__(self, best: int):
        self.best, self.rows = best, {}

    def add(self, item: int, ids: list, scores: np.ndarray) -> None:
        rows = self.rows.setdefault(item, [])
        rows += [(-s, d is None, d or 0) for d, s in zip(ids, scores.tolist())]
        if len(rows) > 20 * self.best:
            self.rows[item] = sorted(rows)[:self.best]

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        out = [(item, None if none else d, -s) for item, rows in self.rows.items() for s, none, d in sorted(rows)[:self.best]]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], kind), pa.array([o[2] for o in out], pa.int64())],
            ["item", "doc_id", "score"])


def scan(index: DataFrame, part: Part, weights: Weights, least: dict[int, int] | None, best: int, kind: DataType) -> DataFrame:
    """item, doc_id, score: the best documents of each task. Without ``least`` only each chunk's best block, and its single documents, are scored."""
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Best(best)
        for batch in batches:
            for row in batch.column("chunk"):
                get = unpacked(row.as_py())
                ids = get["doc_ids"]
                used, column = np.unique(get["terms"], return_inverse=True)
                x = dense(get["starts"], column, get["parts"], len(used))
                summary = dense(get["top_starts"], np.searchsorted(used, get["top_terms"]), get["tops"], len(used))
                owner, long = np.searchsorted(used, get["block_terms"]), get["block_long"] > 0
                ends = np.append(get["block_starts"][1:], len(get["members"]))
                first = np.searchsorted(owner, np.arange(len(used) + 1))  # blocks are stored in the order of their terms
                for number, _, wanted in part.items:
                    at = np.searchsorted(used, wanted)
                    at = at[(at < len(used)) & (used[np.minimum(at, len(used) - 1)] == wanted)]
                    if not len(at):
                        continue
                    blocks = np.concatenate([np.arange(first[c], first[c + 1]) for c in at])
                    weight = weights.term[used[at]]
                    single, blocks = blocks[~long[blocks]], blocks[long[blocks]]
                    bounds = summary[blocks[:, None], at].astype(np.int64) @ weight
                    if least is None:
                        blocks = blocks[[bounds.argmax()]] if len(blocks) else blocks
                    else:
                        blocks = blocks[(bounds >= least.get(number, 0)) & (bounds > 0)]
                    blocks = np.concatenate([single, blocks])
                    if not len(blocks):
                        continue
                    hit = np.unique(np.concatenate([get["members"][get["block_starts"][b]:ends[b]] for b in blocks]))
                    scores = x[hit[:, None], at].astype(np.int64) @ weight
                    good = scores >= max(1, (least or {}).get(number, 1))
                    if good.sum() > best:  # of one chunk no more than the best can matter; ties stay
                        good &= scores >= np.partition(scores, len(scores) - best)[len(scores) - best]
                    top.add(number, [ids[k] for k in hit[good]], scores[good])
        yield top.batch(id_type)

    return index.select("chunk").mapInArrow(run, f"item long, doc_id {kind.simpleString()}, score long")


def ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def search(docs: DataFrame, benchmark: DataFrame, best: int = BEST, chunk: int = CHUNK, block: int = BLOCK, short: int = SHORT,
           part_terms: int = PART_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of every query by the fixed formula, scores above 0 only.

    Equal scores come by ascending doc_id, null last. Null texts have no term.
    Every query row is ranked by itself, also with a null or repeated item_id;
    one without a term finds nothing. Repeated documents are ranked each. Empty
    tables give no rows. Other columns take no part.
    """
    spark = docs.sparkSession
    kinds = {"item_id": benchmark.schema["item_id"].dataType, "doc_id": docs.schema["doc_id"].dataType}
    results = []
    for part in parts_of(benchmark, part_terms):
        rows = forward(docs, part.vocabulary)
        weights = weigh(rows, len(part.vocabulary))
        index = build(rows, weights, chunk, block, short)
        seeds = ranked(scan(index, part, weights, None, best, kinds["doc_id"]), best).where(F.col("rank") == best).collect()
        least = {r["item"]: r["score"] for r in seeds}  # one number per query of the part
        named = spark.createDataFrame([Row(item=k, item_id=i) for k, i, _ in part.items], f"item long, item_id {kinds['item_id'].simpleString()}")
        found = ranked(scan(index, part, weights, least, best, kinds["doc_id"]), best)
        results.append(found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kinds['item_id'].simpleString()}, rank int, doc_id {kinds['doc_id'].simpleString()}, score long")
    return reduce(DataFrame.unionByName, results)
