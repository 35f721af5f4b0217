"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into passages of ``2 * BLOCK`` words
that overlap by half. Passages are TF-IDF vectors. A distributed randomised SVD
of corpus and benchmark passages gives a latent space over the benchmark's
vocabulary; document passages with a high cosine to an item's passage are
candidates. Longest common subsequence and an answer check on the words
themselves decide. The benchmark is the stated query set; it is worked on in
blocks of ``QUERIES`` passages, each with its own space, all in one pass over
the documents.

What is counted (document frequencies), fitted and searched covers every
passage of the corpus and the benchmark. For the fit each task adds up what its
passages give to A^T A over the words of each space, the tasks' sums are added
on Spark, and the iterations work with the result.
Small blocks keep the work low: a document passage meets only those spaces
whose few words make up enough of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from demandloom.llm.common import passing, stage

BLOCK = 8
BUCKETS = 1 << 16
QUERIES = 32
RANK = 64
#: Different words of the spaces that are fitted in one pass over the corpus (64 MB of sums a task at most).
FIT_WORDS = 1 << 12
#: Words whose passages are weighed together.
SOME_WORDS = 200_000
#: Benchmark words that are sent to every task at once (some 60 spaces); a larger benchmark takes several passes.
ITEM_WORDS = 16_000

# ASCII punctuation and controls separate words, so that "end," is the word "end".
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class Rules:
    """Cosine of a candidate; shares of an item's words in common, alone or with the answer's."""

    cosine: float = 0.4
    common: float = 0.6
    common_with_answer: float = 0.4
    answer: float = 0.8
    answer_words: int = 8


RULES = Rules()


def word_hashes(text: str | None) -> np.ndarray:
    """A 32-bit checksum of every word of the text, in lower case."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def hashed(docs: DataFrame, name: str) -> DataFrame:
    """The frame with the word checksums of its texts appended under the name, four bytes a word."""
    schema = StructType([*docs.schema.fields, StructField(name, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([word_hashes(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def passages(n: int, block: int = BLOCK) -> list[tuple[int, int]]:
    """Start and end of the passages of n words: two blocks each, one block apart; a short text is one passage."""
    return [(s, min(n, s + 2 * block)) for s in range(0, max(1, n - block), block)] if n else []


def block_buckets(texts: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """(the different buckets of every block of the texts, one after the other; number of blocks)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // BLOCK)
    # One row a block; a row's last places may be empty.
    grid = np.full(int(counts.sum()) * BLOCK, -1, np.int32)
    shift = (np.cumsum(counts) - counts) * BLOCK - (np.cumsum(sizes) - sizes)
    if len(grid):
        grid[np.arange(int(sizes.sum())) + np.repeat(shift, sizes)] = np.concatenate(texts) & np.uint32(BUCKETS - 1)
    places = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
    once = places >= 0
    for k in range(1, BLOCK):
        for before in range(k):
            once[k] &= places[k] != places[before]
    return places[once], int(counts.sum())


def document_frequencies(marked: DataFrame, name: str) -> tuple[np.ndarray, int]:
    """(blocks that hold each bucket, number of blocks) over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, blocks = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            buckets, n = block_buckets([np.frombuffer(raw, np.uint32) for raw in batch.column(name).to_pylist()])
            total += np.bincount(buckets, minlength=BUCKETS)
            blocks += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, BUCKETS)), pa.array(np.append(total[used], blocks))],
                                         ["bucket", "n"])

    rows = marked.select(name).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out[:BUCKETS], int(out[BUCKETS])


def weights(frequencies: np.ndarray, blocks: int) -> np.ndarray:
    """The inverse document frequency of every bucket."""
    return np.log((blocks + 1) / (frequencies + 1)).astype(np.float32) + np.float32(0.05)


# --- the latent space -----------------------------------------------------------------------


@dataclass
class Sparse:
    """Rows of (column, value), as compressed sparse rows."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def times(self, m: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.zeros((0, m.shape[1]), np.float32)
        return np.add.reduceat(m[self.columns] * self.values[:, None], self.starts)

    def transposed_times(self, y: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, y.shape[1]), np.float32)
        if len(self.columns):
            rows = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(self.columns))))
            order = np.argsort(self.columns, kind="stable")
            sorted_ = self.columns[order]
            cuts = np.flatnonzero(np.diff(sorted_, prepend=-1))
            out[sorted_[cuts]] = np.add.reduceat((y[rows] * self.values[:, None])[order], cuts)
        return out


def known(ids: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of words in the vocabulary, their columns)."""
    at = np.searchsorted(vocabulary, ids)
    at[at == len(vocabulary)] = 0
    hit = np.flatnonzero(vocabulary[at] == ids) if len(vocabulary) else np.zeros(0, np.int64)
    return hit, at[hit]


def sparse_passages(texts: list[np.ndarray], vocabulary: np.ndarray, idf: np.ndarray) -> Sparse:
    """The passages of the texts over the vocabulary, scaled to length one over all their words. Empty rows are left out."""
    starts, columns, values, n = [], [], [], 0
    for ids in texts:
        weight = idf[ids & np.uint32(BUCKETS - 1)]
        for a, b in passages(len(ids)):
            hit, column = known(ids[a:b], vocabulary)
            if len(hit):
                starts.append(n)
                columns.append(column)
                values.append(weight[a:b][hit] / length(ids[a:b], weight[a:b]))
                n += len(hit)
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return Sparse(np.array(starts, np.int64), join(columns, np.int64), join(values, np.float32))


def length(ids: np.ndarray, weight: np.ndarray) -> float:
    """The Euclidean length of a passage's TF-IDF vector."""
    order = np.argsort(ids, kind="stable")
    cuts = np.flatnonzero(np.diff(ids[order].astype(np.int64), prepend=-1))
    return float(np.sqrt((np.add.reduceat(weight[order], cuts) ** 2).sum()))


@dataclass
class Weighed:
    """The different words of all passages of some texts, sorted by passage."""

    passage: np.ndarray
    word: np.ndarray
    bucket: np.ndarray
    weight: np.ndarray
    norm: np.ndarray  # of every passage
    counts: np.ndarray  # passages of every text
    first: np.ndarray  # number of its first one


def weigh(texts: list[np.ndarray], idf: np.ndarray) -> Weighed:
    """The TF-IDF vectors of all passages, in a few array steps for all texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - BLOCK) // BLOCK)), 0)  # as in passages()
    first = np.cumsum(counts) - counts
    block = (np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // BLOCK
    begins, follows = block < np.repeat(counts, sizes), block > 0
    passage = np.repeat(first, sizes) + block
    # A word stands in the passage that begins with its block and in the one before.
    key = np.concatenate([passage[begins], passage[follows] - 1]) << 32
    key |= np.concatenate([ids[begins], ids[follows]])
    key.sort()
    cuts = np.flatnonzero(np.diff(key, prepend=-1))
    passage, word = key[cuts] >> 32, (key[cuts] & 0xFFFFFFFF).astype(np.uint32)
    bucket = word & np.uint32(BUCKETS - 1)
    weight = idf[bucket] * np.diff(cuts, append=len(key)).astype(np.float32)
    norm = np.sqrt(np.bincount(passage, weight.astype(np.float64) ** 2, int(counts.sum())))
    return Weighed(passage, word, bucket, weight, norm, counts, first)


def _some(texts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The texts in order, some ``SOME_WORDS`` words at a time (a longer text alone)."""
    some, held = [], 0
    for ids in texts:
        some.append(ids)
        held += len(ids)
        if held >= SOME_WORDS:
            yield some
            some, held = [], 0
    if some:
        yield some


def _packed(row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Places of a symmetric matrix kept as rows up to the diagonal; column <= row."""
    return row * (row + 1) // 2 + column


def add_products(part: Weighed, vocabulary: np.ndarray, listed: np.ndarray, sums: np.ndarray) -> None:
    """Add A^T A to the packed sums, for the matrix A of the passages over the vocabulary, rows of length one over all their words."""
    hit = np.flatnonzero(listed[part.bucket])
    own, column = known(part.word[hit], vocabulary)
    hit, column = hit[own], column.astype(np.int64)
    passage = part.passage[hit]
    values = part.weight[hit] / part.norm[passage]
    # The words of a passage stand together in rising order; each is paired with itself and those before it.
    at = np.arange(len(hit))
    for back in range(2 * BLOCK):
        at = at[at >= back]
        at = at[passage[at] == passage[at - back]]
        if not len(at):
            break
        np.add.at(sums, _packed(column[at], column[at - back]), values[at] * values[at - back])


def corpus_products(marked: DataFrame, name: str, idf: np.ndarray, vocabularies: list[np.ndarray]) -> list[np.ndarray]:
    """A^T A over each vocabulary, for the matrix A of all passages of the corpus.

    Tasks are a few for each core, so that what they send does not grow with
    the corpus, and their sums are added by matrix row on Spark.
    """
    spark = marked.sparkSession
    out = [np.zeros((len(v), len(v)), np.float64) for v in vocabularies]
    tasks = min(marked.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism)
    at = 0
    while at < len(vocabularies):
        union, end = vocabularies[at], at + 1
        while end < len(vocabularies) and len(more := np.union1d(union, vocabularies[end])) <= FIT_WORDS:
            union, end = more, end + 1
        listed = np.zeros(BUCKETS, bool)
        listed[union & np.uint32(BUCKETS - 1)] = True
        places = [np.searchsorted(union, v) for v in vocabularies[at:end]]
        shared = spark.sparkContext.broadcast((union, listed, places, idf))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, listed_, own, weights_ = shared.value
            sums = np.zeros(len(words) * (len(words) + 1) // 2)
            for batch in batches:
                for some in _some([np.frombuffer(r, np.uint32) for r in batch.column(name).to_pylist()]):
                    add_products(weigh(some, weights_), words, listed_, sums)
            for k, place in enumerate(own):
                full = sums[_packed(np.maximum.outer(place, place), np.minimum.outer(place, place))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(place), pa.int64()), pa.array(range(len(place)), pa.int64()),
                     pa.array([row.tobytes() for row in full], pa.binary())], ["block", "line", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for k, line, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "line", "sums"))):
                    row = np.frombuffer(raw, np.float64)
                    total[k, line] = total[k, line] + row if (k, line) in total else row
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in total], pa.int64()), pa.array([x for _, x in total], pa.int64()),
                 pa.array([t.tobytes() for t in total.values()], pa.binary())], ["block", "line", "sums"])

        schema = "block long, line long, sums binary"
        parts = marked.select(name).coalesce(tasks).mapInArrow(run, schema)
        for row in parts.repartition(8, "block", "line").mapInArrow(add, schema).toLocalIterator():
            out[at + row["block"]][row["line"]] = np.frombuffer(row["sums"], np.float64)
        shared.unpersist()
        at = end
    return out


def latent_axes(marked: DataFrame, name: str, idf: np.ndarray, blocks: list[tuple[np.ndarray, list[np.ndarray]]],
                rank: int = RANK, rounds: int = 2) -> list[np.ndarray]:
    """Right singular vectors (vocabulary x rank) for each block (vocabulary, queries), of its queries and the corpus.

    Randomised subspace iteration with the corpus' A^T A over the block's
    vocabulary, which Spark adds up over all passages. The corpus' part is
    scaled to a tenth of the queries': the directions of the queries must be in
    the space, whatever the corpus is full of.
    """
    owns = [sparse_passages(queries, vocabulary, idf) for vocabulary, queries in blocks]
    rng = np.random.default_rng(7)
    axes = []
    for (vocabulary, _), own in zip(blocks, owns):
        width = min(rank, len(vocabulary), len(own.starts) + 32)
        axes.append(np.linalg.qr(rng.standard_normal((len(vocabulary), width)).astype(np.float32))[0])
    products = corpus_products(marked, name, idf, [vocabulary for vocabulary, _ in blocks])
    for k, own in enumerate(owns):
        for _ in range(rounds):
            corpus = (products[k] @ axes[k]).astype(np.float32)
            mine = own.transposed_times(own.times(axes[k]), len(blocks[k][0]))
            scale = 0.1 * np.linalg.norm(mine) / max(float(np.linalg.norm(corpus)), 1e-9)
            axes[k] = np.linalg.qr(mine + np.float32(scale) * corpus)[0].astype(np.float32)
    return axes


@dataclass
class Space:
    """One block of queries: vocabulary, axes, the queries' unit latent vectors and their items."""

    vocabulary: np.ndarray
    axes: np.ndarray
    latent: np.ndarray
    items: np.ndarray

    def __post_init__(self):
        #: What a word of weight one adds to its passage's product with each query; the largest of these, 0 at least.
        self.products = self.axes @ self.latent.T
        self.most = np.maximum(self.products.max(axis=1, initial=0), 0).astype(np.float64)


# --- exact checks ---------------------------------------------------------------------------


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence; one machine-wide row of bits per word of b."""
    where: dict[int, int] = {}
    for k, word in enumerate(a):
        where[word] = where.get(word, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        hit = row & where.get(word, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def checked(item: list[int], ids: np.ndarray, a: int, b: int, rules: Rules) -> tuple[float, float]:
    """Shares of the item's words, and of its last words (the answer), in order in the text around a passage."""
    reach = len(item)
    around = ids[max(0, a - reach):b + reach].tolist()
    tail = item[-rules.answer_words:]
    return common_subsequence(item, around) / len(item), common_subsequence(tail, around) / len(tail)


def leaked(common: float, answer: float, rules: Rules) -> bool:
    return common >= rules.common or (common >= rules.common_with_answer and answer >= rules.answer)


def search(texts: list[np.ndarray], index: "Index", rules: Rules) -> list[dict[int, tuple[float, float, float]]]:
    """For each text: item -> (cosine, common, answer) of its best passage, for the leaks in it.

    A passage's cosine with a query is a sum over its words, so it is at most
    the sum of what each word adds for the query it serves best. Passages for
    which that is too little over all spaces are dropped first, then those for
    which it is in a space, which loses no candidate. Texts are searched
    together, some 200,000 words at a time (a longer text alone), so that the
    work is in few large array steps.
    """
    return [found for some in _some(texts) for found in _search(some, index, rules)]


def _near(passage: np.ndarray, adds: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which of the words are in a passage whose words add up to its least sum."""
    return (np.bincount(passage, adds, len(least)) >= least)[passage]


def _search(texts: list[np.ndarray], index: "Index", rules: Rules) -> list[dict[int, tuple[float, float, float]]]:
    found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
    if not any(len(t) for t in texts):
        return found
    part_ = weigh(texts, index.idf)
    passage, weight, norm, first = part_.passage, part_.weight, part_.norm, part_.first
    least = rules.cosine * norm * (1 - 1e-5)
    hit = np.flatnonzero(index.listed[part_.bucket])
    own, column = known(part_.word[hit], index.vocabulary)
    hit = hit[own]
    near = _near(passage[hit], weight[hit] * index.most[column], least)
    hit, column = hit[near], column[near]
    # The passages left, numbered anew.
    cuts = np.diff(passage[hit], prepend=-1) != 0
    left, at_, heavy = passage[hit][cuts], np.cumsum(cuts) - 1, weight[hit]
    for number, space in enumerate(index.spaces):
        local = index.places[number][column]
        mine = np.flatnonzero(local >= 0)
        mine = mine[_near(at_[mine], heavy[mine] * space.most[local[mine]], least[left])]
        rows, local, weights_ = at_[mine], local[mine], heavy[mine]
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        for at in range(0, len(starts), 4096):
            cut = starts[at:at + 4096]
            end = starts[at + 4096] if at + 4096 < len(starts) else len(rows)
            gathered = space.products[local[cut[0]:end]]
            gathered *= weights_[cut[0]:end, None]
            part = left[rows[cut]]
            cosines = np.add.reduceat(gathered, cut - cut[0])
            cosines /= norm[part][:, None]
            for k, q in zip(*np.nonzero(cosines >= rules.cosine)):
                text = int(np.searchsorted(first, part[k], "right")) - 1
                while not part_.counts[text]:
                    text -= 1
                item, x = int(space.items[q]), int(part[k] - first[text]) * BLOCK
                common, answer = checked(index.items[item], texts[text], x, min(len(texts[text]), x + 2 * BLOCK), rules)
                if leaked(common, answer, rules):
                    best = found[text].get(item, (0.0, 0.0, 0.0))
                    found[text][item] = max(best, (float(cosines[k, q]), common, answer), key=lambda s: (s[1], s[2], s[0]))
    return found


# --- on Spark ---------------------------------------------------------------------------------


@dataclass
class Index:
    """What a search pass needs, for one part of the benchmark."""

    spaces: list[Space]
    vocabulary: np.ndarray
    places: list[np.ndarray]  # for each space: word of the vocabulary -> its column there, or -1
    most: np.ndarray  # word of the vocabulary -> the most it adds in any space
    listed: np.ndarray
    idf: np.ndarray
    items: dict[int, list[int]]
    names: dict[int, int | None]  # item_id of each item


def _parts(benchmark: DataFrame, item_words: int) -> Iterator[tuple[dict[int, list[int]], dict[int, int | None]]]:
    """The benchmark's rows by number, as word checksums and item_id, in parts of bounded size. Rows without words are left out."""
    part: dict[int, list[int]] = {}
    names: dict[int, int | None] = {}
    held = 0
    for number, row in enumerate(benchmark.select("item_id", "text").toLocalIterator()):
        words = word_hashes(row["text"]).tolist()
        if words:
            part[number], names[number] = words, row["item_id"]
            held += len(words)
            if held >= item_words:
                yield part, names
                part, names, held = {}, {}, 0
    if part:
        yield part, names


def indexes(marked: DataFrame, name: str, benchmark: DataFrame, item_words: int = ITEM_WORDS) -> Iterator[Index]:
    """The search indexes of a benchmark over a staged corpus with word checksums."""
    frequencies, blocks = document_frequencies(marked, name)
    idf = weights(frequencies, blocks)
    for items, names in _parts(benchmark, item_words):
        owned = [(item, np.array(words[a:b], np.uint32)) for item, words in sorted(items.items())
                 for a, b in passages(len(words))]
        parts = [owned[at:at + QUERIES] for at in range(0, len(owned), QUERIES)]
        blocks_ = [(np.unique(np.concatenate([q for _, q in part])), [q for _, q in part]) for part in parts]
        spaces = []
        for part, (words_, queries), axes in zip(parts, blocks_, latent_axes(marked, name, idf, blocks_)):
            latent = sparse_passages(queries, words_, idf).times(axes)
            size = np.linalg.norm(latent, axis=1, keepdims=True)
            spaces.append(Space(words_, axes, latent / np.maximum(size, 1e-9), np.array([i for i, _ in part])))
        vocabulary = np.unique(np.concatenate([s.vocabulary for s in spaces]))
        listed = np.zeros(BUCKETS, bool)
        listed[vocabulary & np.uint32(BUCKETS - 1)] = True
        places, most = [], np.zeros(len(vocabulary))
        for space in spaces:
            place, own = np.full(len(vocabulary), -1, np.int32), np.searchsorted(vocabulary, space.vocabulary)
            place[own] = np.arange(len(space.vocabulary))
            places.append(place)
            most[own] = np.maximum(most[own], space.most)
        yield Index(spaces, vocabulary, places, most, listed, idf, items, names)


LEAKS = "doc_id long, item_id long, cosine double, common double, answer double"


def leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = RULES, item_words: int = ITEM_WORDS) -> DataFrame:
    """One row per document and benchmark item found in it.

    common and answer are the shares of the item's words, and of its last
    words, that stand in order in the document. Null or empty texts and items
    have no words and no leaks; a null doc_id is kept in its rows. Repeated
    documents give repeated rows. Every row of the benchmark is searched by
    itself, also with a null or repeated item_id. Empty tables give no rows.
    """
    spark = docs.sparkSession
    marked = stage(hashed(docs.select("doc_id", "text"), "ids").select("doc_id", "ids"), "words")
    out = spark.createDataFrame([], LEAKS)
    for index in indexes(marked, "ids", benchmark, item_words):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            i = shared.value
            for batch in batches:
                found = search([np.frombuffer(raw, np.uint32) for raw in batch.column("ids").to_pylist()], i, rules)
                rows = [(doc, i.names[item], *scores) for doc, items in zip(batch.column("doc_id").to_pylist(), found)
                        for item, scores in items.items()]
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.float64()] * 3)],
                    ["doc_id", "item_id", "cosine", "common", "answer"])

        out = out.unionByName(marked.mapInArrow(run, LEAKS))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = RULES, item_words: int = ITEM_WORDS) -> DataFrame:
    """The documents in which no benchmark item is found, in the columns of the table."""
    spark = docs.sparkSession
    with passing():
        # Word checksums only; the texts are read again for the search.
        marked = stage(hashed(docs.select("text"), "ids").select("ids"), "words")
        parts = [spark.sparkContext.broadcast(index) for index in indexes(marked, "ids", benchmark, item_words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All in one function: each further one over the same rows would take another Python worker a core.
        for batch in batches:
            texts = [word_hashes(t) for t in batch.column("text").to_pylist()]
            kept = list(range(len(texts)))
            for shared in parts:
                found = search([texts[k] for k in kept], shared.value, rules)
                kept = [k for k, items in zip(kept, found) if not items]
            yield batch.take(pa.array(kept, pa.int64()))

    return docs.mapInArrow(run, docs.schema) if parts else docs
