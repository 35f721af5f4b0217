"""Near-duplicate texts by the Jaccard similarity of their five-word shingles.

1. Every text gets a key of its words (equal words: equal key), so that exact
   copies are one node, a SimHash fingerprint of its shingles, and band hashes
   of a MinHash sketch.
2. Fingerprints within ``RADIUS`` bits are found with the vantage-point shards
   of ``simhash``; the exact shingle sets decide which of these links stay, and
   they are contracted to classes. Texts at the limit are some ten bits apart,
   which no tree prunes, so the rest finds the links beyond the radius.
3. Nodes that share a band are in one bucket. A pair at the limit shares none
   of the ``BANDS`` bands with probability (1 - 0.8^ROWS)^BANDS, about 3 in
   100,000; pairs above it with less.
4. In each bucket the node with the most candidates is the hub. Every node
   of another class is compared with it by the exact shingle sets; the links
   are contracted. A bucket whose nodes are one class then is settled. This is
   done ``ROUNDS`` times, each time without the last hub, which has met all.
5. A bucket that still holds several classes, with more than ``PART`` nodes
   outside the largest, gives its nodes to new buckets,
   one for each of their rarest shingles: with shingles in one order for all,
   rarest first, two sets that reach the limit share one of the first
   n - ceil(0.8 n) + 1. No pair is lost, and texts that only share a frequent
   passage seldom meet.
   Of buckets with equal nodes one stays.
6. In the buckets that hold several classes the nodes outside the largest
   class are compared with all others; those of the largest class need no
   comparison with each other. Both sides and the hubs' candidates are cut into
   parts of at most about ``PART`` nodes and ``CELL`` shingles, so a group of
   any size is dealt over many tasks.
7. The exact links are contracted to components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from demandloom.llm.common import WORD_SPLIT, free_name, passing, stage
from demandloom.llm.simhash import contract, links, of_hashes

SHINGLE = 5
#: Similarity of a link, as a fraction, so that the comparison is exact.
LIMIT = (4, 5)
BANDS, ROWS = 20, 4
SEED = 43
#: Bits by which the fingerprints of a link of the first step differ at most.
RADIUS = 6
#: Shingles and nodes of one part of a bucket or of a hub's candidates.
CELL, PART = 1 << 18, 128
#: Rounds of hubs before all nodes of a bucket are compared.
ROUNDS = 1

_RNG = np.random.default_rng(SEED)
_FLIP = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1)).astype(np.uint64)
_TIMES = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def text_words(text: str | None) -> list[bytes]:
    """The words in lower case (A-Z only), split at the six separators."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """The different hashes of the word shingles, sorted. Too few words: one shingle of all. No word: none."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    size = min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())], np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """A signed hash for each band of the MinHash sketch; it holds the band's number. No shingle: none."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, ((hashes[at:at + 2048] ^ _FLIP) * _TIMES).min(axis=1))
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(rows)]


def words_key(text: str) -> Column:
    """A hash of the text's words; texts of equal words have equal ones."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), letters, letters.lower())
    return F.xxhash64(F.trim(F.regexp_replace(lower, WORD_SPLIT, " ")))


def sketched(keyed: DataFrame) -> DataFrame:
    """fp, doc_id, number of shingles, bands and fingerprint (mark) of a frame (fp, doc_id, text)."""
    kept = [f for f in keyed.schema.fields if f.name != "text"]
    schema = StructType([*kept]).add("n", LongType()).add("bands", ArrayType(LongType())).add("mark", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text_words(text)) for text in batch.column("text").to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            sizes, sketches = [len(h) for h in found], [bands(h) for h in found]
            marks = np.array([of_hashes(h) for h in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(marks)], schema.names)

    return keyed.mapInArrow(run, schema)


def shingle_sets(nodes: DataFrame) -> DataFrame:
    """fp, n and the shingle set as bytes of a frame (fp, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text_words(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("fp"), pa.array([len(h) for h in found], pa.int64()),
                 pa.array([h.tobytes() for h in found], pa.binary())], ["fp", "n", "hashes"])

    return nodes.select("fp", "text").mapInArrow(run, "fp long, n long, hashes binary")


def groups(sets: list[np.ndarray], known: np.ndarray | None = None, asking: np.ndarray | None = None) -> np.ndarray:
    """A label for every set; sets connected by links of at least the limit have equal labels.

    A set is compared with all others at once, and never again with those of
    its own group, so a group of copies of any size needs few comparisons.
    ``known`` gives labels to begin with, ``asking`` the places of the sets to
    compare with all others (by default all).
    """
    label = np.arange(len(sets)) if known is None else known.copy()
    n = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    mark = np.zeros(codes.max() + 1, np.int32)
    up, down = LIMIT
    for x in range(len(sets)) if asking is None else asking:
        if (label == label[0]).all():
            break
        own = codes[starts[x]:starts[x] + n[x]]
        mark[own] = 1
        shared = np.add.reduceat(mark[codes], starts)
        mark[own] = 0
        near = (label != label[x]) & (down * shared >= up * (n[x] + n - shared))
        if near.any():
            label[np.isin(label, label[near])] = label[x]
    return label


def alike(own: np.ndarray, other: np.ndarray) -> bool:
    """Do two sorted sets reach the limit?"""
    up, down = LIMIT
    few, many = sorted((own, other), key=len)
    if down * len(few) < up * len(many):
        return False
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    shared = int((many[at] == few).sum())
    return down * shared >= up * (len(own) + len(other) - shared)


def _parts(sizes: DataFrame, key: str, cell: int) -> DataFrame:
    """(key, parts): how many parts the rows (key, n) of each key are cut into."""
    total = sizes.groupBy(key).agg(F.sum("n").alias("_n"), F.count("*").alias("_rows"))
    return total.select(key, F.ceil(F.greatest(F.col("_n") / cell, F.col("_rows") / PART)).cast("int").alias("parts"))


def hub_links(pairs: DataFrame, sets: DataFrame, cell: int) -> DataFrame:
    """The pairs (fp, root) that reach the limit. A hub's pairs are cut into parts, each with the hub's set."""
    parts = stage(_parts(pairs.join(sets.select("fp", "n"), "fp"), "root", cell), "hubs")
    others = (pairs.join(parts, "root").select("fp", "root", F.pmod(F.xxhash64("fp"), "parts").cast("int").alias("part"))
              .join(sets, "fp").select("root", "part", "fp", "hashes"))
    hubs = (parts.join(sets, parts.root == sets.fp)
            .select("root", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "fp", "hashes"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        is_hub = rows["fp"] == rows["root"]
        hub = np.frombuffer(rows["hashes"][is_hub].iloc[0], np.uint64)
        rows = rows[~is_hub]
        return rows[[alike(hub, np.frombuffer(raw, np.uint64)) for raw in rows["hashes"]]][["fp", "root"]]

    return others.unionByName(hubs).groupBy("root", "part").applyInPandas(run, "fp long, root long")


def bucket_links(rows: DataFrame, sets: DataFrame, cell: int) -> DataFrame:
    """Links (fp, root) that connect exactly what the pairs inside each bucket (fp, band, label) connect.

    Nodes of equal label count as linked. The rest (all but the largest class
    of a bucket) meets that class and itself: a group is a part of the rest
    with a part of either side.
    """
    classes = rows.groupBy("band", "label").agg(F.count("*").alias("nodes"))
    largest = classes.groupBy("band").agg(F.max(F.struct("nodes", "label"))["label"].alias("largest"))
    sided = stage(rows.join(largest, "band").join(sets.select("fp", "n"), "fp")
                  .select("band", "fp", "label", "n", (F.col("label") != F.col("largest")).alias("rest")), "sides")

    def parts(rest: bool, name: str) -> DataFrame:
        return _parts(sided.where(F.col("rest") == rest), "band", cell).withColumnRenamed("parts", name)

    numbers = stage(parts(True, "rests").join(parts(False, "mains"), "band"), "parts")
    dealt = sided.join(numbers, "band").withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))).cast("int"))
    upto = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    # (other side is the rest, part of the rest, part of the other side) of all groups a node is in
    with_rest = F.transform(upto("rests"), lambda k: F.struct(
        F.lit(True).alias("inner"), F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    with_main = F.transform(upto("mains"), lambda k: F.struct(F.lit(False).alias("inner"), F.col("own").alias("i"), k.alias("j")))
    of_main = F.transform(upto("rests"), lambda k: F.struct(F.lit(False).alias("inner"), k.alias("i"), F.col("own").alias("j")))
    spread = (dealt.withColumn("group", F.explode(F.when(F.col("rest"), F.concat(with_rest, with_main)).otherwise(of_main)))
              .join(sets.select("fp", "hashes"), "fp")
              .select("band", "group.*", "fp", "label", "rest", "hashes"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["fp"].to_numpy(np.int64)
        _, one, known = np.unique(group["label"].to_numpy(np.int64), return_index=True, return_inverse=True)
        found = groups([np.frombuffer(raw, np.uint64) for raw in group["hashes"]], known, np.flatnonzero(group["rest"]))
        _, first, same = np.unique(found, return_index=True, return_inverse=True)
        out = pd.DataFrame({"fp": keys[one], "root": keys[first[same[one]]]})
        return out[out.fp != out.root]

    return spread.groupBy("band", "inner", "i", "j").applyInPandas(run, "fp long, root long")


def rare_shingles(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """New buckets (fp, band, label) of the nodes (fp, band, label); two nodes that reach the limit share one.

    A bucket is a shingle; how many of the nodes have it decides the order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [np.frombuffer(raw, np.int64) for raw in batch.column("hashes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(items, pa.list_(pa.int64()))], ["fp", "label", "n", "items"])

    nodes = rows.select("fp", "label").distinct().join(sets, "fp").select("fp", "label", "n", "hashes")
    tokens = (nodes.mapInArrow(run, "fp long, label long, n long, items array<long>")
              .select("fp", "label", "n", F.explode("items").alias("band")))
    shared = tokens.groupBy("band").agg(F.count("*").alias("holders")).where("holders > 1")
    held = (tokens.join(shared, "band").groupBy("fp", "label", "n")
            .agg(F.sort_array(F.collect_list(F.struct("holders", "band"))).alias("items")))
    up, down = LIMIT
    alone = F.col("n") - F.size("items")
    first = F.col("n") - F.ceil(F.col("n") * up / down) + 1 - alone
    return held.select("fp", "label", F.explode(F.slice("items", 1, F.greatest(first, F.lit(0)).cast("int"))["band"]).alias("band"))


def several_classes(rows: DataFrame) -> DataFrame:
    """The rows (fp, band, label) whose bucket holds more than one label."""
    mixed = rows.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return rows.join(mixed.select("band"), "band").select("fp", "band", "label")


def crowded(rows: DataFrame) -> DataFrame:
    """The buckets (band) with more than PART nodes outside their largest class."""
    classes = rows.groupBy("band", "label").agg(F.count("*").alias("nodes"))
    return classes.groupBy("band").agg((F.sum("nodes") - F.max("nodes")).alias("rest")).where(F.col("rest") > PART).select("band")


def different_buckets(rows: DataFrame) -> DataFrame:
    """The rows (fp, band, label) of one bucket among those with the same nodes, told by 128 bits of hashes."""
    marks = rows.groupBy("band").agg(F.count("*").alias("nodes"), F.bit_xor(F.xxhash64("fp")).alias("one"),
                                     F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("two"))
    return rows.join(marks.groupBy("nodes", "one", "two").agg(F.min("band").alias("band")).select("band"), "band")


def fingerprint_pairs(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (fp, root) of staged nodes (fp, mark) that connect, before any check, all fingerprints within the radius.

    Equal fingerprints are paired with their first node; of the others the
    first nodes are paired along the stars of the vantage-point shards.
    """
    first = stage(marks.groupBy("mark").agg(F.min("fp").alias("first")), "firsts")
    near = links(first.select(F.col("mark").alias("fp")), radius)
    one, other = (first.select(F.col("mark").alias(c), F.col("first").alias(c + "_first")) for c in ("fp", "root"))
    near = near.join(one, "fp").join(other, "root").select(F.col("fp_first").alias("fp"), F.col("root_first").alias("root"))
    same = marks.join(first, "mark").where("fp != first").select("fp", F.col("first").alias("root"))
    return near.unionByName(same).distinct()


def apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (fp, root) that are not of one class (fp, label) yet."""
    mine, other = (classes.select(F.col("fp").alias(c), F.col("label").alias(c + "_label")) for c in ("fp", "root"))
    named = pairs.join(mine, "fp", "left").join(other, "root", "left")
    return named.where(F.coalesce("fp_label", "fp") != F.coalesce("root_label", "root")).select("fp", "root")


def candidate_links(banded: DataFrame, marks: DataFrame, sets_of: Callable[[DataFrame], DataFrame], cell: int) -> DataFrame:
    """The contracted links (fp, label) of nodes (fp, band) and (fp, mark); sets_of gives the shingle sets of the nodes named."""
    several = banded.groupBy("band").agg(F.count("*").alias("nodes")).where("nodes > 1")
    rows = stage(banded.join(several.select("band"), "band").select("fp", "band"), "buckets")
    pairs = stage(fingerprint_pairs(marks), "pairs")
    sets = stage(sets_of(rows.select("fp").union(pairs.select("fp")).union(pairs.select("root")).distinct()), "sets")
    found = stage(hub_links(pairs, sets, cell), "found")
    classes = contract(found)
    for _ in range(ROUNDS):  # at least one
        counts = rows.groupBy("band").agg(F.count("*").alias("nodes"))
        met = rows.join(counts, "band").groupBy("fp").agg(F.sum("nodes").alias("met"))
        hubs = rows.select("fp", "band").join(met, "fp").groupBy("band").agg(F.max(F.struct("met", "fp"))["fp"].alias("root"))
        others = stage(rows.select("fp", "band").join(hubs, "band").where("fp != root"), "others")
        new = stage(hub_links(apart(others.select("fp", "root").distinct(), classes), sets, cell), "found")
        found = found.unionByName(new)
        classes = contract(found)
        named = others.join(classes, "fp", "left").select("fp", "band", F.coalesce("label", "fp").alias("label"))
        rows = stage(several_classes(named), "open")
        if rows.isEmpty():
            return classes
    full = stage(crowded(rows), "crowded")
    rare = stage(rare_shingles(rows.join(full, "band", "left_semi"), sets), "rare")
    rows = stage(rows.join(full, "band", "left_anti").unionByName(several_classes(rare)), "open")
    rows = stage(different_buckets(rows), "different")
    return contract(found.unionByName(stage(bucket_links(rows, sets, cell), "found")))


def representatives(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """One row of each component, in the columns of the table: the smallest doc_id, null last, of repeated rows any one.

    Null text has no word; all texts without a word are one component. Texts
    under five words have one shingle of all of them. An empty table gives no
    rows. The table is read several times and not copied, so give a stored one.
    """
    fp = free_name(docs, "_fp")
    keyed = docs.select(words_key("text").alias("fp"), F.col("doc_id"), F.col("text"))
    with passing():
        ids = stage(sketched(keyed).groupBy("fp", "doc_id")
                    .agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("mark").alias("mark"), F.count("*").alias("rows")), "ids")
        first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "rows")
        nodes = stage(ids.groupBy("fp").agg(F.min(first).alias("best")), "nodes")
        banded = ids.select("fp", F.explode("bands").alias("band")).distinct()
        marks = stage(ids.where("n > 0").select("fp", "mark").distinct(), "marks")

        def sets_of(wanted: DataFrame) -> DataFrame:
            named = nodes.join(wanted, "fp").select("fp", F.col("best.doc_id").alias("doc_id")).alias("k")
            texts = keyed.alias("t").join(named, (F.col("t.fp") == F.col("k.fp")) & F.col("t.doc_id").eqNullSafe(F.col("k.doc_id")))
            return shingle_sets(texts.groupBy(F.col("k.fp").alias("fp")).agg(F.first("t.text").alias("text")))

        labels = candidate_links(banded, marks, sets_of, cell)
        chosen = (nodes.join(labels, "fp", "left").groupBy(F.coalesce("label", "fp").alias("label"))
                  .agg(F.min("best").alias("best")).select("best.fp", "best.doc_id", "best.rows"))
        stay = stage(chosen, "chosen")
        gone = stage(_matching(ids.select("fp", "doc_id"), stay, "fp", "left_anti"), "gone", lasting=True)
        twice = stage(stay.where("rows > 1").select("fp", "doc_id"), "twice", lasting=True)
    marked = docs.withColumn(fp, words_key("text"))
    kept = _matching(marked, gone, fp, "left_anti")
    if not twice.isEmpty():
        once = _matching(kept, twice, fp, "left_semi").dropDuplicates([fp, "doc_id"])
        kept = _matching(kept, twice, fp, "left_anti").unionByName(once)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _matching(rows: DataFrame, keys: DataFrame, fp: str, how: str) -> DataFrame:
    """The rows that have (left_semi) or have not (left_anti) their key and doc_id among the keys."""
    key, doc = free_name(rows, "_key"), free_name(rows, "_doc")
    k = keys.select(F.col("fp").alias(key), F.col("doc_id").alias(doc))
    return rows.join(k, (F.col(fp) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc)), how)
