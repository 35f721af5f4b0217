"""Near-duplicate groups by SimHash fingerprints, found with vantage-point trees.

1. Every text gets a 64-bit fingerprint (``fingerprints``).
2. A vantage-point tree over a bounded sample of the different fingerprints
   cuts the Hamming space into shards. Every fingerprint is stored in one
   shard and also asks the later shards that its ball of the link radius
   touches; the triangle inequality rules all others out.
3. Each shard searches its pairs exactly with a tree of its own and returns a
   spanning star for each linked group, never all pairs.
4. The stars are contracted to components by joins.

The sample shapes the shards, that is the speed; it never decides a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from demandloom.llm.common import free_name, stage

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Different fingerprints that the routing tree is built from; the only rows that reach the driver.
SAMPLE = 4096
#: Fingerprints that a shard should hold. A shard that holds more is worked on in blocks of this size.
SHARD_ROWS = 1 << 16
#: Points below which the search inside a shard compares directly.
DIRECT = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of the word shingles of a text, unsigned. No word: 0. Too few words: one shingle of all."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only the six separators
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return of_hashes(np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())], np.uint64))


def of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of the hashes, unsigned: the bits that over half of them have."""
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes)).view(np.uint64)[0])


def fingerprints(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """The frame with the signed 64-bit fingerprint of its text appended under the name."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))],
                                             [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


# --- vantage-point trees ------------------------------------------------------------------


def distance(points: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count(points ^ other)


def build_routing(sample: np.ndarray, leaves: int) -> list:
    """A tree as nested [vantage point, cut, near, far], leaves numbered in order. Distances up to the cut are near."""
    counter = iter(range(1 << 30))

    def node(points: np.ndarray, wanted: int):
        if wanted > 1 and len(points) > 1:
            vantage = points[0]
            far = distance(points, vantage)
            cut = int(np.median(far))
            if cut == far.max():
                cut -= 1
            near = far <= cut
            if near.any() and not near.all():
                half = wanted // 2
                return [int(vantage), cut, node(points[near], wanted - half), node(points[~near], half)]
        return next(counter)

    return node(sample, max(1, leaves))


def route(tree, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, point index, is it at home there), for the home leaf and the later leaves within the radius.

    A pair within the radius meets in the later one of its two home leaves, so
    asking the earlier leaves as well would find it twice.
    """
    leaf, index, home = [], [], []

    def down(node, rows: np.ndarray, at_home: np.ndarray) -> None:
        if not len(rows):
            return
        if not isinstance(node, list):
            leaf.append(np.full(len(rows), node, np.int64))
            index.append(rows)
            home.append(at_home)
            return
        vantage, cut, near, far = node
        d = distance(points[rows], np.uint64(vantage)).astype(np.int64)
        inside = d <= cut
        # Leaves are numbered near before far: from a far home, no near leaf is a later one.
        to_near = np.where(at_home, inside, d - radius <= cut)
        to_far = (d + radius > cut)
        down(near, rows[to_near], (at_home & inside)[to_near])
        down(far, rows[to_far], (at_home & ~inside)[to_far])

    down(tree, np.arange(len(points)), np.ones(len(points), bool))
    if not leaf:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(leaf), np.concatenate(index), np.concatenate(home)


class Groups:
    """Disjoint sets over positions, joined by arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b)[apart], np.maximum(a, b)[apart]], 1), axis=0)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for x, y in pairs.tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        jump = np.arange(len(self.label))
        for x in list(parent):
            jump[x] = root(x)
        self.label = jump[self.label]


def search(values: np.ndarray, points: np.ndarray, asking: np.ndarray, radius: int, groups: Groups) -> None:
    """Join every asking position with every point position within the radius, by a vantage-point tree."""
    if not len(points) or not len(asking):
        return
    if len(points) > DIRECT:
        far = distance(values[points], values[points[0]]).astype(np.int64)
        cut = int(np.median(far))
        if cut == far.max():
            cut -= 1
        near = far <= cut
        if near.any() and not near.all():
            d = distance(values[asking], values[points[0]]).astype(np.int64)
            search(values, points[near], asking[d - radius <= cut], radius, groups)
            search(values, points[~near], asking[d + radius > cut], radius, groups)
            return
    for p in range(0, len(points), DIRECT):
        some = points[p:p + DIRECT]
        for q in range(0, len(asking), DIRECT):
            those = asking[q:q + DIRECT]
            i, j = np.nonzero(np.bitwise_count(values[those][:, None] ^ values[some][None, :]) <= radius)
            groups.join(those[i], some[j])


def _links(cells: DataFrame, radius: int) -> DataFrame:
    """Star links (fp, root) inside every cell of points and asking fingerprints."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fp"].to_numpy(np.int64).view(np.uint64)
        point = rows["point"].to_numpy(bool)
        groups = Groups(len(values))
        # The same fingerprint may be here as a point and as one that asks; it is one node.
        _, first, same = np.unique(values, return_index=True, return_inverse=True)
        groups.join(np.arange(len(values)), first[same])
        search(values, np.flatnonzero(point), np.flatnonzero(~point), radius, groups)
        signed = values.view(np.int64)
        out = pd.DataFrame({"fp": signed, "root": signed[groups.label]})
        return out[out.fp != out.root].drop_duplicates()

    return cells.groupBy("leaf", "i", "j").applyInPandas(run, "fp long, root long")


def links(nodes: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (fp, root) that connect exactly the different fingerprints within the radius, from a staged column ``fp``."""
    spark = nodes.sparkSession
    n = nodes.count()
    # The share to take follows from the count, so that no task sends more than its part of the sample.
    near = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) <= int(min(1.0, 1.5 * sample / max(1, n)) * (1 << 30))
    chosen = nodes.where(near).orderBy(F.xxhash64("fp"), "fp").limit(sample)
    some = chosen.toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = build_routing(some, min(-(-n // shard_rows), max(1, len(some) // 8)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            leaf, index, home = route(tree, values.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(values[index]), pa.array(home)],
                                             ["leaf", "fp", "home"])

    routed = stage(nodes.select("fp").mapInArrow(run, "leaf long, fp long, home boolean"), "shards")
    # One row a shard, at most an eighth of the sample: how many blocks of points and of asking rows it needs.
    sizes = routed.groupBy("leaf").agg(F.count(F.when(F.col("home"), 1)).alias("points"), F.count("*").alias("asking")).collect()
    grid = spark.createDataFrame(
        [(r.leaf, max(1, -(-r.points // shard_rows)), max(1, -(-r.asking // (4 * shard_rows)))) for r in sizes],
        "leaf long, ni int, nj int")
    rows = routed.join(F.broadcast(grid), "leaf")
    own_i, own_j = F.pmod(F.xxhash64("fp"), "ni").cast("int"), F.pmod(F.xxhash64("fp", F.lit(1)), "nj").cast("int")
    every_j = F.explode(F.sequence(F.lit(0), F.col("nj") - 1))
    every_i = F.explode(F.sequence(F.lit(0), F.col("ni") - 1))
    as_point = rows.where("home").select("leaf", "fp", own_i.alias("i"), every_j.alias("j"), F.lit(True).alias("point"))
    as_asking = rows.select("leaf", "fp", every_i.alias("i"), own_j.alias("j"), F.lit(False).alias("point"))
    return _links(as_point.unionByName(as_asking), radius)


def contract(edges: DataFrame) -> DataFrame:
    """(fp, label) for every node of the links; nodes with equal labels are connected.

    Every round each node points to its smallest neighbour (or itself) and the
    links are redrawn between what they point to, until none is left. The stars
    of the shards make two or three rounds enough for most inputs. The
    aggregates combine before the shuffle, and the joins have one row for each
    node on one side, so adaptive execution may split a hub's links.
    """
    edges = stage(edges.select(F.col("fp").alias("a"), F.col("root").alias("b")).distinct(), "links")
    nodes = edges.select(F.col("a").alias("fp")).union(edges.select("b")).distinct()
    labels = stage(nodes.select("fp", F.col("fp").alias("label")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                        .select("node", F.least("node", "low").alias("parent")), "parents")
        to_a, to_b = (parents.select(F.col("node").alias(c), F.col("parent").alias("p" + c)) for c in "ab")
        edges = stage(edges.join(to_a, "a").join(to_b, "b").where("pa != pb")
                      .select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(), "links")
        moved = parents.select(F.col("node").alias("label"), "parent")
        labels = stage(labels.join(moved, "label", "left").select("fp", F.coalesce("parent", "label").alias("label")), "labels")
    return labels


def label(marked: DataFrame, fp: str, radius: int = RADIUS, **sizes: int) -> DataFrame:
    """(fp, label) for every different fingerprint of a staged frame; unlinked ones are their own label."""
    nodes = stage(marked.select(F.col(fp).alias("fp")).distinct(), "fingerprints")
    found = contract(links(nodes, radius, **sizes))
    return nodes.join(found, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def components(docs: DataFrame, radius: int = RADIUS, **sizes: int) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest linked doc_id) of every row.

    Null text has no word and the fingerprint zero, which links like any other.
    A null doc_id takes part in linking; the component_id is the smallest
    doc_id that is not null, or null if there is none. Repeated rows stay.
    """
    marked = stage(fingerprints(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "marked")
    labels = label(marked, "fp", radius, **sizes)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    named = least.join(labels, "fp")
    groups = named.groupBy("label").agg(F.min("low").alias("component_id"))
    mapped = named.join(groups, "label").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return marked.join(mapped, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, radius: int = RADIUS, **sizes: int) -> DataFrame:
    """One row of each component, in the columns of the table: the smallest doc_id, null last, of repeated rows any one."""
    uid, fp = free_name(docs, "_uid"), free_name(docs, "_fp")
    marked = stage(fingerprints(docs, fp).withColumn(uid, F.monotonically_increasing_id()), "marked")
    labels = label(marked, fp, radius, **sizes)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(uid).alias("uid"))
    best = marked.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("best"))
    chosen = best.join(labels, "fp").groupBy("label").agg(F.min("best").alias("best")).select(F.col("best.uid").alias(uid))
    return marked.join(chosen, uid, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
