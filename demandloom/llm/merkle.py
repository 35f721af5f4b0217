"""Merkle manifest of a table as a content-addressed graph, with a checked proof for every row.

Every row is a leaf digest. Per source the leaves, in the order of doc_id, are
folded three by three into a subroot; the subroots, in the order of the source,
into the root.

* The tree is stored as records ``digest -> children``. Records of ``LEVELS``
  levels below a node are stored together as its segment, found by the node's
  digest alone.
* Leaf requests descend from the root. The digits of a leaf's rank in base
  ``ARITY`` say which child to take at each level; the children not taken are
  collected. Requests that share their leading digits travel as one row until
  their paths part, so each round reads every segment once.
* The collected path, turned round, is the proof from leaf to root.

A source of any size is cut by rank: no task sees more than one segment
(``ARITY ** LEVELS`` leaves) at a time. Ranks come from a range sort and counts
for each input partition, not from a window over a source.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from demandloom.llm.common import stage

ARITY = 3
#: Tree levels of one segment.
LEVELS = 5
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of a row's place within its partition, as monotonically_increasing_id gives it.
PLACE = (1 << 33) - 1
PATH = "array<struct<left:string,right:string>>"
STATE = f"tree long, n long, index long, digest string, subroot string, path {PATH}"
RESULT = ("doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
          "rank long")


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves until one node remains."""
    levels = 0
    while n > 1:
        n = -(-n // ARITY)
        levels += 1
    return levels


def levels_of(n: int, at: int, depth: int) -> int:
    """Levels that a tree of n leaves has in the round."""
    return max(0, min(depth, height(n) - at * depth))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row: each column as byte count, colon, value; - for null."""
    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in COLUMNS]), 256)


def requests(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, and the leaf that tampering gives (equal where nothing is changed)."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(chosen & F.contains("text", F.lit("\n")), leaf_digest(text=F.replace("text", F.lit("\n"), F.lit(""))))
    leaves = docs.select(*COLUMNS).select("doc_id", "source", leaf_digest().alias("digest"), tampered.alias("tampered"))
    return leaves.withColumn("uid", F.monotonically_increasing_id())


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``tree`` (a number for each group, in the groups' order), its size ``n`` and the row's ``rank`` in it.

    Rows are range-sorted by group and order. A row's rank is its place in its
    partition plus what earlier partitions hold of its group; both come from
    one count for each partition and group.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "sorted").withColumn("part", F.shiftright("at", 33))
    pieces = stage(placed.groupBy("part", group).agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("rows")), "pieces")
    # One row per partition of the range sort: this window is bounded by their number.
    before = pieces.groupBy("part").agg(F.sum("rows").alias("rows")).select(
        "part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    first = F.col("before") + F.col("low").bitwiseAND(PLACE)
    own = Window.partitionBy("group")
    starts = (
        pieces.withColumnRenamed(group, "group").join(before, "part").withColumn("first", first)
        .select(F.col("part").alias("_part"), "group", "low", F.min("first").over(own).alias("tree"),
                F.sum("rows").over(own).alias("n"), "first")
    )
    joined = placed.join(starts, (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("group")))
    rank = F.col("first") - F.col("tree") + F.col("at") - F.col("low")
    return joined.select(*[c for c in rows.columns if c != group], "tree", "n", rank.alias("rank"))


def fold(digests: list[str], levels: int) -> tuple[str, dict[str, list[str]]]:
    """The top of a segment after so many levels, and its records."""
    records = {}
    for _ in range(levels):
        above = []
        for at in range(0, len(digests), ARITY):
            children = digests[at:at + ARITY]
            above.append(digest_of(*children))
            records[above[-1]] = children
        digests = above
    return digests[0], records


def build(nodes: DataFrame, kind: DataType, depth: int) -> list[DataFrame]:
    """The segments of every round, from the leaves up; nodes: tree, n, rank, digest, load (of the kind).

    Round k folds ``depth`` levels from ``k * depth``; a tree takes part until one
    node of it remains. A tree of one leaf has one segment without records.
    """
    rounds: list[DataFrame] = []
    while True:
        at = len(rounds)
        loads = f", loads array<{kind.simpleString()}>" if not at else ""
        schema = f"tree long, n long, index long, digest string, digests array<string>, children array<array<string>>{loads}"

        def run(batches: Iterator[pa.RecordBatch], at=at) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tops, names, children = [], [], []
                for n, row in zip(batch.column("n").to_pylist(), batch.column("digests").to_pylist()):
                    top, records = fold(row, levels_of(n, at, depth))
                    tops.append(top)
                    names.append(list(records))
                    children.append(list(records.values()))
                out = [batch.column("tree"), batch.column("n"), batch.column("index"), pa.array(tops, pa.string()),
                       pa.array(names, pa.list_(pa.string())), pa.array(children, pa.list_(pa.list_(pa.string())))]
                fields = ["tree", "n", "index", "digest", "digests", "children"]
                if not at:
                    out.append(batch.column("loads"))
                    fields.append("loads")
                yield pa.RecordBatch.from_arrays(out, fields)

        load = ["load"] if not at else []
        cut = nodes.groupBy("tree", "n", F.expr(f"rank DIV {ARITY ** depth}").alias("index")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest", *load))).alias("nodes"))
        rows = cut.select("tree", "n", "index", F.col("nodes.digest").alias("digests"), *[F.col("nodes.load").alias("loads") for _ in load])
        rounds.append(stage(rows.mapInArrow(run, schema), "segments"))
        limit = ARITY ** (depth * len(rounds))
        nodes = rounds[-1].where(F.col("n") > limit).select("tree", "n", F.col("index").alias("rank"), "digest")
        if nodes.isEmpty():
            return rounds


def entering(rows: DataFrame, at: int, depth: int) -> DataFrame:
    """The rows of trees whose top lies in the round."""
    low, high = ARITY ** (depth * at) if at else 0, ARITY ** (depth * (at + 1))
    return rows.where((F.col("n") > low) & (F.col("n") <= high))


def tops(rounds: list[DataFrame], depth: int) -> DataFrame:
    """tree, n and digest of every tree's top."""
    return reduce(DataFrame.unionByName, [entering(r, k, depth).select("tree", "n", "digest") for k, r in enumerate(rounds)])


def follow(digest: str, children: dict[str, list[str]], place: int, levels: int) -> tuple[str, list[tuple[str, str]]]:
    """Descend by the digits of the place: the node reached, and the children left and right of the path, from the top."""
    path = []
    for level in range(levels - 1, -1, -1):
        digit = place // ARITY ** level % ARITY
        own = children[digest]
        path.append(("".join(own[:digit]), "".join(own[digit + 1:])))
        digest = own[digit]
    return digest, path


def reached(row: dict, at: int, depth: int) -> Iterator[tuple[int, str, list[tuple[str, str]]]]:
    """(index in the level below, digest, path from the root) of every node at the bottom of a state's segment."""
    children = dict(zip(row["digests"], row["children"]))
    levels = levels_of(row["n"], at, depth)
    below = -(-row["n"] // ARITY ** (at * depth))
    above = [(p["left"], p["right"]) for p in row["path"]]
    first = row["index"] * ARITY ** depth
    for place in range(min(ARITY ** depth, below - first)):
        digest, path = follow(row["digest"], children, place, levels)
        yield first + place, digest, above + path


def descend(entries: DataFrame, rounds: list[DataFrame], depth: int) -> DataFrame:
    """States joined with the segments of the lowest round and the leaves' loads; entries: tree, n, digest, subroot, path."""
    states: DataFrame | None = None
    for at in range(len(rounds) - 1, -1, -1):
        starting = entering(entries, at, depth).select("tree", "n", F.lit(0).cast("long").alias("index"), "digest", "subroot", "path")
        states = starting if states is None else states.unionByName(starting)
        records = rounds[at].groupBy("digest").agg(F.first("digests").alias("digests"), F.first("children").alias("children"))
        states = states.join(records, "digest")
        if at:
            def run(batches: Iterator[pa.RecordBatch], at=at) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    out = [(r["tree"], r["n"], i, d, r["subroot"], [{"left": a, "right": b} for a, b in path])
                           for r in batch.to_pylist() for i, d, path in reached(r, at, depth)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[k] for o in out], t) for k, t in enumerate(
                            [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                             pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))])],
                        ["tree", "n", "index", "digest", "subroot", "path"])

            states = states.mapInArrow(run, STATE)
    return states.join(rounds[0].select("tree", "index", "loads"), ["tree", "index"])


def manifest(docs: DataFrame, depth: int = LEVELS) -> DataFrame:
    """Each row's leaf, subroot, root, proof digest, and the root folded from its (partly tampered) leaf along the proof.

    Order within a source: doc_id, null first, then the leaf digest; repeated
    rows have equal leaves and different proofs. Null source is a source of its
    own and comes first; a null or empty text is a leaf like any other; a null
    doc_id is never tampered with. A source of one row is its own subroot. An
    empty table gives no rows. Other columns take no part.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    leaves = stage(requests(docs), "leaves")
    rows = ranked(leaves, "source", ["doc_id", "digest", "uid"])
    load = F.struct("doc_id", "tampered")
    nodes = rows.select("tree", "n", "rank", "digest", load.alias("load"))
    rounds = build(nodes, nodes.schema["load"].dataType, depth)
    subroots = stage(tops(rounds, depth), "subroots")

    upper = ranked(subroots.select(F.lit(0).alias("all"), F.col("tree").alias("source_tree"), F.col("n").alias("size"), "digest"),
                   "all", ["source_tree"])
    nodes = upper.select("tree", "n", "rank", "digest", F.struct("source_tree", "size").alias("load"))
    upper_rounds = build(nodes, nodes.schema["load"].dataType, depth)
    top = tops(upper_rounds, depth).first()
    if top is None:
        return docs.sparkSession.createDataFrame([], RESULT.format(kind=kind))
    root = top["digest"]
    begin = tops(upper_rounds, depth).select("tree", "n", "digest", F.lit("").alias("subroot"), F.array().cast(PATH).alias("path"))

    def to_sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(load["source_tree"], load["size"], digest, digest, [{"left": a, "right": b} for a, b in path])
                   for row in batch.to_pylist() for load, (_, digest, path) in zip(row["loads"], reached(row, 0, depth), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate(
                    [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))])],
                ["tree", "n", "digest", "subroot", "path"])

    entries = stage(descend(begin, upper_rounds, depth).mapInArrow(to_sources, f"tree long, n long, digest string, subroot string, path {PATH}"),
                    "entries")

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for load, (rank, leaf, path) in zip(row["loads"], reached(row, 0, depth), strict=True):
                    path.reverse()
                    folded = load["tampered"] or leaf
                    for left, right in path:
                        folded = digest_of(left, folded, right)
                    proof = digest_of(*[side for both in path for side in both])
                    out.append((load["doc_id"], leaf, row["subroot"], root, proof, folded, folded == root, rank))
            columns = [[o[k] for o in out] for k in range(8)]
            kinds = [batch.schema.field("loads").type.value_type.field("doc_id").type, *[pa.string()] * 5, pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "rank"])

    return descend(entries, rounds, depth).mapInArrow(to_rows, RESULT.format(kind=kind))
