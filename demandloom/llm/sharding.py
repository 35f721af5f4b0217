"""Weighted rendezvous hashing of stable record keys over shards.

Each (key, shard) pair gets a hash in (0, 1); the shard with the smallest
``-ln(hash) / weight`` takes the key. A new shard competes with its own hash
only, so the keys it does not win stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import stage

SHARDS = 16


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key. Null is a key like any other. Weights must be positive."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    bids = []
    for shard, weight in enumerate(weights):
        digest = F.xxhash64(key, F.lit(shard))
        uniform = (F.shiftrightunsigned(digest, 11) + F.lit(0.5)) / F.lit(float(2**53))
        bids.append(F.struct((-F.log(uniform) / F.lit(float(weight))).alias("bid"), F.lit(shard).alias("shard")))
    return F.least(*bids)["shard"] if len(bids) > 1 else F.lit(0)


def assign(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: float = 1.0) -> DataFrame:
    """Every row with its shard, its gapless slot there, and its shard after one more is added.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The slot is the number of rows of the shard in earlier input partitions
    plus the rank within its own, so no task ever sees a whole shard, and a key
    that holds a third of all rows is ranked in as many tasks as it came in.
    Rows are staged once, without texts; the partition numbers in the staged
    files are fixed from then on, whatever executor is lost.

    Null text: size 1 and checksum 0, as for the empty text. Null doc_id: one
    key, all its rows go to one shard. Repeated rows each get their own slot,
    in any order among themselves. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    placed = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            rendezvous(key, weights).cast("int").alias("shard"),
            rendezvous(key, [*weights, grown]).cast("int").alias("grown_shard"),
            F.spark_partition_id().alias("part"),
        ),
        "shards",
    )
    # One row for each shard and input partition: the window over a shard holds as many rows as there were tasks.
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "part").agg(F.count("*").alias("rows")).select(
        "shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))
    ranked = placed.withColumn("rank", rank)
    return ranked.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard")
