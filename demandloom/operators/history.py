"""Dimension history (type 2): one row per period in which nothing changed.

A key with very many versions is not sorted in one task. Versions are cut into
time chunks per key; the ordering window runs inside (key, chunk), and only
one summary row per chunk is compared across chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.operators.merging import latest_per_key

HISTORY_COLUMNS = ("valid_from_ts", "valid_to_ts", "is_current_flg")


def _with_neighbour(rows: DataFrame, keys: Sequence[str], value: str, previous: bool) -> DataFrame:
    """Add ``_near``: ``value`` of the previous (or next) row of the key by ``_at``."""
    group = [*keys, "_chunk"]
    inside = Window.partitionBy(*group).orderBy("_at")
    edge = F.max_by(value, "_at") if previous else F.min_by(value, "_at")
    across = Window.partitionBy(*keys).orderBy("_chunk")
    step = F.lag if previous else F.lead
    edges = (
        rows.groupBy(*group)
        .agg(edge.alias("_edge"))
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(group)],
            step("_edge").over(across).alias("_outer"),
        )
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(group)]
    first_or_last = step(F.lit(True)).over(inside).isNull()
    return (
        rows.withColumns({"_inner": step(value).over(inside), "_border": first_or_last})
        .join(edges, on, "left")
        .withColumn("_near", F.when(F.col("_border"), F.col("_outer")).otherwise(F.col("_inner")))
        .drop("_inner", "_border", "_outer", *[f"_k{i}" for i in range(len(group))])
    )


def dimension_history(
    versions: DataFrame, keys: Sequence[str], at: str, attributes: Sequence[str],
    chunk: str = "month", tie_break: Sequence[str] = (),
) -> DataFrame:
    """Versions (key, time, attributes) to validity periods.

    Versions of one key at the same time are reduced to one (largest by
    ``tie_break``, then by the attributes); a version that changes nothing is
    merged into the one before it.
    """
    single = latest_per_key(
        versions.select(*keys, at, *dict.fromkeys([*tie_break, *attributes])), [*keys, at], list(tie_break)
    )
    rows = single.select(
        *keys, F.col(at).alias("_at"), F.date_trunc(chunk, at).alias("_chunk"),
        F.struct(*attributes).alias("_state"),
    )
    compared = _with_neighbour(rows, keys, "_state", previous=True)
    changes = compared.where(F.col("_near").isNull() | ~F.col("_near").eqNullSafe(F.col("_state"))).drop("_near")
    closed = _with_neighbour(changes, keys, "_at", previous=False)
    return closed.select(
        *keys, "_state.*",
        F.col("_at").alias("valid_from_ts"),
        F.col("_near").alias("valid_to_ts"),
        F.col("_near").isNull().alias("is_current_flg"),
    )


def extend_history(
    history: DataFrame, changes: DataFrame, keys: Sequence[str], at: str, attributes: Sequence[str],
    chunk: str = "month",
) -> DataFrame:
    """Add new versions to an existing history; only the keys that changed are rebuilt. NULL is a key like any other."""
    touched = changes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    same = history.join(touched, on, "left_anti")
    reopened = history.join(touched, on, "left_semi").select(
        *keys, F.col("valid_from_ts").alias(at), *attributes, F.lit(0).alias("_arrival")
    )
    arriving = changes.select(*keys, at, *attributes, F.lit(1).alias("_arrival"))
    rebuilt = dimension_history(
        reopened.unionByName(arriving), keys, at, attributes, chunk, tie_break=["_arrival"]
    )
    return same.unionByName(rebuilt)
