"""Transitive substitution chains: every part's last successor, found by pointer jumping.

A part names its successor (``head``); the successor may be replaced itself. In
round k every open part knows where it stands after ``2 ** k`` steps, so a chain
of any length takes a logarithmic number of joins. Each round's pointers are
stored, which cuts the lineage; parts that have arrived take no part in later
joins, so a successor that very many parts end in is never a hot key, and one
that many parts pass through is salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.joins import HOT_ROWS, spread_join
from demandloom.session import remove_path, scratch_path


def chain_closure(
    parts: DataFrame, group: Sequence[str] = ("empresa",), part: str = "material", head: str = "item_principal_cadeia",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """group, part, ``head``, ``depth`` (steps to it) and ``cycle``.

    A chain ends at a part without a successor, with itself as successor, or
    with one that is no part of the group. A part that is on a cycle, or whose
    chain runs into one, has no last successor: it keeps its own number as
    head, ``cycle`` is true and ``depth`` NULL. A repeated part follows its
    smallest successor. NULL is a group like any other; rows without a part
    are left out.
    """
    spark = parts.sparkSession
    groups = [f"_g{i}" for i in range(len(group))]
    single = parts.where(F.col(part).isNotNull()).groupBy(
        *[F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")).alias(n) for g, n in zip(group, groups)],
        *[F.col(g) for g in group], F.col(part).alias("_part"),
    ).agg(F.min(head).alias("_to"))
    paths: list[str] = []

    def kept(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "chains"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    # A part whose successor is NULL or itself has arrived; so has one that points at no part of its group.
    start = kept(single)
    names = start.select(*[F.col(g).alias(f"_n{i}") for i, g in enumerate(groups)], F.col("_part").alias("_known"))
    keys = [f"_n{i}" for i in range(len(groups))]
    self_end = F.col("_to").isNull() | (F.col("_to") == F.col("_part"))
    marked = spread_join(start.where(~self_end), [*groups, "_to"], names, [*keys, "_known"], "left", min_rows)
    columns = [*groups, *group, "_part"]
    state = kept(
        start.where(self_end).select(*columns, F.col("_part").alias("_to"), F.lit(0).cast("long").alias("_steps"), F.lit(True).alias("_done"))
        .unionByName(marked.select(*columns, "_to", F.lit(1).cast("long").alias("_steps"), F.col("_known").isNull().alias("_done")))
    )
    arrived = [state.where("_done")]
    open_ = state.where("NOT _done")
    left = open_.count()
    while left:
        # Where the target stands: arrived parts of any round, and the open ones.
        jumps = arrived[0]
        for more in arrived[1:]:
            jumps = jumps.unionByName(more)
        jumps = jumps.unionByName(open_).select(
            *[F.col(g).alias(f"_n{i}") for i, g in enumerate(groups)], F.col("_part").alias("_known"),
            F.col("_to").alias("_next"), F.col("_steps").alias("_more"), F.col("_done").alias("_end"))
        joined = spread_join(open_.drop("_done"), [*groups, "_to"], jumps, [*keys, "_known"], "left", min_rows)
        state = kept(joined.select(*columns, F.col("_next").alias("_to"), (F.col("_steps") + F.col("_more")).alias("_steps"),
                                   F.col("_end").alias("_done")))
        arrived.append(state.where("_done"))
        open_, before = state.where("NOT _done"), left
        left = open_.count()
        if left == before:  # none arrived: what is left runs in cycles
            break
    ends = arrived[0]
    for more in arrived[1:]:
        ends = ends.unionByName(more)
    found = ends.select(*group, F.col("_part").alias(part), F.col("_to").alias(head), F.col("_steps").alias("depth"), F.lit(False).alias("cycle"))
    loops = open_.select(*group, F.col("_part").alias(part), F.col("_part").alias(head), F.lit(None).cast("long").alias("depth"),
                         F.lit(True).alias("cycle"))
    result = kept(found.unionByName(loops))
    for path in paths[:-1]:
        remove_path(spark, path)
    return result
