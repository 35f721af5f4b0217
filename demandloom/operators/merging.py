"""Row-level merge, dedup, delete and append as DataFrame transformations.

These are pure functions from DataFrames to DataFrames. The table wrappers in
``demandloom.sinks.tables`` add staging and the swap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_full_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows to quarantine)."""
    complete = has_full_key(keys)
    return df.where(complete), df.where(~complete)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``order``, ties by the remaining columns.

    A struct maximum instead of a ranking window: it combines map-side, so a
    key that owns a large part of the rows shrinks to one row per input task
    before the shuffle, and the survivor does not depend on partitioning.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = F.struct(*[c for c in order if c not in keys], *rest)
    return (
        df.groupBy(*keys)
        .agg(F.max(ranked).alias("row"))
        .select(*[F.col(c) if c in keys else F.col(f"row.`{c}`") for c in df.columns])
    )


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """Update matching rows, insert the others; one full join on the key.

    ``source`` holds at most one row per key. Columns in ``keep_first`` keep
    the target's value when it has one. A key with a NULL part matches nothing.
    """
    columns = target.columns
    added = source.select(
        *[F.col(c).alias(f"_new_{c}") for c in columns if c in source.columns], F.lit(True).alias("_hit")
    )
    on = reduce(lambda a, b: a & b, [target[k] == added[f"_new_{k}"] for k in keys])

    def pick(name: str) -> Column:
        if name not in source.columns:
            return target[name]
        new = added[f"_new_{name}"]
        if name in keep_first:
            return F.coalesce(target[name], new).alias(name)
        return F.when(added["_hit"], new).otherwise(target[name]).alias(name)

    return target.join(added, on, "full").select(*[pick(c) for c in columns])


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append by name; a column missing on either side becomes NULL there."""
    return target.unionByName(source, allowMissingColumns=True)


def delete_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which ``predicate`` is not true; NULL results stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def in_month(column: str, year: int, month: int) -> Column:
    """Year and month test written as a range, so that it can be pushed down."""
    start = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    return (F.col(column) >= start) & (F.col(column) < F.add_months(start, 1))


def replace_period(target: DataFrame, source: DataFrame, period: Column, keys: Sequence[str]) -> DataFrame:
    """Drop the target rows of the periods that ``source`` brings and of its keys, then add its rows.

    NULL and 0 mean that the date is missing, which is no period: stored
    undated rows stay unless their key arrives. A key that moved to another
    period is stored once. A key with a NULL part matches nothing.
    """
    arriving = source.select(period.alias("_period")).where("_period IS NOT NULL AND _period <> 0").distinct()
    moved = source.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k) == F.col(f"_key_{i}") for i, k in enumerate(keys)]
    kept = target.join(arriving, period == F.col("_period"), "left_anti").join(moved, same, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))
