"""Dimension joins that check the size of what they broadcast.

A dimension is measured once. Under the limit, a share of the driver's heap, it
is broadcast. Beyond it both sides are shuffled on the key plus a salt. The salt is 0 except for keys (NULL
among them) with at least ``HOT_ROWS`` rows: their facts are spread over as
many salts as they have times that number of rows, and only their lookup rows
are copied.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.session import freeing_shuffles, remove_path, scratch_path

BROADCAST_BYTES = 256 * 1024 * 1024
# A lookup's rows, hash table and blocks are in the driver's heap at once, some
# eight times its bytes, and those of several lookups together.
HEAP_SHARE = 64
# A key with fewer rows is no burden for one task.
HOT_ROWS = 1_000_000
# Parts that keys are counted in before any key is counted by itself.
KEY_BUCKETS = 1 << 14
# Rows of a list of hot keys that is broadcast; a longer one is joined by a shuffle.
HOT_LIST = 1_000_000


@dataclass(frozen=True)
class Dimension:
    """A lookup table, the fact columns that match its key, and what to fetch."""

    table: DataFrame
    keys: tuple[str, ...]
    on: tuple[str, ...]

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.table.columns if c not in self.keys]


def broadcast_bytes(spark: SparkSession) -> int:
    """The largest lookup, in the bytes of :func:`measure`, that the driver has room to broadcast beside others."""
    return min(BROADCAST_BYTES, spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // HEAP_SHARE)


def _row_bytes(df: DataFrame) -> Column:
    # 32 bytes of row overhead, 8 per column, plus the text itself.
    fixed = F.lit(32 + 8 * len(df.columns))
    texts = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    ]
    return reduce(lambda a, b: a + b, texts, fixed).cast("long")


def measure(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Size of each table in bytes, counted over its rows; one job for all."""
    parts = [
        df.agg(F.sum(_row_bytes(df)).alias("bytes")).select(F.lit(name).alias("name"), "bytes")
        for name, df in tables.items()
    ]
    found = reduce(DataFrame.unionByName, parts).collect()  # one row per table
    return {r["name"]: r["bytes"] or 0 for r in found}


def require_unique_keys(dimensions: Mapping[str, Dimension]) -> None:
    """Refuse dimensions whose repeated keys would multiply the facts."""
    parts = [
        d.table.groupBy(*d.keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .agg(F.count(F.lit(1)).alias("repeated")).select(F.lit(name).alias("name"), "repeated")
        for name, d in dimensions.items()
    ]
    repeated = sorted(r["name"] for r in reduce(DataFrame.unionByName, parts).collect() if r["repeated"])
    if repeated:
        raise ValueError(f"repeated keys would multiply quantities, in dimensions: {repeated}")


def key_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per combination of the columns, as ``_n``, stored so that several lookups can be counted from it."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return stored(counts, "keycounts")


@contextmanager
def passing(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows written to the shared folder and read back; the files go at the end of the block."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with freeing_shuffles(spark):
        df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back; the files go when the program ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with freeing_shuffles(spark):
        df.write.parquet(path)

    def clean() -> None:
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001 - the session has ended; the folder is scratch
            pass

    atexit.register(clean)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(rows: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame | None:
    """All keys with at least ``min_rows`` rows, as ``_hot_0``…, and over how many salts they are spread.

    ``rows`` are the rows themselves or counts of them in ``_n``. None if there
    is no such key. There are at most rows / ``min_rows`` of them.
    """
    n = F.sum("_n") if "_n" in rows.columns else F.count(F.lit(1))
    named = rows.groupBy(*keys).agg(n.alias("_n")).where(F.col("_n") >= min_rows).select(
        *[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)],
        (F.ceil(F.col("_n") / min_rows) + 1).cast("int").alias("_salts"),
    )
    found = stored(named, "hotkeys")
    return None if found.isEmpty() else found


def hot_lists(rows: DataFrame, lookups: Mapping[str, Sequence[str]], min_rows: int) -> dict[str, DataFrame | None]:
    """:func:`hot_keys` of several lookups (name: key columns of ``rows``).

    One pass counts the rows per bucket of each lookup's keys, which shuffles
    almost nothing. A hot key's bucket has as many rows, so only the rows of
    such buckets, mostly none, are counted by key.
    """
    def bucket(on: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*on), F.lit(KEY_BUCKETS)).cast("int")

    each = [F.struct(F.lit(i).alias("_list"), bucket(on).alias("_bucket")) for i, on in enumerate(lookups.values())]
    counted = rows.select(F.inline(F.array(*each))).groupBy("_list", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    full = stored(counted.where(F.col("_n") >= min_rows), "hotbuckets")
    lists = {r[0] for r in full.select("_list").distinct().collect()}
    wanted = {n: on for i, (n, on) in enumerate(lookups.items()) if i in lists}
    if not wanted:
        return dict.fromkeys(lookups)
    marked, found = rows, F.lit(False)
    for i, on in enumerate(lookups.values()):
        if i in lists:
            listed = full.where(F.col("_list") == i).select(F.col("_bucket").alias(f"_bucket_{i}"))
            marked = marked.join(F.broadcast(listed), bucket(on) == F.col(f"_bucket_{i}"), "left")
            found = found | F.col(f"_bucket_{i}").isNotNull()
    counts = key_counts(marked.where(found), sorted({c for on in wanted.values() for c in on}))
    return dict.fromkeys(lookups) | {n: hot_keys(counts, on, min_rows) for n, on in wanted.items()}


def _salted(rows: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add ``_salts``, 1 for all keys that are not in the list."""
    listed = F.broadcast(hot) if hot.count() <= HOT_LIST else hot
    on = [rows[k].eqNullSafe(listed[f"_hot_{i}"]) for i, k in enumerate(keys)]
    joined = rows.join(listed, on, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    return joined.drop(*[f"_hot_{i}" for i in range(len(keys))])


def spread_join(
    rows: DataFrame, on: Sequence[str], lookup: DataFrame, keys: Sequence[str], how: str,
    min_rows: int = HOT_ROWS, hot: DataFrame | None = None, counted: bool = False, salt_by: Sequence[str] = (),
) -> DataFrame:
    """Shuffle join (left or left_anti) in which no key of ``rows`` falls on one task.

    ``lookup`` names its columns apart from those of ``rows``. ``hot`` is the
    list of :func:`hot_keys` if that is ``counted`` already. The salt comes from
    the row, by the columns ``salt_by`` (all of them if none are named), not
    from chance: a repeated task gives the same rows.
    """
    hot = hot if counted else hot_lists(rows, {"": on}, min_rows)[""]
    if hot is None:
        return rows.join(lookup, [rows[c] == lookup[k] for c, k in zip(on, keys)], how)
    salt = F.pmod(F.xxhash64(*(salt_by or rows.columns)), F.col("_salts")).cast("int")
    spread = _salted(rows, on, hot).withColumn("_salt", F.when(F.col("_salts") > 1, salt).otherwise(0)).drop("_salts")
    copies = _salted(lookup, keys, hot).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    pairs = [spread[c] == copies[k] for c, k in zip(on, keys)]
    joined = spread.join(copies, [*pairs, spread["_salt"] == copies["_copy"]], how)
    return joined.drop("_salt", "_copy")


def left_join_dimension(
    fact: DataFrame, dimension: Dimension, fits_broadcast: bool, min_rows: int = HOT_ROWS,
    hot: DataFrame | None = None, counted: bool = False, salt_by: Sequence[str] = (),
) -> DataFrame:
    """Left join on equal keys; the attributes are added to the fact's columns."""
    keys = [f"_key_{i}" for i in range(len(dimension.keys))]
    renamed = dimension.table.select(
        *[F.col(k).alias(name) for k, name in zip(dimension.keys, keys)], *dimension.attributes
    )
    if fits_broadcast:
        on = [fact[c] == renamed[k] for c, k in zip(dimension.on, keys)]
        joined = fact.join(F.broadcast(renamed), on, "left")
    else:
        joined = spread_join(fact, dimension.on, renamed, keys, "left", min_rows, hot, counted, salt_by)
    return joined.select(*fact.columns, *dimension.attributes)


def nested(dimension: Dimension, by: str, name: str) -> DataFrame:
    """The lookup's rows with a ``by``, as a list ``name`` of all its other columns for each value of ``by``."""
    rest = [c for c in dimension.table.columns if c != by]
    known = dimension.table.where(F.col(by).isNotNull())
    return known.groupBy(by).agg(F.collect_list(F.struct(*rest)).alias(name))


def _equals(field: str, column: str) -> Callable[[Column], Column]:
    return lambda row: row[field] == F.col(column)


def left_join_nested(
    fact: DataFrame, on: str, dimensions: Mapping[str, Dimension], min_rows: int = HOT_ROWS,
    hot: DataFrame | None = None, salt_by: Sequence[str] = (),
) -> DataFrame:
    """Left joins with several large lookups whose keys all have the column ``on``: the fact is shuffled once.

    The lookups are nested by that column and joined with each other first;
    the rest of a key is compared inside the row. A repeated key gives several
    rows, as the joins one by one do. ``hot`` is the list of :func:`hot_lists` for ``on``.
    """
    lookup = None
    for i, d in enumerate(dimensions.values()):
        by = d.keys[d.on.index(on)]
        one = nested(d, by, f"_rows_{i}").withColumnRenamed(by, "_key")
        lookup = one if lookup is None else lookup.join(one, "_key", "full")
    joined = spread_join(fact, [on], lookup, ["_key"], "left", min_rows, hot, True, salt_by)
    columns = list(fact.columns)
    for i, d in enumerate(dimensions.values()):
        rows = F.col(f"_rows_{i}")
        for k, c in zip(d.keys, d.on):
            if c != on:
                rows = F.filter(rows, _equals(k, c))
        joined = joined.withColumn(f"_row_{i}", F.explode_outer(rows)).drop(f"_rows_{i}")
        columns += [F.col(f"_row_{i}.{a}").alias(a) for a in d.attributes]
    return joined.select(*columns)


def full_join_filled(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Full outer join; numeric gaps become 0. NULL keys stay separate rows."""
    return left.join(right, key, "full").fillna(0)


def orphans(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
    limit: int | None = None, min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Child rows whose key has no parent. NULL keys count as orphans. ``limit``: as of :func:`broadcast_bytes`."""
    limit = broadcast_bytes(child.sparkSession) if limit is None else limit
    # Stored, because it is measured and joined.
    parents = stored(parent.select(F.col(parent_key).alias("_parent")).distinct(), "parents")
    if measure({"parents": parents})["parents"] <= limit:
        return child.join(F.broadcast(parents), child[child_key] == F.col("_parent"), "left_anti")
    return spread_join(child, [child_key], parents, ["_parent"], "left_anti", min_rows)
