"""Data checks as DataFrames: one row per check, one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def key_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total rows, rows with an incomplete key, and number of repeated keys."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(incomplete, F.col("n"))), F.lit(0).cast("bigint")).alias("null_key_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


def _digest(*values: Column) -> list[Column]:
    """Two independent 64-bit hashes of the values, NULL told from all else: equal rows only, but for one chance in 2^64 or less."""
    parts = [p for v in values for p in (v.isNull(), v)]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def table_profile(df: DataFrame) -> DataFrame:
    """Metric rows: total rows, NULLs per column, surplus full-row copies.

    One scan and one shuffle, of a 128-bit digest per row with the bits of its
    NULLs; never of the rows. Equal rows have equal digests and equal bits, so
    everything is derived from the number of rows per digest. Maps are compared
    by their text.
    """
    columns = [F.col(f"`{c}`").cast("string") if "map<" in t else F.col(f"`{c}`") for c, t in df.dtypes]
    words = [
        reduce(lambda a, b: a.bitwiseOR(b),
               [F.when(c.isNull(), F.lit(1 << i).cast("long")).otherwise(0) for i, c in enumerate(columns[at:at + 60])])
        for at in range(0, len(columns), 60)
    ]
    one, two = _digest(*columns)
    marked = df.select(one.alias("_d1"), two.alias("_d2"), *[w.alias(f"_b{i}") for i, w in enumerate(words)])
    counts = marked.groupBy("_d1", "_d2", *[f"_b{i}" for i in range(len(words))]).agg(F.count(F.lit(1)).alias("_n"))
    nulls = [
        F.coalesce(F.sum(F.when(F.col(f"_b{i // 60}").bitwiseAND(F.lit(1 << (i % 60)).cast("long")) != 0, F.col("_n"))), F.lit(0))
        .cast("bigint") for i in range(len(columns))
    ]
    metrics = {
        "total_rows": F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint"),
        "duplicate_rows": F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint"),
        **{f"nulls:{c}": n for c, n in zip(df.columns, nulls)},
    }
    row = counts.agg(*[m.alias(f"m{i}") for i, m in enumerate(metrics.values())])
    cells = [
        F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("value"))
        for i, name in enumerate(metrics)
    ]
    return row.select(F.inline(F.array(*cells)))


def column_sketches(df: DataFrame, error: float = 0.02, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per column: its different values within a relative ``error``, and quantiles of numbers (ranks within a thousandth).

    Both are mergeable sketches, made in the scan; one small row per task is shuffled.
    """
    numbers = {"byte", "short", "integer", "long", "float", "double", "decimal"}
    cells = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        values = F.percentile_approx(c.cast("double"), list(quantiles), 1000) if f.dataType.typeName() in numbers else F.lit(None)
        cells.append(F.struct(F.lit(f.name).alias("column"), F.approx_count_distinct(c, error).alias("different"),
                              values.cast("array<double>").alias("quantiles")))
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def row_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per rule: rows checked and rows for which it is not true. One scan."""
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~F.coalesce(r, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules.values())],
    )
    cells = [
        F.struct(F.lit(name).alias("rule"), F.col("_rows").alias("rows"), F.col(f"r{i}").alias("failed"))
        for i, name in enumerate(rules)
    ]
    return row.select(F.inline(F.array(*cells))).withColumn("passed", F.col("failed") == 0)


def quality_report(
    df: DataFrame,
    keys: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
    domains: Mapping[str, Sequence[str]] | None = None,
    references: Mapping[str, tuple[DataFrame, str]] | None = None,
    rules: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per rule: key filled, type, value domain, unique key, reference, custom.

    ``types`` are tested by cast, so text columns can be checked before typing.
    NULL passes type and domain rules; keys and references test for it.

    The table is read once: each row becomes one entry per rule, with a digest
    of the key or value where the rule needs it, and one aggregation counts the
    entries. Parents add entries that mark their values as known.
    """
    tests: dict[str, Column] = {f"filled:{k}": F.col(k).isNotNull() for k in keys}
    for column, kind in (types or {}).items():
        tests[f"type:{column}"] = F.col(column).isNull() | F.col(column).cast("string").try_cast(kind).isNotNull()
    for column, allowed in (domains or {}).items():
        tests[f"domain:{column}"] = F.col(column).isNull() | F.col(column).isin(list(allowed))
    tests |= dict(rules or {})
    unique = [f"unique:{','.join(keys)}"] if keys else []
    names = [*tests, *unique, *[f"reference:{c}" for c in references or {}]]
    if not names:
        raise ValueError("name at least one rule")

    def entry(rule: str, digest: Sequence[Column], bad: Column, known: bool = False) -> Column:
        return F.struct(F.lit(names.index(rule)).alias("rule"), digest[0].alias("d1"), digest[1].alias("d2"),
                        bad.cast("long").alias("bad"), F.lit(0 if known else 1).cast("long").alias("n"), F.lit(known).alias("known"))

    none = [F.lit(0).cast("long")] * 2
    entries = [entry(name, none, ~F.coalesce(test, F.lit(False))) for name, test in tests.items()]
    entries += [entry(name, _digest(*[F.col(k) for k in keys]), F.lit(0)) for name in unique]
    entries += [entry(f"reference:{c}", _digest(F.col(c)), F.lit(0)) for c in references or {}]
    expanded = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    for column, (parent, parent_key) in (references or {}).items():
        value = F.col(parent_key).cast(df.schema[column].dataType)
        known = parent.where(value.isNotNull()).select(entry(f"reference:{column}", _digest(value), F.lit(0), True).alias("e"))
        expanded = expanded.unionByName(known.select("e.*"))
    # Tests of single rows shrink to one row a task before the shuffle, keys and values to one per task and digest.
    counts = expanded.groupBy("rule", "d1", "d2").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.max("known").alias("known"))
    place = F.col("rule")
    is_unique = place.isin([names.index(u) for u in unique]) if unique else F.lit(False)
    is_reference = place.isin([names.index(f"reference:{c}") for c in references]) if references else F.lit(False)
    failed = (F.when(is_unique, F.greatest(F.col("n") - 1, F.lit(0)))
              .when(is_reference, F.when(~F.col("known"), F.col("n")).otherwise(0)).otherwise(F.col("bad")))
    found = counts.groupBy("rule").agg(F.sum("n").alias("rows"), F.sum(failed).alias("failed"))
    zero = F.lit(0).cast("long")
    listed = df.sparkSession.createDataFrame(list(enumerate(names)), "number int, name string")
    return listed.join(found, F.col("number") == place, "left").select(
        F.col("name").alias("rule"), F.coalesce("rows", zero).alias("rows"), F.coalesce("failed", zero).alias("failed"),
        (F.coalesce("failed", zero) == 0).alias("passed"))
