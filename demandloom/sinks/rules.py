"""Rules that a table keeps and that hold for every later write.

Key, NOT NULL and value rules are stored with the table as one property.
``append``, ``upsert`` and ``replace_table`` read it and test the arriving rows
before anything of the table changes. The source is computed once: it is
written to the shared folder with the reasons of each row, then either all of
it is refused, or the broken rows go to a quarantine table (their reasons in
``_broken``) and the others are written. Partition rewrites of the merge keep
the rows that are already in the table, which were tested when they came.

* ``not_null:<column>``: the value is missing.
* ``check:<name>``: the condition is false; an unknown condition (NULL) passes.
* ``key:null``: part of the key is missing.
* ``key:repeated``: several arriving rows have the key; all of them are broken.
* ``key:taken``: an appended row has a key of the table; in a merge it is an update.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROPERTY = "write_rules"
BROKEN = "_broken"


@dataclass(frozen=True)
class Rules:
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> set[str]:
        """The columns that must not be absent."""
        return {*self.key, *self.not_null}

    def with_key(self, key: Sequence[str]) -> Rules:
        return replace(self, key=tuple(key))


def stored_rules(spark: SparkSession, table: str) -> Rules | None:
    """The rules of a table; none if it has none or does not exist."""
    from demandloom.sinks.tables import quote

    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {quote(table)}").where(F.col("key") == PROPERTY).first()
    if not found:
        return None
    stored = json.loads(found["value"])
    return Rules(tuple(stored["key"]), tuple(stored["not_null"]), stored["checks"])


def store_rules(spark: SparkSession, table: str, rules: Rules) -> None:
    from demandloom.sinks.tables import describe

    value = json.dumps({"key": rules.key, "not_null": rules.not_null, "checks": dict(rules.checks)})
    describe(spark, table, properties={PROPERTY: value})


def set_rules(spark: SparkSession, table: str, key: Sequence[str] = (), not_null: Sequence[str] = (),
              checks: Mapping[str, str] | None = None) -> Rules:
    """Give a table its rules in place of earlier ones. An error if its present rows break them."""
    rules = Rules(tuple(key), tuple(not_null), dict(checks or {}))
    _refuse(_reason_counts(with_reasons(spark.table(table), rules)), table)
    store_rules(spark, table, rules)
    return rules


def with_reasons(df: DataFrame, rules: Rules, taken: DataFrame | None = None) -> DataFrame:
    """The rows with ``_broken``, the reasons against each (an empty list: none)."""
    tests: list[Column] = [F.when(F.col(f"`{c}`").isNull(), f"not_null:{c}") for c in rules.not_null]
    tests += [F.when(~F.coalesce(F.expr(f"({test})"), F.lit(True)), f"check:{name}") for name, test in rules.checks.items()]
    rows = df
    if rules.key:
        keys = [F.col(f"`{k}`") for k in rules.key]
        missing = keys[0].isNull()
        for k in keys[1:]:
            missing = missing | k.isNull()
        tests.append(F.when(missing, "key:null"))
        repeated = df.where(~missing).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
        rows = rows.join(repeated.withColumn("_repeated", F.lit(True)).drop("_rows"), list(rules.key), "left")
        tests.append(F.when(F.col("_repeated"), "key:repeated"))
        if taken is not None:
            known = taken.select(*keys).join(df.select(*keys), list(rules.key), "left_semi").distinct()
            rows = rows.join(known.withColumn("_taken", F.lit(True)), list(rules.key), "left")
            tests.append(F.when(F.col("_taken"), "key:taken"))
    reasons = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], reasons.alias(BROKEN))


def _reason_counts(marked: DataFrame) -> dict[str, int]:
    """Rows per reason; there are as many reasons as rules."""
    return {r[0]: r[1] for r in marked.select(F.explode(BROKEN)).groupBy("col").count().collect()}


def _refuse(counts: Mapping[str, int], table: str | None) -> None:
    if counts:
        told = ", ".join(f"{reason} {rows}" for reason, rows in sorted(counts.items()))
        raise ValueError(f"rows break the rules{f' of {table}' if table else ''}: {told}")


@contextmanager
def held(df: DataFrame, rules: Rules, table: str | None = None, quarantine: str | None = None, load: str | None = None,
         taken: DataFrame | None = None) -> Iterator[DataFrame]:
    """The rows that keep the rules. The others go to ``quarantine``; without one, all are refused.

    ``load`` names the column of the load, so that a load that runs again replaces its own quarantined rows.
    """
    from demandloom.sinks.tables import append, replace_loads, staged

    counts: dict[str, int] = {}
    with staged(with_reasons(df, rules, taken)) as marked:
        broken = marked.where(F.size(BROKEN) > 0)
        if not quarantine:
            counts = _reason_counts(broken)
        elif load:
            replace_loads(quarantine, broken, load)
        else:
            append(quarantine, broken)
        if not counts:
            yield marked.where(F.size(BROKEN) == 0).drop(BROKEN)
            return
    _refuse(counts, table)
