"""Stored views that are refreshed from the changed source partitions only.

A view has two tables. ``<name>_partials`` holds the sums of every source
partition; ``<name>`` holds the sums over all of them. A refresh compares the
marks of the source's files with those of the last one, reads the changed
partitions, and adds to the sums what the new partials have more than the old
ones (old partials count as retractions). A key without rows left disappears.

A refresh first stores the new partials and the differences and notes them.
Everything after the note can be done again with the same result: partials are
replaced, and the folder of the sums carries the number of the refresh, so
differences are never added twice. A refresh that died is ended by the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import config
from demandloom.session import remove_path
from demandloom.sinks import swap, tables

ROWS = "_rows"


class IncrementalCube:
    """Sums of ``measures`` by ``keys`` over a table partitioned by ``period``.

    ``measures`` are row-level columns of an exact type (integers or decimals):
    sums of floating numbers would depend on the order of the refreshes. A
    measure that is NULL in all rows sums to 0. NULL keys are keys like others.
    """

    def __init__(self, spark: SparkSession, source: str, name: str, keys: Sequence[str], measures: Mapping[str, Column],
                 period: str = config.PERIOD):
        self.spark, self.source, self.name, self.keys, self.period = spark, source, name, list(keys), period
        self.measures, self.partials = dict(measures), f"{name}_partials"
        if {ROWS, period} & {*keys, *measures}:
            raise ValueError(f"{ROWS} and {period} are columns of the stored tables")

    def lines(self, values: Sequence[str]) -> DataFrame:
        """The source rows of the partitions; no other partition is read."""
        rows = self.spark.table(self.source)
        return rows.where(F.col(self.period).isin([tables._typed(rows, self.period, v) for v in values]))

    def _summed(self, rows: DataFrame, *more: str) -> DataFrame:
        names = [*self.measures, ROWS]
        return rows.groupBy(*self.keys, *more).agg(*[F.sum(n).alias(n) for n in names])

    def _sums(self, lines: DataFrame) -> DataFrame:
        """Partials of the lines, a row per key and source partition."""
        rows = lines.select(*self.keys, self.period, *[F.coalesce(m, F.lit(0)).alias(n) for n, m in self.measures.items()],
                            F.lit(1).cast("long").alias(ROWS))
        inexact = [n for n in self.measures if rows.schema[n].dataType.typeName() in ("double", "float")]
        if inexact:
            raise ValueError(f"measures are not exact: {inexact}")
        return self._summed(rows, self.period)

    def _prepare(self) -> None:
        if not self.spark.catalog.tableExists(self.name):
            empty = self._sums(self.lines([]))
            tables.replace_table(empty, self.partials, [self.period])
            tables.replace_table(self._summed(empty), self.name)

    def _numbers(self, prefix: str) -> list[int]:
        """Numbers of the notes with the prefix."""
        names = swap._names(self.spark, self.folder)
        return sorted(int(n[len(prefix):-len(".json")]) for n in names if n.startswith(prefix) and n.endswith(".json"))

    @property
    def folder(self) -> str:
        return f"{swap.root(self.spark, self.name)}/_versions"

    def refresh(self) -> list[str]:
        """Bring the view up to date; the source partitions that were read or had gone."""
        self._prepare()
        folder = self.folder
        for number in self._numbers("pending-"):
            self._apply(number)
        done = self._numbers("state-")
        number = done[-1] + 1 if done else 1
        known = swap._read(self.spark, f"{folder}/state-{number - 1}.json")["marks"] if done else {}
        self.spark.catalog.refreshTable(self.source)
        marks = swap.partition_marks(self.spark, self.source, self.period)
        changed = sorted(v for v in marks if marks[v] != known.get(v))
        gone = sorted(set(known) - set(marks))
        if not changed and not gone:
            return []
        new, delta = f"{folder}/new-{number}", f"{folder}/delta-{number}"
        sums = self._sums(self.lines(changed))
        sums.write.mode("overwrite").parquet(new)
        stored = self.spark.table(self.partials)
        old = stored.where(F.col(self.period).isin([tables._typed(stored, self.period, v) for v in [*changed, *gone]]))
        names = [*self.measures, ROWS]
        retracted = old.select(*self.keys, *[(-F.col(n)).cast(sums.schema[n].dataType).alias(n) for n in names])
        fresh = self.spark.read.schema(sums.schema).parquet(new)
        differences = self._summed(fresh.select(*self.keys, *names).unionByName(retracted))
        some = reduce(lambda a, b: a | b, [F.col(n) != 0 for n in names])
        differences.where(some).write.mode("overwrite").parquet(delta)
        swap._note(self.spark, f"{folder}/pending-{number}.json", {"marks": marks, "touched": [*changed, *gone]})
        self._apply(number)
        return [*changed, *gone]

    def _apply(self, number: int) -> None:
        """Put a noted refresh in place; doing it again changes nothing."""
        spark, folder = self.spark, self.folder
        note = swap._read(spark, f"{folder}/pending-{number}.json")
        stored = spark.table(self.partials)
        touched = [tables._typed(stored, self.period, v) for v in note["touched"]]
        fresh = spark.read.schema(stored.schema).parquet(f"{folder}/new-{number}").select(*stored.columns)
        swap.swap_partitions(fresh, self.partials, touched, self.period)
        path = f"{folder}/sums-{number}"
        if swap.location(spark, self.name).rstrip("/").rsplit("/", 1)[-1] != f"sums-{number}":
            sums = spark.table(self.name)
            delta = spark.read.schema(sums.schema).parquet(f"{folder}/delta-{number}")
            kinds = {f.name: f.dataType for f in sums.schema.fields}
            merged = self._summed(sums.unionByName(delta)).where(F.col(ROWS) > 0)
            merged.select(*[F.col(c).cast(kinds[c]) for c in sums.columns]).write.mode("overwrite").parquet(path)
            swap._alter(spark, self.name, f"SET LOCATION {tables.sql_text(path)}")
            spark.catalog.refreshTable(self.name)
        swap._note(spark, f"{folder}/state-{number}.json", {"marks": note["marks"]})
        for leftover in (f"pending-{number}.json", f"new-{number}", f"delta-{number}", f"state-{number - 1}.json", f"sums-{number - 2}"):
            remove_path(spark, f"{folder}/{leftover}")

    def result(self) -> DataFrame:
        return self.spark.table(self.name).drop(ROWS)
