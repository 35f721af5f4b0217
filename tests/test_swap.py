"""One-step replacement and the key index."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from demandloom.sinks import keyindex, swap, tables

SCHEMA = "k string, v int, p int"


def rows(df):
    return sorted(map(tuple, df.select("k", "v", "p").collect()), key=str)


class Killed(Exception):
    pass


def killer(monkeypatch, name, at):
    """Let the function die at its call number ``at``."""
    real, calls = getattr(swap, name), [0]

    def wrapped(*args, **kwargs):
        calls[0] += 1
        if calls[0] == at:
            raise Killed
        return real(*args, **kwargs)

    monkeypatch.setattr(swap, name, wrapped)


def test_swap_table_reads_itself_and_keeps_a_running_reader(spark, database):
    name = f"{database}.t"
    df = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], SCHEMA)
    swap.swap_table(df, name)
    reader = spark.table(name)
    swap.swap_table(spark.table(name).withColumn("v", F.col("v") + 1), name)
    assert rows(reader) == [("a", 1, 1), ("b", 2, 1)]  # planned before the swap
    swap.swap_table(spark.table(name).withColumn("v", F.col("v") + 1), name)
    assert rows(spark.table(name)) == [("a", 3, 1), ("b", 4, 1)]
    with pytest.raises(ValueError):
        swap.swap_table(df.drop("v"), name)


def test_killed_table_writer_leaves_old_or_new(spark, database, monkeypatch):
    name = f"{database}.t"
    old, new = [("a", 1, 1)], [("b", 2, 2)]
    swap.swap_table(spark.createDataFrame(old, SCHEMA), name)
    killer(monkeypatch, "_alter", 1)
    with pytest.raises(Killed):
        swap.swap_table(spark.createDataFrame(new, SCHEMA), name)
    assert rows(spark.table(name)) == old
    swap.swap_table(spark.createDataFrame(new, SCHEMA), name)
    assert rows(spark.table(name)) == new


OLD = [("a", 1, 1), ("b", 1, 2), ("c", 1, 3), ("z", 1, 9)]
NEW = [("a", 2, 2), ("b", 2, 4), ("z", 1, 9)]


@pytest.mark.parametrize("name,at,want", [("_note", 1, OLD), ("_alter", 1, NEW), ("_alter", 3, NEW), ("_alter", 6, NEW), ("remove_path", 1, NEW)])
def test_killed_partition_writer_leaves_old_or_new(spark, database, monkeypatch, name, at, want):
    """Partition 1 and 3 are emptied, 2 changes, 4 is new; whoever comes next ends what was noted."""
    table = f"{database}.t"
    tables.replace_table(spark.createDataFrame(OLD, SCHEMA), table, ["p"])
    swap.recover_swaps(spark, table)
    with monkeypatch.context() as patched:
        killer(patched, name, at)
        with pytest.raises(Killed):
            swap.swap_partitions(spark.createDataFrame(NEW[:2], SCHEMA), table, [1, 2, 3, 4], "p")
    swap.recover_swaps(spark, table)
    assert rows(spark.table(table)) == sorted(want, key=str)
    swap.swap_partitions(spark.createDataFrame(NEW[:2], SCHEMA), table, [1, 2, 3, 4], "p")
    assert rows(spark.table(table)) == sorted(NEW, key=str) and swap.recover_swaps(spark, table) == 0
    with pytest.raises(ValueError):
        swap.swap_partitions(spark.createDataFrame([("q", 1, 7)], SCHEMA), table, [1], "p")


def test_old_versions_go(spark, database):
    table = f"{database}.t"
    tables.replace_table(spark.createDataFrame(OLD, SCHEMA), table, ["p"])
    for k in range(4):
        swap.swap_partitions(spark.createDataFrame([("a", k, 1)], SCHEMA), table, [1], "p")
    assert len(swap._names(spark, swap.versions(spark, table))) <= 2
    assert ("a", 3, 1) in rows(spark.table(table)) and len(rows(spark.table(table))) == 4


def test_indexed_upserts_equal_plain_ones(spark, database):
    """Keys that stay, move and come new, in several loads; one load passes the index by."""
    rng = random.Random(2)
    plain, indexed = f"{database}.plain", f"{database}.indexed"
    for load in range(4):
        batch = {f"k{rng.randrange(80)}": (load, rng.randrange(6)) for _ in range(5 if load else 60)}
        df = spark.createDataFrame([(k, v, p) for k, (v, p) in batch.items()], SCHEMA)
        tables.upsert(plain, df, ["k"], partition_by="p")
        tables.upsert(indexed, df, ["k"], partition_by="p", swap=load != 2, indexed=load != 2)
        assert rows(spark.table(indexed)) == rows(spark.table(plain))
        assert len({k for k, _, _ in rows(spark.table(indexed))}) == spark.table(indexed).count()


def test_index_prunes_partitions_and_misses_no_home(spark, database):
    table = f"{database}.t"
    df = spark.range(4000).selectExpr("concat('k', id) AS k", "CAST(id AS int) AS v", "CAST(id % 20 AS int) AS p")
    tables.upsert(table, df, ["k"], partition_by="p", indexed=True)
    arriving = spark.createDataFrame([("k5", 1, 1), ("k105", 1, 1), ("k46", 1, 1), ("new", 1, 1)], SCHEMA)
    found = set(keyindex.possible_homes(spark, table, arriving, ["k"], "p"))
    assert {"5", "6"} <= found and len(found) <= 6
    # A partition somebody else wrote is always a possible home.
    with tables.dynamic_overwrite(spark):
        spark.createDataFrame([("k46", 0, 13)], SCHEMA).select("k", "v", "p").write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    assert "13" in keyindex.possible_homes(spark, table, arriving, ["k"], "p")
    nothing = spark.createDataFrame([("absent", 1, 1)], SCHEMA)
    assert len(keyindex.possible_homes(spark, table, nothing, ["k"], "p")) <= 3
