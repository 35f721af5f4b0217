"""Incremental views against full recomputation."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from demandloom.sinks import swap, tables
from demandloom.sinks.cubes import IncrementalCube
from test_swap import Killed, killer

SCHEMA = "id int, g string, q int, p int"


def cube_of(spark, database):
    return IncrementalCube(spark, f"{database}.lines", f"{database}.cube", ["g"], {"q": F.col("q").cast("long")}, "p")


def full(spark, database):
    rows = spark.table(f"{database}.lines").groupBy("g").agg(F.coalesce(F.sum("q"), F.lit(0)).alias("q"))
    return sorted(map(tuple, rows.collect()), key=str)


def got(cube):
    return sorted(map(tuple, cube.result().collect()), key=str)


def load(spark, database, rows):
    tables.upsert(f"{database}.lines", spark.createDataFrame(rows, SCHEMA), ["id"], partition_by="p", swap=True)


def test_refreshes_equal_recomputation(spark, database):
    rng = random.Random(4)
    cube = cube_of(spark, database)
    for k in range(3):
        load(spark, database, [(rng.randrange(60), rng.choice(["a", "b", None, f"only{k}"]), rng.choice([None, 1, 5, -5]), rng.randrange(8))
                               for _ in range(1)] + [(100 * k + i, "abc"[i % 3], i, (k + i) % 3) for i in range(9)])
        cube.refresh()
        assert got(cube) == full(spark, database)
    assert cube.refresh() == []
    tables.delete_where(spark, f"{database}.lines", F.lit(True), [0], "p")
    assert "0" in cube.refresh() and got(cube) == full(spark, database)


def test_only_changed_partitions_are_read(spark, database):
    cube = cube_of(spark, database)
    load(spark, database, [(k, "a", k, k % 10) for k in range(50)])
    assert cube.refresh() == [str(k) for k in range(10)]
    load(spark, database, [(3, "b", 7, 3), (4, "a", 1, 8)])  # one corrected, one moved from 4 to 8
    assert cube.refresh() == ["3", "4", "8"]
    files = cube._sums(cube.lines(["3", "4", "8"])).inputFiles()
    assert files and {f.rsplit("/p=", 1)[1].split("/")[0] for f in files} == {"3", "4", "8"}
    assert got(cube) == full(spark, database)


@pytest.mark.parametrize("name,at", [("_note", 1), ("_note", 2), ("_note", 3), ("_alter", 4), ("_alter", 6)])
def test_a_killed_refresh_is_ended_by_the_next(spark, database, monkeypatch, name, at):
    cube = cube_of(spark, database)
    load(spark, database, [(1, "a", 1, 1), (2, "b", 2, 2)])
    cube.refresh()
    load(spark, database, [(1, "a", 10, 1), (2, "b", 5, 1), (3, "c", 1, 3)])
    with monkeypatch.context() as patched:
        killer(patched, name, at)
        with pytest.raises(Killed):
            cube.refresh()
    cube.refresh()
    assert got(cube) == full(spark, database) == [("a", 10), ("b", 5), ("c", 1)]


def test_floating_measures_are_refused(spark, database):
    load(spark, database, [(1, "a", 1, 1)])
    with pytest.raises(ValueError):
        IncrementalCube(spark, f"{database}.lines", f"{database}.c", ["g"], {"x": F.col("q") * 0.5e0}, "p").refresh()
    assert swap.partition_marks(spark, f"{database}.lines", "p").keys() == {"1"}
