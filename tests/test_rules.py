"""Rules stored with a table hold for append, merge and replacement."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandloom.sinks import rules, tables

ROWS = "id long, cust string, price int, load string"
FIRST = [(1, "a", 5, "x"), (2, "b", None, "x")]
ODD = [(3, "c", 1, "y"), (3, "d", 2, "y"), (4, None, 1, "y"), (5, "e", -1, "y"), (None, "f", 1, "y"), (6, None, -2, "y")]
ASIDE = [("check:price", "e"), ("key:null", "f"), ("key:repeated", "c"), ("key:repeated", "d"),
         ("not_null:cust", None), ("not_null:cust,check:price", None)]


@pytest.fixture
def table(spark, database):
    name = f"{database}.held"
    tables.replace_table(spark.createDataFrame(FIRST, ROWS), name)
    rules.set_rules(spark, name, ["id"], ["cust"], {"price": "price >= 0"})
    return name


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def aside(spark, table):
    found = spark.table(table).select(F.array_join("_broken", ",").alias("why"), "cust")
    return sorted((tuple(r) for r in found.collect()), key=str)


WRITES = {
    "append": lambda df, table, **to: tables.append(table, df, **to),
    "merge": lambda df, table, **to: tables.upsert(table, df, ["id"], **to),
    "replace": lambda df, table, **to: tables.replace_table(df, table, **to),
}


@pytest.mark.parametrize("write", WRITES)
def test_same_rows_are_refused_or_set_aside(spark, table, write):
    odd = spark.createDataFrame([*ODD, (7, "g", None, "y")], ROWS)
    with pytest.raises(ValueError, match="check:price 2, key:null 1, key:repeated 2, not_null:cust 2"):
        WRITES[write](odd, table)
    assert ids(spark, table) == [1, 2]
    WRITES[write](odd, table, quarantine=f"{table}_aside")
    assert ids(spark, table) == ([7] if write == "replace" else [1, 2, 7])
    assert aside(spark, f"{table}_aside") == sorted(ASIDE, key=str)
    # the rules outlast the write
    assert rules.stored_rules(spark, table) == rules.Rules(("id",), ("cust",), {"price": "price >= 0"})
    with pytest.raises(ValueError):
        WRITES[write](odd, table)


def test_known_key_is_taken_for_append_and_an_update_for_merge(spark, table):
    again = spark.createDataFrame([(1, "z", 9, "y")], ROWS)
    with pytest.raises(ValueError, match="key:taken 1"):
        tables.append(table, again)
    tables.upsert(table, again, ["id"])
    assert {r.id: r.cust for r in spark.table(table).collect()} == {1: "z", 2: "b"}


def test_absent_column_is_missing_and_empty_batch_passes(spark, table):
    with pytest.raises(ValueError, match="not_null:cust 1"):
        tables.append(table, spark.createDataFrame([(8, 1)], "id long, price int"))
    tables.append(table, spark.createDataFrame([], ROWS))
    assert ids(spark, table) == [1, 2]


def test_replayed_load_replaces_its_own_quarantine(spark, table):
    odd = spark.createDataFrame(ODD, ROWS)
    for _ in range(2):
        tables.upsert(table, odd, ["id"], quarantine=f"{table}_aside", quarantine_by="load")
    assert aside(spark, f"{table}_aside") == sorted(ASIDE, key=str)


def test_rules_must_fit_the_rows_there_are(spark, table):
    with pytest.raises(ValueError, match="check:high 1"):
        rules.set_rules(spark, table, checks={"high": "price > 5"})
    assert rules.stored_rules(spark, table).key == ("id",)
