"""Substitution chains against following every part by hand."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from demandloom.operators.chains import chain_closure

SCHEMA = "empresa string, material string, item_principal_cadeia string"


def brute(rows):
    follow = {}
    for g, p, h in rows:
        if p is not None and (h is not None or (g, p) not in follow):
            old = follow.get((g, p))
            follow[g, p] = h if old is None else min(old, h)
    out = []
    for g, p in follow:
        at, steps, seen = p, 0, {p}
        while True:
            to = follow.get((g, at))
            if to is None or to == at:
                out.append((g, p, at, steps, False))
                break
            at, steps = to, steps + 1
            if at in seen:
                out.append((g, p, p, None, True))
                break
            seen.add(at)
    return sorted(out, key=str)


def got(df, **options):
    return sorted(map(tuple, chain_closure(df, **options).collect()), key=str)


def test_long_chains_cycles_and_hot_heads(spark):
    rng = random.Random(1)
    rows = [("a", f"p{k}", f"p{k + 1}") for k in range(100)]  # a chain of 100, ending at no part
    rows += [("a", f"h{k}", "h") for k in range(300)] + [("a", "h", "p0")]  # many parts pass through one
    rows += [("a", "x", "y"), ("a", "y", "z"), ("a", "z", "x"), ("a", "w", "x")]  # a cycle and a way into it
    rows += [("b", f"q{k}", f"q{rng.randrange(60)}") for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == brute(rows) == got(df, min_rows=50)


def test_odd_rows(spark):
    rows = [(None, "a", "b"), (None, "b", None), ("", "a", "c"), ("g", None, "a"), ("g", "s", "s"), ("g", "r", "s"), ("g", "r", "q"),
            ("g", "n", None), ("g", "n", "r"), ("g", "", "n")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows)
    assert chain_closure(df.limit(0)).count() == 0


def test_key_columns_are_parameters(spark):
    df = spark.createDataFrame([(1, 2, "a", "b"), (1, 2, "b", "c"), (1, 3, "b", "d")], "x int, y int, p string, h string")
    found = chain_closure(df, ["x", "y"], "p", "h").where(F.col("p") == "a").first()
    assert (found.h, found.depth, found.cycle) == ("c", 2, False)
