from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from demandloom import config, session
from demandloom.operators import history, joins, merging, quality
from demandloom.sinks import tables
from demandloom.sources import catalog


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- merge functions ---------------------------------------------------------------


def test_latest_per_key_is_deterministic(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 1, None)]
    df = spark.createDataFrame(data, "k string, t int, v string")
    for parts in (1, 5):
        assert rows(merging.latest_per_key(df.repartition(parts), ["k"], ["t"])) == [("a", 2, "z"), ("b", 1, None)]


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    plan = merging.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_merge_rows(spark):
    target = spark.createDataFrame([("a", 1, "t", "p"), ("b", 2, "t", None), (None, 9, "t", "q")], "k string, v int, first string, keep string")
    source = spark.createDataFrame([("b", 20, "s", "n"), ("c", 30, "s", "n"), (None, 90, "s", "n")], "k string, v int, first string, keep string")
    merged = merging.merge_rows(target, source, ["k"], keep_first=["first", "keep"])
    assert rows(merged) == sorted(
        [("a", 1, "t", "p"), ("b", 20, "t", "n"), ("c", 30, "s", "n"), (None, 9, "t", "q"), (None, 90, "s", "n")], key=str
    )
    changed = merging.merge_rows(target.select("k", "v"), spark.createDataFrame([("a", None)], "k string, v int"), ["k"])
    assert ("a", None) in rows(changed)  # a new NULL replaces the old value


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(date(2026, 6, 1),), (date(2026, 6, 30),), (date(2026, 7, 1),), (None,)], "data date")
    left = merging.delete_rows(df, merging.in_month("data", 2026, 6))
    assert rows(left) == sorted([(date(2026, 7, 1),), (None,)], key=str)


def test_replace_period_keeps_undated_rows_and_moves_keys(spark):
    schema = "k string, p int, v string"
    target = spark.createDataFrame([("1", 1, "a"), ("2", 2, "b"), ("3", None, "c"), ("4", None, "d"), ("5", 3, "e")], schema)
    source = spark.createDataFrame([("6", 2, "B"), ("3", None, "C"), ("5", 2, "E")], schema)
    want = [("1", 1, "a"), ("3", None, "C"), ("4", None, "d"), ("5", 2, "E"), ("6", 2, "B")]
    assert rows(merging.replace_period(target, source, F.col("p"), ["k"])) == sorted(want, key=str)


# --- tables ---------------------------------------------------------------------------


def lines(spark, *data):
    df = spark.createDataFrame(
        [(a, b, None if d is None else date.fromisoformat(d), q) for a, b, d, q in data],
        "numero_ov string, item string, data date, quantidade int",
    )
    return tables.with_period(df)


def test_upsert_rewrites_only_touched_months(spark, database):
    name = f"{database}.raw"
    tables.replace_table(
        lines(spark, ("1", "1", "2026-01-05", 1), ("2", "1", "2026-02-05", 2), ("3", "1", "2026-03-05", 3), ("4", "1", None, 4)),
        name, [tables.PERIOD],
    )

    def files():
        placed = spark.table(name).select(tables.PERIOD, F.col("_metadata.file_path").alias("f"))
        return {r[0]: r[1] for r in placed.collect()}

    before = files()
    # Line 2 moves from February to March, line 5 is new; January is not touched.
    change = lines(spark, ("2", "1", "2026-03-06", 20), ("5", "1", "2026-03-07", 5))
    for _ in range(2):
        tables.upsert(name, change, config.LINE_KEY, partition_by=tables.PERIOD)
        assert rows(spark.table(name).select("numero_ov", "quantidade", tables.PERIOD)) == [
            ("1", 1, 202601), ("2", 20, 202603), ("3", 3, 202603), ("4", 4, 0), ("5", 5, 202603),
        ]
    after = files()
    assert before[202601] == after[202601] and before[0] == after[0] and before[202603] != after[202603]
    kept = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert "ano_mes=202602" not in kept


def test_upsert_with_fixed_partitions(spark, database):
    name = f"{database}.fixed"
    tables.replace_table(lines(spark, ("1", "1", "2026-01-05", 1), ("2", "1", "2026-02-05", 2)), name, [tables.PERIOD])
    change = lines(spark, ("2", "1", "2026-02-06", 20), ("3", "1", "2026-03-07", 5))
    tables.upsert(name, change, config.LINE_KEY, partition_by=tables.PERIOD, fixed_partition=True)
    assert rows(spark.table(name).select("numero_ov", "quantidade")) == [("1", 1), ("2", 20), ("3", 5)]


def test_upsert_unpartitioned_and_missing_table(spark, database):
    name = f"{database}.dim"
    for batch in ([("a", 1)], [("a", 2), ("b", 3)]):
        tables.upsert(name, spark.createDataFrame(batch, "k string, v int"), ["k"])
    assert rows(spark.table(name)) == [("a", 2), ("b", 3)]


def test_incomplete_keys_are_set_aside(spark, database):
    batch = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    with pytest.raises(ValueError, match="quarantine"):
        tables.upsert(f"{database}.strict", batch, ["k"])
    for load in ("one", "one", "two"):
        marked = batch.withColumn("load", F.lit(load))
        tables.upsert(f"{database}.t", marked, ["k"], quarantine=f"{database}.q", quarantine_by="load")
    assert rows(spark.table(f"{database}.t").select("k", "v")) == [("a", 1)]
    assert rows(spark.table(f"{database}.q").select("v", "load")) == [(2, "one"), (2, "two")]


def test_period_refresh_of_a_table(spark, database):
    """Undated rows stay, a moved key is stored once, and a second run changes nothing."""
    name = f"{database}.refresh"
    data = [("1", "1", "2026-01-05", 1), ("2", "1", "2026-02-05", 2), ("3", "1", None, 3), ("4", "1", None, 4), ("5", "1", "2026-03-01", 5)]
    tables.replace_table(lines(spark, *data), name, [tables.PERIOD])
    change = lines(spark, ("6", "1", "2026-02-06", 6), ("3", "1", None, 30), ("5", "1", "2026-02-07", 50))
    for _ in range(2):
        tables.replace_periods(name, change)
        assert rows(spark.table(name).select("numero_ov", "quantidade")) == [("1", 1), ("3", 30), ("4", 4), ("5", 50), ("6", 6)]


def test_recovery_of_a_failed_replacement(spark, database):
    name = f"{database}.recovered"
    tables.replace_table(lines(spark, ("1", "1", "2026-01-05", 1)), name, [tables.PERIOD])
    with pytest.raises(RuntimeError) as failed:
        with tables.staged(lines(spark, ("2", "1", "2026-02-05", 2)), [tables.PERIOD]):
            raise RuntimeError("while putting in place")
    tables.recover(spark, failed.value.__notes__[0].split(" in ")[-1], name, [tables.PERIOD])
    assert rows(spark.table(name).select("numero_ov")) == [("1",), ("2",)]


def test_dynamic_overwrite_does_not_depend_on_the_session(spark, database):
    name = f"{database}.p"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    tables.replace_table(lines(spark, ("1", "1", "2026-01-05", 1), ("2", "1", "2026-02-05", 2)), name, [tables.PERIOD])
    tables.replace_periods(name, lines(spark, ("3", "1", "2026-02-06", 3)))
    assert rows(spark.table(name).select("numero_ov")) == [("1",), ("3",)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"


def test_failed_rewrite_keeps_the_table(spark, database):
    name = f"{database}.safe"
    tables.replace_table(spark.range(10).toDF("v"), name)
    with pytest.raises(Exception):
        tables.rewrite_table(spark, name, lambda df: df.select(F.raise_error(F.lit("boom")).cast("long").alias("v")))
    assert spark.table(name).count() == 10


def test_delete_month(spark, database):
    data = [("1", "1", "2026-01-05", 1), ("2", "1", "2026-02-05", 2), ("3", "1", None, 3)]
    tables.replace_table(lines(spark, *data), f"{database}.p", [tables.PERIOD])
    tables.replace_table(lines(spark, *data), f"{database}.u")
    for name in (f"{database}.p", f"{database}.u"):
        assert tables.delete_month(spark, name, 2026, 2) == 1
        assert tables.delete_month(spark, name, 2026, 2) == 0
        assert rows(spark.table(name).select("numero_ov")) == [("1",), ("3",)]


def test_append_evolves_both_ways(spark, database):
    name = f"{database}.grow"
    tables.append(name, spark.createDataFrame([("H", 1)], "`Item Principal Cadeia` string, `2026/01` int"))
    tables.append(name, spark.createDataFrame([("K", 2)], "`Item Principal Cadeia` string, `2026/02` int"))
    assert spark.table(name).columns == ["Item Principal Cadeia", "2026/01", "2026/02"]
    assert rows(spark.table(name)) == sorted([("H", 1, None), ("K", None, 2)], key=str)


def test_discovery_and_drop(spark, database):
    for name in ("refined_demand_a", "refined_demand_b", "other"):
        tables.replace_table(spark.range(2).toDF("file" if name.endswith("a") else "v"), f"{database}.{name}")
    spark.sql(f"CREATE VIEW {database}.refined_demand_v AS SELECT 1 AS one")
    spark.range(1).createOrReplaceTempView("refined_demand_session")
    assert catalog.list_tables(spark, database, "refined_demand_") == ["refined_demand_a", "refined_demand_b", "refined_demand_v"]
    assert catalog.control_columns(spark, f"{database}.refined_demand_a") == {"file"}
    assert len(tables.drop_tables(spark, database, ["refined_demand_"])) == 3
    assert catalog.list_tables(spark, database) == ["other"]
    spark.catalog.dropTempView("refined_demand_session")


def test_metadata(spark, database):
    name = f"{database}.described"
    tables.replace_table(spark.range(1).toDF("id"), name)
    tables.describe(
        spark, name, "it's a table", {"id": "the 'key'"}, {"business_owner": "planning"}, {"layer": "raw"},
        {"id": {"pii": "no"}}, ["id"],
    )
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["tag.layer"] == "raw" and properties["tag.id.pii"] == "no"
    assert properties["primary_key"] == "id" and properties["business_owner"] == "planning"
    assert spark.catalog.listColumns(name)[0].description == "the 'key'"
    assert spark.catalog.getTable(name).description == "it's a table"
    assert tables.add_columns(spark, name, {"id": "bigint", "extra": "string"}) == ["extra"]
    with pytest.raises(ValueError):
        tables.ensure_source_columns(spark, f"{database}.absent")


def test_key_enforcement(spark):
    good = spark.createDataFrame([("a",), ("b",)], "k string")
    assert tables.enforce_key(good, ["k"]) is good
    for bad in ([("a",), ("a",)], [("a",), (None,)]):
        with pytest.raises(ValueError):
            tables.enforce_key(spark.createDataFrame(bad, "k string"), ["k"])


def test_measured_write(spark, database):
    found = tables.write_measured(
        spark.range(7).toDF("v"), lambda df: tables.replace_table(df, f"{database}.m"), top=F.max("v")
    )
    assert found == {"rows": 7, "top": 6}


def test_compaction_keeps_rows(spark, database):
    name = f"{database}.small"
    tables.replace_table(spark.range(100).repartition(20).toDF("v"), name)
    tables.compact(spark, name, ["v"], file_bytes=tables.table_bytes(spark, name) // 2 + 1)
    assert rows(spark.table(name)) == rows(spark.range(100))
    assert len(spark.table(name).inputFiles()) == 2


@pytest.mark.parametrize(
    "settings",
    [
        {"table_name": ""}, {"table_name": "t", "write_mode": "merge"}, {"table_name": "t", "catalog": "c"},
        {"output_type": "materialized_view"}, {"table_name": "t", "write_mode": "odd"},
        {"output_type": "file", "file_name": "a/b", "folder": "/tmp"}, {"output_type": "file", "file_name": "a", "file_type": "pdf", "folder": "/tmp"},
    ],
)
def test_bad_outputs_are_refused(spark, settings):
    with pytest.raises(ValueError):
        tables.write_output(spark.range(1), settings)


def test_output_properties_take_parameters(spark, database):
    settings = {"schema": database, "table_name": "o", "table_properties": {"team": ":team", "plain": "x"}, "comment": "c"}
    tables.write_output(spark.range(3), settings, {"team": "demand"})
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.o").collect()}
    assert properties["team"] == "demand" and properties["plain"] == "x"


@pytest.mark.parametrize(
    "source",
    [{}, {"file_source": {"format": "csv"}}, {"table_source": {"x": 1}},
     {"table_source": {"tableName": "t", "metricView": {"dimensions": []}}},
     {"table_source": {"tableName": "t", "metricView": {"dimensions": [], "measures": ["unknown"]}}}],
)
def test_bad_sources_are_refused(spark, source):
    with pytest.raises(ValueError):
        catalog.load_source(spark, source)


def test_metric_selection(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "d string, v int")
    assert rows(catalog.select_metrics(df, ["d"], {"t": F.sum("v")})) == [("a", 3), ("b", 3)]
    assert rows(catalog.select_metrics(df, ["d"])) == [("a",), ("b",)]
    assert rows(catalog.select_metrics(df, [], {"t": F.sum("v")})) == [(6,)]
    assert catalog.select_metrics(df, []) is df


def test_shared_folder_is_required_on_a_cluster(spark):
    class Remote:
        class sparkContext:
            master = "yarn"

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Remote())


# --- quality and history ------------------------------------------------------------------


def test_quality_report(spark):
    df = spark.createDataFrame(
        [("1", "01", "5", "x"), ("1", "01", "5", "x"), (None, "03", "abc", "y"), ("2", None, None, None)],
        "k string, market string, amount string, ref string",
    )
    parent = spark.createDataFrame([("x",)], "id string")
    report = quality.quality_report(
        df, ["k"], {"amount": "double"}, {"market": ["01", "02"]}, {"ref": (parent, "id")}, {"short": F.length("k") < 2}
    )
    assert {r["rule"]: (r["failed"], r["passed"]) for r in report.collect()} == {
        "filled:k": (1, False), "type:amount": (1, False), "domain:market": (1, False), "short": (1, False),
        "unique:k": (1, False), "reference:ref": (2, False),
    }


def test_table_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, None)], "n int, `odd name` string")
    assert {r["metric"]: r["value"] for r in quality.table_profile(df).collect()} == {
        "total_rows": 5, "duplicate_rows": 2, "nulls:n": 2, "nulls:odd name": 1,
    }
    assert {r["value"] for r in quality.table_profile(df.limit(0)).collect()} == {0}


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_orphans(spark, limit):
    child = spark.createDataFrame([(1,), (1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert rows(joins.orphans(child, "k", parent, "id", limit=limit, min_rows=2)) == sorted([(2,), (2,), (None,)], key=str)


@pytest.mark.parametrize("chunk", ["day", "month", "year"])
def test_history(spark, chunk):
    data = [("a", "2026-01-01", "x"), ("a", "2026-01-02", "x"), ("a", "2026-03-01", "y"), ("a", "2026-03-01", "x"),
            ("a", "2026-04-01", "x"), ("a", "2027-01-01", "x"), ("b", "2026-01-01", None), ("b", "2026-02-01", None), ("b", "2026-02-02", "z")]
    df = spark.createDataFrame(data, "k string, t string, v string").withColumn("t", F.to_timestamp("t"))
    found = history.dimension_history(df, ["k"], "t", ["v"], chunk)
    shown = found.select("k", "v", F.date_format("valid_from_ts", "yyyy-MM-dd"), F.date_format("valid_to_ts", "yyyy-MM-dd"), "is_current_flg")
    assert rows(shown) == sorted([
        ("a", "x", "2026-01-01", "2026-03-01", False), ("a", "y", "2026-03-01", "2026-04-01", False),
        ("a", "x", "2026-04-01", None, True), ("b", None, "2026-01-01", "2026-02-02", False), ("b", "z", "2026-02-02", None, True),
    ], key=str)


def test_history_grows_like_one_load(spark):
    data = [(k, f"2026-{m:02d}-01", str((m * 7 + len(k)) % 3)) for k in ("a", "bb") for m in range(1, 13)]
    df = spark.createDataFrame(data, "k string, t string, v string").withColumn("t", F.to_timestamp("t"))
    whole = history.dimension_history(df, ["k"], "t", ["v"])
    early = history.dimension_history(df.where("t < '2026-07-01'"), ["k"], "t", ["v"])
    late = df.where("t >= '2026-07-01'")
    grown = history.extend_history(early, late, ["k"], "t", ["v"])
    assert rows(grown) == rows(whole)
    assert rows(history.extend_history(grown, late, ["k"], "t", ["v"])) == rows(whole)


def test_large_merges_go_in_slices(spark, database, monkeypatch):
    """A merge made and put in place in several steps gives the table of one step: moved, undated, new and kept rows."""
    schema = "k string, n string, data date, v int, f string"
    day = lambda k: None if k % 7 == 0 else date(2026, 1 + k % 5, 1)
    old = [(str(k), None if k % 11 == 0 else "a", day(k), k, "first") for k in range(60)]
    new = [(str(k), "a", day(k + k % 2), -k, "later") for k in range(30, 90) if k % 11]
    merges, found = [], []
    merge = tables.merge_rows
    monkeypatch.setattr(tables, "merge_rows", lambda *a: merges.append(1) or merge(*a))
    for name, large in (("whole", 1 << 40), ("sliced", 0)):
        monkeypatch.setattr(tables, "LARGE_BYTES", large, raising=False)
        monkeypatch.setattr(tables, "LARGE_ROWS", large, raising=False)
        table = f"{database}.{name}"
        tables.replace_table(tables.with_period(spark.createDataFrame(old, schema)), table, [tables.PERIOD])
        tables.upsert(table, tables.with_period(spark.createDataFrame(new, schema)), ["k", "n"], keep_first=("f",), partition_by=tables.PERIOD)
        found.append(rows(spark.table(table)))
    assert found[0] == found[1] and len(merges) == 1 + tables.REWRITES
    assert tables._even_groups({1: 5, 2: 5, None: 5, 3: 5, 4: 100}, 4)[-1] == [None]
    sizes = {k: 1 for k in range(80)}
    assert sorted(sum(tables._even_groups(sizes, 4), [])) == list(range(80)) and len(tables._even_groups(sizes, 4)) == 4
