"""Profile, quality report and reject channel: what they read and shuffle, and odd rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from demandloom import config
from demandloom.operators import cleaning, quality
from demandloom.session import scratch_path
from demandloom.streaming.ingest import LoadMode, OrderIngest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_scans_the_table_once(spark):
    path, other = scratch_path(spark, "checked"), scratch_path(spark, "parent")
    spark.range(100).selectExpr("id AS k", "id % 7 AS v", "CAST(id AS string) AS s").write.parquet(path)
    spark.range(5).selectExpr("id AS v").write.parquet(other)
    report = quality.quality_report(
        spark.read.parquet(path), keys=["k", "s"], types={"s": "int"}, domains={"v": [0, 1, 2]},
        references={"v": (spark.read.parquet(other), "v"), "k": (spark.read.parquet(other), "v")}, rules={"small": F.col("k") < 50})
    assert plan(report).count("FileScan parquet [k#") == 1 and plan(report).count("FileScan") == 3
    got = {r.rule: (r.rows, r.failed) for r in report.collect()}
    assert got == {"filled:k": (100, 0), "filled:s": (100, 0), "type:s": (100, 0), "domain:v": (100, 100 - 15 - 15 - 14 + 0),
                   "small": (100, 50), "unique:k,s": (100, 0), "reference:v": (100, 28), "reference:k": (100, 95)}


def test_report_tells_null_keys_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, "a"), ("a", "a"), ("a", "a"), ("a", "a")], "x string, y string")
    got = {r.rule: r.failed for r in quality.quality_report(df, keys=["x", "y"], references={"x": (df.where("x = 'b'"), "x")}).collect()}
    assert got == {"filled:x": 2, "filled:y": 1, "unique:x,y": 3, "reference:x": 6}
    empty = quality.quality_report(df.limit(0), keys=["x"], references={"y": (df, "y")})
    assert {(r.rule, r.rows, r.failed, r.passed) for r in empty.collect()} == {(n, 0, 0, True) for n in ("filled:x", "unique:x", "reference:y")}


def test_profile_shuffles_digests_only(spark):
    rows = [(1, "a", [1], None), (1, "a", [1], None), (None, "a", None, 2.5), (None, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, `c d` array<int>, e double").withColumn("m", F.create_map(F.lit("k"), F.col("a")))
    wide = df.select("*", *[F.lit(None).cast("int").alias(f"n{k}") for k in range(70)])
    got = {r.metric: r.value for r in quality.table_profile(wide).collect()}
    assert (got["total_rows"], got["duplicate_rows"], got["nulls:a"], got["nulls:b"], got["nulls:c d"], got["nulls:e"], got["nulls:m"]) == (5, 2, 3, 2, 3, 4, 0)
    assert got["nulls:n0"] == got["nulls:n69"] == 5
    text = plan(quality.table_profile(df))
    keys = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert keys and all("_d1" in k and "b#" not in k for k in keys)


def test_column_sketches(spark):
    df = spark.range(10_000).selectExpr("id", "CAST(id % 100 AS string) AS s", "CAST(NULL AS double) AS none")
    got = {r.column: r for r in quality.column_sketches(df).collect()}
    assert abs(got["id"].different - 10_000) < 500 and abs(got["s"].different - 100) < 5 and got["none"].different == 0
    assert all(abs(q - p) <= 20 for q, p in zip(got["id"].quantiles, (2500, 5000, 7500))) and got["s"].quantiles is None


@pytest.mark.parametrize("mode", [LoadMode.INCREMENTAL])
def test_accepted_and_rejected_make_up_what_was_read(spark, database, mode):
    folder = scratch_path(spark, "landing")
    good = "|" + "|".join(["7", "05.06.2026", "ZNOR", *[""] * 9, "10", "A1", "TAN", "", "1,000", "PC"]) + "|"
    lines = [good, good.replace("|10|", "|20|"), "", "   ", "-----", "|Doc.venda|05.06.2026|" + "|".join(["x"] * 16) + "|", "|1|2|",
             good.replace("05.06.2026", "2026-06-05")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    checkpoint = scratch_path(spark, "checkpoint")
    ingest = OrderIngest(spark, folder, f"{database}.orders", checkpoint, mode)
    metrics = ingest.run()
    stored = Counter(r.reject_reason for r in spark.table(f"{database}.orders_rejects").collect())
    assert stored == Counter({"blank": 2, "separator": 1, "header": 1, "fields": 1, "date": 1})
    assert [(m["input_rows"], m["rejected_rows"]) for m in metrics] == [(8, 6)]
    assert spark.table(f"{database}.orders").count() == 2 and ingest.run() == []
    # The same batch again, as after a lost acknowledgement.
    batch = spark.read.text(folder).selectExpr("value", *[f"CAST(NULL AS {k}) AS {c}" for c, k in config.SOURCE_COLUMNS.items()])
    ingest._handle(batch, 0)
    spark.catalog.refreshTable(f"{database}.orders_rejects")
    assert spark.table(f"{database}.orders_rejects").count() == 6 and spark.table(f"{database}.orders").count() == 2


def test_classes_agree_with_the_parser(spark):
    lines = [None, "", "|", "||", "-", "--|--", "|Doc. x|" + "|".join(["a"] * 17) + "|", "|a| 01.01.2020 |" + "|".join(["b"] * 16) + "|"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    kept = cleaning.classify_lines(df).where("reject_reason IS NULL")
    assert kept.count() == cleaning.parse_pipe_lines(df).count() == 1
