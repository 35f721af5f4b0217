"""Load and sales summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions import dates


def load_summary(raw: DataFrame, *groups: str) -> DataFrame:
    """Rows, orders and date span per load and file, newest load first."""
    groups = groups or ("_load_id", "_ingested_by", "_ingested_at", "_source_file_name")
    newest = "_ingested_at" if "_ingested_at" in groups else "data_max"
    summary = raw.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("numero_ov").alias("orders"),
        F.date_format(F.min("data"), "yyyy/MM/dd").alias("data_min"),
        F.date_format(F.max("data"), "yyyy/MM/dd").alias("data_max"),
    )
    if "_ingested_at" in groups:
        summary = summary.withColumn("_ingested_at", F.date_format("_ingested_at", "yyyy/MM/dd HH:mm:ss"))
    return summary.orderBy(F.col(newest).desc(), *groups)


def date_span(raw: DataFrame, *groups: str, pattern: str = "dd/MM/yyyy", **spans: str) -> DataFrame:
    """First and last date per group as text, e.g. ``uploaded="_ingested_at"``."""
    return raw.groupBy(*groups).agg(
        F.date_format(F.min("data"), pattern).alias("data_inicial"),
        F.date_format(F.max("data"), pattern).alias("data_final"),
        *[F.date_format(F.min(c), pattern).alias(n) for n, c in spans.items()],
    )


def totals_by(lines: DataFrame, columns: Sequence[str], amount: str) -> DataFrame:
    """The amount summed by the columns, largest first, ties in the columns' order."""
    return lines.groupBy(*columns).agg(F.sum(amount).alias(amount)).orderBy(F.col(amount).desc(), *columns)


def month_matrix(lines: DataFrame, groups: dict[str, Column], window: dates.Window) -> DataFrame:
    """Groups × one whole-number column per month."""
    inside = lines.where(dates.rows_in(window, lines))
    month = dates.month_start(F.col("data"))
    cells = [
        F.coalesce(F.sum(F.when(month == F.lit(m), F.col("quantidade"))).cast("bigint"), F.lit(0).cast("bigint"))
        .alias(f"{m:%Y/%m}")
        for m in window.month_starts
    ]
    return inside.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(*cells)


def report_row_counts(long: DataFrame) -> DataFrame:
    """Rows each report sheet would have, with subtotals per report and segment."""
    ids = ["item_principal_cadeia", "material", "emissor_da_ordem"]
    rows = long.select("org_vendas", "report", "sheet", *ids).distinct()
    return (
        rows.rollup("org_vendas", "report", "sheet")
        .agg(F.count(F.lit(1)).alias("rows"), F.grouping_id().cast("int").alias("level"))
    )


def changed_heads(chain: DataFrame) -> DataFrame:
    """Parts whose chain head is another part."""
    return chain.where(F.col("material") != F.col("item_principal_cadeia"))
