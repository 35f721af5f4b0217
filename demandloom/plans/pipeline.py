"""The batch run: raw lines and lookups in, all report tables out."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from demandloom import config
from demandloom.plans import reports as plan
from demandloom.plans.model import Model, analytics_lines
from demandloom.sinks import tables

CONCURRENT_OUTPUTS = 4


def run_reports(
    model: Model,
    database: str,
    segments: Sequence[config.Segment] = config.SEGMENTS,
    reports: Sequence[config.Report] = config.REPORTS,
    codes: config.Codes = config.Codes(),
) -> list[str]:
    """Write the cube, the long reports, the stacked wide tables and one view per sheet.

    The order lines are read once, for the cube. Everything after works on
    stored aggregates. Returns the names of the per-sheet views.
    """
    model.require_unique_keys()
    spark = model.lines.sparkSession
    prefix = f"{database}.{config.TABLE_PREFIX}"
    longest = max([r.months for r in reports] + [config.MARKET_SHARE_MONTHS])
    window = model.window(longest)

    cube_table = f"{prefix}cube"
    tables.replace_table(model.cube(window, segments, reports), cube_table, ["org_vendas"])
    cube = spark.table(cube_table)

    long_table = f"{prefix}long"
    tables.replace_table(
        plan.demand_long(cube, reports, segments, window), long_table, ["report", "org_vendas"]
    )
    long = spark.table(long_table)

    def write_report(report: config.Report) -> list[str]:
        stacked = f"{prefix}{report.name}"
        wide = plan.widen(long, report, window)
        tables.replace_table(wide, stacked, ["sheet"])
        columns = wide.columns
        return [
            _sheet_view(
                spark, f"{stacked}_{segment.prefix}_{sheet}", stacked, columns,
                plan.dates.file_title(segment.prefix, window.as_of, report.title), sheet,
            )
            for segment in segments
            for sheet in report.sheets(segment)
        ]

    def write_shares(segment: config.Segment) -> list[str]:
        name = f"{prefix}{config.SHARE_NAME}_{segment.prefix}_{config.TOTAL_SHEET}"
        months = cube.withColumn("data", F.col("month"))
        tables.replace_table(plan.distribution(months, [segment], window, codes=codes), name)
        return [name]

    # The outputs are small next to the cube, so several jobs share the cluster.
    with ThreadPoolExecutor(max_workers=CONCURRENT_OUTPUTS) as pool:
        written = [*pool.map(write_report, reports), *pool.map(write_shares, segments)]
    return [name.lower() for names in written for name in names]


def _sheet_view(spark: SparkSession, view: str, table: str, columns: Sequence[str], file: str, sheet: str) -> str:
    """One sheet as a view: the sheet column is the partition, so only that part is read."""
    chosen = ", ".join(tables.quote_column(c) for c in columns)
    name = view.replace(" ", "_").lower()
    spark.sql(
        f"CREATE OR REPLACE VIEW {tables.quote(name)} AS SELECT {chosen} FROM {tables.quote(table)} "
        f"WHERE sheet = {tables.sql_text(sheet)} AND file = {tables.sql_text(file)}"
    )
    return name


def run_analytics(model: Model, table: str, months: int = config.ANALYTICS_MONTHS) -> None:
    """The wide line-level table, replaced on every run."""
    tables.replace_table(analytics_lines(model, model.window(months)), table)
