"""Tables, table discovery and sources described by a configuration."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, database: str, prefix: str = "") -> list[str]:
    """Names of the stored tables and views of a database; session views are left out.

    Only plain identifiers are returned, lower case as the catalog keeps them.
    """
    return sorted(
        t.name
        for t in spark.catalog.listTables(database)
        if not t.isTemporary and t.name.startswith(prefix.lower()) and re.fullmatch("[A-Za-z0-9_]+", t.name)
    )


def control_columns(spark: SparkSession, table: str) -> set[str]:
    """Which of ``file`` and ``sheet`` a table has."""
    return {c.lower() for c in spark.table(table).columns} & {"file", "sheet"}


def select_metrics(
    df: DataFrame, dimensions: Sequence[str], measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """Dimensions and named aggregates of a table.

    Both: group by the dimensions. Dimensions only: their distinct rows.
    Measures only: one row. Neither: the table itself.
    """
    measures = measures or {}
    wanted = [m.alias(name) for name, m in measures.items()]
    if dimensions and wanted:
        return df.groupBy(*dimensions).agg(*wanted)
    if dimensions:
        return df.select(*dimensions).distinct()
    return df.agg(*wanted) if wanted else df


def _read_files(spark: SparkSession, settings: Mapping[str, Any]) -> DataFrame:
    options = dict(settings)
    path = options.pop("path", None)
    if not path:
        raise ValueError("file source: 'path' is required")
    kind = str(options.pop("format", "") or _format_of(path))
    texts = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    if kind == "excel":
        from demandloom.sources.workbooks import FIRST_SHEET, read_workbooks

        # "Sheet!A1" names a sheet; the used range of the sheet is read.
        address = texts.get("dataAddress", "").strip("'\"")
        sheet = address.split("!")[0].strip("'") if "!" in address else FIRST_SHEET
        header = texts.get("headerRows", texts.get("header", "true")) not in ("0", "false")
        return read_workbooks(spark, path, sheet=sheet, header=header)
    return spark.read.format(kind).options(**texts).load(path)


def _format_of(path: str) -> str:
    extension = re.sub("^.*[.]", "", path.rstrip("/")).lower()
    return {"xlsx": "excel", "xls": "excel", "txt": "text"}.get(extension, extension)


def load_source(
    spark: SparkSession,
    settings: Mapping[str, Any],
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A DataFrame from a configuration.

    ``{"file_source": {"path": …, "format": …, <reader options>}}`` or
    ``{"table_source": {"tableName": …}}``. A table source may be a query
    (``isExpression``) or carry ``metricView: {dimensions, measures}``, whose
    measures are looked up by name in ``measures``.
    """
    files, table = settings.get("file_source"), settings.get("table_source")
    if files:
        return _read_files(spark, files)
    if not table:
        raise ValueError("source: set 'file_source' or 'table_source'")
    name = table.get("tableName")
    if not name:
        raise ValueError("table source: 'tableName' is required")
    view = table.get("metricView")
    if view is not None:
        if view.get("dimensions") is None or view.get("measures") is None:
            raise ValueError("table source: metricView needs both 'dimensions' and 'measures' lists")
        known = measures or {}
        unknown = [m for m in view["measures"] if m not in known]
        if unknown:
            raise ValueError(f"table source: measures without a definition: {unknown}")
        return select_metrics(
            spark.table(name), view["dimensions"], {m: known[m] for m in view["measures"]}
        )
    return spark.sql(name) if table.get("isExpression") else spark.table(name)


def table_row_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Row count per table, in one job."""
    counts = [spark.table(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows") for t in tables]
    return reduce(DataFrame.unionByName, counts)
