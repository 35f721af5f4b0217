"""Export files: CSV and JSON folders in parts, and workbooks.

CSV and JSON are written in parallel by Spark. A workbook is one file by
nature: its task streams the sorted rows into the file and never holds them
all, and rows beyond a sheet's size go on to further sheets. Workbooks are
completed under a temporary name and then moved, so a retried task replaces
the file instead of damaging it.
"""

from __future__ import annotations

import uuid
import zipfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import groupby
from typing import Any
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import config
from demandloom.functions import text
from demandloom.session import ship_package
from demandloom.sinks.tables import quote_column, write_measured
from demandloom.sources.catalog import control_columns


# --- CSV and JSON in parts -------------------------------------------------------


def export_tables_csv(spark: SparkSession, tables: Sequence[str], folder: str) -> list[str]:
    """Every table as a folder ``<folder>/<table>.csv`` of numbered, named CSV files; returns the folders."""
    written = []
    for table in tables:
        name = table.rsplit(".", 1)[-1]
        target = f"{folder}/{name}.csv"
        write_parts(spark.table(table), target, "csv")
        name_parts(spark, target, name, "csv")
        written.append(target)
    return written


def name_parts(spark: SparkSession, folder: str, name: str, extension: str) -> list[str]:
    """Rename the part files of a folder to ``<name>-00001.<extension>`` and so on, in their order."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().getName() for s in system.listStatus(path) if s.getPath().getName().startswith("part-"))
    names = [f"{name}-{number:05}.{extension}" for number in range(1, len(parts) + 1)]
    for old, new in zip(parts, names):
        if not system.rename(jvm.org.apache.hadoop.fs.Path(path, old), jvm.org.apache.hadoop.fs.Path(path, new)):
            raise OSError(f"cannot rename {folder}/{old} to {new}")
    return names


def _csv_cells(df: DataFrame) -> DataFrame:
    """Text is kept from running as a formula; nothing else changes: decimals keep their digits, numbers their form."""

    def one(f: T.StructField) -> Column:
        value = F.col(quote_column(f.name))
        if isinstance(f.dataType, T.StringType):
            value = text.neutralise_formula(value)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(value)
        return value.alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def write_parts(df: DataFrame, path: str, file_type: str = "csv", mode: str = "overwrite", order_by: Sequence[str] = ()) -> int:
    """A folder of CSV or JSON files, written in parallel by Spark; returns the rows written.

    Append adds files and leaves the old ones as they are; the columns must be
    the same and take the order of those there. ``order_by`` sorts over all
    new files, in the order of their names.
    """
    spark = df.sparkSession
    if mode == "append" and _file_exists(spark, path):
        old = read_parts(spark, path, file_type).columns
        if sorted(old) != sorted(df.columns):
            raise ValueError(f"cannot append to {path}: columns {sorted(df.columns)} differ from {sorted(old)}")
        if file_type == "csv":
            df = df.select(*[F.col(quote_column(c)) for c in old])
    rows = df.orderBy(*order_by) if order_by else df
    if file_type == "csv":
        def save(out: DataFrame) -> None:
            out.write.mode(mode).option("header", "true").option("escape", '"').csv(path)

        rows = _csv_cells(rows)
    else:
        def save(out: DataFrame) -> None:
            out.write.mode(mode).option("ignoreNullFields", "false").json(path)

    return write_measured(rows, save)["rows"]


def read_parts(spark: SparkSession, path: str, file_type: str) -> DataFrame:
    """What :func:`write_parts` wrote; CSV cells come back as text."""
    if file_type == "csv":
        return spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    return spark.read.json(path)


# --- one workbook ----------------------------------------------------------------


class _Sheet:
    """Writes one worksheet part of a workbook, row by row."""

    def __init__(self, book: zipfile.ZipFile, number: int, header: Sequence[str]):
        self._part = book.open(f"xl/worksheets/sheet{number}.xml", "w", force_zip64=True)
        self._put(
            '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/'
            'spreadsheetml/2006/main"><sheetData>'
        )
        self.add(header)

    def _put(self, markup: str) -> None:
        self._part.write(markup.encode())

    def add(self, values: Sequence[Any]) -> None:
        self._put("<row>" + "".join(_cell(v) for v in values) + "</row>")

    def close(self) -> None:
        self._put("</sheetData></worksheet>")
        self._part.close()


def _cell(value: Any) -> str:
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, _Number):
        return f"<c><v>{value}</v></c>"
    if isinstance(value, (int, float)) and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def _close_workbook(book: zipfile.ZipFile, names: Sequence[str]) -> None:
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    package = "http://schemas.openxmlformats.org/package/2006"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    numbers = range(1, len(names) + 1)
    sheets = "".join(
        f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in zip(numbers, names)
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers
    )
    parts = "".join(
        f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in numbers
    )
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{sheets}</sheets></workbook>')
    book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships">{links}</Relationships>')
    book.writestr(
        "_rels/.rels",
        f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" '
        f'Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    )
    book.writestr(
        "[Content_Types].xml",
        f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" '
        'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>',
    )


def _write_sheets(book: zipfile.ZipFile, names: list[str], name: str, header: Sequence[str], rows: Iterator[Sequence[Any]]) -> int:
    """Write the rows under the name; what a sheet cannot hold goes on to further sheets with the same header."""
    count = 0
    sheet, left = None, 0
    for row in rows:
        if not left:
            if sheet:
                sheet.close()
            names.append(unique_sheet_name(name, names))
            sheet, left = _Sheet(book, len(names), header), config.SHEET_ROWS - 1
        sheet.add(row)
        count, left = count + 1, left - 1
    if sheet is None:
        names.append(unique_sheet_name(name, names))
        sheet = _Sheet(book, len(names), header)
    sheet.close()
    return count


def unique_sheet_name(name: str, taken: Iterable[str]) -> str:
    """The name, or with ``_2``, ``_3``… at its end within the allowed length, that is not taken in any case."""
    used = {t.lower() for t in taken}
    found, number = name, 1
    while found.lower() in used:
        number += 1
        suffix = f"_{number}"
        found = name[:config.SHEET_NAME_LENGTH - len(suffix)] + suffix
    return found


def _write_excel(out, header: Sequence[str], rows: Iterator[Sequence[Any]], name: str = "Sheet1") -> int:
    names: list[str] = []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        count = _write_sheets(book, names, name, header, rows)
        _close_workbook(book, names)
    return count


def _put_file(path: str, write: Callable[[Any], int]) -> int:
    """Write a file under a temporary name, then move it into place. ``path`` is a URI, see :func:`_qualified`."""
    scheme, _, rest = path.partition("://")
    # A local name may hold characters that a URI may not.
    system, target = (arrow_fs.LocalFileSystem(), rest) if scheme == "file" else arrow_fs.FileSystem.from_uri(path)
    folder = target.rsplit("/", 1)[0]
    system.create_dir(folder, recursive=True)
    aside = f"{target}.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as out:
        count = write(out)
    system.move(aside, target)
    return count


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, the session's default one if it names none, for driver and tasks alike."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    name = system.makeQualified(target).toString()
    return name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file:///") else name


def _file_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class _Number(str):
    """The text of a number, written as a number."""


def _cell_columns(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Cells as text with their kind in front: n number, b boolean, t text made safe for spreadsheets. NULL stays NULL."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def one(name: str) -> Column:
        value = F.col(quote_column(name))
        if isinstance(kinds[name], T.NumericType):
            return F.concat(F.lit("n"), value.cast("string"))
        if isinstance(kinds[name], T.BooleanType):
            return F.concat(F.lit("b"), value.cast("string"))
        return F.concat(F.lit("t"), text.cell_text(value.cast("string")))

    return [one(n) for n in names]


def _read_cell(value: str | None) -> Any:
    if value is None:
        return None
    kind, body = value[0], value[1:]
    if kind == "b":
        return body == "true"
    if kind == "n" and body not in ("NaN", "Infinity", "-Infinity"):
        return _Number(body)
    return None if kind == "n" and body == "NaN" else body


def write_file(
    df: DataFrame, path: str, file_type: str = "csv", mode: str = "overwrite", order_by: Sequence[str] = (),
) -> int:
    """A csv or json folder in parts, or one workbook; returns the rows it then holds (csv, json: the rows added).

    Append keeps the old content first, its column order and its values.
    """
    if file_type in ("csv", "json"):
        return write_parts(df, path, file_type, mode, order_by)
    if file_type != "excel":
        raise ValueError(f"file type {file_type!r} is not one of ['csv', 'excel', 'json']")
    return _write_workbook(df, path, mode, order_by)


def read_file(spark: SparkSession, path: str, file_type: str) -> DataFrame:
    """What :func:`write_file` wrote; CSV and workbook cells come back as text, columns in their order."""
    if file_type != "excel":
        return read_parts(spark, path, file_type)
    from demandloom.sources.workbooks import read_workbook_cells

    folder, name = path.rsplit("/", 1)
    cells = read_workbook_cells(spark, folder, name, clean_names=False, sheet=None)
    return cells.select(*[F.col("cells").getItem(c).alias(c) for c in _workbook_header(spark, folder, name)])


def _workbook_header(spark: SparkSession, folder: str, name: str) -> list[str]:
    from demandloom.sources.workbooks import FIRST_SHEET, read_workbook_cells

    first = read_workbook_cells(spark, folder, name, sheet=FIRST_SHEET, header=False).where("row_number = 1").head()
    cells = first["cells"] if first else {}
    return [cells[c] for c in sorted(cells, key=lambda c: int(c[2:])) if cells[c] is not None]


ORDER_KEY = "array<struct<number:double,text:string>>"


def _order_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Sort key of a row: numbers by value, all else by text, so that rows of several tables can be sorted together."""
    numbers = {"byte", "short", "integer", "long", "float", "double", "decimal"}
    return F.array(*[
        F.struct((F.col(quote_column(c)) if number else F.lit(None)).cast("double").alias("number"),
                 (F.lit(None) if number else F.col(quote_column(c))).cast("string").alias("text"))
        for c in columns for number in [df.schema[c].dataType.typeName() in numbers]]).cast(ORDER_KEY)


def _write_workbook(df: DataFrame, path: str, mode: str, order_by: Sequence[str]) -> int:
    spark = df.sparkSession
    ship_package(spark)
    header = list(df.columns)
    old = None
    if mode == "append" and _file_exists(spark, path):
        old = read_file(spark, path, "excel")
        if sorted(old.columns) != sorted(header):
            raise ValueError(f"cannot append to {path}: columns {sorted(header)} differ from {sorted(old.columns)}")
        header = old.columns
    cells = df.select(F.lit(1).alias("_part"), (_order_key(df, order_by) if order_by else F.lit(None).cast(ORDER_KEY)).alias("_order"),
                      F.array(*_cell_columns(df, header)).alias("cells"))
    if old is not None:
        # What reads as a number is written as one again, everything else as the text it is.
        kept = [F.concat(F.when(F.col(quote_column(c)).rlike(r"^-?(0|[1-9][0-9]*)([.][0-9]+)?(E-?[0-9]+)?$"), F.lit("n")).otherwise(F.lit("t")),
                         F.col(quote_column(c))) for c in header]
        cells = old.select(F.lit(0).alias("_part"), F.lit(None).cast(ORDER_KEY).alias("_order"),
                           F.array(*kept).alias("cells")).unionByName(cells)
    target = _qualified(spark, path)
    ordered = cells.repartition(1).sortWithinPartitions("_part", "_order").select("cells")
    names = list(header)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ([_read_cell(c) for c in row] for batch in batches for row in batch.column("cells").to_pylist())
        count = _put_file(target, lambda out: _write_excel(out, names, rows))
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["rows"])

    written = ordered.mapInArrow(write, "rows long").first()
    return written["rows"] if written else _put_file(target, lambda out: _write_excel(out, names, iter(())))


# --- workbooks ------------------------------------------------------------------


def export_plan(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Which table feeds which sheet of which file: (file, table, sheet, rows).

    Tables without ``file`` and ``sheet`` columns become a file of their own.
    """
    parts = []
    for table in tables:
        short = table.rsplit(".", 1)[-1]
        df = spark.table(table)
        if control_columns(spark, table) == {"file", "sheet"}:
            part = df.groupBy("file", "sheet").agg(F.count(F.lit(1)).alias("rows"))
        else:
            part = df.agg(F.count(F.lit(1)).alias("rows")).withColumns(
                {"file": F.lit(short), "sheet": F.lit(None).cast("string")}
            )
        parts.append(part.select("file", F.lit(table).alias("table"), "sheet", "rows"))
    return reduce(DataFrame.unionByName, parts)


def sheet_order(sheet: Column) -> list[Column]:
    return [F.upper(sheet) != config.TOTAL_SHEET, sheet]


def name_sheets(plan: DataFrame) -> DataFrame:
    """Add the position and the legal, unique sheet name of every plan row.

    Names that collide after cleaning get ``_2``, ``_3``… within the allowed
    length; ``check_plan`` settles what still collides with a given name.
    """
    table = F.element_at(F.split("table", "\\."), -1)
    shown = F.coalesce("sheet", table)
    by_file = Window.partitionBy("file").orderBy(*sheet_order(shown), "table")
    cleaned = text.sheet_name(shown)
    same = Window.partitionBy("file", F.lower("_clean")).orderBy("position")
    named = plan.withColumns({"position": F.row_number().over(by_file), "_clean": cleaned})
    repeat = F.row_number().over(same)
    return named.withColumn(
        "name",
        F.when(repeat == 1, F.col("_clean")).otherwise(
            F.concat(F.substring("_clean", 1, config.SHEET_NAME_LENGTH - 1 - F.length(repeat.cast("string"))),
                     F.lit("_"), repeat.cast("string"))
        ),
    ).drop("_clean")


def check_plan(plan: DataFrame) -> list[dict[str, Any]]:
    """Reject unsafe names and doubly claimed sheets; return the plan with unique names.

    The plan has one row per sheet, a list of report size.
    """
    rows = [r.asDict() for r in name_sheets(plan).orderBy("file", "position").collect()]
    unsafe = {r["file"] for r in rows if r["file"] is None or "/" in r["file"] or ".." in r["file"]}
    if unsafe:
        raise ValueError(f"unsafe file names: {unsafe}")
    pairs = [(r["file"], r["sheet"]) for r in rows if r["sheet"] is not None]
    doubled = sorted(p for p, n in Counter(pairs).items() if n > 1)
    if doubled:
        raise ValueError(f"sheets claimed by several tables: {doubled}")
    taken: dict[str, list[str]] = {}
    for r in rows:
        used = taken.setdefault(r["file"], [])
        r["name"] = unique_sheet_name(r["name"], used)
        used.append(r["name"])
    return rows


def export_workbooks(
    spark: SparkSession, tables: Sequence[str], folder: str, order_by: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One ``<file>.xlsx`` per plan file, in parallel; returns (file, path, sheets, rows).

    Rows travel as arrays of cell texts with their type, sorted by file, sheet
    and row order, and are streamed into the workbooks by the tasks that
    receive them. Existing workbooks of the plan are replaced; others stay.
    """
    ship_package(spark)
    frames = {t: spark.table(t) for t in tables}
    shown = {t: [c for c in df.columns if c.lower() not in ("file", "sheet") or control_columns(spark, t) != {"file", "sheet"}]
             for t, df in frames.items()}
    plan = check_plan(export_plan(spark, tables))
    if not plan:
        raise ValueError("nothing to export")
    layout: dict[str, list[tuple[int, str, list[str]]]] = {}
    for r in plan:
        layout.setdefault(r["file"], []).append((r["position"], r["name"], shown[r["table"]]))

    # One small row per sheet: the places rows go to.
    places = spark.createDataFrame(
        [(r["table"], r["file"], r["sheet"], r["position"]) for r in plan],
        "_table string, _file string, _sheet string, _position int",
    )
    parts = []
    for table, df in frames.items():
        # A table with control columns is matched on them; any other has one place.
        if control_columns(spark, table) == {"file", "sheet"}:
            mine = F.broadcast(places.where(F.col("_table") == table))
            placed = df.join(mine, (df["file"] == F.col("_file")) & df["sheet"].eqNullSafe(F.col("_sheet")))
        else:
            only = next(r for r in plan if r["table"] == table)
            placed = df.withColumns({"_file": F.lit(only["file"]), "_position": F.lit(only["position"])})
        order = _order_key(df, (order_by or {}).get(table, shown[table][:2]))
        cells = F.array(*_cell_columns(df, shown[table]))
        parts.append(placed.select("_file", "_position", order.alias("_order"), cells.alias("cells")))
    rows = reduce(DataFrame.unionByName, parts)
    spread = rows.repartition(len(layout), "_file").sortWithinPartitions("_file", "_position", "_order")

    target = _qualified(spark, folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (
            (file, position, cells)
            for batch in batches
            for file, position, cells in zip(batch["_file"], batch["_position"], batch["cells"])
        )
        for file, of_file in groupby(rows, key=lambda r: r[0]):
            by_sheet = groupby(of_file, key=lambda r: r[1])
            sheets = ((p, ([_read_cell(c) for c in r[2]] for r in part)) for p, part in by_sheet)
            yield pd.DataFrame([_put_workbook(target, file, layout[file], sheets)], columns=_WRITTEN)

    written = spread.mapInPandas(write, "file string, path string, sheets int, rows long")
    results = [tuple(r) for r in written.collect()]  # one row per workbook
    done = {r[0] for r in results}
    results += [_put_workbook(target, f, sheets, iter(())) for f, sheets in layout.items() if f not in done]
    return spark.createDataFrame(results, written.schema)


_WRITTEN = ["file", "path", "sheets", "rows"]


def _put_workbook(
    folder: str, file: str, layout: Sequence[tuple[int, str, list[str]]],
    rows_by_sheet: Iterator[tuple[int, Iterator[Sequence[Any]]]],
) -> tuple[str, str, int, int]:
    """Stream the rows of one workbook, which arrive in sheet order, into its file."""

    def fill(out) -> int:
        count, names = 0, []
        arriving = next(rows_by_sheet, None)
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
            for position, name, header in sorted(layout):
                here = arriving is not None and arriving[0] == position
                count += _write_sheets(book, names, name, [text_of(h) for h in header], arriving[1] if here else iter(()))
                if here:
                    arriving = next(rows_by_sheet, None)
            _close_workbook(book, names)
        return count

    path = f"{folder}/{file}.xlsx"
    count = _put_file(path, fill)
    return file, path, len(layout), count


def text_of(header: str) -> str:
    """A header cell without control characters."""
    return "".join(c for c in header if c >= " " or c in "\t\n\r")
