"""Spreadsheet files as DataFrames; every cell is text.

Spark lists and ships the files; one task opens one workbook at a time and
streams its rows out. Headers are cleaned per file, so files with other column
orders or extra columns line up by name.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from itertools import chain
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions import text
from demandloom.session import ship_package

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_SCHEMA = "path string, sheet string, row_number long, cells map<string,string>"
_BATCH_ROWS = 5_000
FIRST_SHEET = ""
MAX_COLUMNS = 16_384  # of the file format


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as part:
        return [_texts(node) for _, node in ElementTree.iterparse(part) if node.tag == f"{_MAIN}si"]


def _sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target").lstrip("/") for link in links}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
    found = [(s.get("name"), targets[s.get(f"{_REL}id")]) for s in sheets]
    return [(name, t if t.startswith("xl/") else f"xl/{t}") for name, t in found]


def _cell_value(cell, shared: Sequence[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return _texts(cell)
    value = cell.findtext(f"{_MAIN}v")
    if value is None:
        return None
    return shared[int(value)] if kind == "s" else value


def _sheet_rows(book: zipfile.ZipFile, part: str, shared: Sequence[str]) -> Iterator[list[str | None]]:
    with book.open(part) as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag != f"{_MAIN}row":
                continue
            row: list[str | None] = []
            for cell in node.iter(f"{_MAIN}c"):
                position = _column_index(cell.get("r")) if cell.get("r") else len(row)
                row.extend([None] * (position - len(row)))
                row.append(_cell_value(cell, shared))
            node.clear()
            if any(v is not None for v in row):
                yield row


def _workbook_rows(path: str, content: bytes, clean: bool, sheet: str | None, header: bool):
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        sheets = _sheet_parts(book)
        wanted = sheets[:1] if sheet == FIRST_SHEET else [s for s in sheets if sheet in (None, s[0])]
        for name, part in wanted:
            rows = _sheet_rows(book, part, shared)
            first = next(rows, None)
            if first is None:
                continue
            if not header:
                rows = chain([first], rows)
                names = [f"_c{i}" for i in range(MAX_COLUMNS)]
            else:
                names = text.clean_headers(first) if clean else _numbered([h or f"col_{i}" for i, h in enumerate(first)])
            for number, row in enumerate(rows, 1):
                if len(row) > len(names):  # cells to the right of the header
                    names = _numbered([*names, *[f"col_{i}" for i in range(len(names), len(row))]])
                yield path, name, number, dict(zip(names, row))


def _numbered(names: Sequence[str]) -> list[str]:
    """The names, repeats as ``name_1``, ``name_2``… so that no cell hides another."""
    taken: set[str] = set()
    out = []
    for name in names:
        candidate, number = name, 0
        while candidate in taken:
            number += 1
            candidate = f"{name}_{number}"
        taken.add(candidate)
        out.append(candidate)
    return out


def read_workbook_cells(
    spark: SparkSession, folder: str, pattern: str = "*.xls*", clean_names: bool = True,
    sheet: str | None = FIRST_SHEET, header: bool = True,
) -> DataFrame:
    """One row per sheet row: path, sheet, row number, and cells by header name.

    ``sheet`` names a sheet; None reads all. Without ``header`` the columns
    are ``_c0``, ``_c1``…
    """
    ship_package(spark)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "content")
    )

    def open_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "sheet", "row_number", "cells"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                pending = []
                for row in _workbook_rows(path, content, clean_names, sheet, header):
                    pending.append(row)
                    if len(pending) == _BATCH_ROWS:
                        yield pd.DataFrame(pending, columns=columns)
                        pending = []
                if pending:
                    yield pd.DataFrame(pending, columns=columns)

    return files.mapInPandas(open_files, _SCHEMA)


def header_names(cells: DataFrame) -> list[str]:
    """All header names of the files read; a short list by nature of a sheet."""
    names = cells.select(F.explode(F.map_keys("cells")).alias("name")).distinct().collect()
    return sorted(r["name"] for r in names)


def read_workbooks(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str] | None = None,
    renames: Mapping[str, str] | None = None,
    pattern: str = "*.xls*",
    sheet: str | None = FIRST_SHEET,
    header: bool = True,
) -> DataFrame:
    """One sheet (the first) of every workbook in ``folder`` as one all-text DataFrame.

    Name the ``columns`` (after cleaning) to avoid the extra pass that lists
    the headers. A file without one of them yields NULL there.
    """
    cells = read_workbook_cells(spark, folder, pattern, sheet=sheet, header=header)
    renames = renames or {}
    columns = header_names(cells) if columns is None else columns
    return cells.select(*[F.col("cells").getItem(c).alias(renames.get(c, c)) for c in columns])
