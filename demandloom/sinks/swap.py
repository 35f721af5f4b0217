"""One-step replacement of a table's rows.

The new rows are written once, as finished files in a folder of their own.
Then the catalog is pointed at the folder: one ``ALTER TABLE ... SET LOCATION``
for a table, one for each partition of a partitioned one. Nothing is staged
and copied, nothing that a running reader has open is overwritten.

A partitioned replacement is first noted in a journal beside the files. A
writer that dies before the note leaves the old rows; one that dies after it
leaves work that :func:`recover_swaps` ends, also when run again or by somebody
else, and every later swap of the table runs it first. Folders that are no longer
used stay for running readers until the next swap.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from demandloom.session import remove_path
from demandloom.sinks import tables

ROOT = "swap.root"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    files, target = _fs(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def _read(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def _note(spark: SparkSession, path: str, content: dict) -> None:
    """Write the note in one step: it is there whole or not at all."""
    files, target = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if files.exists(target):  # the same note of a writer that died right after it
        files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"{path} cannot be written")


def location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {tables.quote(table)}").where("col_name = 'Location'").first()["data_type"]


def root(spark: SparkSession, table: str) -> str:
    """The folder the table was made in; versions lie below it. It is noted at the first swap."""
    known = spark.sql(f"SHOW TBLPROPERTIES {tables.quote(table)}").where(f"key = '{ROOT}'").first()
    if known:
        return known["value"]
    found = location(spark, table)
    spark.sql(f"ALTER TABLE {tables.quote(table)} SET TBLPROPERTIES ('{ROOT}' = {tables.sql_text(found)})")
    return found


def versions(spark: SparkSession, table: str) -> str:
    return f"{root(spark, table)}/_versions"


def _alter(spark: SparkSession, table: str, change: str) -> None:
    spark.sql(f"ALTER TABLE {tables.quote(table)} {change}")


def _same_columns(df: DataFrame, target: DataFrame) -> DataFrame:
    """The rows in the table's columns; a swap changes rows, never the schema."""
    kinds = dict(df.dtypes)
    if {c: kinds.get(c) for c in target.columns} != dict(target.dtypes):
        raise ValueError(f"columns differ: {sorted(set(df.dtypes) ^ set(target.dtypes))}")
    return df.select(*target.columns)


def swap_table(df: DataFrame, table: str) -> None:
    """Replace all rows of an unpartitioned table. ``df`` may read the table itself. The table is made when missing."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        tables.replace_table(df, table)
        return
    folder, before = versions(spark, table), location(spark, table)
    path = f"{folder}/{uuid.uuid4().hex}"
    _same_columns(df, spark.table(table)).write.parquet(path)
    _alter(spark, table, f"SET LOCATION {tables.sql_text(path)}")
    spark.catalog.refreshTable(table)
    for name in _names(spark, folder):
        if name not in (path.rsplit("/", 1)[-1], before.rstrip("/").rsplit("/", 1)[-1]):
            remove_path(spark, f"{folder}/{name}")


def swap_partitions(rows: DataFrame, table: str, touched: Sequence[Any], partition: str) -> None:
    """Put ``rows`` in place of the touched partitions; those without rows are dropped. ``rows`` may read the table."""
    spark = rows.sparkSession
    recover_swaps(spark, table)
    folder, name = versions(spark, table), uuid.uuid4().hex
    path = f"{folder}/{name}"
    tables.by_partition(_same_columns(rows, spark.table(table)), [partition]).write.partitionBy(partition).parquet(path)
    filled = [n.partition("=")[2] for n in _names(spark, path) if n.startswith(f"{partition}=")]
    stray = set(filled) - {str(v) for v in touched}
    if stray:
        remove_path(spark, path)
        raise ValueError(f"rows outside the touched partitions: {sorted(stray)}")
    emptied = sorted({str(v) for v in touched} - set(filled))
    _note(spark, f"{folder}/{name}.json", {"partition": partition, "path": path, "filled": sorted(filled), "emptied": emptied})
    recover_swaps(spark, table)


def recover_swaps(spark: SparkSession, table: str) -> int:
    """End the swaps that were noted but not ended; the number of them. Files of writers that died before their note go."""
    folder = versions(spark, table)
    names = _names(spark, folder)
    notes = [n for n in names if n.endswith(".json")]
    for note in notes:
        swap = _read(spark, f"{folder}/{note}")
        column = tables.quote_column(swap["partition"])
        for value in swap["filled"]:
            spec, place = f"PARTITION ({column}={tables.sql_text(value)})", tables.sql_text(f"{swap['path']}/{swap['partition']}={value}")
            _alter(spark, table, f"ADD IF NOT EXISTS {spec} LOCATION {place}")
            _alter(spark, table, f"{spec} SET LOCATION {place}")
        for value in swap["emptied"]:
            _alter(spark, table, f"DROP IF EXISTS PARTITION ({column}={tables.sql_text(value)})")
        remove_path(spark, f"{folder}/{note}")
    spark.catalog.refreshTable(table)
    if not notes:
        # Nothing is under way: what no partition points at has been left by a swap before the last, or by a dead writer.
        used = {f.rsplit("/_versions/", 1)[1].split("/")[0] for f in spark.table(table).inputFiles() if "/_versions/" in f}
        for name in names:
            if name not in used:
                remove_path(spark, f"{folder}/{name}")
    return len(notes)


def partition_marks(spark: SparkSession, table: str, partition: str) -> dict[str, str]:
    """A mark for each partition that changes whenever its files do. Names of files are enough: no write uses one again.

    Only the file listing is read, which planning any query of the table reads too.
    """
    found: dict[str, list[str]] = {}
    place = re.compile(rf"/{re.escape(partition)}=([^/]+)/([^/]+)$")
    for path in spark.table(table).inputFiles():
        if m := place.search(path):
            found.setdefault(m[1], []).append(m[2])
    return {value: hashlib.md5("\n".join(sorted(names)).encode()).hexdigest() for value, names in found.items()}
