"""What the operators of this subpackage share: table reading, staging, Arrow mapping."""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.session import configure, remove_path, scratch_path

#: Word separators of the whole subpackage: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\f\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
#: Rows per Arrow batch; a batch of very long texts must fit a Python worker.
BATCH_ROWS = 400


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: For each open ``passing`` block, what removes its staged copies.
_OPEN: list[list[Callable[[], None]]] = []


@contextmanager
def passing() -> Iterator[None]:
    """Staged copies made inside the block go at its end; nothing may read them later."""
    _OPEN.append([])
    try:
        yield
    finally:
        for clean in _OPEN.pop():
            clean()
            atexit.unregister(clean)


def stage(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """Write the rows to the shared folder and read them again.

    Cuts the lineage: a lost executor costs nothing, because the files are in
    the folder that all executors share. The files go at the end of the
    ``passing`` block around the call; without one, or if lasting, when the
    program ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)

    def clean() -> None:
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder is scratch
            pass

    atexit.register(clean)
    if _OPEN and not lasting:
        _OPEN[-1].append(clean)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Run the function over every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def has_word(text: Column) -> Column:
    return F.translate(text, SPACES, "") != ""


def free_name(df: DataFrame, wanted: str) -> str:
    """The name, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
