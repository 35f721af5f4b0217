"""Incremental load of order files with Structured Streaming."""

from __future__ import annotations

import enum
import uuid
from collections.abc import Callable
from contextlib import ExitStack, nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandloom import config
from demandloom.operators.cleaning import classify_lines, parse_pipe_lines, type_order_lines
from demandloom.operators.merging import latest_per_key, split_null_keys
from demandloom.sinks import tables
from demandloom.sources.files import stream_order_files


class LoadMode(enum.Enum):
    INCREMENTAL = "INCREMENTAL"  # upsert by business key
    PERIOD_REFRESH = "PERIOD_REFRESH"  # replace the months that arrive
    FULL_REFRESH = "FULL_REFRESH"  # replace the table


# Later files win; within a file the order of the remaining columns decides.
_NEWEST = ("_source_file_modification_time", "_source_file_path")
# Kept from the first load of a key: when it came in, and the field that text
# files do not carry but history does.
_KEPT = ("_ingested_at", "numero_pedido")


def prepare_batch(lines: DataFrame, mode: LoadMode = LoadMode.INCREMENTAL, load_id: str | None = None) -> DataFrame:
    """Text lines with source columns to typed lines with their period."""
    typed = type_order_lines(parse_pipe_lines(lines), mode.value, load_id or str(uuid.uuid4()))
    return tables.with_period(typed)


def save_batch(batch: DataFrame, table: str, mode: LoadMode, fixed_dates: bool = False,
               release: Callable[[], None] | None = None) -> None:
    """Store a prepared batch, newest row per key.

    With ``release`` the batch is read from a finished copy; it is called when that is needed no more.

    Running it again with the same rows leaves the table as it is. Rows
    without a full key go to ``<table>_quarantine``, where a load replaces
    its own rows.
    """
    quarantine = f"{table}_quarantine"
    if mode is LoadMode.INCREMENTAL:
        tables.upsert(
            table, batch, config.LINE_KEY, keep_first=_KEPT, partition_by=tables.PERIOD,
            quarantine=quarantine, newest=_NEWEST, fixed_partition=fixed_dates, quarantine_by="_load_id",
            release=release,
        )
        return
    with ExitStack() as copies:
        # The batch's copy goes once that of its newest rows is finished.
        with nullcontext(batch) if release else tables.staged(batch) as rows:
            keyed, broken = split_null_keys(rows, config.LINE_KEY)
            tables.replace_loads(quarantine, broken, "_load_id")
            latest = copies.enter_context(tables.staged(latest_per_key(keyed, config.LINE_KEY, _NEWEST)))
        if release:
            release()
        if mode is LoadMode.FULL_REFRESH:
            tables.replace_table(latest, table, [tables.PERIOD])
        else:
            tables.replace_periods(table, latest)


def save_rejects(lines: DataFrame, table: str, load_id: str) -> None:
    """Store the lines of a load that cannot be read, with file and reason, in ``<table>_rejects``; a replay replaces them."""
    source = [F.col(c) if c in lines.columns else F.lit(None).cast(kind).alias(c) for c, kind in config.SOURCE_COLUMNS.items()]
    rejected = lines.where("reject_reason IS NOT NULL").select(
        "reject_reason", F.col("value").alias("line"), *source, F.lit(load_id).alias("_load_id"))
    tables.replace_loads(f"{table}_rejects", rejected, "_load_id")


@dataclass
class OrderIngest:
    """A file stream into the raw order table.

    Lines that cannot be read go to ``<table>_rejects``. Every batch is split
    once, so what is stored there and what is loaded make up what was read.

    ``fixed_dates`` promises that a line never changes its order month, which
    spares the search for the month a known key is stored under.
    """

    spark: SparkSession
    folder: str
    table: str
    checkpoint: str
    mode: LoadMode = LoadMode.INCREMENTAL
    max_files_per_batch: int | None = None
    pattern: str = "*.txt"
    fixed_dates: bool = False

    def __post_init__(self):
        self._batches: list[dict] = []
        if self.mode is not LoadMode.INCREMENTAL and self.max_files_per_batch:
            raise ValueError("a refresh must see all new files in one batch")

    def _handle(self, lines: DataFrame, batch_id: int) -> None:
        load_id = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{self.checkpoint}#{batch_id}"))
        counted = Observation()
        with ExitStack() as copies:
            # The copy of the lines goes once that of their typed rows is finished.
            with tables.staged(classify_lines(lines).observe(
                    counted, F.count(F.lit(1)).alias("rows"), F.count("reject_reason").alias("rejected"))) as split:
                save_rejects(split, self.table, load_id)
                good = split.where("reject_reason IS NULL").drop("reject_reason")
                batch = copies.enter_context(tables.staged(prepare_batch(good, self.mode, load_id)))
            save_batch(batch, self.table, self.mode, self.fixed_dates, copies.close)
        self._batches.append({"batch_id": batch_id, "input_rows": counted.get["rows"], "rejected_rows": counted.get["rejected"]})

    def start(self) -> StreamingQuery:
        """Process every file not seen before, then stop.

        Batches run in the stream's own session, so a session that has read
        the table before must refresh it afterwards, as :meth:`run` does.
        """
        stream = stream_order_files(self.spark, self.folder, self.pattern, self.max_files_per_batch)
        return (
            stream.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", self.checkpoint)
            .foreachBatch(self._handle)
            .start()
        )

    def run(self) -> list[dict]:
        """Run to the end and return one metrics row per batch with rows, however many there are."""
        self._batches = []
        query = self.start()
        query.awaitTermination()
        for table in (self.table, f"{self.table}_quarantine", f"{self.table}_rejects"):
            if self.spark.catalog.tableExists(table):
                self.spark.catalog.refreshTable(table)
        return [b for b in self._batches if b["input_rows"]]
