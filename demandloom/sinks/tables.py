"""Table writes on plain Parquet tables of any Spark catalog.

Rows are never changed in place. A write that also reads its target is first
completed in the shared folder (``spark.checkpoint.dir``) and only then put in
place. A lost executor, or a failure before that, leaves the target as it was.
Putting in place is several steps (overwrite, then drop emptied partitions); if
one of them fails, the finished copy stays in the shared folder and its path is
in the error, for ``recover``. Merges into a partitioned table rewrite only the
partitions they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandloom import config
from demandloom.operators.merging import (
    append_rows,
    delete_rows,
    in_month,
    latest_per_key,
    merge_rows,
    replace_period,
    split_null_keys,
)
from demandloom.session import freeing_shuffles, remove_path, scratch_path

PERIOD = config.PERIOD
# In how many steps a large merge is made and put in place; what is large, in bytes of the table and in rows.
REWRITES = 4
LARGE_BYTES = 1 << 25
LARGE_ROWS = 1_000_000


def with_period(df: DataFrame, day: str = "data") -> DataFrame:
    """Add the partition column ``ano_mes`` (yyyymm; 0 when the date is missing)."""
    period = F.year(day) * 100 + F.month(day)
    return df.withColumn(PERIOD, F.coalesce(period, F.lit(0)))


def quote(name: str) -> str:
    """Quote a table name, part by part."""
    return ".".join(quote_column(part) for part in name.split("."))


def quote_column(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows of a partition into few files; a very large partition is split over tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


@contextmanager
def staged(df: DataFrame, partition_by: Sequence[str] = (), *more: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back: complete, and without lineage.

    ``more`` frames of the same columns are added one after the other. The copy is removed at the end, but kept when the block fails, so that
    rows already taken out of a target can be recovered.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    with freeing_shuffles(spark):
        for part in (df, *more):
            by_partition(part, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path).select(*[F.col(quote_column(c)) for c in df.columns])
    except Exception as error:
        error.add_note(f"the finished rows are in {path}")
        raise
    remove_path(spark, path)


def recover(spark: SparkSession, path: str, table: str, partition_by: Sequence[str] = ()) -> None:
    """Put the finished copy of a failed replacement in place: whole, or the partitions it has."""
    rows = spark.read.parquet(path)
    if not partition_by:
        _put_table(rows, table)
        return
    with dynamic_overwrite(spark):
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), format: str = "parquet",
                  quarantine: str | None = None) -> None:
    """Full replace, schema included. ``df`` must not read ``table``.

    The rules of the table stay and hold for the new rows (:mod:`demandloom.sinks.rules`).
    """
    from demandloom.sinks.rules import held, stored_rules

    rules = stored_rules(df.sparkSession, table)
    if not rules:
        _put_table(df, table, partition_by, format)
        return
    with held(df, rules, table, quarantine) as good:
        _put_table(good, table, partition_by, format)


def _put_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), format: str = "parquet") -> None:
    from demandloom.sinks.rules import store_rules, stored_rules

    rules = stored_rules(df.sparkSession, table)
    writer = by_partition(df, partition_by).write.mode("overwrite").format(format)
    with freeing_shuffles(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
    if rules:  # a replaced table begins without properties
        store_rules(df.sparkSession, table, rules)


def rewrite_table(spark: SparkSession, table: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Full replace by a function of the table's own content."""
    partitions = partition_columns(spark, table)
    with staged(change(spark.table(table)), partitions) as rows:
        _put_table(rows, table, partitions)


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions that have rows, whatever the session says."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _even_groups(sizes: Mapping[Any, int], groups: int) -> list[list[Any]]:
    """The names in at most so many groups of about the same size."""
    out: list[list[Any]] = []
    most, held = -(-sum(sizes.values()) // groups), 0
    for name in sorted(sizes, key=lambda v: (v is None, v)):
        if not out or held + sizes[name] / 2 > most * len(out):
            out.append([])
        out[-1].append(name)
        held += sizes[name]
    return out


def _overwrite_partitions(
    spark: SparkSession, table: str, rows: DataFrame, touched: Sequence[Any], partition: str
) -> None:
    """Put ``rows``, which are staged, in place of the touched partitions; those left empty are dropped.

    Some partitions at a time, with about ``1 / REWRITES`` of the rows, so that
    only their rows are in the shuffle and beside the old ones on disk.
    """
    with freeing_shuffles(spark), dynamic_overwrite(spark):
        filled = {r[0]: r[1] for r in rows.groupBy(partition).count().collect()}
        columns = spark.table(table).columns
        for values in _even_groups(filled, REWRITES if sum(filled.values()) >= LARGE_ROWS else 1):
            part = rows.where(F.col(partition).isin([v for v in values if v is not None]) | (F.col(partition).isNull() & F.lit(None in values)))
            by_partition(part, [partition]).select(*columns).write.mode("overwrite").insertInto(table)
    for value in touched:
        if value not in filled:
            spark.sql(f"ALTER TABLE {quote(table)} DROP IF EXISTS PARTITION ({quote_column(partition)}={value!r})")


def upsert(
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    keep_first: Sequence[str] = (),
    partition_by: str | None = None,
    quarantine: str | None = None,
    newest: Sequence[str] = (),
    fixed_partition: bool = False,
    quarantine_by: str | None = None,
    swap: bool = False,
    indexed: bool = False,
    release: Callable[[], None] | None = None,
) -> None:
    """Update rows with a known key, insert the others.

    ``source`` holds one row per key, or names in ``newest`` the columns whose
    largest values pick the survivor. A row with an incomplete key can never
    match, so it goes to the ``quarantine`` table; without one it is an error.
    ``quarantine_by`` names a column with the load, so that a load that runs
    again replaces its own quarantined rows instead of adding them twice.
    The target is created when missing. With a partition column, the partitions
    to rewrite are those of the arriving rows plus those where their keys live
    now; that list is bounded by the number of partitions. Finding where keys
    live reads the key columns of the whole table; ``fixed_partition`` skips it
    when a key is known never to change its partition, and ``indexed`` asks the
    key index first and reads only partitions that can hold an arriving key.
    With ``swap`` the merged rows are written once, to a new folder, and put in
    place by the catalog (:mod:`demandloom.sinks.swap`). Rows that break the
    table's rules (:mod:`demandloom.sinks.rules`) are refused, or set aside with their reasons.
    With ``release``, ``source`` is read from a finished copy and needs none;
    it is called when that copy is needed no more.
    """
    from demandloom.sinks.rules import held, stored_rules

    rules = stored_rules(source.sparkSession, table)
    with nullcontext(source) if release else staged(source) as rows:
        arriving, broken = split_null_keys(rows, keys)
        if rules:
            arriving = latest_per_key(arriving, keys, newest) if newest else arriving
            with held(arriving.unionByName(broken), rules.with_key(keys), None, quarantine, quarantine_by) as good:
                _upsert(table, good, keys, keep_first, partition_by, fixed_partition, swap, indexed)
            return
        if quarantine and quarantine_by:
            replace_loads(quarantine, broken, quarantine_by)
        elif quarantine:
            append(quarantine, broken)
        elif not broken.isEmpty():
            raise ValueError(f"rows without a complete key {list(keys)}; name a quarantine table for them")
        # Computed once: it is read for the places, the homes and the merge.
        with staged(latest_per_key(arriving, keys, newest)) if newest else nullcontext(arriving) as arriving:
            if newest and release:
                release()
            _upsert(table, arriving, keys, keep_first, partition_by, fixed_partition, swap, indexed)


def _upsert(
    table: str, arriving: DataFrame, keys: Sequence[str], keep_first: Sequence[str],
    partition_by: str | None, fixed_partition: bool, swap: bool = False, indexed: bool = False,
) -> None:
    from demandloom.sinks.keyindex import possible_homes, update_index
    from demandloom.sinks.swap import recover_swaps, swap_partitions, swap_table

    spark = arriving.sparkSession
    if indexed and not partition_by:
        raise ValueError("a key index needs a partition column")
    if not spark.catalog.tableExists(table):
        replace_table(arriving, table, [partition_by] if partition_by else [])
        if indexed:
            update_index(spark, table, keys, partition_by, [r[0] for r in arriving.select(partition_by).distinct().collect()])
        return
    if swap and partition_by:
        recover_swaps(spark, table)
    target = spark.table(table)
    if not partition_by:
        if swap:
            swap_table(merge_rows(target, arriving, keys, keep_first), table)
            return
        with staged(merge_rows(target, arriving, keys, keep_first)) as merged:
            _put_table(merged, table)
        return
    places = arriving.select(partition_by)
    if not fixed_partition:
        stored = target.select(*keys, partition_by)
        possible = possible_homes(spark, table, arriving, keys, partition_by) if indexed else None
        if possible is not None:
            stored = stored.where(F.col(partition_by).isin([_typed(target, partition_by, v) for v in possible]))
        homes = stored.join(arriving.select(*keys), list(keys), "left_semi")
        places = places.union(homes.select(partition_by))
    with freeing_shuffles(spark):
        touched = [r[0] for r in places.distinct().collect()]
    if not touched:
        return
    old = target.where(F.col(partition_by).isin(touched))
    if swap:
        swap_partitions(merge_rows(old, arriving, keys, keep_first), table, touched, partition_by)
    else:
        # Equal keys are in one slice; a slice's shuffle goes before the next one's comes.
        alike = all(old.schema[k].dataType == arriving.schema[k].dataType for k in keys)
        n = REWRITES if alike and table_bytes(spark, table) >= LARGE_BYTES else 1
        in_slice = [F.pmod(F.xxhash64(*keys), F.lit(n)) == i for i in range(n)]
        merged = [merge_rows(old.where(c), arriving.where(c), keys, keep_first) for c in in_slice]
        with staged(merged[0], (), *merged[1:]) as rows:
            _overwrite_partitions(spark, table, rows, touched, partition_by)
    if indexed:
        update_index(spark, table, keys, partition_by, touched)


def _typed(df: DataFrame, column: str, value: str) -> Any:
    """A partition value as its column has it."""
    return int(value) if df.schema[column].dataType.typeName() in ("integer", "long", "short", "byte") else value


def replace_periods(
    table: str, source: DataFrame, keys: Sequence[str] = config.LINE_KEY, partition_by: str = PERIOD
) -> None:
    """Replace exactly the periods that ``source`` brings; keys that moved leave their old period.

    Period 0 holds undated rows and is upserted by key instead. The partitions
    to rewrite are those of the arriving rows and those their keys are in now.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(table):
        replace_table(source, table, [partition_by])
        return
    target = spark.table(table)
    with staged(source.select(*target.columns)) as arriving:
        homes = target.select(*keys, partition_by).join(arriving.select(*keys).distinct(), list(keys), "left_semi")
        places = arriving.select(partition_by).union(homes.select(partition_by)).distinct()
        with freeing_shuffles(spark):
            touched = [r[0] for r in places.collect()]  # bounded by the number of partitions
        old = target.where(F.col(partition_by).isin(touched))
        with staged(replace_period(old, arriving, F.col(partition_by), keys)) as rows:
            _overwrite_partitions(spark, table, rows, touched, partition_by)


def replace_loads(table: str, source: DataFrame, load: str) -> None:
    """Store rows under their load: the same load again replaces its own rows and nothing else."""
    spark = source.sparkSession
    if not spark.catalog.tableExists(table):
        replace_table(source, table, [load])
        return
    with dynamic_overwrite(spark):
        source.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)


def append(table: str, source: DataFrame, quarantine: str | None = None) -> None:
    """Append by name. New columns are added to the table; absent ones become NULL.

    Rows that break the table's rules are refused, or go to ``quarantine``; so do rows with a key the table has.
    """
    from demandloom.sinks.rules import held, stored_rules

    spark = source.sparkSession
    if not spark.catalog.tableExists(table):
        source.write.saveAsTable(table)
        return
    rules = stored_rules(spark, table)
    if not rules:
        _append(table, source)
        return
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(table).schema.fields
              if f.name in rules.columns and f.name not in source.columns]
    with held(source.select("*", *absent), rules, None, quarantine, taken=spark.table(table)) as good:
        _append(table, good)


def _append(table: str, source: DataFrame) -> None:
    spark = source.sparkSession
    target = spark.table(table)
    new = [f for f in source.schema.fields if f.name not in target.columns]
    if new:
        add_columns(spark, table, {f.name: f.dataType.simpleString() for f in new})
        target = spark.table(table)
    aligned = append_rows(target.limit(0), source).select(*[F.col(f"`{c}`") for c in target.columns])
    aligned.write.mode("append").insertInto(table)


def delete_where(spark: SparkSession, table: str, predicate: Column, partition_values: Sequence[Any] | None = None,
                 partition_by: str = PERIOD) -> int:
    """Delete rows and return how many matched. Rows where the test is NULL stay.

    ``partition_values`` limits reading and rewriting to those partitions.
    """
    rows = spark.table(table)
    if partition_values is not None:
        rows = rows.where(F.col(partition_by).isin(list(partition_values)))
    matched = rows.where(predicate).count()
    if not matched:
        return 0
    if partition_values is None:
        rewrite_table(spark, table, lambda df: delete_rows(df, predicate))
    else:
        with staged(delete_rows(rows, predicate)) as kept:
            _overwrite_partitions(spark, table, kept, partition_values, partition_by)
    return matched


def delete_month(spark: SparkSession, table: str, year: int, month: int) -> int:
    """Drop one month; on a table partitioned by period only that partition is read."""
    partitioned = PERIOD in partition_columns(spark, table)
    return delete_where(
        spark, table, in_month("data", year, month), [year * 100 + month] if partitioned else None
    )


def drop_tables(spark: SparkSession, database: str, prefixes: Sequence[str]) -> list[str]:
    """Drop the tables and views whose name starts with one of ``prefixes``."""
    from demandloom.sources.catalog import list_tables

    dropped = []
    for name in sorted({t for p in prefixes for t in list_tables(spark, database, p)}):
        kind = spark.catalog.getTable(f"{database}.{name}").tableType
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {quote(f'{database}.{name}')}")
        dropped.append(name)
    return dropped


# --- schema and metadata ----------------------------------------------------


def add_columns(spark: SparkSession, table: str, columns: Mapping[str, str]) -> list[str]:
    """Add the columns a table lacks; the table must exist."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    existing = set(spark.table(table).columns)
    missing = {n: t for n, t in columns.items() if n not in existing}
    if missing:
        added = ", ".join(f"{quote_column(n)} {t}" for n, t in missing.items())
        spark.sql(f"ALTER TABLE {quote(table)} ADD COLUMNS ({added})")
    return list(missing)


def ensure_source_columns(spark: SparkSession, table: str) -> list[str]:
    return add_columns(spark, table, config.SOURCE_COLUMNS)


def describe(
    spark: SparkSession,
    table: str,
    comment: str = "",
    columns: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
    tags: Mapping[str, str] | None = None,
    column_tags: Mapping[str, Mapping[str, str]] | None = None,
    primary_key: Sequence[str] = (),
) -> None:
    """Comments and properties. Tags and the key become properties (``tag.*``)."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {quote(table)} IS {sql_text(comment)}")
    for name, note in (columns or {}).items():
        spark.sql(f"ALTER TABLE {quote(table)} ALTER COLUMN {quote_column(name)} COMMENT {sql_text(note)}")
    settings = dict(properties or {})
    settings |= {f"tag.{k}": v for k, v in (tags or {}).items()}
    settings |= {f"tag.{c}.{k}": v for c, pairs in (column_tags or {}).items() for k, v in pairs.items()}
    if primary_key:
        settings["primary_key"] = ",".join(primary_key)
    if settings:
        pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in settings.items())
        spark.sql(f"ALTER TABLE {quote(table)} SET TBLPROPERTIES ({pairs})")


def enforce_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, or an error when its key is incomplete or repeated."""
    from demandloom.operators.quality import key_summary

    found = key_summary(df, keys).first()
    if found["null_key_rows"] or found["duplicate_keys"]:
        raise ValueError(
            f"key {list(keys)}: {found['null_key_rows']} rows without it, {found['duplicate_keys']} repeated"
        )
    return df


def write_measured(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict[str, Any]:
    """Run ``write`` and return metrics of the rows it wrote, without a second scan."""
    observation = Observation()
    wanted = {"rows": F.count(F.lit(1)), **metrics}
    write(df.observe(observation, *[m.alias(n) for n, m in wanted.items()]))
    return observation.get


TARGET_FILE_BYTES = 256 * 1024 * 1024


def table_bytes(spark: SparkSession, table: str) -> int:
    """Bytes of a table's files, as its file system tells."""
    location = spark.sql(f"DESCRIBE FORMATTED {quote(table)}").where("col_name = 'Location'").first()["data_type"]
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def compact(spark: SparkSession, table: str, sort_by: Sequence[str], file_bytes: int = TARGET_FILE_BYTES) -> None:
    """Rewrite a table into range-clustered files of about ``file_bytes``, however large it is."""
    partitions = partition_columns(spark, table)
    files = max(1, -(-table_bytes(spark, table) // file_bytes))
    rewrite_table(
        spark, table,
        lambda df: df.repartitionByRange(files, *partitions, *sort_by).sortWithinPartitions(*partitions, *sort_by),
    )


# --- output described by a configuration ------------------------------------


def write_output(df: DataFrame, settings: Mapping[str, Any], parameters: Mapping[str, str] | None = None) -> None:
    """Write as a configuration says.

    ``output_type``: ``table``, ``materialized_view`` or ``file``. Tables take
    ``write_mode`` overwrite, append or merge (with ``merge_keys``, and
    ``partition_by`` so that a merge rewrites touched partitions only), ``format``
    and ``table_properties`` (a mapping; ``:name`` values come from
    ``parameters``). A materialized view is a table recomputed on each run.
    """
    kind = settings.get("output_type", "table")
    if kind == "file":
        from demandloom.sinks.files import write_file

        extension = {"csv": "csv", "json": "json", "excel": "xlsx"}
        file_type = settings.get("file_type", "csv")
        if file_type not in extension:
            raise ValueError(f"file type {file_type!r} is not one of {sorted(extension)}")
        name = settings.get("file_name") or ""
        if not name or "/" in name or ".." in name:
            raise ValueError(f"invalid file name {name!r}")
        suffix = f".{extension[file_type]}"
        name = name if name.lower().endswith(suffix) else name + suffix
        write_file(df, f"{settings['folder']}/{name}", file_type, settings.get("write_mode", "overwrite"))
        return
    name = settings.get("view_name" if kind == "materialized_view" else "table_name")
    if not name:
        raise ValueError("output: a table or view name is required")
    if settings.get("catalog") and not settings.get("schema"):
        raise ValueError("output: 'schema' is required when 'catalog' is set")
    table = ".".join(p for p in (settings.get("catalog"), settings.get("schema"), name) if p)
    spark, mode = df.sparkSession, settings.get("write_mode", "overwrite")
    keys = [k for k in settings.get("merge_keys") or [] if k]
    if kind == "table" and mode == "merge" and not keys:
        raise ValueError("output: 'merge_keys' is required when write_mode is merge")
    format = settings.get("format", "default")
    if kind == "materialized_view" or mode == "overwrite":
        clustered = settings.get("cluster_by_column")
        rows = df.repartitionByRange(clustered) if clustered else df
        replace_table(rows, table, format="parquet" if format == "default" else format)
    elif mode == "append":
        append(table, df)
    elif mode == "merge":
        upsert(table, df, keys, partition_by=settings.get("partition_by"))
    else:
        raise ValueError(f"unknown write_mode {mode!r}")
    values = parameters or {}
    properties = {
        k: values.get(v[1:], v) if v.startswith(":") else v
        for k, v in (settings.get("table_properties") or {}).items()
    }
    describe(spark, table, settings.get("comment", "") or "", properties=properties)
