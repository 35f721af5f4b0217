"""A small key index beside a partitioned table: in which partitions can a key be stored?

For every partition a Bloom filter of its keys, kept by the writer as rows
(partition, filter size, 64-bit word, bits) of a table ``<table>_keys``. About
two bytes a key are stored, and a merge asks them instead of reading the key
columns of the whole table. The filter has no false negatives, so no home of a
key is missed; false positives only mean that a partition's keys are read.

Each partition's entry carries the mark of the files it was made from. A
partition written by anybody else has another mark and always counts as a
possible home, so a stale index costs time and never a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.sinks import tables
from demandloom.sinks.swap import partition_marks

#: Bits for each key and number of hashes: about 2 wrong answers in 1,000.
BITS, HASHES = 16, 5
#: A merge of more keys than this would touch nearly every filter; it reads the key columns instead.
MOST_KEYS = 1_000_000


def index_name(table: str) -> str:
    return f"{table}_keys"


def _places(keys: Sequence[str], size: Column) -> Column:
    """The bit positions of a key in a filter of the size (a power of two)."""
    return F.array_distinct(F.array(*[F.pmod(F.xxhash64(F.lit(i), *keys), size) for i in range(HASHES)]))


def update_index(spark: SparkSession, table: str, keys: Sequence[str], partition: str, values: Sequence) -> None:
    """Make the filters of the partitions anew from the key columns just written. Their old entries go."""
    name, marks = index_name(table), partition_marks(spark, table, partition)
    rows = spark.table(table).where(F.col(partition).isin(list(values))).select(partition, *keys)
    counted = rows.groupBy(F.col(partition).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("_n") * BITS, F.lit(64))))).cast("long")
    sized = rows.join(F.broadcast(counted.select("_p", size.alias("size"))), F.col(partition).eqNullSafe(F.col("_p")))
    bits = sized.select(partition, "size", F.explode(_places(keys, F.col("size"))).alias("bit"))
    words = bits.groupBy(partition, "size", F.expr("bit DIV 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits"))
    listed = [(str(v), marks[str(v)]) for v in values if str(v) in marks]
    known = spark.createDataFrame(listed, "_value string, mark string")
    entries = words.join(F.broadcast(known), F.col(partition).cast("string") == F.col("_value")).select("size", "word", "bits", "mark", partition)
    if not spark.catalog.tableExists(name):
        tables.replace_table(entries, name, [partition])
        return
    with tables.dynamic_overwrite(spark):
        tables.by_partition(entries, [partition]).select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    gone = [v for v in values if str(v) not in marks]
    for value in gone:
        spark.sql(f"ALTER TABLE {tables.quote(name)} DROP IF EXISTS PARTITION ({tables.quote_column(partition)}={value!r})")


def possible_homes(spark: SparkSession, table: str, arriving: DataFrame, keys: Sequence[str], partition: str) -> list[str] | None:
    """The partitions that can hold one of the arriving keys, as text; None if the index cannot help."""
    name = index_name(table)
    if not spark.catalog.tableExists(name):
        return None
    wanted = arriving.select(*keys).distinct()
    if wanted.limit(MOST_KEYS + 1).count() > MOST_KEYS:
        return None
    marks = partition_marks(spark, table, partition)
    index = spark.table(name)
    held = index.select(F.col(partition).cast("string").alias("value"), "size", "mark").distinct().collect()  # one row per partition
    current = {r["value"]: r["size"] for r in held if marks.get(r["value"]) == r["mark"]}
    unknown = [v for v in marks if v not in current]
    if not current:
        return unknown
    sizes = F.explode(F.array(*[F.lit(s).cast("long") for s in sorted(set(current.values()))])).alias("size")  # at most one per power of two
    keyed = wanted.select(F.struct(*keys).alias("key"), *keys, sizes)
    asked = keyed.select("key", "size", _places(keys, F.col("size")).alias("places")).select(
        "key", "size", F.size("places").alias("needed"), F.explode("places").alias("bit"))
    asked = asked.select("key", "size", "needed", F.expr("bit DIV 64").alias("word"), F.expr("CAST(bit % 64 AS INT)").alias("at"))
    hits = (
        index.where(F.col(partition).cast("string").isin(list(current)))
        .join(asked, ["size", "word"]).where(F.expr("(shiftright(bits, at) & 1L) = 1"))
        .groupBy(F.col(partition).cast("string").alias("value"), "key", "needed").agg(F.count(F.lit(1)).alias("n"))
        .where("n = needed").select("value").distinct()
    )
    return unknown + [r["value"] for r in hits.collect()]
