"""Where landed files belong: a plan, not a file move."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import config
from demandloom.functions import text


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name and path of every file directly in ``folder``; contents are not read."""
    listing = spark.read.format("binaryFile").load(folder).select("path", "length")
    return listing.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length")


def route_files(
    files: DataFrame, routes: Mapping[str, str] = config.ROUTES, dry_run: bool = True
) -> DataFrame:
    """Destination per file by its name prefix (exact case); unknown prefixes are errors."""
    lookup = F.create_map(*[F.lit(x) for pair in routes.items() for x in pair])
    named = files.withColumn("prefix", text.route_prefix(F.col("name")))
    folder = F.try_element_at(lookup, F.col("prefix"))
    return named.select(
        "name", "path", "prefix",
        F.concat_ws("/", folder, F.when(folder.isNotNull(), F.col("name"))).alias("_destination"),
        F.when(folder.isNull(), "error").otherwise("planned" if dry_run else "to_move").alias("status"),
    ).select(
        "name", "path", "prefix", F.nullif("_destination", F.lit("")).alias("destination"), "status"
    )


def routing_counts(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("status") != "error").alias("routed"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
