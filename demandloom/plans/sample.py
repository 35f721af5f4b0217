"""Adapter: the star-schema sample tables as canonical order lines and lookups."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import config
from demandloom.plans.model import Model

SEGMENTS = (
    config.Segment("AUTOMOBILE", "AUT", ("AMERICA", "ASIA", "EUROPE")),
    config.Segment("MACHINERY", "MAC", ("AMERICA", "ASIA")),
)
ALL_SEGMENT_CODES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CODES = config.Codes(
    urgent="1-URGENT", initial_export="5-LOW", domestic="A", export="R",
    market_names={"A": "MI", "R": "ME"},
)
MARKETS = ("A", "N", "R")
SITES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SECTOR = "00"
STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
REPORTS = config.build_reports(SEGMENTS, CODES)
LEGACY_REPORTS = config.build_reports(
    SEGMENTS, CODES, site_sheets_for_new_models=("AUTOMOBILE",), months=config.LEGACY_WINDOW_MONTHS,
    customer_months=config.LEGACY_WINDOW_MONTHS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its order and customer, under the canonical names."""
    item, order, customer = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    joined = item.join(order, item.l_orderkey == order.o_orderkey).join(
        customer, order.o_custkey == customer.c_custkey
    )
    return joined.select(
        F.col("l_orderkey").cast("string").alias("numero_ov"),
        F.to_date("o_orderdate").alias("data"),
        F.col("o_orderpriority").alias("tipo_ov"),
        F.col("c_mktsegment").alias("org_vendas"),
        F.col("l_returnflag").alias("canal_dist"),
        F.lit(SECTOR).alias("setor_ativ"),
        F.col("l_linestatus").alias("centro"),
        F.col("o_custkey").cast("string").alias("emissor_da_ordem"),
        F.col("l_suppkey").cast("string").alias("autor"),
        F.col("l_linenumber").cast("string").alias("item"),
        F.col("l_partkey").cast("string").alias("material"),
        F.col("l_quantity").cast(config.QUANTITY_TYPE).alias("quantidade"),
        F.col("l_shipdate").alias("_source_file_modification_time"),
        F.date_format("l_shipdate", "yyyy-MM").alias("_source_file_name"),
    )


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand as the chain head; parts over size 40 have none, which leaves gaps."""
    part = table(spark, sf_dir, "part").where("p_size <= 40")
    return part.select(
        F.explode(F.array(*[F.lit(c) for c in ALL_SEGMENT_CODES])).alias("empresa"),
        F.col("p_partkey").cast("string").alias("material"),
        F.col("p_brand").alias("item_principal_cadeia"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


def sales_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer's region as the serving site; unknown when the balance is negative."""
    return _customers(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("cliente"),
        F.col("c_mktsegment").alias("orgv"),
        F.explode(F.array(*[F.lit(m) for m in MARKETS])).alias("cdst"),
        F.lit(SECTOR).alias("sa"),
        F.when(F.col("c_acctbal") >= 0, F.col("r_name")).alias("cen"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("cliente"),
        F.col("c_name").alias("razao_social"),
        F.col("n_name").alias("estado"),
        F.col("r_name").alias("pais"),
    )


class SampleModel(Model):
    """The model over the sample tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, **options):
        super().__init__(
            lines(spark, sf_dir), chain(spark, sf_dir), sales_areas(spark, sf_dir),
            customers(spark, sf_dir), **options,
        )
        self.spark, self.sf_dir = spark, sf_dir

    def order_dates(self) -> DataFrame:
        """Dates of the orders that have lines, without joining the other line columns."""
        item = table(self.spark, self.sf_dir, "lineitem").select("l_orderkey")
        order = table(self.spark, self.sf_dir, "orders")
        dated = order.join(item, order.o_orderkey == item.l_orderkey, "left_semi")
        return dated.select(F.to_date("o_orderdate").alias("data"))


@lru_cache(maxsize=8)
def model(spark: SparkSession, sf_dir: str) -> SampleModel:
    """One model per session and folder: its lookups are measured once."""
    return SampleModel(spark, sf_dir)
