"""The enriched order line and the monthly cube every report is built from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import config
from demandloom.functions import dates, text
from demandloom.operators.cleaning import rename_and_cast
from demandloom.operators.joins import (
    HOT_ROWS,
    Dimension,
    broadcast_bytes,
    hot_lists,
    left_join_dimension,
    left_join_nested,
    measure,
    passing,
    require_unique_keys,
    stored,
)

# What the lookups and reports need to know about a line, apart from its month.
PLACING_COLUMNS = (
    "org_vendas", "canal_dist", "setor_ativ", "tipo_ov", "emissor_da_ordem", "material",
)
CUBE_KEYS = (
    "org_vendas", "canal_dist", "tipo_ov", "centro_original", "emissor_da_ordem",
    "item_principal_cadeia", "material", "month",
)


def dimensions(
    chain: DataFrame, sales_areas: DataFrame, customers: DataFrame
) -> dict[str, Dimension]:
    """The three lookups with the line columns that match their keys."""
    return {
        "chain": Dimension(
            chain.select("material", "empresa", F.col("item_principal_cadeia").alias("_head")),
            ("material", "empresa"),
            ("material", "org_vendas"),
        ),
        "sales_area": Dimension(
            sales_areas.select("cliente", "orgv", "cdst", "sa", F.col("cen").alias("centro_original")),
            ("cliente", "orgv", "cdst", "sa"),
            ("emissor_da_ordem", "org_vendas", "canal_dist", "setor_ativ"),
        ),
        "customer": Dimension(
            customers.select("cliente", "razao_social", "estado", "pais"),
            ("cliente",),
            ("emissor_da_ordem",),
        ),
    }


class Model:
    """Order lines with their dimensions.

    A dimension is measured when first joined, once per model; its size picks
    the join strategy (``broadcast_limit`` bytes, by default what the driver's
    heap has room for). Repeated keys are refused by :meth:`require_unique_keys`.
    The report date is ``as_of``, or the latest order date, looked up once, so
    that all reports of a model share it; make a new model for new data. With
    ``as_of``, later lines are left out, so a closed month can be made again.
    """

    def __init__(
        self,
        lines: DataFrame,
        chain: DataFrame,
        sales_areas: DataFrame,
        customers: DataFrame,
        bare_customer_numbers: bool = False,
        broadcast_limit: int | None = None,
        hot_rows: int = HOT_ROWS,
        as_of: date | None = None,
    ):
        if bare_customer_numbers:
            # Dimensions hold customer numbers without leading zeros.
            lines = lines.withColumn(
                "emissor_da_ordem", text.strip_leading_zeros(F.col("emissor_da_ordem"))
            )
        kind = lines.schema["quantidade"].dataType
        if isinstance(kind, T.DecimalType) and kind.scale > 3:
            raise ValueError(f"quantities are counted in thousandths, {kind.simpleString()} has more decimals")
        if as_of is not None:
            lines = lines.where(F.col("data") <= F.lit(as_of))
        self.lines = lines
        self.dimensions = dimensions(chain, sales_areas, customers)
        self.broadcast_limit = broadcast_bytes(lines.sparkSession) if broadcast_limit is None else broadcast_limit
        self.hot_rows = hot_rows
        self._sizes: dict[str, int] = {}
        self._as_of = as_of

    def sizes(self, *names: str) -> dict[str, int]:
        """In-memory bytes of the named dimensions."""
        unknown = {n: self.dimensions[n].table for n in names if n not in self._sizes}
        if unknown:
            self._sizes |= measure(unknown)
        return {n: self._sizes[n] for n in names}

    def require_unique_keys(self) -> None:
        require_unique_keys(self.dimensions)

    def order_dates(self) -> DataFrame:
        """The dates the report month is taken from: those of the newest period, if known."""
        if config.PERIOD not in self.lines.columns:
            return self.lines.select("data")
        newest = self.lines.agg(F.max(config.PERIOD)).first()[0]
        return self.lines.where(F.col(config.PERIOD) == F.lit(newest)).select("data")

    def window(self, months: int = config.WINDOW_MONTHS) -> dates.Window:
        self._as_of = self._as_of or dates.reference_date(self.order_dates())
        return dates.Window(self._as_of, months)

    def broadcasts(self, *names: str) -> bool:
        return all(size <= self.broadcast_limit for size in self.sizes(*names).values())

    def _hot(self, lines: DataFrame, *names: str) -> dict[str, DataFrame | None]:
        """The hot keys of those dimensions that are too large to broadcast.

        All join keys are columns of the base lines, so one count over these
        serves every lookup, before any join.
        """
        large = [n for n in names if not self.broadcasts(n)]
        if not large:
            return {}
        return hot_lists(lines, {n: self.dimensions[n].on for n in large}, self.hot_rows)

    def _join(self, fact: DataFrame, name: str, hot: dict[str, DataFrame | None] | None = None) -> DataFrame:
        hot = self._hot(fact, name) if hot is None else hot
        by = config.LINE_KEY if set(config.LINE_KEY) <= set(fact.columns) else ()
        return left_join_dimension(
            fact, self.dimensions[name], self.broadcasts(name), self.hot_rows, hot.get(name), True, by)

    def with_head(self, fact: DataFrame, hot: dict[str, DataFrame | None] | None = None) -> DataFrame:
        joined = self._join(fact, "chain", hot)
        return joined.withColumn("item_principal_cadeia", F.coalesce("_head", "material")).drop("_head")

    def with_site(self, fact: DataFrame, hot: dict[str, DataFrame | None] | None = None) -> DataFrame:
        return self._join(fact, "sales_area", hot)

    def with_customer(self, fact: DataFrame, hot: dict[str, DataFrame | None] | None = None) -> DataFrame:
        return self._join(fact, "customer", hot)

    def enriched(self, rows: Column | None = None) -> DataFrame:
        """The 14-column line view; ``rows`` filters the lines before the joins.

        If several lookups are too large to broadcast, the lines are stored
        before and after they get their heads: they are computed once, to be
        counted and joined, and one shuffle of them at a time is on disk.
        """
        lines = self.lines if rows is None else self.lines.where(rows)
        self.sizes(*self.dimensions)
        large = [n for n in self.dimensions if not self.broadcasts(n)]
        if len(large) < 2:
            hot = self._hot(lines, *large)
            return self.with_customer(self.with_site(self.with_head(lines, hot), hot), hot).select(*config.ENRICHED_COLUMNS)
        needed = {*config.ENRICHED_COLUMNS, *config.LINE_KEY, *(c for d in self.dimensions.values() for c in d.on)}
        kept = [c for c in lines.columns if c in needed]
        with passing(lines.select(*kept), "lines") as copy:
            together = {n: self.dimensions[n] for n in ("sales_area", "customer")}
            both = set(together) <= set(large)
            hot = self._hot(copy, *[n for n in large if not (both and n == "sales_area")])
            headed = stored(self.with_head(copy, hot).select(*kept, "item_principal_cadeia"), "headed")
        if not both:
            return self.with_customer(self.with_site(headed, hot), hot).select(*config.ENRICHED_COLUMNS)
        by = config.LINE_KEY if set(config.LINE_KEY) <= set(kept) else ()
        placed = left_join_nested(headed, "emissor_da_ordem", together, self.hot_rows, hot["customer"], by)
        return placed.select(*config.ENRICHED_COLUMNS)

    def report_lines(self, rows: Column | None = None) -> DataFrame:
        """Lines with chain head and site only, for reports that name no customer data."""
        lines = self.lines if rows is None else self.lines.where(rows)
        self.sizes("chain", "sales_area")
        hot = self._hot(lines, "chain", "sales_area")
        return self.with_site(self.with_head(lines, hot), hot)

    def cube(self, window: dates.Window, segments: Sequence[config.Segment],
             reports: Sequence[config.Report]) -> DataFrame:
        """Monthly totals at the finest grain that any of ``reports`` needs.

        With small lookups: broadcast joins, then one aggregation. With large
        ones the lines are summed first, so that a hot part or customer shrinks
        to one row per month, market and order type inside each scan task
        before the joins shuffle it. The customer survives only on rows that a
        by-customer report uses. ``milesimos`` is the quantity in thousandths,
        ``linhas`` the number of lines that have one.
        """
        lines = self.lines.where(
            dates.rows_in(window, self.lines) & F.col("org_vendas").isin([s.code for s in segments])
        )
        rows = lines.select(
            *PLACING_COLUMNS, dates.month_start(F.col("data")).alias("month"),
            F.round(F.col("quantidade") * 1000).cast("bigint").alias("milesimos"),
            F.when(F.col("quantidade").isNotNull(), F.lit(1).cast("bigint")).otherwise(0).alias("linhas"),
        )
        totals = [F.sum(c).alias(c) for c in ("milesimos", "linhas")]
        if not self.broadcasts("chain", "sales_area"):
            rows = rows.groupBy(*PLACING_COLUMNS, "month").agg(*totals)
        hot = self._hot(rows, "chain", "sales_area")
        placed = self.with_site(self.with_head(rows, hot), hot)
        named = [report_rows(r) for r in reports if "emissor_da_ordem" in r.ids]
        wanted = reduce(lambda a, b: a | b, named, F.lit(False))
        return (
            placed.withColumn("emissor_da_ordem", F.when(wanted, F.col("emissor_da_ordem")))
            .groupBy(*CUBE_KEYS)
            .agg(*totals)
        )


def report_rows(report: config.Report) -> Column:
    return F.expr(report.where) if report.where else F.lit(True)


def analytics_lines(model: Model, window: dates.Window,
                    fields: Mapping[str, tuple[str, str | None]] = config.ANALYTICS_FIELDS) -> DataFrame:
    """The wide, typed line-level table of the last 60 months (D10)."""
    recent = model.enriched(dates.rows_in(window, model.lines))
    return rename_and_cast(recent, fields)
