"""Every operator as a query over the sample tables.

Each function takes (session, folder of the sample tables) and returns a
DataFrame. Tables are read whole; some queries ask for one report, segment or
period of them, as their docstrings say. Quantities and dates are returned as
double and text, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import config
from demandloom.functions import text
from demandloom.operators import cleaning, history, joins, merging, quality, summaries
from demandloom.operators.chains import chain_closure
from demandloom.plans import reports, sample
from demandloom.plans.model import analytics_lines
from demandloom.plans.pipeline import run_reports
from demandloom.session import configure, freeing_shuffles, scratch_database, scratch_path
from demandloom.sinks import files, rules, swap, tables
from demandloom.sinks.cubes import IncrementalCube
from demandloom.sinks.tables import quote_column
from demandloom.sources import catalog, routing
from demandloom.sources.files import read_history, read_order_files
from demandloom.sources.workbooks import read_workbooks
from demandloom.streaming.ingest import LoadMode, OrderIngest, save_rejects

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LINE_COLUMNS = ("numero_ov", "item", "data", "tipo_ov", "org_vendas", "canal_dist", "emissor_da_ordem",
                "material", "quantidade")
NEWEST = ("_source_file_modification_time", "material", "autor")


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def comparable(df: DataFrame) -> DataFrame:
    """Dates to text, decimals to double; all else as it is."""

    def one(name: str, kind: str):
        value = F.col(f"`{name}`")
        if kind == "date":
            return value.cast("string").alias(name)
        return value.cast("double").alias(name) if kind.startswith("decimal") else value

    return df.select(*[one(n, t) for n, t in df.dtypes])


def _report(name: str, legacy: bool = False) -> config.Report:
    return next(r for r in (sample.LEGACY_REPORTS if legacy else sample.REPORTS) if r.name == name)


def _wide(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    model = sample.model(spark, sf_dir)
    return _wide_of(model, name)


def _wide_of(model, name: str) -> DataFrame:
    report = _report(name)
    window = model.window(report.months)
    return reports.demand_wide(model.report_lines(window.contains(F.col("data"))), report, sample.SEGMENTS, window)


def _latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.latest_per_key(sample.lines(spark, sf_dir), config.LINE_KEY, NEWEST)


def _short(df: DataFrame) -> DataFrame:
    return comparable(df.select(*LINE_COLUMNS))


# --- the line view and the reports ------------------------------------------------


@query
def j1_j3_enriched_lines(spark, sf_dir):
    return comparable(sample.model(spark, sf_dir).enriched())


@query
def a1_reference_window(spark, sf_dir):
    lines = sample.lines(spark, sf_dir)
    latest = F.max("data")
    return lines.agg(
        latest.cast("string").alias("reference_date"),
        F.add_months(F.trunc(latest, "MM"), 1 - config.WINDOW_MONTHS).cast("string").alias("start_date"),
        F.add_months(F.trunc(latest, "MM"), 1 - config.CUSTOMER_WINDOW_MONTHS).cast("string").alias("customer_start"),
        F.last_day(latest).cast("string").alias("end_date"),
    )


@query
def d1_closed_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "fechada")


@query
def d2_closed_new_models_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "fechada_novos_modelos")


@query
def d3_open_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "aberta")


@query
def d4_line_count_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "linha")


@query
def d5_domestic_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "mi")


@query
def d6_export_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "me")


@query
def d7_urgent_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "zpug")


@query
def d8_urgent_by_customer_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "zpug_cliente")


@query
def d1_d8_all_reports_long(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    window = model.window()
    cube = model.cube(window, sample.SEGMENTS, sample.REPORTS)
    return comparable(reports.demand_long(cube, sample.REPORTS, sample.SEGMENTS, window))


@query
def d1_closed_from_long(spark, sf_dir):
    """The wide report derived from the long form of all reports."""
    model = sample.model(spark, sf_dir)
    window = model.window()
    report = [_report("fechada")]
    long = reports.demand_long(model.cube(window, sample.SEGMENTS, report), report, sample.SEGMENTS, window)
    return reports.widen(long, report[0], window)


@query
def d9_distribution(spark, sf_dir):
    """Shares of the first segment: sites over 6 months, markets over 12."""
    model = sample.model(spark, sf_dir)
    return reports.distribution(
        model.report_lines(), sample.SEGMENTS[:1], model.window(),
        sites={"AUTOMOBILE": [*sample.SITES, None]}, markets=sample.MARKETS, codes=sample.CODES,
    )


@query
def d9_distribution_second_segment(spark, sf_dir):
    """The same shares for the second segment, sites and markets as given."""
    model = sample.model(spark, sf_dir)
    window = model.window()
    lines = model.report_lines(window.contains(F.col("data")))
    return reports.distribution(
        lines, sample.SEGMENTS[1:], window, sites={"MACHINERY": [*sample.SITES, None]}, markets=sample.MARKETS, codes=sample.CODES)


@query
def d9_distribution_of_the_run(spark, sf_dir):
    """The second segment's distribution as the batch run stores it, with the sites and markets that occur: its cells that are not 0."""
    database = scratch_database(spark, "run")
    names = run_reports(sample.SampleModel(spark, sf_dir), database, sample.SEGMENTS, sample.REPORTS, sample.CODES)
    wanted = f"{config.SHARE_NAME}_{sample.SEGMENTS[1].prefix}_{config.TOTAL_SHEET}".lower()
    stored = spark.table(next(n for n in names if n.endswith(wanted))).drop("file", "sheet")
    head, *columns = stored.columns
    cells = [F.struct(F.lit(c).alias("cell"), F.col(quote_column(c)).cast("double").alias("value")) for c in columns]
    return stored.select(F.col(quote_column(head)).alias("head"), F.inline(F.array(*cells))).where("value <> 0")


@query
def d1_as_of_month(spark, sf_dir):
    """A closed report of an earlier month, made again: later lines are left out."""
    return _wide_of(sample.SampleModel(spark, sf_dir, as_of=date(2000, 6, 30)), "fechada")


@query
def j1_j3_large_lookups(spark, sf_dir):
    """The line view with no lookup broadcast: salted shuffle joins, hot keys counted once on the lines."""
    return comparable(sample.SampleModel(spark, sf_dir, broadcast_limit=-1, hot_rows=200).enriched())


@query
def a4_a5_share_rows(spark, sf_dir):
    """Site shares of both segments in long form, for any number of sites."""
    model = sample.model(spark, sf_dir)
    window = model.window(config.SITE_SHARE_MONTHS)
    wanted = window.contains(F.col("data")) & F.col("org_vendas").isin([s.code for s in sample.SEGMENTS])
    return reports.share_rows(model.report_lines(wanted), "centro_original", window)


@query
def d9_distribution_all_segments(spark, sf_dir):
    """The older layout: sites of both segments beside markets of all segments (J5)."""
    model = sample.model(spark, sf_dir)
    window = model.window()
    sites = {s.code: [*sample.SITES, None] for s in sample.SEGMENTS}
    # The longest of its windows, so that only its lines are counted for hot keys.
    lines = model.report_lines(window.resized(config.MARKET_SHARE_MONTHS).contains(F.col("data")))
    return reports.distribution(
        lines, sample.SEGMENTS, window, sites=sites, markets=sample.MARKETS, codes=sample.CODES, all_markets=True)


@query
def d10_analytics_typed(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    return comparable(analytics_lines(model, model.window(config.ANALYTICS_MONTHS)))


@query
def d11_stacked_sheets(spark, sf_dir):
    """Older layout: 48 months, total only for the second segment, all stacked (U1)."""
    model = sample.model(spark, sf_dir)
    report = _report("fechada_novos_modelos", legacy=True)
    window, placed = model.window(report.months), model.report_lines()
    parts = [reports.demand_wide(placed, report, [segment], window) for segment in sample.SEGMENTS]
    return reports.stack_sheets(parts)


@query
def a4_site_share(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    lines = model.report_lines(F.col("org_vendas") == "AUTOMOBILE")
    return reports.value_share(
        lines, "centro_original", model.window(config.SITE_SHARE_MONTHS), [*sample.SITES, None]
    )


@query
def a5_market_share(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    lines = model.with_head(model.lines.where("org_vendas = 'AUTOMOBILE'"))
    return reports.value_share(
        lines, "canal_dist", model.window(config.MARKET_SHARE_MONTHS), sample.MARKETS,
        sample.CODES.market_names,
    )


@query
def j4_shares_full_join(spark, sf_dir):
    """The distribution as an explicit full outer join of its two sides."""
    sides = joins.full_join_filled(a4_site_share(spark, sf_dir), a5_market_share(spark, sf_dir), "item_principal_cadeia")
    return sides.withColumnRenamed("item_principal_cadeia", "Item Principal Cadeia")


@query
def a11_customer_totals(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    window = model.window(12)
    rows = window.contains(F.col("data")) & (F.col("org_vendas") == "AUTOMOBILE")
    return comparable(summaries.totals_by(model.enriched(rows), ["razao_social", "estado"], "quantidade"))


@query
def a12_segment_state_months(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    window = model.window(6)
    label = F.when(F.col("org_vendas") == "AUTOMOBILE", "AUT").otherwise("OUT")
    groups = {"Segmento": label, "Item Principal Cadeia": F.col("item_principal_cadeia"), "Estado": F.col("estado")}
    lines = model.with_customer(model.with_head(model.lines.where(window.contains(F.col("data")))))
    return summaries.month_matrix(lines, groups, window).orderBy("Segmento", "Item Principal Cadeia", "Estado")


@query
def f11_ad_hoc_lines(spark, sf_dir):
    """Lines of one state in a chosen period, newest first."""
    model = sample.model(spark, sf_dir)
    rows = F.col("data").between("2001-01-01", "2001-06-30")
    found = model.with_customer(model.lines.where(rows)).where("estado = 'NATION_3'")
    return comparable(
        found.select("numero_ov", "item", "data", "material", "quantidade", "razao_social", "estado")
        .orderBy(F.col("data").desc())
    )


# --- dedup, merge, delete -----------------------------------------------------------


@query
def a6_latest_per_key(spark, sf_dir):
    return _short(_latest_lines(spark, sf_dir))


def _versions(spark, sf_dir):
    """(rows as first loaded, rows of a later load), one per key each."""
    lines = sample.lines(spark, sf_dir).select(*LINE_COLUMNS, "autor", "_source_file_modification_time")
    late = F.col("_source_file_modification_time") >= F.lit("1999-01-01").cast("timestamp_ntz")
    first = merging.latest_per_key(lines.where(~late), config.LINE_KEY, NEWEST)
    return first, merging.latest_per_key(lines.where(late), config.LINE_KEY, NEWEST)


def _merged_columns(df: DataFrame) -> DataFrame:
    return comparable(df.select(*LINE_COLUMNS, "autor"))


@query
def k1_upsert(spark, sf_dir):
    target, source = _versions(spark, sf_dir)
    return _merged_columns(merging.merge_rows(target, source, config.LINE_KEY, keep_first=("autor",)))


@query
def k1_upsert_table(spark, sf_dir):
    """The same merge on a table partitioned by month; only touched months are rewritten."""
    target, source = (tables.with_period(v) for v in _versions(spark, sf_dir))
    name = f"{scratch_database(spark, 'upsert')}.raw_sales_order"
    tables.replace_table(target, name, [tables.PERIOD])
    tables.upsert(name, source, config.LINE_KEY, keep_first=("autor",), partition_by=tables.PERIOD)
    return _merged_columns(spark.table(name))


@query
def k1_upsert_indexed(spark, sf_dir):
    """The same merge: keys are looked up in the key index, merged months are written once and swapped in."""
    target, source = (tables.with_period(v) for v in _versions(spark, sf_dir))
    name = f"{scratch_database(spark, 'indexed')}.raw_sales_order"
    options = {"keep_first": ("autor",), "partition_by": tables.PERIOD, "swap": True, "indexed": True}
    tables.upsert(name, target, config.LINE_KEY, **options)
    tables.upsert(name, source, config.LINE_KEY, **options)
    return _merged_columns(spark.table(name))


@query
def k3_swapped_table(spark, sf_dir):
    """A table replaced by a function of its own rows, in one step of the catalog."""
    name = f"{scratch_database(spark, 'swapped')}.orders"
    swap.swap_table(sample.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), name)
    swap.swap_table(spark.table(name).where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2), name)
    return spark.table(name)


@query
def k2_create_or_merge(spark, sf_dir):
    """Merge as a configured output: the first call creates the table."""
    target, source = _versions(spark, sf_dir)
    database = scratch_database(spark, "merge")
    settings = {"schema": database, "table_name": "orders", "write_mode": "merge", "merge_keys": list(config.LINE_KEY)}
    tables.write_output(target, settings)
    tables.write_output(source, settings)
    return _merged_columns(spark.table(f"{database}.orders"))


@query
def k3_replace_table(spark, sf_dir):
    """Replace a table by one with another schema."""
    name = f"{scratch_database(spark, 'replace')}.orders"
    orders = sample.table(spark, sf_dir, "orders")
    tables.replace_table(orders.select("o_orderkey", "o_custkey"), name)
    tables.replace_table(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), name)
    return spark.table(name)


@query
def k4_drop_and_recreate(spark, sf_dir):
    """A table that is dropped first keeps nothing of its old rows and schema."""
    database = scratch_database(spark, "recreate")
    orders = sample.table(spark, sf_dir, "orders")
    tables.replace_table(orders, f"{database}.raw_orders")
    tables.drop_tables(spark, database, ["raw_orders"])
    tables.replace_table(orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("cliente")), f"{database}.raw_orders")
    return spark.table(f"{database}.raw_orders")


@query
def k10_clear_outputs(spark, sf_dir):
    """All outputs with the prefix go, other tables stay: the tables left and their rows."""
    database = scratch_database(spark, "clear")
    for name in ("refined_demand_orders", "refined_demand_part", "raw_supplier", "raw_nation"):
        tables.replace_table(sample.table(spark, sf_dir, name.rsplit("_", 1)[-1]), f"{database}.{name}")
    tables.drop_tables(spark, database, [config.TABLE_PREFIX])
    counts = catalog.table_row_counts(spark, [f"{database}.{t}" for t in catalog.list_tables(spark, database)])
    return counts.select(F.element_at(F.split("table", "\\."), -1).alias("table"), "rows")


@query
def k17_k18_metadata(spark, sf_dir):
    """Comments, tags, properties and the checked key of a table, read back beside its row count."""
    name = f"{scratch_database(spark, 'metadata')}.customer"
    customer = tables.enforce_key(sample.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"])
    tables.replace_table(customer, name)
    tables.describe(spark, name, "customers", {"c_name": "the 'name'"}, {"business_owner": "planning"}, {"layer": "raw"},
                    {"c_name": {"pii": "yes"}}, ["c_custkey"])
    listed = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key IN ('business_owner', 'tag.layer', 'tag.c_name.pii', 'primary_key')")
    notes = spark.createDataFrame([(f"comment.{c.name}", c.description) for c in spark.catalog.listColumns(name) if c.description],
                                  "key string, value string")
    rows = spark.table(name).agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    return listed.unionByName(notes).withColumn("rows", F.lit(rows).cast("long"))


@query
def k18_rules_on_write(spark, sf_dir):
    """The same odd rows against append, merge and replacement of a table with rules: rows set aside by reason, rows kept."""
    database = scratch_database(spark, "rules")
    orders = sample.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price"),
        F.substring("o_orderpriority", 1, 1).alias("priority"))
    odd = orders.select(
        F.when(F.col("priority") == "3", F.col("id")).otherwise(-F.col("id") - 1).alias("id"),
        F.when(F.col("priority") == "1", None).otherwise(F.col("cust")).alias("cust"),
        F.when(F.col("priority") == "2", -F.col("price")).otherwise(F.col("price")).alias("price"), "priority")
    parts = []
    for write in ("append", "merge", "replace"):
        name, aside = f"{database}.{write}_orders", f"{database}.{write}_aside"
        tables.replace_table(orders, name)
        rules.set_rules(spark, name, ["id"], ["cust"], {"price": "price >= 0"})
        if write == "append":
            tables.append(name, odd, quarantine=aside)
        elif write == "merge":
            tables.upsert(name, odd, ["id"], quarantine=aside)
        else:
            tables.replace_table(odd, name, quarantine=aside)
        reasons = spark.table(aside).select(F.explode("_broken").alias("reason"))
        kept = spark.table(name).select(F.lit("kept").alias("reason"))
        parts.append(reasons.unionByName(kept).groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).withColumn("write", F.lit(write)))
    return reduce(DataFrame.unionByName, parts)


@query
def k5_append_evolving(spark, sf_dir):
    """Append rows that lack one column and bring another."""
    orders = sample.table(spark, sf_dir, "orders")
    name = f"{scratch_database(spark, 'append')}.orders"
    tables.append(name, orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice"))
    tables.append(name, orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority", "o_totalprice"))
    return spark.table(name).withColumn("o_custkey", F.col("o_custkey").cast("string"))


@query
def k6_append_by_name(spark, sf_dir):
    customer = sample.table(spark, sf_dir, "customer")
    database = scratch_database(spark, "byname")
    settings = {"schema": database, "table_name": "customer", "write_mode": "append"}
    tables.write_output(customer.where("c_acctbal >= 0").select("c_custkey", "c_name", "c_mktsegment"), settings)
    tables.write_output(customer.where("c_acctbal < 0").select("c_mktsegment", "c_custkey", "c_name"), settings)
    return spark.table(f"{database}.customer")


@query
def k7_configured_replace(spark, sf_dir):
    part = sample.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))
    database = scratch_database(spark, "output")
    settings = {"schema": database, "table_name": "brands", "comment": "parts per brand",
                "table_properties": {"business_owner": ":team"}}
    tables.write_output(part, settings, {"team": "planning"})
    return spark.table(f"{database}.brands")


@query
def k8_materialized_view(spark, sf_dir):
    """A stored result, recomputed from its source at each run."""
    supplier = sample.table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    database = scratch_database(spark, "view")
    settings = {"output_type": "materialized_view", "schema": database, "view_name": "by_nation",
                "cluster_by_column": "s_nationkey"}
    tables.write_output(supplier, settings)
    tables.write_output(supplier, settings)
    return spark.table(f"{database}.by_nation")


@query
def k8_incremental_cube(spark, sf_dir):
    """Sums by segment, market, order type and part after late and corrected lines; each refresh reads changed months only."""
    target, source = (tables.with_period(v) for v in _versions(spark, sf_dir))
    database = scratch_database(spark, "cube")
    name = f"{database}.raw_sales_order"
    measures = {"milesimos": F.round(F.col("quantidade") * 1000).cast("bigint"),
                "linhas": F.when(F.col("quantidade").isNotNull(), F.lit(1).cast("bigint")).otherwise(0)}
    cube = IncrementalCube(spark, name, f"{database}.refined_cube", ["org_vendas", "canal_dist", "tipo_ov", "material"], measures)
    tables.upsert(name, target, config.LINE_KEY, partition_by=tables.PERIOD)
    cube.refresh()
    tables.upsert(name, source, config.LINE_KEY, partition_by=tables.PERIOD, swap=True)
    tables.delete_month(spark, name, 1999, 3)
    cube.refresh()
    return cube.result()


@query
def k9_delete_month(spark, sf_dir):
    name = f"{scratch_database(spark, 'delete')}.raw_sales_order"
    tables.replace_table(tables.with_period(sample.lines(spark, sf_dir)), name, [tables.PERIOD])
    tables.delete_month(spark, name, 2000, 6)
    return _short(spark.table(name))


@query
def t3_replace_period(spark, sf_dir):
    """Months that arrive again replace the stored ones; other months stay."""
    lines = tables.with_period(sample.lines(spark, sf_dir))
    arriving = lines.where((F.year("data") == 2000) & (F.col("canal_dist") == "A"))
    return _short(merging.replace_period(lines, arriving, F.col(tables.PERIOD), config.LINE_KEY))


@query
def t3_replace_period_table(spark, sf_dir):
    lines = tables.with_period(sample.lines(spark, sf_dir))
    name = f"{scratch_database(spark, 'period')}.raw_sales_order"
    tables.replace_table(lines, name, [tables.PERIOD])
    tables.replace_periods(name, lines.where((F.year("data") == 2000) & (F.col("canal_dist") == "A")))
    return _short(spark.table(name))


@query
def k16_add_columns(spark, sf_dir):
    """An old table gets the source columns; its rows carry NULL there."""
    name = f"{scratch_database(spark, 'migrate')}.orders"
    tables.replace_table(sample.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), name)
    tables.ensure_source_columns(spark, name)
    return spark.table(name).drop("_source_file_modification_time")


@query
def k19_write_metrics(spark, sf_dir):
    """Rows, quantity and date span observed while the table is written."""
    name = f"{scratch_database(spark, 'measured')}.raw_sales_order"
    found = tables.write_measured(
        sample.lines(spark, sf_dir), lambda df: tables.replace_table(df, name),
        quantity=F.sum("quantidade").cast("double"), first_date=F.min("data").cast("string"),
        last_date=F.max("data").cast("string"),
    )
    return spark.createDataFrame([found], "rows long, quantity double, first_date string, last_date string")


@query
def k20_compacted_table(spark, sf_dir):
    name = f"{scratch_database(spark, 'compact')}.lineitem"
    tables.replace_table(sample.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), name)
    tables.compact(spark, name, ["l_orderkey"], file_bytes=1 << 18)
    return spark.table(name)


@query
def w1_dimension_history(spark, sf_dir):
    """Order priority per customer as validity periods."""
    return _history(history.dimension_history(
        _priorities(spark, sf_dir), ["o_custkey"], "ts", ["o_orderpriority"], "year", ["o_orderkey"]
    ))


@query
def w1_extended_history(spark, sf_dir):
    """The same history built in two loads."""
    versions = _priorities(spark, sf_dir)
    early = F.col("ts") < F.lit("1999-01-01").cast("timestamp_ntz")
    keys, states = ["o_custkey"], ["o_orderpriority"]
    first = history.dimension_history(versions.where(early), keys, "ts", states, "year", ["o_orderkey"])
    later = merging.latest_per_key(versions.where(~early), ["o_custkey", "ts"], ["o_orderkey"])
    return _history(history.extend_history(first, later.drop("o_orderkey"), keys, "ts", states, "year"))


@query
def w1_null_keys(spark, sf_dir):
    """NULL is a key like any other; the history is built in two loads."""
    key = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("o_custkey")
    versions = _priorities(spark, sf_dir).select(key, "ts", "o_orderkey", "o_orderpriority")
    early = F.col("ts") < F.lit("1999-01-01").cast("timestamp_ntz")
    keys, states = ["o_custkey"], ["o_orderpriority"]
    first = history.dimension_history(versions.where(early), keys, "ts", states, "year", ["o_orderkey"])
    later = merging.latest_per_key(versions.where(~early), ["o_custkey", "ts"], ["o_orderkey"])
    return _history(history.extend_history(first, later.drop("o_orderkey"), keys, "ts", states, "year"))


def _priorities(spark, sf_dir):
    return sample.table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("ts"), "o_orderkey", "o_orderpriority"
    )


def _history(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("valid_from_ts", "valid_to_ts")})


# --- quality and summaries ------------------------------------------------------------


@query
def a9_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(sample.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def a9_key_summary(spark, sf_dir):
    return quality.key_summary(sample.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def a14_table_profile(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    columns = ["numero_ov", "org_vendas", "canal_dist", "centro_original"]
    return quality.table_profile(model.with_site(model.lines).select(*columns))


@query
def a14_profile_all_columns(spark, sf_dir):
    """Every column of every star table, and of the lines with a third of the quantities and types missing or cut in halves."""
    parts = [quality.table_profile(sample.table(spark, sf_dir, t)).withColumn("table", F.lit(t)) for t in sample.STAR_TABLES]
    third = F.col("l_orderkey") % 3
    odd = sample.table(spark, sf_dir, "lineitem").select(
        F.when(third == 0, F.col("l_quantity") / 2).when(third == 1, F.col("l_quantity")).alias("quantidade"),
        F.when(third != 2, F.col("l_returnflag")).alias("tipo_ov"))
    return reduce(DataFrame.unionByName, [*parts, quality.table_profile(odd).withColumn("table", F.lit("odd_lines"))])


@query
def t2_line_rejects(spark, sf_dir):
    """Lines that cannot be read are stored with their reason; a replay of the same load stores them once."""
    database, folder = scratch_database(spark, "rejects"), scratch_path(spark, "rejects")
    _text_lines(spark, sf_dir).write.text(folder)
    split = cleaning.classify_lines(read_order_files(spark, folder))
    for load in ("load-1", "load-2", "load-2"):
        save_rejects(split, f"{database}.raw_sales_order", load)
    stored = spark.table(f"{database}.raw_sales_order_rejects")
    good = split.where("reject_reason IS NULL").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("read").alias("load"), F.lit(None).cast("string").alias("reject_reason"), "rows")
    return stored.groupBy(F.col("_load_id").alias("load"), "reject_reason").agg(F.count(F.lit(1)).alias("rows")).unionByName(good)


@query
def a15_quality_report(spark, sf_dir):
    item, part = (sample.table(spark, sf_dir, t) for t in ("lineitem", "part"))
    return quality.quality_report(
        item,
        keys=["l_orderkey", "l_linenumber"],
        types={"l_shipdate": "date"},
        domains={"l_returnflag": ["A", "R"]},
        references={"l_partkey": (part.where("p_size <= 40"), "p_partkey")},
        rules={"positive_quantity": F.col("l_quantity") > 0, "small_discount": F.col("l_discount") < 0.05},
    )


@query
def j7_orphan_orders(spark, sf_dir):
    orders, item = (sample.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    return joins.orphans(orders.select("o_orderkey", "o_custkey"), "o_orderkey", item, "l_orderkey")


@query
def j7_orphan_documents(spark, sf_dir):
    documents, labels = (sample.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return joins.orphans(documents.select("doc_id", "lang"), "doc_id", labels, "doc_id")


@query
def a7_load_summary(spark, sf_dir):
    """Ship months stand for loaded files."""
    return summaries.load_summary(sample.lines(spark, sf_dir), "_source_file_name")


@query
def a8_report_row_counts(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    window = model.window()
    cube = model.cube(window, sample.SEGMENTS, sample.REPORTS)
    long = reports.demand_long(cube, sample.REPORTS, sample.SEGMENTS, window)
    return summaries.report_row_counts(long)


@query
def a10_date_span_by_segment(spark, sf_dir):
    return summaries.date_span(sample.lines(spark, sf_dir), "org_vendas", upload="_source_file_modification_time")


@query
def a10_date_span_by_file(spark, sf_dir):
    lines = sample.lines(spark, sf_dir).where("org_vendas = 'MACHINERY'")
    spans = summaries.date_span(lines, "org_vendas", "_source_file_name", pattern="yyyy/MM/dd")
    return spans.orderBy(F.col("data_final").desc())


@query
def a13_file_sheets(spark, sf_dir):
    """Sheets per report file."""
    model = sample.model(spark, sf_dir)
    window = model.window()
    cube = model.cube(window, sample.SEGMENTS, sample.REPORTS)
    long = reports.demand_long(cube, sample.REPORTS, sample.SEGMENTS, window)
    return long.select("file", "sheet").distinct().groupBy("file").agg(F.count(F.lit(1)).alias("sheets"))


def _chain_texts(spark, sf_dir):
    """Part master with heads in every state of disorder."""
    brand, size = F.col("p_brand"), F.col("p_size") % 6
    return sample.table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, "0200").otherwise("0500").alias("empresa"),
        F.concat(F.col("p_partkey").cast("string"), F.when(size == 1, "  C").otherwise("")).alias("material"),
        F.when(size == 0, F.lit(None)).when(size == 1, " ").when(size == 2, "Sim")
        .when(size == 3, F.concat(brand, F.lit("  C"))).when(size == 4, F.concat(brand, F.lit(" G")))
        .otherwise(brand).alias("item_principal_cadeia"),
    )


@query
def p18_p19_chain_head(spark, sf_dir):
    return cleaning.chain_dimension(_chain_texts(spark, sf_dir))


@query
def a16_changed_heads(spark, sf_dir):
    return summaries.changed_heads(cleaning.chain_dimension(_chain_texts(spark, sf_dir)))


@query
def j1_chain_closure(spark, sf_dir):
    """Every part's last successor over several steps: parts point at half their number, some at each other."""
    key = F.col("p_partkey")
    to = (F.when(key % 40 == 10, key + 1).when(key % 40 == 11, key - 1).when(F.col("p_size") <= 45, F.floor(key / 2)))
    parts = sample.table(spark, sf_dir, "part").select(
        F.lit("0200").alias("empresa"), key.cast("string").alias("material"), to.cast("string").alias("item_principal_cadeia"))
    return chain_closure(parts, min_rows=1000)


# --- parsing and cleaning ---------------------------------------------------------------


def _text_lines(spark, sf_dir) -> DataFrame:
    """Order lines as file text, with header, separator, blank and short lines mixed in."""
    good = cleaning.render_pipe_lines(sample.lines(spark, sf_dir))
    noise = sample.table(spark, sf_dir, "nation").select(
        F.explode(F.array(
            F.lit("|Doc.venda|05.06.2026|" + "|".join(["x"] * 16) + "|"), F.lit("-" * 80), F.lit("   "),
            F.lit("|1|2|3|"), F.lit("|9|2026-06-05|" + "|".join(["x"] * 16) + "|"),
        )).alias("value")
    )
    return good.union(noise)


@query
def p1_p8_parse_lines(spark, sf_dir):
    parsed = cleaning.parse_pipe_lines(_text_lines(spark, sf_dir))
    return _short(cleaning.type_order_lines(parsed, "TEST", "0"))


@query
def p8_p10_audit_columns(spark, sf_dir):
    """The typed null column, the audit columns (times: are they filled) and the order of all columns."""
    typed = cleaning.type_order_lines(cleaning.parse_pipe_lines(_text_lines(spark, sf_dir)), "TEST", "load-1")
    filled = [F.col(c).isNotNull().alias(c) for c in ("_ingested_at", "_last_updated_at", "_ingested_by")]
    return typed.select("numero_ov", "item", "numero_pedido", "_load_type", "_load_id", *filled,
                        F.lit(" ".join(typed.columns)).alias("column_order"))


@query
def s2_read_order_files(spark, sf_dir):
    """The same through text files on storage; also reports one file name pattern."""
    folder = scratch_path(spark, "orders")
    _text_lines(spark, sf_dir).write.text(folder)
    parsed = cleaning.parse_pipe_lines(read_order_files(spark, folder))
    typed = cleaning.type_order_lines(parsed, "TEST", "0")
    return comparable(typed.select(*LINE_COLUMNS, F.col("_source_file_name").endswith(".txt").alias("from_text")))


@query
def s3_read_history(spark, sf_dir):
    """Parquet in subfolders, odd header spelling, missing quantity as 0."""
    folder = scratch_path(spark, "history")
    lines = sample.lines(spark, sf_dir)
    wanted = [
        F.col(c) if c in lines.columns else F.lit(None).cast("string").alias(c) for c in config.BUSINESS_COLUMNS
    ]
    named = lines.select(*wanted).withColumn(
        "quantidade", F.when(F.col("canal_dist") != "N", F.col("quantidade"))
    )
    odd = {"numero_ov": "Número OV", "org_vendas": "Org. Vendas"}
    renamed = named.select(*[F.col(c).alias(odd.get(c, c)) for c in named.columns])
    renamed.where("canal_dist = 'A'").write.parquet(f"{folder}/2001/a")
    renamed.where("canal_dist <> 'A'").write.parquet(f"{folder}/other")
    return _short(cleaning.type_historical_lines(read_history(spark, folder)))


@query
def p5_blank_to_null(spark, sf_dir):
    orders = sample.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "   ").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return cleaning.blanks_to_null(orders)


@query
def p6_date_parse(spark, sf_dir):
    """Days shifted by three, so that some dates do not exist."""
    day = F.lpad((F.dayofmonth("o_orderdate") + 3).cast("string"), 2, "0")
    written = F.concat(day, F.date_format("o_orderdate", ".MM.yyyy"))
    return sample.table(spark, sf_dir, "orders").select(
        "o_orderkey", written.alias("written"), text.parse_date(written).cast("string").alias("parsed")
    )


@query
def p7_number_parse(spark, sf_dir):
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    signed = F.when(F.col("l_linestatus") == "F", -amount).otherwise(amount)
    written = F.when(F.col("l_returnflag") == "N", "n/a").otherwise(text.format_number(signed, 2))
    return sample.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.parse_number(written).cast("double").cast("string").alias("parsed")
    ).withColumn("parsed", F.format_number(F.col("parsed").cast("decimal(18,2)"), 2))


@query
def p16_strip_zeros(spark, sf_dir):
    padded = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    return sample.table(spark, sf_dir, "customer").select(
        "c_custkey", padded.alias("padded"), text.strip_leading_zeros(padded).alias("bare")
    )


@query
def p17_default_site(spark, sf_dir):
    raw = sample.sales_areas(spark, sf_dir).select(
        F.lpad("cliente", 8, "0").alias("Cliente"),
        F.when(F.col("orgv") == "AUTOMOBILE", "0200").when(F.col("orgv") == "MACHINERY", "0500")
        .otherwise("0900").alias("OrgV."),
        F.col("cdst").alias("CDst"), F.col("sa").alias("SA"),
        F.when(F.col("cen") == "ASIA", " ").otherwise(F.col("cen")).alias("Cen."),
    )
    return cleaning.sales_area_dimension(raw)


@query
def p15_customer_dimension(spark, sf_dir):
    raw = sample.customers(spark, sf_dir).select(
        F.lpad("cliente", 8, "0").alias("Cliente"), F.col("pais").alias("PS"), F.col("estado").alias("Rg"),
        F.col("razao_social").alias("Nome 3"), F.upper("estado").alias("Local"),
    )
    return cleaning.customer_dimension(raw)


@query
def p14_promote_header(spark, sf_dir):
    """A header taken for data, once per file, becomes the column names."""
    orders = sample.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("_c0"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("_c1"),
    )
    repeats = sample.table(spark, sf_dir, "nation").select(F.lit("Pedido Nº").alias("_c0"), F.lit("Situação").alias("_c1"))
    return cleaning.promote_header(orders.union(repeats), ["Pedido Nº", "Situação"])


@query
def p30_p31_cell_text(spark, sf_dir):
    """Whole document texts made safe for spreadsheet cells."""
    lead = F.element_at(F.array(*[F.lit(c) for c in ["=", "+", "-", "@", "\t", "\r", "\x01", ""]]), (F.col("doc_id") % 8 + 1).cast("int"))
    value = F.concat(lead, F.col("text"))
    safe = text.cell_text(value)
    return sample.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(safe.cast("binary")).alias("digest"), F.length(safe).cast("bigint").alias("length")
    )


@query
def p32_sheet_names(spark, sf_dir):
    return sample.table(spark, sf_dir, "pages").select("page_id", text.sheet_name(F.col("url")).alias("sheet"))


@query
def p33_unsafe_names(spark, sf_dir):
    name = F.when(F.col("doc_id") % 3 == 0, F.concat("source", F.lit("/"), "lang")).when(
        F.col("doc_id") % 3 == 1, F.concat("source", F.lit("..xlsx"))
    ).otherwise(F.col("source"))
    documents = sample.table(spark, sf_dir, "documents").select("doc_id", name.alias("name"))
    return documents.where(text.unsafe_file_name(F.col("name")))


@query
def p35_template_audit(spark, sf_dir):
    orders = sample.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("id_order"), "o_orderstatus"
    )
    return cleaning.template_audit(orders, ["id_order"], "sample").select("id_order", "o_orderstatus", "source_system")


@query
def p36_clean_and_standardise(spark, sf_dir):
    raw = sample.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Order Date"),
        F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_custkey").cast("string")).alias("Cust No."),
    )
    clean = cleaning.clean_and_standardise(raw, ["order_date"], ["cust_no"]).drop("created_ts")
    return comparable(clean.withColumn("cust_no", F.col("cust_no").cast("bigint").cast("string")))


# --- configured sources, exports, streams ---------------------------------------------------


@query
def s6_table_scan(spark, sf_dir):
    name = f"{scratch_database(spark, 'scan')}.supplier"
    tables.replace_table(sample.table(spark, sf_dir, "supplier"), name)
    return catalog.load_source(spark, {"table_source": {"tableName": name}})


@query
def s7_file_source(spark, sf_dir):
    source = {"file_source": {"path": f"{sf_dir}/orders.parquet", "mergeSchema": False}}
    return catalog.load_source(spark, source).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query
def s7_query_source(spark, sf_dir):
    statement = f"SELECT p_brand, count(*) AS parts FROM parquet.`{sf_dir}/part.parquet` GROUP BY p_brand"
    return catalog.load_source(spark, {"table_source": {"tableName": statement, "isExpression": True}})


@query
def s8_metric_view(spark, sf_dir):
    name = f"{scratch_database(spark, 'metrics')}.lineitem"
    tables.replace_table(sample.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_orderkey"), name)
    measures = {"quantity": F.sum("l_quantity"), "orders": F.count_distinct("l_orderkey"), "lines": F.count(F.lit(1))}
    view = {"dimensions": ["l_returnflag", "l_linestatus"], "measures": list(measures)}
    return catalog.load_source(spark, {"table_source": {"tableName": name, "metricView": view}}, measures)


@query
def s8_metric_dimensions(spark, sf_dir):
    return catalog.select_metrics(sample.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query
def s9_table_row_counts(spark, sf_dir):
    """Tables found by prefix in a database, counted in one job (A8)."""
    database = scratch_database(spark, "discover")
    for name in ("orders", "customer", "part"):
        tables.replace_table(sample.table(spark, sf_dir, name), f"{database}.refined_demand_{name}")
    tables.replace_table(sample.table(spark, sf_dir, "supplier"), f"{database}.other_supplier")
    found = catalog.list_tables(spark, database, config.TABLE_PREFIX)
    counts = catalog.table_row_counts(spark, [f"{database}.{t}" for t in found])
    return counts.select(F.element_at(F.split("table", "\\."), -1).alias("table"), "rows")


@query
def s11_file_routing(spark, sf_dir):
    item = sample.table(spark, sf_dir, "lineitem")
    name = F.when(F.col("l_linestatus") == "O", F.concat_ws("_", "l_returnflag", F.col("l_orderkey").cast("string"), F.lit("x.txt")))
    landed = item.select(name.alias("long"), F.concat("l_returnflag", F.lit(".tar.gz")).alias("short")).select(
        F.coalesce("long", "short").alias("name"), F.concat(F.lit("in/"), F.coalesce("long", "short")).alias("path")
    )
    return routing.route_files(landed, {"A": "dest/a", "R.tar": "dest/r"})


@query
def k11_k12_csv_export(spark, sf_dir):
    """Tables to folders of named CSV files, read back."""
    database, folder = scratch_database(spark, "csv"), scratch_path(spark, "csvout")
    totals = sample.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    tables.replace_table(totals, f"{database}.part_totals")
    written = files.export_tables_csv(spark, [f"{database}.part_totals"], folder)
    return spark.read.option("header", True).schema("l_partkey long, quantity double").csv(written[0])


def _report_tables(spark, sf_dir, label) -> list[str]:
    """Two reports as stored tables with file and sheet columns."""
    database = scratch_database(spark, label)
    model = sample.model(spark, sf_dir)
    window, placed = model.window(), model.report_lines()
    names = []
    for report in ("fechada", "mi"):
        name = f"{database}.refined_demand_{report}"
        tables.replace_table(reports.demand_wide(placed, _report(report), sample.SEGMENTS, window), name)
        names.append(name)
    return names


@query
def k13_export_plan(spark, sf_dir):
    plan = files.name_sheets(files.export_plan(spark, _report_tables(spark, sf_dir, "plan")))
    return plan.select(
        "file", F.element_at(F.split("table", "\\."), -1).alias("table"), "sheet", "rows", "position", "name"
    )


@query
def k14_s4_workbook_readback(spark, sf_dir):
    """Reports exported to workbooks, and their first sheets read back."""
    names, folder = _report_tables(spark, sf_dir, "books"), scratch_path(spark, "books")
    files.export_workbooks(spark, names, folder)
    recent = ["2001_05", "2001_06", "2001_07", "2001_08"]
    back = read_workbooks(spark, folder, ["item_principal_cadeia", *recent], pattern="*Demanda Fechada.xlsx")
    return back.select("item_principal_cadeia", *[F.col(c).cast("bigint").alias(c) for c in recent])


def _state_months(spark, sf_dir):
    model = sample.model(spark, sf_dir)
    lines = model.with_customer(model.lines)
    return summaries.month_matrix(lines, {"estado": F.col("estado"), "canal": F.col("canal_dist")}, model.window(3))


def _single_file(spark, sf_dir, file_type, extension):
    rows = _state_months(spark, sf_dir)
    path = f"{scratch_path(spark, 'single')}/report.{extension}"
    files.write_file(rows.where("canal = 'A'"), path, file_type)
    files.write_file(rows.where("canal <> 'A'"), path, file_type, "append", order_by=["estado", "canal"])
    back = files.read_file(spark, path, file_type)
    return back.select("estado", "canal", *[F.col(f"`{c}`").cast("bigint").alias(c) for c in rows.columns[2:]])


@query
def k15_single_csv(spark, sf_dir):
    return _single_file(spark, sf_dir, "csv", "csv")


@query
def k15_single_json(spark, sf_dir):
    return _single_file(spark, sf_dir, "json", "json")


@query
def k15_single_excel(spark, sf_dir):
    return _single_file(spark, sf_dir, "excel", "xlsx")


def _ingest(spark, sf_dir, mode: LoadMode, waves: list[DataFrame], label: str) -> DataFrame:
    database, folder = scratch_database(spark, label), scratch_path(spark, label)
    ingest = OrderIngest(spark, folder, f"{database}.raw_sales_order", scratch_path(spark, "checkpoint"), mode, pattern="*.txt.gz")
    for wave in waves:
        with freeing_shuffles(spark):
            cleaning.render_pipe_lines(wave).write.mode("append").text(folder, compression="gzip")
        ingest.run()
    return _short(spark.table(ingest.table))


@query
def t1_stream_ingest(spark, sf_dir):
    """Older versions arrive first, the newest ones in a second run of the stream."""
    old, new = (v.select(*LINE_COLUMNS) for v in _versions(spark, sf_dir))
    return _ingest(spark, sf_dir, LoadMode.INCREMENTAL, [old, new], "stream")


@query
def t3_stream_period_refresh(spark, sf_dir):
    """A second file with some months replaces exactly these."""
    latest = _latest_lines(spark, sf_dir).select(*LINE_COLUMNS)
    again = latest.where((F.year("data") == 2000) & (F.col("canal_dist") == "A"))
    return _ingest(spark, sf_dir, LoadMode.PERIOD_REFRESH, [latest, again], "refresh")


@query
def t3_full_refresh(spark, sf_dir):
    """A full refresh leaves the rows of the last load only."""
    latest = _latest_lines(spark, sf_dir).select(*LINE_COLUMNS)
    return _ingest(spark, sf_dir, LoadMode.FULL_REFRESH, [latest, latest.where("canal_dist = 'A'")], "full")
