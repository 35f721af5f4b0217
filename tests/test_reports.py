from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from demandloom import config
from demandloom.operators import joins
from demandloom.plans import pipeline, reports, sample
from demandloom.plans.model import Model, analytics_lines
from demandloom.sinks import tables

LINES = ("numero_ov string, item string, data date, tipo_ov string, org_vendas string, canal_dist string, "
         "setor_ativ string, centro string, emissor_da_ordem string, material string, quantidade decimal(18,3)")


def order(item, day, quantity, material="M1", segment="0200", market="01", kind="ZNOR", customer="7"):
    amount = None if quantity is None else Decimal(str(quantity))
    return ("1", item, date.fromisoformat(day), kind, segment, market, "04", "0203", customer, material, amount)


@pytest.fixture
def build(spark):
    chain = spark.createDataFrame(
        [("0200", "M1", "H1"), ("0200", "M2", "H1"), ("0500", "M1", "H9")],
        "empresa string, material string, item_principal_cadeia string",
    )
    areas = spark.createDataFrame(
        [("7", "0200", "01", "04", "0203"), ("8", "0200", "01", "04", "0209"), ("9", "0200", "01", "04", None),
         ("7", "0500", "01", "04", "0503"), ("6", "0200", "01", "04", "0999")],
        "cliente string, orgv string, cdst string, sa string, cen string",
    )
    customers = spark.createDataFrame(
        [("7", "BR", "X", "SP", "Dealer 7"), ("8", "BR", "Y", "RJ", "Dealer 8")],
        "cliente string, pais string, cidade string, estado string, razao_social string",
    )

    def make(rows, **options):
        return Model(spark.createDataFrame(rows, LINES), chain, areas, customers, **options)

    return make


def report(name):
    return next(r for r in config.REPORTS if r.name == name)


def wide(model, name, **options):
    placed = model.report_lines()
    return reports.demand_wide(placed, report(name), config.SEGMENTS, model.window(), **options)


def test_closed_report_by_hand(build):
    model = build([
        order("1", "2026-06-05", 10), order("2", "2026-05-05", 5.9, material="M2"), order("3", "2026-06-05", 0.9, customer="8"),
        order("4", "2026-06-01", 3, customer="9"), order("5", "2026-06-01", 4, customer="6"), order("6", "2026-06-01", 2, material="M3"),
        order("7", "2024-06-30", 99), order("8", "2026-06-02", 1, segment="0500"), order("9", "2026-06-02", 1, segment="0900"),
        order("10", "2026-06-01", None, material="M4"),
    ])
    rows = {(r["file"], r["sheet"], r["Item Principal Cadeia"]): r for r in wide(model, "fechada").collect()}
    name = "HDA 2026 Jun Demanda Fechada"
    total = rows[(name, "TTL", "H1")]
    # 10 + 0.9 + 3 + 4 is cut, not rounded; sites outside the sheets and no site count in the total only.
    assert (total["2026/06"], total["2026/05"], total["2024/07"]) == (17, 5, 0)
    assert rows[(name, "0203", "H1")]["2026/06"] == 10 and rows[(name, "0209", "H1")]["2026/06"] == 0
    assert rows[(name, "TTL", "M3")]["2026/06"] == 2
    assert rows[(name, "TTL", "M4")]["2026/06"] == 0  # only a line without quantity
    assert rows[("HAB 2026 Jun Demanda Fechada", "0503", "H9")]["2026/06"] == 1
    assert not any(sheet in ("0999", "0232") for _, sheet, _ in rows)
    assert len(total) == 3 + 24


def test_report_filters(build):
    model = build([
        order("1", "2026-06-05", 1, kind="ZESP"), order("2", "2026-06-05", 2, kind=None),
        order("3", "2026-06-05", 4, kind="ZPUG"), order("4", "2026-06-05", 8, market="02"),
        order("5", "2025-06-30", 16, kind="ZPUG"), order("6", "2026-06-05", None),
    ])

    def june(name):
        return [r["2026/06"] for r in wide(model, name).where("sheet = 'TTL'").collect()]

    assert june("fechada") == [15]
    assert june("fechada_novos_modelos") == [12]  # an unknown order type is dropped too
    assert june("linha") == [4]  # a line without quantity does not count
    assert june("mi") == [7] and june("me") == [8]
    assert june("zpug") == [4]
    by_customer = wide(model, "zpug_cliente").collect()
    assert len(by_customer) == 1 and by_customer[0]["Cliente"] == "7" and len(by_customer[0]) == 4 + 12


def test_observed_months_only(build):
    model = build([order("1", "2026-06-05", 1), order("2", "2026-01-05", 1)])
    assert wide(model, "fechada", observed_only=True).columns[3:] == ["2026/01", "2026/06"]


def test_empty_segment_gives_no_rows(build):
    model = build([order("1", "2026-06-05", 1, segment="0900")])
    assert wide(model, "fechada").count() == 0
    assert reports.distribution(model.report_lines(), config.SEGMENTS[:1], model.window()).count() == 0


def test_distribution_by_hand(build):
    model = build([
        order("1", "2026-06-05", 1), order("2", "2026-06-05", 2, customer="8"), order("3", "2026-06-05", 0.5, customer="9"),
        order("4", "2025-12-31", 10, market="02"), order("5", "2026-06-05", 7, material=None), order("6", "2025-07-01", 5, material="M5"),
    ])
    found = reports.distribution(model.report_lines(), config.SEGMENTS[:1], model.window(), codes=config.Codes())
    assert found.columns == [
        "file", "sheet", "Item Principal Cadeia", "DMD_0203", "DMD_0209", "DMD_null", "%_0203", "%_0209", "%_null",
        "DMD_ME", "DMD_MI", "%_ME", "%_MI",
    ]
    rows = [tuple(r)[2:] for r in found.collect()]
    head = {r[0]: r[1:] for r in rows if r[0]}
    assert head["H1"] == (1, 2, 0, 33.33, 66.67, 0.0, 10, 3, 76.92, 23.08)
    assert head["M5"] == (0, 0, 0, 0.0, 0.0, 0.0, 0, 5, 0.0, 100.0)
    # A NULL head never matches itself in a join: one row per side.
    assert sorted(r[1:] for r in rows if r[0] is None) == [
        (0, 0, 0, 0.0, 0.0, 0.0, 0, 7, 0.0, 100.0), (7, 0, 0, 100.0, 0.0, 0.0, 0, 0, 0.0, 0.0),
    ]


def test_distribution_equals_full_join(spark, sf_dir):
    model = sample.SampleModel(spark, sf_dir)
    window, lines = model.window(), model.report_lines(F.col("org_vendas") == "AUTOMOBILE")
    site = reports.value_share(lines, "centro_original", window.resized(6))
    market = reports.value_share(lines, "canal_dist", window.resized(12), names=sample.CODES.market_names)
    joined = joins.full_join_filled(site, market, "item_principal_cadeia")
    single = reports.distribution(model.report_lines(), sample.SEGMENTS[:1], window, codes=sample.CODES)
    assert sorted(map(tuple, joined.collect())) == sorted(tuple(r)[2:] for r in single.collect())


def test_shares_sum_to_hundred(spark, sf_dir):
    model = sample.SampleModel(spark, sf_dir)
    found = reports.distribution(model.report_lines(), sample.SEGMENTS[:1], model.window(), codes=sample.CODES)
    markets = [c for c in found.columns if c in ("%_MI", "%_ME", "%_N")]
    for r in found.collect():
        assert abs(sum(r[c] for c in markets) - 100) < 0.03


def test_repeated_dimension_keys_are_refused(build, database):
    model = build([order("1", "2026-06-05", 1)])
    twice = model.dimensions["customer"]
    model.dimensions["customer"] = joins.Dimension(twice.table.union(twice.table), twice.keys, twice.on)
    with pytest.raises(ValueError, match="customer"):
        pipeline.run_reports(model, database)


def test_large_dimensions_give_the_same_result(spark, sf_dir):
    """Without broadcast: salted joins, and lines summed before the lookups."""
    small = sample.SampleModel(spark, sf_dir)
    large = sample.SampleModel(spark, sf_dir, broadcast_limit=-1, hot_rows=20)
    window = small.window()

    def long(model):
        cube = model.cube(window, sample.SEGMENTS, sample.REPORTS)
        return reports.demand_long(cube, sample.REPORTS, sample.SEGMENTS, window)

    assert long(small).exceptAll(long(large)).isEmpty() and long(large).exceptAll(long(small)).isEmpty()
    assert small.enriched().exceptAll(large.enriched()).isEmpty()
    plan = large.enriched()._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


def test_hot_material_is_spread(spark, build):
    rows = [order(str(i), "2026-06-05", 1, customer="7" if i % 3 else "8") for i in range(300)]
    model = build(rows + [order("n", "2026-06-05", 0, material=None)], broadcast_limit=-1, hot_rows=10)
    assert [tuple(r) for r in joins.hot_keys(model.lines, ["material", "org_vendas"], 10).collect()] == [("M1", "0200", 31)]
    assert joins.hot_keys(model.lines, ["material", "org_vendas"], 1000) is None
    placed = model.report_lines()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = model.with_head(model.lines).where("material = 'M1'")
        assert hot.select(F.spark_partition_id().alias("task")).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    placed = placed.where("material IS NOT NULL")
    assert placed.count() == 300
    closed = reports.demand_wide(placed, report("fechada"), config.SEGMENTS, model.window())
    assert {r["sheet"]: r["2026/06"] for r in closed.collect()} == {"TTL": 300, "0203": 200, "0209": 100}


def test_large_lookups_read_only_what_is_asked_for(spark, build):
    model = build([order(str(i), "2026-06-05", 1) for i in range(50)], broadcast_limit=-1, hot_rows=10)
    model.lines = model.lines.withColumn("unused", F.lit("x"))
    plan = model.enriched().select("numero_ov", "quantidade", "estado")._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "unused" not in plan


def test_lookups_are_broadcast_only_if_the_driver_has_room(spark, build, monkeypatch):
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert joins.broadcast_bytes(spark) <= heap // 64  # 750 MB of heap failed with 100 and 250 MB of lookups
    model = build([order("1", "2026-06-05", 1)])
    assert model.broadcasts(*model.dimensions)
    monkeypatch.setattr(joins, "HEAP_SHARE", heap)
    model = build([order("1", "2026-06-05", 1)])
    assert not any(model.broadcasts(n) for n in model.dimensions)
    plan = model.enriched()._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_two_large_lookups_in_one_shuffle(spark, build):
    """Nested lookups give what the joins one by one give, with repeated and NULL keys on both sides."""
    customers = [order(str(i), "2026-06-05", 1, customer=c, market=m, segment=s) for i, (c, m, s) in enumerate(
        [("7", "01", "0200"), ("7", "02", "0200"), ("8", "01", "0200"), ("6", "01", None), ("5", "01", "0200"),
         (None, "01", "0200"), ("9", "01", "0200"), ("7", None, "0500")])]
    small, large = build(customers), build(customers, broadcast_limit=-1, hot_rows=2)
    for model in (small, large):
        for name, extra in (("sales_area", ("7", "0200", "01", "04", "0209")), ("sales_area", (None, "0200", "01", "04", "X")),
                            ("customer", ("7", "Dealer 7b", "RJ", "BR")), ("customer", (None, "nobody", "RJ", "BR"))):
            d = model.dimensions[name]
            more = spark.createDataFrame([extra], d.table.schema)
            model.dimensions[name] = joins.Dimension(d.table.unionByName(more), d.keys, d.on)
    want, got = (sorted(map(str, m.enriched().collect())) for m in (small, large))
    assert got == want and len(want) == 8 + 3 + 1 + 1


def test_hot_lists_count_the_keys_of_full_buckets_only(spark, monkeypatch):
    rows = spark.createDataFrame([("a", "x")] * 5 + [("b", "x")] * 2 + [(None, "y")] * 5 + [("c", None)], "k string, l string")
    for buckets in (1, joins.KEY_BUCKETS):  # one bucket: all keys are in a full one
        monkeypatch.setattr(joins, "KEY_BUCKETS", buckets)
        found = joins.hot_lists(rows, {"k": ["k"], "l": ["l"], "both": ["l", "k"]}, 5)
        listed = {n: sorted(map(str, (tuple(r) for r in f.collect()))) for n, f in found.items()}
        assert listed == {"k": ["('a', 2)", "(None, 2)"], "l": ["('x', 3)", "('y', 2)"], "both": ["('x', 'a', 2)", "('y', None, 2)"]}
    assert joins.hot_lists(rows, {"k": ["k"], "l": ["l"]}, 8) == {"k": None, "l": None}


def test_as_of(build):
    model = build([order("1", "2026-05-05", 1), order("2", "2026-06-20", 2)], as_of=date(2026, 5, 31))
    assert model.window().as_of == date(2026, 5, 31)
    assert [r["numero_ov"] for r in model.enriched().collect()] == ["1"]


def test_customer_numbers_with_leading_zeros(build):
    rows = [order("1", "2026-06-05", 1, customer="0007")]
    assert build(rows).enriched().first()["razao_social"] is None
    assert build(rows, bare_customer_numbers=True).enriched().first()["razao_social"] == "Dealer 7"


def test_enriched_columns_and_analytics(spark, database, build):
    model = build([order("1", "2026-06-05", 1.9), order("2", "2021-06-30", 1)])
    assert model.enriched().columns == list(config.ENRICHED_COLUMNS)
    typed = analytics_lines(model, model.window(config.ANALYTICS_MONTHS))
    assert typed.columns == [n for n, _ in config.ANALYTICS_FIELDS.values()]
    assert dict(typed.dtypes)["quantidade"] == "int" and dict(typed.dtypes)["data_ordem"] == "date"
    assert [r["quantidade"] for r in typed.collect()] == [1]
    for _ in range(2):
        pipeline.run_analytics(model, f"{database}.refined_demand_analytics")
    assert spark.table(f"{database}.refined_demand_analytics").count() == 1


def test_totals_agree_across_reports(spark, sf_dir):
    model = sample.SampleModel(spark, sf_dir)
    window = model.window()
    cube = model.cube(window, sample.SEGMENTS, sample.REPORTS)
    long = reports.demand_long(cube, sample.REPORTS, sample.SEGMENTS, window)
    totals = {
        (r["report"], r["org_vendas"], r["sheet"]): r["v"]
        for r in long.groupBy("report", "org_vendas", "sheet").agg(F.sum("value").alias("v")).collect()
    }
    for segment in sample.SEGMENTS:
        code = segment.code
        assert totals[("fechada", code, "TTL")] == totals[("aberta", code, "TTL")]
        sites = sum(totals.get(("fechada", code, s), 0) for s in segment.sites)
        assert sites <= totals[("fechada", code, "TTL")]
        direct = model.lines.where(window.contains(F.col("data")) & (F.col("org_vendas") == code))
        assert totals[("fechada", code, "TTL")] == direct.agg(F.sum("quantidade")).first()[0]


def test_batch_run_writes_one_view_per_sheet(spark, sf_dir, database):
    model = sample.SampleModel(spark, sf_dir)
    views = pipeline.run_reports(model, database, sample.SEGMENTS, sample.REPORTS, sample.CODES)
    # 3 total-only reports with 1 sheet, 5 with sites, shares: per segment.
    assert len(views) == (4 * 4 + 4 + 3 + 1) + (4 * 3 + 1 + 3 + 1)
    view = spark.table(f"{database}.refined_demand_fechada_aut_asia")
    expected = reports.demand_wide(
        model.report_lines(), sample.REPORTS[0], sample.SEGMENTS, model.window()
    ).where("sheet = 'ASIA' AND file LIKE 'AUT%'")
    assert view.columns == expected.columns
    assert view.exceptAll(expected).isEmpty() and expected.exceptAll(view).isEmpty()
    shares = spark.table(f"{database}.refined_demand_distribuicao_aut_ttl")
    direct = reports.distribution(model.report_lines(), sample.SEGMENTS[:1], model.window(), codes=sample.CODES)
    assert shares.exceptAll(direct).isEmpty()


def test_production_report_count():
    sheets = {s.code: sum(len(r.sheets(s)) for r in config.REPORTS) + 1 for s in config.SEGMENTS}
    assert sheets == {"0200": 24, "0500": 17}


def test_no_shuffle_beyond_the_aggregation(spark, sf_dir):
    model = sample.SampleModel(spark, sf_dir)
    df = reports.demand_wide(model.report_lines(), sample.REPORTS[0], sample.SEGMENTS, model.window())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_reports_read_only_the_months_they_need(spark, database, build):
    plain = build([order("1", "2026-06-05", 1), order("2", "2025-01-05", 2), order("3", "2020-01-05", 3)])
    name = f"{database}.raw"
    tables.replace_table(tables.with_period(plain.lines), name, [tables.PERIOD])
    stored = build([order("1", "2026-06-05", 1)])
    stored.lines = spark.table(name)
    assert stored.window() == plain.window()
    found = wide(stored, "fechada")
    assert found.exceptAll(wide(plain, "fechada")).isEmpty() and found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_mes" in plan and "202407" in plan
