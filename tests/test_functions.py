from __future__ import annotations

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandloom import config
from demandloom.functions import dates, text
from demandloom.operators import cleaning


def values(spark, expression, *inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_numbers(spark):
    found = values(spark, text.parse_number, "1.234,500-", "1.234,500", " 7 ", "abc", "", None, "-3,5", "1,2,3")
    assert [None if v is None else float(v) for v in found] == [-1234.5, 1234.5, 7.0, None, None, None, -3.5, None]


def test_number_rendering_is_inverted_by_parsing(spark):
    amounts = [0.0, -0.125, 1234567.891, -99.5, 1000.0]
    found = values(
        spark, lambda v: text.parse_number(text.format_number(v.cast("decimal(18,3)"))), *amounts, kind="double"
    )
    assert [float(v) for v in found] == amounts


def test_dates(spark):
    found = values(spark, text.parse_date, "05.06.2026", "31.02.2026", "2026-06-05", " 01.01.2000 ", None)
    assert found == [date(2026, 6, 5), None, None, date(2000, 1, 1), None]


def test_leading_zeros(spark):
    assert values(spark, text.strip_leading_zeros, "00077", "70", "000", None) == ["77", "70", "", None]


def test_default_site(spark):
    rows = spark.createDataFrame(
        [(None, "0200"), (" ", "0500"), ("", "0900"), ("0232", "0200"), (None, None)], "cen string, orgv string"
    )
    fill = text.default_when_blank(F.col("cen"), F.col("orgv"), config.DEFAULT_SITES)
    assert [r[0] for r in rows.select(fill).collect()] == ["0203", "0503", None, "0232", None]


@pytest.mark.parametrize(
    "company, material, head, expected",
    [
        ("0200", "A1", None, "A1"), ("0200", "A1", " ", "A1"), ("0200", "A1", "Sim", "A1"), ("0200", "A1", " sIM ", "A1"),
        ("0200", "A2", "B7  C", "B7"), ("0200", "A3", "B7 G", "B7 G"), ("0500", "A4", "B7 G", "B7"),
        ("0500", "A4", "B7 C", "B7"), ("0200", "A5 C", None, "A5"), ("0300", "A6", "B7 C", "B7 C"),
        ("0200", "A7", "B7C", "B7C"), (None, "A8", "B7 C", "B7 C"),
    ],
)
def test_chain_head(spark, company, material, head, expected):
    rows = spark.createDataFrame([(company, material, head)], "empresa string, material string, item_principal_cadeia string")
    assert cleaning.chain_dimension(rows).first()["item_principal_cadeia"] == expected


def test_cell_text(spark):
    found = values(spark, text.cell_text, "=1+1", "+1", "-1", "@a", "\tx", "\rx", "a=1", "a\x01b", "\x01=1", "", None)
    assert found == ["'=1+1", "'+1", "'-1", "'@a", "'\tx", "'\rx", "a=1", "ab", "'=1", "", None]


def test_sheet_names(spark):
    found = values(spark, text.sheet_name, "a/b:c", "'quoted'", "", "x" * 40, "[1]*?\\")
    assert found == ["a-b-c", "quoted", "Planilha", "x" * 31, "-1----"]


def test_unsafe_file_names(spark):
    assert values(spark, text.unsafe_file_name, "ok", "a/b", "a..b", "a.b") == [False, True, True, False]


def test_route_prefix(spark):
    found = values(spark, text.route_prefix, "kna1_x.xlsx", "KNA1.xlsx", "foo.tar.gz", "a_b_c.txt", ".hidden", "plain")
    assert found == ["kna1", "KNA1", "foo.tar", "a", ".hidden", "plain"]


def test_headers():
    assert text.clean_headers(["Descrição Curta", "Preço (SP)", "", None, "a", "A", "__x__"]) == [
        "descricao_curta", "preco_sp", "col_unknown", "col_unknown_1", "a", "a_1", "x",
    ]
    assert text.clean_headers(["Ps", "Nome 3", "Rg"], config.CUSTOMER_RENAMES) == ["pais", "razao_social", "estado"]
    assert text.clean_headers(["a", "a_1", "a"]) == ["a", "a_1", "a_2"]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(max_size=8), min_size=1, max_size=8))
def test_headers_are_unique_and_plain(names):
    cleaned = text.clean_headers(names)
    assert len(set(cleaned)) == len(names)
    assert all(c and c == c.lower() and c.replace("_", "a").isalnum() for c in cleaned)


def test_window_snaps_to_months():
    window = dates.Window(date(2026, 6, 30), 24)
    assert (window.start, window.end) == (date(2024, 7, 1), date(2026, 6, 30))
    assert len(window.labels) == 24 and window.labels[0] == "2024/07" and window.labels[-1] == "2026/06"
    assert dates.Window(date(2026, 1, 15), 12).start == date(2025, 2, 1)
    assert dates.file_title("HDA", date(2026, 7, 3), "Demanda Fechada") == "HDA 2026 Jul Demanda Fechada"


def test_local_time_does_not_depend_on_the_session_zone(spark):
    def wall() -> str:
        return spark.range(1).select(F.date_format(dates.local_now(), "yyyy-MM-dd HH:mm")).first()[0]

    in_utc = wall()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert wall()[:15] == in_utc[:15]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_reference_date_is_an_error(spark):
    with pytest.raises(ValueError):
        dates.reference_date(spark.createDataFrame([], "data date"))


FIELDS = ["100", "05.06.2026", "ZNOR", "", "", "", "0200", "01", "04", "0203", "77", "U1", "10", "A1", "TAN", "", "1.234,500", "PC"]


def line(**changes) -> str:
    row = [changes.get(n, v) for n, v in zip(config.ORDER_FILE_LAYOUT, FIELDS)]
    return "|" + "|".join(row) + "|"


def test_parse_order_lines(spark):
    cases = [
        line(), line(quantidade="1.234,500-", item="20"), line(numero_ov="Doc.venda"), "   ", "-" * 40,
        "|" + "|".join(FIELDS[:17]) + "|", line(data="2026-06-05"), line(data="31.02.2026", item="30"),
        line(quantidade="abc", item="40"), line(item=" "), line(item="50")[1:-1],
    ]
    parsed = cleaning.parse_pipe_lines(spark.createDataFrame([(c,) for c in cases], "value string"))
    typed = cleaning.type_order_lines(parsed, "TEST", "1")
    assert typed.columns == list(config.RAW_COLUMNS) and len(typed.columns) == 27
    rows = {r["item"]: r for r in typed.collect()}
    assert set(rows) == {"10", "20", "30", "40", "50", None}
    assert float(rows["10"]["quantidade"]) == 1234.5 and float(rows["20"]["quantidade"]) == -1234.5
    assert rows["10"]["data"] == date(2026, 6, 5) and rows["10"]["motivo_ov"] is None
    assert rows["30"]["data"] is None and rows["40"]["quantidade"] is None
    assert rows["10"]["numero_pedido"] is None and rows["10"]["_load_type"] == "TEST"


def test_promote_header_keeps_rows_with_nulls(spark):
    rows = spark.createDataFrame([("A", "B"), (None, "x"), ("A", None), ("1", "2")], "_c0 string, _c1 string")
    named = cleaning.promote_header(rows, ["A", "B"])
    assert named.columns == ["a", "b"] and named.count() == 3


def test_required_columns(spark):
    with pytest.raises(ValueError, match="data"):
        cleaning.type_historical_lines(spark.createDataFrame([("1",)], "numero_ov string"))


def test_clean_and_standardise(spark):
    rows = spark.createDataFrame([("2024-01-02", "1.5"), ("soon", "n/a")], "`Data Início` string, `Valor (R$)` string")
    clean = cleaning.clean_and_standardise(rows, ["data_inicio"], ["valor_r"])
    assert [tuple(r)[:2] for r in clean.collect()] == [(date(2024, 1, 2), 1.5), (None, None)]
    other = cleaning.clean_and_standardise(rows.limit(0), ["data_inicio"], date_pattern="dd/MM/yyyy")
    assert dict(other.dtypes)["data_inicio"] == "date"


def test_template_audit_drops_incomplete_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    audited = cleaning.template_audit(rows, ["id"], "src")
    assert audited.count() == 1 and audited.first()["source_system"] == "src"
