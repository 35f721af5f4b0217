from __future__ import annotations

import io
import os
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandloom import config
from demandloom.operators import cleaning
from demandloom.session import scratch_path, shared_dir
from demandloom.sinks import files, tables
from demandloom.sources import catalog, routing, workbooks
from demandloom.streaming.ingest import LoadMode, OrderIngest, prepare_batch, save_batch
from demandloom.sources.files import read_order_files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("file_type", ["csv", "json"])
def test_parts_write_and_append(spark, tmp_path, file_type):
    path = f"{tmp_path}/out.{file_type}"
    first = spark.createDataFrame([("a,\"x\"\nline", 1, 1.5), (None, 2, None)], "t string, n int, d double").repartition(2)
    second = spark.createDataFrame([(3, 2.5, "c"), (None, None, "=1")], "n int, d double, t string")
    assert files.write_file(first, path, file_type) == 2
    before = {f for f in os.listdir(path) if f.startswith("part-")}
    assert files.write_file(second, path, file_type, mode="append") == 2
    assert before < set(os.listdir(path))  # old files stay as they are
    back = files.read_file(spark, path, file_type)
    formula = "'=1" if file_type == "csv" else "=1"
    assert rows(back.select("t", F.col("n").cast("int"), F.col("d").cast("double"))) == sorted(
        [("a,\"x\"\nline", 1, 1.5), (None, 2, None), ("c", 3, 2.5), (formula, None, None)], key=str)
    if file_type == "csv":
        assert back.columns == ["t", "n", "d"]
        assert ("3",) in rows(back.select("n"))  # an integer column with gaps stays one
    assert files.write_file(second, path, file_type) == 2
    with pytest.raises(ValueError, match="append"):
        files.write_file(first.drop("d"), path, file_type, mode="append")


def test_csv_keeps_digits_and_characters(spark, tmp_path):
    df = spark.sql("SELECT 12345678901234567890.123BD AS v, 9007199254740993 AS n, 'a\x01b' AS t")
    files.write_file(df, f"{tmp_path}/x.csv")
    assert rows(files.read_file(spark, f"{tmp_path}/x.csv", "csv")) == [("12345678901234567890.123", "9007199254740993", "a\x01b")]


def test_named_parts(spark, database, tmp_path):
    tables.replace_table(spark.range(100).repartition(3), f"{database}.many")
    (folder,) = files.export_tables_csv(spark, [f"{database}.many"], str(tmp_path))
    names = sorted(f for f in os.listdir(folder) if f.endswith(".csv"))
    assert names == [f"many-{k:05}.csv" for k in range(1, len(names) + 1)] and len(names) == 3
    assert spark.read.option("header", True).csv(folder).count() == 100


def test_workbook_write_and_append(spark, tmp_path):
    path = f"{tmp_path}/out.xlsx"
    first = spark.createDataFrame([("abc", 1, 1.5, True), (None, 2, None, None)], "v string, n int, d double, b boolean")
    assert files.write_file(first, path, "excel") == 2
    second = spark.sql("SELECT 7 AS n, 5 AS v, CAST('Infinity' AS double) AS d, false AS b UNION ALL "
                       "SELECT NULL, 6, 12345678901234567890.5BD, NULL")
    assert files.write_file(second, path, "excel", mode="append") == 4
    back = files.read_file(spark, path, "excel")
    assert back.columns == ["v", "n", "d", "b"]  # the order of the file
    assert {("abc", "1"), (None, "2"), ("5", "7"), ("6", None)} == set(rows(back.select("v", "n")))
    assert "Infinity" in {r[0] for r in back.select("d").collect()}
    assert os.listdir(tmp_path) == ["out.xlsx"]
    with pytest.raises(ValueError, match="append"):
        files.write_file(first.drop("d"), path, "excel", mode="append")


def test_long_tables_continue_on_further_sheets(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(config, "SHEET_ROWS", 4)
    assert files._write_excel(io.BytesIO(), ["v"], ([k] for k in range(10))) == 10
    names = []
    with zipfile.ZipFile(io.BytesIO(), "w") as book:
        files._write_sheets(book, names, "S", ["v"], ([k] for k in range(10)))
    assert names == ["S", "S_2", "S_3", "S_4"]


def test_sheet_names_are_unique():
    taken = []
    for name in ["a-b", "a-b_2", "A-B", *["x" * 31] * 120]:
        taken.append(files.unique_sheet_name(name, taken))
    assert len({t.lower() for t in taken}) == len(taken) and max(map(len, taken)) <= 31


def test_formulas_are_neutralised_in_files(spark, tmp_path):
    path = f"{tmp_path}/f.xlsx"
    files.write_file(spark.createDataFrame([("=1+1", -1)], "t string, n int"), path, "excel")
    assert rows(files.read_file(spark, path, "excel")) == [("'=1+1", "-1")]


def report_table(spark, name, data):
    tables.replace_table(spark.createDataFrame(data, "file string, sheet string, id string, `2026/01` bigint"), name)


def test_workbooks(spark, database, tmp_path):
    report_table(spark, f"{database}.r1", [("Book A", "0203", "x", 1), ("Book A", "TTL", "x", 3), ("Book A", "TTL", "=w", 2), ("Book B", "TTL", "z", 9)])
    report_table(spark, f"{database}.r2", [("Book A", "a/b", "y", 5), ("Book A", "a:b", "y", 6)])
    tables.replace_table(spark.createDataFrame([(1.5, None), (2.0, "t")], "v double, s string"), f"{database}.loose")
    names = [f"{database}.{t}" for t in ("r1", "r2", "loose")]
    (tmp_path / "other.xlsx").write_bytes(b"kept")
    written = files.export_workbooks(spark, names, str(tmp_path))
    assert {(r["file"], r["sheets"], r["rows"]) for r in written.collect()} == {("Book A", 4, 5), ("Book B", 1, 1), ("loose", 1, 2)}
    cells = workbooks.read_workbook_cells(spark, str(tmp_path), "Book A.xlsx", clean_names=False, sheet=None)
    found = [(r["sheet"], r["cells"]["id"], r["cells"]["2026/01"]) for r in cells.orderBy("row_number").collect()]
    assert sorted(found) == [("0203", "x", "1"), ("TTL", "'=w", "2"), ("TTL", "x", "3"), ("a-b", "y", "5"), ("a-b_2", "y", "6")]
    with zipfile.ZipFile(tmp_path / "Book A.xlsx") as book:
        listing = book.read("xl/workbook.xml").decode()
    assert [s.split('"')[1] for s in listing.split("<sheet ")[1:]] == ["TTL", "0203", "a-b", "a-b_2"]
    assert (tmp_path / "other.xlsx").read_bytes() == b"kept"
    back = workbooks.read_workbooks(spark, str(tmp_path), pattern="loose.xlsx")
    assert rows(back.select("v", "s")) == sorted([("1.5", None), ("2.0", "t")], key=str)


def test_empty_tables_still_give_a_workbook(spark, database, tmp_path):
    tables.replace_table(spark.range(0).toDF("v"), f"{database}.empty")
    assert [tuple(r)[2:] for r in files.export_workbooks(spark, [f"{database}.empty"], str(tmp_path)).collect()] == [(1, 0)]
    assert workbooks.read_workbook_cells(spark, str(tmp_path)).count() == 0


def test_workbook_plan_refusals(spark, database, tmp_path):
    report_table(spark, f"{database}.a", [("Book", "TTL", "x", 1)])
    report_table(spark, f"{database}.b", [("Book", "TTL", "y", 2)])
    report_table(spark, f"{database}.c", [("../up", "TTL", "y", 2)])
    with pytest.raises(ValueError, match="several tables"):
        files.export_workbooks(spark, [f"{database}.a", f"{database}.b"], str(tmp_path))
    with pytest.raises(ValueError, match="unsafe"):
        files.export_workbooks(spark, [f"{database}.c"], str(tmp_path))
    assert os.listdir(tmp_path) == []


def shared_string_workbook() -> bytes:
    """A workbook as spreadsheet programs write them: shared strings, gaps, two sheets."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="S" sheetId="1" r:id="rId9"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                      '<Relationship Id="rId9" Target="/xl/worksheets/s.xml" Type="t"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Cliente</t></si><si><r><t>Nome</t></r><r><t> 3</t></r></si><si><t>00077</t></si></sst>")
        book.writestr("xl/worksheets/s.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
                      '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>5</v></c><c r="C2" t="inlineStr"><is><t>Ana</t></is></c></row>'
                      '<row r="3"/></sheetData></worksheet>')
    return out.getvalue()


def test_cells_beyond_the_header_are_kept():
    book = io.BytesIO()
    files._write_excel(book, ["a", "a"], iter([[1, 2, 3], [4, 5, 6, 7]]))
    for clean in (True, False):
        got = [r[3] for r in workbooks._workbook_rows("p", book.getvalue(), clean, None, True)]
        assert got == [{"a": "1", "a_1": "2", "col_2": "3"}, {"a": "4", "a_1": "5", "col_2": "6", "col_3": "7"}]


def test_reading_foreign_workbooks(spark, tmp_path):
    (tmp_path / "one.xlsx").write_bytes(shared_string_workbook())
    (tmp_path / "two.xlsx").write_bytes(shared_string_workbook())
    df = workbooks.read_workbooks(spark, str(tmp_path), renames=config.CUSTOMER_RENAMES)
    assert df.columns == ["cliente", "col_unknown", "razao_social"]
    assert rows(df) == [("00077", "5", "Ana")] * 2
    source = {"file_source": {"path": str(tmp_path), "format": "excel", "headerRows": False, "dataAddress": "'S'!A1"}}
    assert ("00077", "5", "Ana") in rows(catalog.load_source(spark, source).select("_c0", "_c1", "_c2"))
    source["file_source"]["dataAddress"] = "Other!A1"
    assert catalog.load_source(spark, source).count() == 0
    chosen = workbooks.read_workbooks(spark, str(tmp_path), ["cliente", "absent"])
    assert rows(chosen) == [("00077", None)] * 2
    assert cleaning.customer_dimension(df).first()["cliente"] == "77"


def test_routing(spark, tmp_path):
    for name in ("kna1_x.xlsx", "KNA1.xlsx", "foo.txt"):
        (tmp_path / name).write_text("x")
    plan = routing.route_files(routing.list_files(spark, str(tmp_path)))
    assert {(r["name"], r["destination"], r["status"]) for r in plan.collect()} == {
        ("kna1_x.xlsx", "dm_customers/kna1_sap/kna1_x.xlsx", "planned"),
        ("KNA1.xlsx", "dm_customers/kna1_sap/KNA1.xlsx", "planned"), ("foo.txt", None, "error"),
    }
    assert tuple(routing.routing_counts(plan).first()) == (3, 2, 1)
    assert routing.route_files(routing.list_files(spark, str(tmp_path)), dry_run=False).where("status = 'to_move'").count() == 2


# --- stream -----------------------------------------------------------------------------------


def order_line(number, item, day="05.06.2026", quantity="1,000", material="M"):
    row = dict(zip(config.ORDER_FILE_LAYOUT, [""] * 18), numero_ov=number, item=item, data=day, quantidade=quantity, material=material)
    return "|" + "|".join(row[c] for c in config.ORDER_FILE_LAYOUT) + "|\n"


def write_file(folder, name, *lines, at):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.writelines(lines)
    os.utime(path, (at, at))


@pytest.fixture
def ingest(spark, database, tmp_path):
    def make(mode=LoadMode.INCREMENTAL, **options):
        return OrderIngest(spark, str(tmp_path), f"{database}.raw", scratch_path(spark, "checkpoint"), mode, **options)

    return make


def stored(spark, ingest):
    return rows(spark.table(ingest.table).select("numero_ov", "item", F.col("quantidade").cast("double")))


def test_stream_runs_add_up_to_one_batch(spark, ingest, tmp_path):
    job = ingest(max_files_per_batch=1)
    write_file(tmp_path, "a.txt", order_line("1", "10"), order_line("1", "20"), order_line("2", " "), at=1_000_000)
    write_file(tmp_path, "b.txt", order_line("1", "10", quantity="5,000"), at=2_000_000)
    write_file(tmp_path, "ignored.csv", order_line("9", "9"), at=2_000_000)
    assert [m["input_rows"] for m in job.run()] == [3, 1]
    assert stored(spark, job) == [("1", "10", 5.0), ("1", "20", 1.0)]
    first_seen = {r["item"]: r["_ingested_at"] for r in spark.table(job.table).collect()}
    write_file(tmp_path, "c.txt", order_line("1", "20", day="01.07.2026", quantity="7,000-"), order_line("3", "10", "31.02.2026"), at=3_000_000)
    job.run()
    assert stored(spark, job) == [("1", "10", 5.0), ("1", "20", -7.0), ("3", "10", 1.0)]
    table = spark.table(job.table)
    assert {r["item"]: r["_ingested_at"] for r in table.where("numero_ov = '1'").collect()} == first_seen
    assert table.where("data IS NULL AND ano_mes = 0").count() == 1
    assert spark.table(f"{job.table}_quarantine").count() == 1
    assert job.run() == []
    batch = prepare_batch(read_order_files(spark, str(tmp_path)))
    again = f"{job.table}_batch"
    save_batch(batch, again, LoadMode.INCREMENTAL)
    assert rows(spark.table(again).select("numero_ov", "item", "data", "quantidade")) == rows(table.select("numero_ov", "item", "data", "quantidade"))
    save_batch(batch, again, LoadMode.INCREMENTAL)  # replayed batch
    assert spark.table(again).count() == 3


def test_later_file_wins_inside_a_batch(spark, ingest, tmp_path):
    job = ingest()
    write_file(tmp_path, "z_old.txt", order_line("1", "10", quantity="9,000"), at=1_000_000)
    write_file(tmp_path, "a_new.txt", order_line("1", "10", quantity="2,000"), at=2_000_000)
    job.run()
    assert stored(spark, job) == [("1", "10", 2.0)]


def test_period_and_full_refresh(spark, ingest, tmp_path):
    job = ingest(LoadMode.PERIOD_REFRESH)
    write_file(tmp_path, "a.txt", order_line("1", "10"), order_line("2", "10", "05.07.2026"), at=1_000_000)
    job.run()
    write_file(tmp_path, "b.txt", order_line("3", "10", "06.07.2026"), at=2_000_000)
    job.run()
    assert stored(spark, job) == [("1", "10", 1.0), ("3", "10", 1.0)]
    job.mode = LoadMode.FULL_REFRESH
    write_file(tmp_path, "c.txt", order_line("4", "10"), at=3_000_000)
    job.run()
    assert stored(spark, job) == [("4", "10", 1.0)]
    with pytest.raises(ValueError):
        ingest(LoadMode.PERIOD_REFRESH, max_files_per_batch=1)


def test_history_value_survives_the_stream(spark, ingest, tmp_path, database):
    """The order number of the dealer comes with history only."""
    job = ingest()
    write_file(tmp_path, "a.txt", order_line("1", "10"), at=1_000_000)
    old = prepare_batch(read_order_files(spark, str(tmp_path))).withColumn("numero_pedido", F.lit("P1"))
    tables.replace_table(old, job.table, [tables.PERIOD])
    job.run()
    assert spark.table(job.table).first()["numero_pedido"] == "P1"


def test_workbook_rows_sort_numbers_by_value(spark):
    path = f"{scratch_path(spark, 'sorted')}/numbers.xlsx"
    df = spark.createDataFrame([(100, "b"), (9, "a"), (10, None), (None, "c")], "n int, t string")
    files.write_file(df, path, "excel", order_by=["n"])
    files.write_file(df, path, "excel", "append", order_by=["t", "n"])
    assert [r.n for r in files.read_file(spark, path, "excel").collect()] == [None, "9", "10", "100", "10", "9", "100", None]


@pytest.mark.parametrize("mode", list(LoadMode))
def test_a_batch_is_put_in_place_from_one_copy(spark, ingest, tmp_path, monkeypatch, mode):
    """When the rows of a load go into the table, the copies of its lines and of its typed rows are gone."""
    folder = Path(shared_dir(spark).removeprefix("file://"))
    copies = lambda: {p.name for p in folder.glob("staged-*")}
    before, seen = copies(), []
    put = tables._put_table

    def watched(df, table, *options):
        if not table.endswith(("_rejects", "_quarantine")):
            seen.append(len(copies() - before))
        put(df, table, *options)

    monkeypatch.setattr(tables, "_put_table", watched)
    layout = config.ORDER_FILE_LAYOUT
    for item in ("10", "20"):
        fields = {"numero_ov": "1", "item": item, "data": "05.06.2026", "quantidade": "1,000"}
        (tmp_path / f"{item}.txt").write_text("|" + "|".join(fields.get(c, "x") for c in layout) + "|\n|short|\n")
    job = ingest(mode)
    job.run()
    assert seen == [1] and spark.table(job.table).count() == 2
    assert copies() == before
