import datetime as dt
import os
import zipfile

from quayside.functions.types import apply_types, infer_types
from quayside.plans.workbook_stage import stage_workbooks, write_workbook
from quayside.sources.workbook import (
    iter_workbook_rows,
    read_workbook_cells,
    sheet_frame,
    sheet_tables,
    stage_cells,
)


def _inline_workbook(path):
    """A hand-made workbook: inline strings, a gap, a boolean, a custom date format."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml",
                    f'<workbook {ns} {rel}><sheets><sheet name="My Sheet" sheetId="1" r:id="rId1"/>'
                    "</sheets></workbook>")
        zf.writestr("xl/_rels/workbook.xml.rels",
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                    '<Relationship Id="rId1" Type="worksheet" Target="/xl/worksheets/s.xml"/></Relationships>')
        zf.writestr("xl/styles.xml",
                    f'<styleSheet {ns}><numFmts count="1"><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/>'
                    '</numFmts><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
        zf.writestr("xl/worksheets/s.xml",
                    f'<worksheet {ns}><sheetData>'
                    '<row r="1"><c r="A1" t="inlineStr"><is><t>Order Key</t></is></c>'
                    '<c r="C1" t="inlineStr"><is><t>When</t></is></c>'
                    '<c r="D1" t="inlineStr"><is><t>ok</t></is></c></row>'
                    '<row r="2"><c r="A2"><v>5</v></c><c r="C2" s="1"><v>45413</v></c>'
                    '<c r="D2" t="b"><v>1</v></c></row>'
                    "</sheetData></worksheet>")


def test_reader_cell_kinds(tmp):
    path = f"{tmp}/x.xlsx"
    _inline_workbook(path)
    with open(path, "rb") as fh:
        rows = list(iter_workbook_rows("x", fh.read()))
    assert rows[0] == ("x", "My Sheet", 1, ["Order Key", None, "When", "ok"])
    assert rows[1] == ("x", "My Sheet", 2, ["5", None, "2024-05-01", "true"])


def test_writer_reader_round_trip(tmp):
    path = f"{tmp}/w.xlsx"
    rows = [(1, "a & b", 2.5, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5)), (2, None, None, None, None)]
    assert write_workbook(path, "S 1", ["k", "t", "d", "day", "ts"], iter(rows)) == 2
    with open(path, "rb") as fh:
        got = list(iter_workbook_rows("w", fh.read()))
    assert got[1][3] == ["1", "a & b", "2.5", "2024-01-02", "2024-01-02 03:04:05"]
    assert got[2][3] == ["2"]


def test_sheet_frame_typed(spark, tmp):
    os.makedirs(f"{tmp}/wb")
    _inline_workbook(f"{tmp}/wb/a.xlsx")
    cells = read_workbook_cells(spark, f"{tmp}/wb")
    df = sheet_frame(cells, "My Sheet")
    assert df.columns == ["Order_Key", "col_1", "When", "ok"]
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert types["Order_Key"] == "int" and types["When"] == "date"
    assert df.first()["When"] == dt.date(2024, 5, 1)


def test_staged_workbooks_to_tables(spark, tmp):
    src = spark.sql("SELECT id AS k, concat('n', id) AS name, DATE'2024-01-01' + CAST(id AS INT) AS day "
                    "FROM range(200)").repartition(3)
    written = stage_workbooks(src, f"{tmp}/books", "Sales data")
    assert sum(r["rows"] for r in written.collect()) == 200
    assert len(os.listdir(f"{tmp}/books")) == 3
    cells = stage_cells(read_workbook_cells(spark, f"{tmp}/books"), f"{tmp}/cells")
    tables = sheet_tables(cells)
    assert list(tables) == ["Sales_data"]
    t = tables["Sales_data"]
    assert t.count() == 200
    assert {f.name: f.dataType.simpleString() for f in t.schema} == {
        "k": "int", "name": "string", "day": "date"}


def test_infer_types_order_and_rules(spark):
    df = spark.createDataFrame(
        [("1", "3000000000", "1.5", "2024-01-01", "2024-01-01 10:00:00", "x", None),
         ("-2", "1", "2", "2024-02-01", "2024-01-01", "1", None)],
        "a string, b string, c string, d string, e string, f string, g string",
    )
    got = {r["column_name"]: r["inferred_type"] for r in infer_types(df).collect()}
    assert got == {"a": "int", "b": "bigint", "c": "double", "d": "date",
                   "e": "timestamp_ntz", "f": "string", "g": "string"}
    typed = apply_types(df, got)
    assert typed.first()["b"] == 3000000000


def test_infer_types_booleans_and_codes(spark):
    df = spark.createDataFrame(
        [("true", "00501", "0", "0.50", "01.5", "true"), (" FALSE ", "12345", "-7", ".5", "2", "1")],
        "flag string, zip string, i string, d string, padded string, mixed string",
    )
    got = {r["column_name"]: r["inferred_type"] for r in infer_types(df).collect()}
    assert got == {"flag": "boolean", "zip": "string", "i": "int", "d": "double",
                   "padded": "string", "mixed": "string"}
    typed = apply_types(df, got)
    assert [r["flag"] for r in typed.collect()] == [True, False]
    assert typed.first()["zip"] == "00501"


def test_reader_default_style_rich_text_and_unnumbered_rows(tmp):
    """A cell without ``s`` takes style 0; inline rich text joins its runs;
    a row without ``r`` follows the previous row."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    path = f"{tmp}/d.xlsx"
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml",
                    f'<workbook {ns} {rel}><sheets><sheet name="D" sheetId="1" r:id="rId1"/>'
                    "</sheets></workbook>")
        zf.writestr("xl/_rels/workbook.xml.rels",
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                    '<Relationship Id="rId1" Type="worksheet" Target="worksheets/d.xml"/></Relationships>')
        zf.writestr("xl/styles.xml",
                    f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="14"/><xf numFmtId="0"/>'
                    '</cellXfs></styleSheet>')
        zf.writestr("xl/worksheets/d.xml",
                    f'<worksheet {ns}><sheetData>'
                    '<row r="1"><c r="A1"><v>45413</v></c><c r="B1" s="1"><v>7</v></c></row>'
                    '<row><c r="B2" t="inlineStr"><is><r><t>a &amp; </t></r><r><t>b</t></r></is></c></row>'
                    "</sheetData></worksheet>")
    with open(path, "rb") as fh:
        rows = list(iter_workbook_rows("d", fh.read()))
    assert rows == [("d", "D", 1, ["2024-05-01", "7"]), ("d", "D", 2, [None, "a & b"])]


def test_chunked_cut_equals_one_piece(tmp):
    """Cutting a sheet into many small chunks gives exactly the rows of one piece."""
    path = f"{tmp}/c.xlsx"
    rows = [(i, f"name {i % 7}", i / 4, dt.date(2024, 1, 1) + dt.timedelta(days=i),
             None if i % 5 else "x & y") for i in range(500)]
    write_workbook(path, "C", ["k", "name", "q", "day", "note"], iter(rows))
    with open(path, "rb") as fh:
        content = fh.read()
    small = list(iter_workbook_rows("c", content, chunk_bytes=300))
    whole = list(iter_workbook_rows("c", content, chunk_bytes=1 << 26))
    assert len(whole) == 501 and small == whole
    assert whole[3][3] == ["2", "name 2", "0.5", "2024-01-03"]


def test_chunks_keep_prefixed_namespaces_and_row_order(tmp):
    """``x:``-prefixed sheet XML, rows and cells without references, shared
    strings: every chunk parses on its own and rows keep their numbers."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    path = f"{tmp}/p.xlsx"
    body = "".join(
        f'<x:row><x:c t="s"><x:v>{i % 3}</x:v></x:c><x:c><x:v>{i}</x:v></x:c></x:row>'
        for i in range(40)
    )
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml",
                    f'<workbook xmlns="{main}" {rel}><sheets><sheet name="P" sheetId="1" r:id="rId1"/>'
                    "</sheets></workbook>")
        zf.writestr("xl/_rels/workbook.xml.rels",
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                    '<Relationship Id="rId1" Type="worksheet" Target="worksheets/p.xml"/></Relationships>')
        zf.writestr("xl/sharedStrings.xml",
                    f'<sst xmlns="{main}"><si><t>a</t></si><si><t>b</t></si><si><t>c</t></si></sst>')
        zf.writestr("xl/worksheets/p.xml",
                    f'<x:worksheet xmlns:x="{main}"><x:sheetData>{body}</x:sheetData></x:worksheet>')
    with open(path, "rb") as fh:
        got = list(iter_workbook_rows("p", fh.read(), chunk_bytes=100))
    assert [r[2] for r in got] == list(range(1, 41))
    assert [r[3] for r in got] == [["abc"[i % 3], str(i)] for i in range(40)]


def test_empty_and_rowless_sheets(tmp):
    """An empty ``<sheetData/>`` and a sheet without ``sheetData`` give no rows;
    the other sheet of the workbook is read as usual."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    path = f"{tmp}/e.xlsx"
    sheets = {"Empty": "<sheetData/>", "Chart": "<sheetPr/>",
              "Data": '<sheetData><row r="1"><c r="A1"><v>1</v></c></row></sheetData>'}
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml",
                    f'<workbook {ns} {rel}><sheets>'
                    + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>'
                              for i, n in enumerate(sheets, start=1))
                    + "</sheets></workbook>")
        zf.writestr("xl/_rels/workbook.xml.rels",
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                    + "".join(f'<Relationship Id="rId{i}" Type="worksheet" Target="worksheets/s{i}.xml"/>'
                              for i in range(1, len(sheets) + 1))
                    + "</Relationships>")
        for i, body in enumerate(sheets.values(), start=1):
            zf.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}>{body}</worksheet>")
    with open(path, "rb") as fh:
        assert list(iter_workbook_rows("e", fh.read())) == [("e", "Data", 1, ["1"])]


def test_rows_longer_than_a_chunk(tmp):
    path = f"{tmp}/l.xlsx"
    rows = [(i, "text " * 20, i * 1.5) for i in range(30)]
    write_workbook(path, "L", ["k", "t", "q"], iter(rows))
    with open(path, "rb") as fh:
        content = fh.read()
    tiny = list(iter_workbook_rows("l", content, chunk_bytes=40))
    assert tiny == list(iter_workbook_rows("l", content)) and len(tiny) == 31
