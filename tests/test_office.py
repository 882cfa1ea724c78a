"""Workbooks, documents and single CSV files as sources and sinks."""

import datetime
import glob
import zipfile

import pytest
from matchloom.sources import office, readers, writers
from pyspark.sql import functions as F

DAY = datetime.date(2024, 2, 29)


@pytest.fixture(scope="module")
def session(spark):
    office.register(spark)
    return spark


@pytest.fixture()
def table(session):
    rows = [("가 <&> \"q\"", 1.5, 7, True, DAY, datetime.datetime(2024, 2, 29, 13, 30), "north"), (None, None, None, None, None, None, "north"), ("plain", -2.0, 10**12, False, DAY, datetime.datetime(1999, 12, 31), "so/uth"), (" two\nlines ", 0.1, 0, True, None, None, "so:uth")]
    return session.createDataFrame(rows, "name string, x double, n long, ok boolean, day date, at timestamp_ntz, region string").repartition(3)


def test_a_workbook_of_several_sheets_comes_back(session, table, tmp_path):
    path = f"{tmp_path}/out.xlsx"
    writers.workbook(table, path, "region")
    assert glob.glob(f"{tmp_path}/*") == [path]
    assert {"xl/workbook.xml", "xl/worksheets/sheet1.xml", "xl/worksheets/sheet3.xml"} <= set(zipfile.ZipFile(path).namelist())
    d = session.read.format("workbook").load(path)
    assert d.columns == ["file", "sheet", "row", "name", "x", "n", "ok", "day", "at"]
    assert dict(d.dtypes)["x"] == "double" and dict(d.dtypes)["name"] == "string"
    typed = session.read.format("workbook").schema("sheet string, row long, name string, x double, n long, ok boolean, day date, at timestamp_ntz, more string").load(path)
    got = {(r.sheet, r.name, r.x, r.n, r.ok, r.day, r.at, r.more) for r in typed.collect()}
    assert {x[0] for x in got} == {"north", "so uth", "so uth_1"}  # names as the format allows them
    assert {x[1:] for x in got} == {(*r[:6], None) for r in table.collect() if r.name is not None}
    one = session.read.format("workbook").option("sheet", "north").load(f"{tmp_path}/*.xlsx")
    assert one.count() == 1 and one.rdd.getNumPartitions() == 1 and d.rdd.getNumPartitions() == 3
    writers.workbook(table.limit(0), path)  # in the old one's place
    assert session.read.format("workbook").load(path).count() == 0
    with pytest.raises(Exception, match="(?s)written whole"):
        table.write.format("workbook").mode("append").save(path)


SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="3"><c r="A3" t="s"><v>1</v></c><c r="C3" t="inlineStr"><is><r><t>am</t></r><r><t>ount</t></r></is></c></row>
<row r="4"><c r="A4" t="s"><v>2</v></c><c r="B4"><v>3</v></c><c r="C4" s="1"><v>45351.5</v></c></row><row r="5"><c r="A5" t="str"><v>f</v></c><c r="B5" t="e"><v>#N/A</v></c><c r="AA5" t="b"><v>1</v></c></row><row r="9"/>
</sheetData></worksheet>"""


def test_title_rows_shared_texts_and_gaps(session, tmp_path):
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    for n in range(2):
        with zipfile.ZipFile(f"{tmp_path}/b{n}.xlsx", "w") as z:
            z.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="{office.LINK_NS}"><sheets><sheet name="One" sheetId="1" r:id="x1"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{office.PACKAGE_NS}"><Relationship Id="x1" Target="/xl/worksheets/any.xml"/></Relationships>')
            z.writestr("xl/worksheets/any.xml", SHEET)
            z.writestr("xl/styles.xml", f'<styleSheet {space}><numFmts><numFmt numFmtId="170" formatCode="yyyy&quot;h&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>')
            z.writestr("xl/sharedStrings.xml", f"<sst {space}><si><t>A title</t></si><si><t>name</t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>")
    d = session.read.format("workbook").option("header", 2).load(str(tmp_path))
    assert d.columns == ["file", "sheet", "row", "name", "column_1", "amount"]
    got = sorted((r.file[-7:], r.row, r.name, r.column_1, str(r.amount)) for r in d.collect())
    assert got == [(f"b{n}.xlsx", at, *x) for n in range(2) for at, x in ((3, ("ab", 3.0, "2024-02-29 12:00:00")), (4, ("f", None, "None")))]


def test_a_failed_task_leaves_nothing_behind(session, table, tmp_path):
    path = f"{tmp_path}/out.xlsx"
    writers.workbook(table, path)
    before = open(path, "rb").read()

    @F.udf("string")
    def broken(v):
        if v == "plain":
            raise ValueError("no")
        return v

    for kind, mode in (("workbook", "overwrite"), ("one_csv", "overwrite"), ("one_csv", "append")):
        with pytest.raises(Exception, match="(?s)no"):
            table.withColumn("name", broken("name")).write.format(kind).mode(mode).save(path if kind == "workbook" else f"{tmp_path}/new.csv")
    assert glob.glob(f"{tmp_path}/*") == [path] and open(path, "rb").read() == before


def test_one_csv_is_added_to_at_its_end(session, tmp_path):
    path = f"{tmp_path}/a.csv"
    rows = session.createDataFrame([(1, 'q "x", y'), (2, None)], "n int, t string").coalesce(1)
    rows.write.format("one_csv").mode("overwrite").save(path)
    rows.write.format("one_csv").mode("append").save(path)
    assert open(path, encoding="utf-8").read() == '﻿n,t\n1,"q ""x"", y"\n2,\n1,"q ""x"", y"\n2,\n'
    rows.write.format("one_csv").mode("overwrite").save(path)
    assert len(open(path, encoding="utf-8").read().splitlines()) == 3 and glob.glob(f"{tmp_path}/*") == [path]
    assert readers.sheet(session, path).columns[-1] == "t"


def test_paragraphs_and_tables_of_a_document(session, tmp_path):
    p = lambda t, style="": f'<w:p>{f"<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>" if style else ""}<w:r><w:t>{t}</w:t></w:r></w:p>'
    cell = lambda t: f"<w:tc>{p(t)}{p('more')}</w:tc>"
    inner = f"<w:tbl><w:tr><w:tc>{p('deep')}</w:tc></w:tr></w:tbl>"
    body = f"{p('Head', 'Heading1')}{p('text')}<w:tbl><w:tr>{cell('a')}{cell('b')}</w:tr><w:tr>{cell('c')}<w:tc>{inner}{p('x')}</w:tc></w:tr></w:tbl>{p('end')}"
    with zipfile.ZipFile(f"{tmp_path}/d.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{office.TEXT_NS}"><w:body>{body}</w:body></w:document>')
    got = sorted(tuple(r)[1:] for r in session.read.format("document").load(f"{tmp_path}/d.docx").collect())
    assert [g[1:] for g in got] == [
        ("paragraph", "Heading1", None, None, None, "Head"), ("paragraph", None, None, None, None, "text"), ("cell", None, 0, 0, 0, "a\nmore"), ("cell", None, 0, 0, 1, "b\nmore"),
        ("cell", None, 0, 1, 0, "c\nmore"), ("cell", None, 0, 1, 1, "deep\nx"), ("paragraph", None, None, None, None, "end"),
    ]
