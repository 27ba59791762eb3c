"""Office packages, recorded pages, page texts and bundles: round trips, refusals, broken files."""

import io
import tarfile
import zipfile

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedgeline.sources import office, readers, writers


def test_workbooks(spark, tmp_path):
    rows = [["1", None, "a & <b>"], ["2", "x", "é\n"]]
    data = office.workbook_bytes(["k", "v", "w"], rows)
    assert data == office.workbook_bytes(["k", "v", "w"], rows) and office.workbook_grids(data) == [[["k", "v", "w"], *rows]]
    (tmp_path / "a.xlsx").write_bytes(data)
    (tmp_path / "b.xls").write_text("k,v\n1,\n", encoding="utf-8-sig")
    (tmp_path / "c.xls").write_bytes(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"0" * 50)
    (tmp_path / "d.xlsx").write_bytes(b"PK\x03\x04broken")
    got = {r["path"][-6:]: r for r in office.sheets(spark, str(tmp_path)).collect()}
    assert got["a.xlsx"]["rows"] == [["k", "v", "w"], *rows] and got["a.xlsx"]["kind"] == "workbook" and got["a.xlsx"]["error"] is None
    assert got["/b.xls"]["rows"] == [["k", "v"], ["1", None]] and got["/b.xls"]["kind"] == "csv"
    assert got["/c.xls"]["rows"] is None and "old binary" in got["/c.xls"]["error"] and got["d.xlsx"]["error"]
    made = office.workbooks(spark.createDataFrame([(1, "b", "y"), (1, "a", None), (2, "c", "z")], "g int, k string, v string"), "g", ["k", "v"])
    assert {r["g"]: office.workbook_grids(bytes(r["content"]))[0] for r in made.collect()} == {1: [["k", "v"], ["a", None], ["b", "y"]], 2: [["k", "v"], ["c", "z"]]}


def test_sheet_with_shared_strings_and_gaps():
    ns, rel = office.SHEET.strip("{}"), office.RELATION.strip("{}")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets><sheet name="a" sheetId="1" r:id="x"/><sheet name="b" sheetId="2" r:id="y"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{office.PACKAGE.strip("{}")}"><Relationship Id="x" Target="worksheets/one.xml"/><Relationship Id="y" Target="/xl/worksheets/two.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>Ref</t></si><si><r><t>Da</t></r><r><t>te</t></r></si></sst>')
        z.writestr("xl/worksheets/one.xml", f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="3"><c r="B3"><v>5</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/two.xml", f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1"><v>1</v></c></row></sheetData></worksheet>')
    assert office.sheet_grid(out.getvalue()) == ([["Ref", None, "Date"], [], [None, "5"]], 1, "workbook")
    assert [office.column_number(c) for c in ("A1", "Z9", "AA1", "BC12")] == [0, 25, 26, 54]


def test_letters(spark, tmp_path):
    ns = office.LETTER.strip("{}")
    for name, head in (("a.docx", ""), ("b.docx", '<!DOCTYPE x [<!ENTITY e "boom">]>')):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("word/document.xml", f'{head}<w:document xmlns:w="{ns}"><w:body><w:p><w:r><w:t>One</w:t><w:tab/><w:t>two</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>three</w:t></w:r></w:p></w:body></w:document>')
    got = {r["path"][-6:]: r for r in office.letters(spark, str(tmp_path)).collect()}
    assert got["a.docx"]["text"] == "One\ttwo\n\nthree" and got["b.docx"]["text"] is None and "document type" in got["b.docx"]["error"]


def test_bundle():
    files = {"b.txt": b"two", "a/x.txt": b"one"}
    data = office.bundle(files)
    assert data == office.bundle(dict(reversed(files.items())))
    with tarfile.open(fileobj=io.BytesIO(data)) as tar:
        assert [(m.name, m.mtime, tar.extractfile(m).read()) for m in tar] == [("a/x.txt", 0, b"one"), ("b.txt", 0, b"two")]


def test_recorded_pages(spark, tmp_path):
    for n, rows in ((1, '[{"a": 1}, {"a": 2}]'), (2, '[{"a": 3}]'), (3, "[]"), (4, '[{"a": 9}]')):
        (tmp_path / f"{n}.json").write_text(f'{{"page": {n}, "results": {rows}}}')
    got = readers.recorded_pages(spark, str(tmp_path), StructType().add("a", "integer"))
    assert sorted(r["a"] for r in got.collect()) == [1, 2, 3]


def test_page_texts_and_probes(spark):
    html = '<body><nav>menu</nav><div class="main wide"><p>One <b>two</b><br>three</p><script>x()</script><ul><li>four</li></ul></div><p>foot</p></body>'
    pages = spark.createDataFrame([("u", html), ("v", "<p>plain</p>"), ("w", None), ("x", "")], "url string, html string")
    assert {r["url"]: r["text"] for r in readers.page_texts(pages, "url", "html", ["#no", ".main", "p"]).collect()} == {"u": "One two\nthree\nfour", "v": "plain", "w": None, "x": None}
    q = spark.createDataFrame([("https://x.ie/foi/log", "Our FOI log"), ("https://x.ie/news", "Our FOI log"), ("https://x.ie/foi", "news"), (None, None)], "u string, b string")
    assert [r[0] for r in q.select(readers.qualifying_page(F.col("u"), F.col("b"), ["foi"])).collect()] == [True, False, False, False]
    p = spark.createDataFrame([(200, None, "hello"), (200, None, "Domain for SALE"), (403, None, ""), (500, None, ""), (None, "NXDOMAIN", None), (None, "timeout", None)], "s int, e string, b string")
    assert [r[0] for r in p.select(readers.probe_outcome(F.col("s"), F.col("e"), F.col("b"), ["for sale"])).collect()] == ["ok", "parked", "blocked", "dead", "nxdomain", "dead"]
    rows = spark.createDataFrame([("A [b]", "x.md", "n"), ("<C>", "y?a=1&b", None)], "t string, l string, n string")
    assert [r[0] for r in writers.index_lines(rows, F.col("t"), F.col("l"), F.col("n"), "markdown").collect()] == ["- [A \\[b\\]](x.md): n", "- [<C>](y?a=1&b)"]
    assert [r[0] for r in writers.index_lines(rows, F.col("t"), F.col("l"), F.col("n"), "html").collect()] == ['<li><a href="x.md">A [b]</a> n</li>', '<li><a href="y?a=1&amp;b">&lt;C&gt;</a> </li>']
