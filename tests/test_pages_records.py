"""Page geometry, records and the step graph on small fixtures."""

import pytest
from pyspark.sql import functions as F

from sedgeline.functions import dates, documents
from sedgeline.operators import pages, records
from sedgeline.plans.pipeline import Pipeline

LINES = "document string, page int, seq int, block int, x0 double, y0 double, x1 double, y1 double, size double, body_size double, text string"


def line(page, seq, y, text, size=10.0, block=1, x=50.0, doc="d"):
    return (doc, page, seq, block, x, float(y), x + 200, y + 10.0, size, 10.0, text)


def test_furniture_and_order(spark):
    rows = [line(p, 1, 20, f"Annual Report {2000 + p}") for p in range(1, 5)] + [line(p, 2, 400, f"body {p} text") for p in range(1, 5)] + [line(p, 3, 780, f"Page {p} of 4") for p in range(1, 5)] + [line(1, 4, 30, "Only here")]
    sizes = spark.createDataFrame([("d", p, 800.0) for p in range(1, 5)], "document string, page int, height double")
    got = {(r["page"], r["text"]): r["is_furniture"] for r in pages.furniture(spark.createDataFrame(rows, LINES), sizes).collect()}
    assert all(v == ("body" not in t and t != "Only here") for (_, t), v in got.items()) and len(got) == 13
    order = pages.reading_order(spark.createDataFrame([line(1, 1, 101, "b", x=300.0), line(1, 2, 100, "a"), line(1, 3, 50, "top")], LINES))
    assert [r["text"] for r in order.orderBy("line_no").collect()] == ["top", "a", "b"]


def test_columns_sizes_inversions(spark):
    rows = [line(1, i, 100 + 20 * i, "long body text here") for i in range(3)] + [line(1, 9, 90, "T", size=18.0, x=400.0), line(1, 10, 95, "U", size=18.0, x=405.0)]
    df = spark.createDataFrame(rows, LINES)
    assert [(r["column"], r["left"]) for r in pages.text_columns(df).orderBy("column").collect()] == [(1, 50.0), (2, 402.5)]
    assert pages.body_size(df).first()["body_size"] == 10.0
    assert [r["text"] for r in pages.inversions(df).collect()] == ["T"]


def test_boxes(spark):
    assert pages.merged_boxes([(0, 0, 10, 10), (30, 0, 40, 10), (15, 0, 25, 10)], 6) == [(0, 0, 40, 10)]
    assert pages.merged_boxes([(0, 0, 10, 10), (100, 100, 110, 110)], 6) == [(0, 0, 10, 10), (100, 100, 110, 110)]
    df = spark.createDataFrame([("d", 1, 1, 0.0, 0.0, 1.0, 1.0), ("d", 1, 2, 2.0, 0.0, 3.0, 1.0), ("d", 2, 1, 0.0, 0.0, 1.0, 1.0)], "document string, page int, seq int, x0 double, y0 double, x1 double, y1 double")
    assert {tuple(r) for r in pages.box_clusters(df).collect()} == {("d", 1, 0.0, 0.0, 3.0, 1.0), ("d", 2, 0.0, 0.0, 1.0, 1.0)}


def test_paragraphs(spark):
    rows = [line(1, 1, 10, "A Title", size=14.0), line(1, 2, 30, "The inter-", block=2), line(1, 3, 40, "nal audit", block=2), line(1, 4, 60, "- one", block=3), line(1, 5, 70, "- two", block=3), line(1, 6, 80, "  ", block=4)]
    got = [tuple(r)[2:] for r in pages.paragraphs(spark.createDataFrame(rows, LINES)).orderBy("paragraph_no").collect()]
    assert got == [(1, "heading", "A Title"), (2, "paragraph", "The internal audit"), (3, "list", "- one\n- two")]


def test_headings(spark):
    none = spark.createDataFrame([], "document string, level int, title string, page int")
    rows = [line(1, 1, 10, "1. Start Here"), line(2, 2, 10, "2. Go On"), line(2, 3, 30, "2.1 Deeper"), line(3, 4, 30, "plain words only.")]
    df = spark.createDataFrame(rows, LINES)
    run = lambda lines, outline, toc: {(r["title"], r["level"], r["page"], r["source"]) for r in pages.headings(lines, outline, toc).collect()}
    assert run(df, none, none) == {("1. Start Here", 1, 1, "numbering"), ("2. Go On", 1, 2, "numbering"), ("2.1 Deeper", 2, 2, "numbering")}
    outline = spark.createDataFrame([("d", 1, "Whole", 1)], none.schema)
    assert run(df, outline, none) == {("Whole", 1, 1, "outline")}
    assert run(df.filter("page = 3"), none, none) == {("Page 3", 1, 3, "pages")}
    toc = spark.createDataFrame([("d", 1, "Alpha", 0), ("d", 1, "Beta", 0)], none.schema)
    big = spark.createDataFrame([line(4, 1, 10, "Alpha", size=14.0), line(5, 2, 10, "Beta", size=14.0), line(1, 3, 10, "Alpha")], LINES)
    assert run(big, none, toc) == {("Alpha", 1, 4, "contents"), ("Beta", 1, 5, "contents")}


def test_page_coverage_and_ligatures(spark):
    p = spark.createDataFrame([("d", i) for i in range(1, 9)], "document string, page int")
    c = spark.createDataFrame([("d", 2, 3), ("d", 6, 6)], "document string, first_page int, last_page int")
    assert {tuple(r) for r in pages.page_coverage(p, c).collect()} == {("d", 1, 1), ("d", 4, 5), ("d", 7, 8)}
    g = spark.createDataFrame([("d", 1, 1, 9.0), ("d", 1, 2, 0.0), ("d", 1, 3, 0.0), ("d", 1, 4, 4.0)], "document string, page int, seq int, width double")
    assert [r["shared_width"] for r in pages.even_ligatures(g).orderBy("seq").collect()] == [3.0, 3.0, 3.0, 4.0]


def test_attribution(spark):
    obs = spark.createDataFrame([(1, "7", ["A"]), (2, "7", ["A", "B"]), (3, "9", ["A"]), (4, "8", ["A", "B"])], "k int, ref string, owners array<string>")
    dec = spark.createDataFrame([("A", "7", 2023), ("B", "7", 2024), ("B", "8", 2024)], "owner string, ref string, year int")
    got = {r["k"]: (r["owner"], r["error"]) for r in records.attributed(obs, dec, "k", "ref", "owner").collect()}
    assert got == {1: ("A", None), 2: (None, "ambiguous"), 3: (None, "undeclared"), 4: ("B", None)}
    assert {r["k"]: r["owner"] for r in records.attributed(obs, dec, "k", "ref", "owner", F.lit(2024)).collect()}[2] == "B"


def test_sections_recipients_repairs(spark):
    s = spark.createDataFrame([("d", "a", 1, 1, 4), ("d", "b", 2, 3, 3)], "document string, section string, level int, first_page int, last_page int")
    p = spark.createDataFrame([("d", 1), ("d", 3), ("d", 9)], "document string, page int")
    assert {(r["page"], r["section"]) for r in records.sections_of(p, s).collect()} == {(1, "a"), (3, "b"), (9, None)}
    rows = spark.createDataFrame([(1, "cork", "CC/1"), (2, "cork", "DD/1"), (3, None, "CC/1"), (4, None, "XX/1"), (5, None, "SS/1")], "k int, h string, c string")
    alias = spark.createDataFrame([("cork", "Cork")], "alias string, recipient string")
    prefix = spark.createDataFrame([("CC", "Cork"), ("DD", "Dublin"), ("SS", "A"), ("SS", "B")], "prefix string, recipient string")
    got = {r["k"]: (r["recipient"], r["error"]) for r in records.dual_resolved(rows, alias, prefix, F.col("h"), F.col("c")).collect()}
    assert got == {1: ("Cork", None), 2: (None, "conflict"), 3: ("Cork", None), 4: (None, "unresolved"), 5: (None, "shared_prefix")}
    fix = spark.createDataFrame([(1, "set", "new"), (2, "drop", None)], "k int, action string, value string")
    assert {(r["k"], r["c"]) for r in records.row_repairs(rows, fix, ["k"], "c").collect()} == {(1, "new"), (3, "CC/1"), (4, "XX/1"), (5, "SS/1")}


def test_segments(spark):
    kinds = [("heading", "A"), ("item", None), ("anchor", None), ("blank", None), ("item", None), ("anchor", None), ("anchor", None), ("heading", "B"), ("item", None), ("heading", "B"), ("item", None), ("anchor", None), ("anchor", None), ("item", None)]
    df = spark.createDataFrame([("d", i, k, label) for i, (k, label) in enumerate(kinds)], "document string, i int, kind string, label string")
    got = [(r["section_no"], r["block_no"]) for r in records.segments(df, "document", "i", "kind").orderBy("i").collect()]
    assert [s for s, _ in got] == [1] * 7 + [2] * 6 + [3]
    assert [b for _, b in got][:7] == [0, 0, 0, 1, 1, 1, 2] and got[7][1] == 0


def test_matching_and_metrics(spark):
    assert records.greedy_matches(["a b c", "a b c d"], ["a b c d", "a b c"], 0.7) == [(0, 1), (1, 0)]
    assert records.greedy_matches(["", "x"], [""], 0.8) == [(0, 0)]
    g = spark.createDataFrame([("f", 1, "a b"), ("f", 2, "c d"), ("g", 1, "x")], "file string, seq int, text string")
    p = spark.createDataFrame([("f", 1, "b a"), ("h", 1, "z")], "file string, seq int, text string")
    m = records.matched_per_file(g, p, "file")
    assert {tuple(r) for r in m.collect()} == {("f", 2, 1, 1), ("g", 1, 0, 0), ("h", 0, 1, 0)}
    s = records.precision_recall(m).first()
    assert (s["precision"], s["recall"]) == (0.5, pytest.approx(1 / 3))
    q = spark.createDataFrame([("Q4 2023",), ("Q1 2024",)], "p string")
    assert records.latest_period(q, "p") == "Q1 2024"
    with pytest.raises(ValueError):
        records.latest_period(q.unionByName(spark.createDataFrame([("2024",)], "p string")), "p")
    first = records.first_report(spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "k int, r string, at int"), "k", "at", "r")
    assert {(r["k"], r["r"]) for r in first.collect()} == {(1, "a"), (2, "c")}


def test_document_expressions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(documents.last_json(F.lit('so {"a": 1} end'), "a int"))["a"] == 1
    assert one(documents.fenced_json(F.lit('x\n```json\n{"a": 2}\n```'), "a int"))["a"] == 2
    assert one(documents.status_object({"s": F.lit("ok"), "n": F.lit(None).cast("int")})) == '{"s":"ok"}'
    assert one(documents.name_confidence(F.lit("Marine Institute"), F.lit("marine.ie"))) == "high" and one(documents.name_confidence(F.lit("National Board"), F.lit("national.ie"))) == "low"
    assert one(documents.first_of(F.lit(None), F.lit("b"), F.lit("a"), F.lit("b"))) == ["b", "a"]
    assert [one(dates.link_date(F.lit(x)).cast("string")) for x in ("minutes-2024-05-06.pdf", "Minutes 5th May 2024", "min_05062024.pdf", "none 12345")] == ["2024-05-06", "2024-05-05", "2024-06-05", None]
    assert one(dates.resolved_date(F.lit(None).cast("date"), F.lit(None).cast("date"), F.lit("Meeting of 3rd March\nin 2024")).cast("string")) == "2024-03-03"
    assert one(dates.year_quarter(F.lit("Q3 2024"))) == (2024, 3) and one(dates.year_quarter(F.lit("Q5 2024"))) is None
    assert tuple(one(dates.latest_deadline(F.lit("Start Q1 2023, then 2024-2025, end Q2 2024")))) == (2024, 2)


def test_pipeline(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path))
    spark.createDataFrame([(1, 1), (2, 2)], "k int, v int").write.parquet(p.path("raw"))
    p.step("sums", "doubled")(lambda d: d.groupBy().sum("v"))
    p.step("doubled", "raw")(lambda d: d.withColumn("v", F.col("v") * 2))
    assert p.run() == ["doubled", "sums"] and p.run() == []
    spark.createDataFrame([(1, 10), (2, 20)], "k int, v int").write.mode("overwrite").parquet(p.path("raw"))
    assert p.run(only=spark.createDataFrame([(2,)], "k int"), key="k") == ["doubled", "sums"]
    assert {tuple(r) for r in p.read("doubled").collect()} == {(1, 2), (2, 40)}
    p.step("a", "b")(lambda d: d)
    p.step("b", "a")(lambda d: d)
    with pytest.raises(ValueError):
        p.order()
