"""Sources, sinks and streams: round trips in a temporary folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedgeline.sources import readers, writers
from sedgeline.streaming import windows


def test_parts_and_manifest(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.createDataFrame([(1, "b", "x\u2028y"), (1, "a", None), (2, "c", "é")], "k int, row_id string, v string")
    writers.write_parts(df, path, "k", "row_id", ["row_id", "v"])
    back = readers.ndjson_parts(spark, path, StructType().add("row_id", "string").add("v", "string").add("k", "integer"))
    assert {tuple(r) for r in back.select("k", "row_id", "v").collect()} == {tuple(r) for r in df.collect()}
    assert not any("\u2028" in r[0] for r in writers.read_lines(spark, path).select("value").collect())
    writers.write_parts(spark.createDataFrame([(2, "d", "new")], df.schema), path, "k", "row_id", ["row_id", "v"])
    now = readers.ndjson_parts(spark, path, StructType().add("row_id", "string").add("v", "string").add("k", "integer"))
    assert now.filter("k = 1").count() == 2 and [r["row_id"] for r in now.filter("k = 2").collect()] == ["d"]
    old, new = (writers.manifest(d, "k", "row_id", ["row_id", "v"]) for d in (df, now))
    assert {tuple(r) for r in writers.manifest_problems(old, new, "k").collect()} == {(2, "changed")}
    twice = writers.manifest(df.unionByName(df), "k", "row_id", ["row_id", "v"])
    assert {r["problem"] for r in writers.manifest_problems(twice, twice, "k").collect()} == {"duplicate_rows"}


def test_digests_count_repeats(spark, tmp_path):
    a, b = (spark.createDataFrame([(x, 1), (x, 1)], "k string, n int") for x in "ab")
    path = str(tmp_path / "repeats")
    assert writers.write_if_changed(a, path, "k") and writers.write_if_changed(b, path, "k") and not writers.write_if_changed(b, path, "k")
    assert {r[0] for r in spark.read.parquet(path).select("k").collect()} == {"b"}
    four = writers.manifest(a.unionByName(a), "n", "k", ["k"])
    assert four.first()["digest"] not in (writers.manifest(a, "n", "k", ["k"]).first()["digest"], writers.manifest(b.unionByName(b), "n", "k", ["k"]).first()["digest"])


def test_manifest_files_and_problems(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.createDataFrame([(1, "b", "2024-02-01"), (1, "a", "2024-01-01"), (2, "c", None)], "k int, row_id string, day string")
    writers.write_parts(df, path, "k", "row_id", ["row_id", "day"])
    m = writers.manifest(df, "k", "row_id", ["row_id", "day"], "day")
    assert {(r["k"], r["n_rows"], r["first_day"], r["last_day"]) for r in m.collect()} == {(1, 2, "2024-01-01", "2024-02-01"), (2, 1, None, None)}
    assert tuple(writers.manifest_totals(m).first()) == (2, 3, 0) and tuple(writers.manifest_totals(m.filter("false")).first()) == (0, 0, 0)
    now = writers.manifest(df.filter("k = 1").withColumn("day", F.lit("x")).unionByName(df.filter("k = 2").withColumn("k", F.lit(3))), "k", "row_id", ["row_id", "day"])
    assert {tuple(r) for r in writers.part_changes(m, now, "k").collect()} == {(1, "changed"), (2, "removed"), (3, "added")}
    import hashlib

    files = {r["file"]: (r["n_bytes"], r["sha256"]) for r in writers.file_digests(spark, path).collect()}
    assert files == {str(f.relative_to(tmp_path / "parts")): (f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in (tmp_path / "parts").rglob("*.txt")}
    schema = StructType().add("row_id", "string").add("day", "string")
    assert writers.part_problems(spark, path, schema, "row_id").count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.txt").write_text('{"row_id":"b"}\n{"row_id": "a"}\nnope\n{"row_id":"b"}\n')
    assert {r["problem"] for r in writers.part_problems(spark, str(tmp_path / "bad"), schema, "row_id").collect()} == {"out_of_order", "not_canonical", "does_not_parse", "duplicate"}


def test_jsonld_document(spark, tmp_path):
    import json

    df = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k int, name string").coalesce(1)
    writers.jsonld_document(df, str(tmp_path / "g"), {"name": "https://schema.example/name"}, F.concat(F.lit("id/"), F.col("k").cast("string")), "Body")
    (made,) = (json.loads(f.read_text()) for f in (tmp_path / "g").glob("*.txt"))
    assert [n["@id"] for n in made["@graph"]] == [f"id/{i}" for i in range(5)] and made["@context"] == {"name": "https://schema.example/name"}


def test_serialised_cells(spark):
    from sedgeline.functions.documents import serialised_cell

    df = spark.sql("select 5 i, 'x' s, 1.5D d, true b, date '2024-01-02' day, timestamp_ntz '2024-01-02 03:04:05' at, array(1, 2) a, named_struct('k', 'v') o, cast(null as int) n")
    got = df.select(*[serialised_cell(F.col(c)).alias(c) for c in df.columns]).first()
    assert {c: tuple(got[c]) for c in df.columns} == {
        "i": ("5", False), "s": ("x", False), "d": ("1.5", False), "b": ("true", False), "day": ("2024-01-02", False), "at": ("2024-01-02T03:04:05", False), "a": ("[1,2]", True), "o": ('{"k":"v"}', True), "n": (None, False),
    }


def test_csv_contract_of_a_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,n\nx,1\n")
    (tmp_path / "b.csv").write_text("n,name\n2,y\n")
    with pytest.raises(Exception):
        readers.csv_contract(spark, str(tmp_path), ["name", "n"]).collect()


def test_csv_contract(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffname,n\n"a, b",1\n', encoding="utf-8")
    assert [tuple(r) for r in readers.csv_contract(spark, str(tmp_path / "a.csv"), ["name", "n"]).collect()] == [("a, b", "1")]
    with pytest.raises(ValueError):
        readers.csv_contract(spark, str(tmp_path / "a.csv"), ["name", "m"])


def test_json_tables_and_links(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"metadata": {}, "results": [{"a": 1, "b": "x"}, {"a": 2}]}')
    got = readers.step_json(spark, str(tmp_path / "s.json"), StructType().add("a", "integer").add("b", "string"))
    assert [tuple(r) for r in got.collect()] == [(1, "x"), (2, None)]
    df = spark.createDataFrame([(1, "x\n| A | B |\n|---|:-:|\n| 1 | |\n\n| C | D |\n"), (2, None), (3, "")], "k int, t string")
    assert [tuple(r) for r in readers.pipe_tables(df, "k", "t").orderBy("table_no", "row_no").collect()] == [(1, 1, 0, ["A", "B"]), (1, 1, 1, ["1", None]), (1, 2, 0, ["C", "D"])]
    page = '<p><a href="/foi/log">FOI  disclosure log</a> <a href="/news">News</a><a name="x">n</a><a href="/foi/log2">disclosure log</a></p>'
    links = readers.page_links(spark.createDataFrame([("https://x.ie/a/", page), ("u", None)], "url string, html string"), "url", "html")
    assert links.count() == 3
    best = readers.scored_links(links, {"disclosure": 100, "foi": 40}, ["news"], 40).collect()
    assert [(r["href"], r["score"]) for r in best] == [("https://x.ie/foi/log", 100)]


def test_versions_and_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    writers.write_version(df, str(tmp_path), "v1")
    with pytest.raises(Exception):
        writers.write_version(df, str(tmp_path), "v1")
    assert writers.write_if_changed(df, str(tmp_path / "w"), "k") and not writers.write_if_changed(df, str(tmp_path / "w"), "k")
    assert writers.write_if_changed(df.withColumn("v", F.lit("b")), str(tmp_path / "w"), "k")
    index = writers.write_groups(df, str(tmp_path / "g"), "v", [F.min("k").alias("least")])
    assert [tuple(r) for r in index.collect()] == [("a", 1, 1)]
    errors = writers.safe_errors(spark.createDataFrame([("https://www.x.ie/p?q=1", "token=abc " + "m" * 300)], "url string, message string"), "url", "message").first()
    assert errors["url"] == "x.ie" and errors["message"].startswith("token=*** m") and len(errors["message"]) == 200
    assert '"@type":"Body"' in writers.jsonld_lines(df, {"k": "https://schema.example/k"}, F.lit("id/1"), "Body").first()[0]
    assert [r[0] for r in writers.orphaned_groups(df, df.filter("false"), "k").collect()] == [1]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = windows.event_stream(spark, str(tmp_path / "in"), events.schema, files_per_trigger=1)
    q = windows.tumbling(windows.timed(stream), "1 hour").writeStream.format("memory").queryName("tumbled").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("tumbled").collect()} == {tuple(r) for r in windows.tumbling(windows.timed(events), "1 hour").collect()}


def test_stream_state(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, 7, t0), (1, 7, t0), (2, 7, t0 + dt.timedelta(seconds=5)), (3, 8, t0), (4, 7, t0 + dt.timedelta(seconds=70))]
    spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windows.timed(windows.event_stream(spark, str(tmp_path / "in"), "event_id int, user_id int, ts timestamp"))
    def run(df, name):
        df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name).collect()

    assert len(run(windows.first_seen(stream, ["event_id"]), "firsts")) == 4
    paced = {(r["user_id"], r["ts"].second + 60 * r["ts"].minute): r["allowed"] for r in run(windows.paced(windows.first_seen(stream, ["event_id"]), "user_id", 60), "paced")}
    assert paced == {(7, 0): True, (7, 5): False, (8, 0): True, (7, 70): True}
