"""p2, p5, p6 and p7: nulls, empty tables, repeated rows, ties, clashing names, brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sedgeline.operators.hierarchy import tree_descendants, tree_paths
from sedgeline.operators.profile import column_profile, form_mask, load_findings, mask, mask_drift, mined_patterns, rare_masks, value_counts
from sedgeline.operators.references import current_rows, fault_counts, faulty_references, reference_rows
from sedgeline.operators.snapshots import SnapshotIndex, plain_url, plain_value, snapshot_changes

T = dt.datetime


def test_mask(spark):
    df = spark.createDataFrame([("2024-01-05",), ("Part-Granted (9)",), ("Éire ÁBC x",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(mask(F.col("v"))).collect()] == ["9999-99-99", "Aa-Aa (9)", "Aa A a", "", None]


KINDS = {"d": "date", "c": "code", "t": "text"}
ROWS = "feed int, load int, at timestamp_ntz, d string, c string, t string, value string, n int"


def _load(feed, load, d, c, t):
    return [(feed, load, T(2024, load, 1), x, y, z, "clash", 1) for x, y, z in zip(d, c, t)]


def findings(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    p = column_profile(value_counts(df, ["feed", "load"], KINDS, "at"), ["feed", "load"])
    return {tuple(r) for r in load_findings(p, "feed", "load").collect()}


def test_profile_findings(spark):
    good = ["2023-05-01", "2023-05-02", "2023-05-03", "2023-05-04"] * 5
    rows = _load(1, 1, good, ["A", "B", "C", "D"] * 5, ["ten chars."] * 20)
    rows += _load(1, 2, ["01/02/2023"] * 6 + good[:14], ["A1", "B2", "A3"] + ["A"] * 17, ["twenty characters...."] * 20)
    rows += _load(1, 3, [None] * 10 + ["1990-01-01"] + good[:9], ["A"] * 20, [None, "", "  "] + ["x" * 100_000] * 17)
    rows += _load(2, 2, good, ["A"] * 20, ["t"] * 20)  # no load before
    rows += [(None, 1, T(2024, 1, 1), "x", "y", "z", "clash", 1), (1, None, None, None, None, None, None, None)]
    got = findings(spark, rows)
    assert (1, 2, "d", "pattern_break") in got and (1, 2, "c", "pattern_break") in got and (1, 2, "t", "length_shift") in got
    assert (1, 3, "d", "blank_shift") in got and (1, 3, "d", "range_break") in got and (1, 2, "c", "top_share_shift") in got
    assert not [x for x in got if x[0] == 2]
    assert (1, 3, "t", "blank_shift") not in got  # 0.15 only


def test_profile_empty(spark):
    assert findings(spark, []) == set()
    df = spark.createDataFrame([], ROWS)
    assert mask_drift(value_counts(df, ["feed", "load"], KINDS, "at"), "feed", "load").count() == 0


def test_mask_drift(spark):
    rows = _load(1, 1, ["2023-05-01"] * 99 + ["5.1.2023"], ["A"] * 100, ["t"] * 100) + _load(1, 2, ["1/2/23"] * 100, ["A"] * 100, ["t"] * 100)
    got = {(r["load"], r["column_name"]): r for r in mask_drift(value_counts(spark.createDataFrame(rows, ROWS), ["feed", "load"], KINDS, "at"), "feed", "load", rare_share=0.02).collect()}
    assert got[1, "d"]["n_rare_mask"] == 1 and got[1, "d"]["dominant_mask"] == "9999-99-99"
    assert got[2, "d"]["divergence"] == pytest.approx(1.0) and got[2, "c"]["divergence"] == 0.0


def test_texts_by_value_and_form(spark):
    texts = [f"Please send record {i} of the council." for i in range(100)]
    rows = _load(1, 1, [None] * 100, ["A"] * 100, texts) + _load(1, 2, [None] * 100, ["A"] * 100, texts[:99] + ["please send: record 7 (of the council)"])
    df = spark.createDataFrame(rows, ROWS)
    got = {(r["load"], r["column_name"]): r for r in column_profile(value_counts(df, ["feed", "load"], KINDS, "at"), ["feed", "load"]).collect()}
    assert got[1, "t"]["n_distinct"] == 100 and got[1, "t"]["n_top"] == 1 and got[1, "t"]["n_values"] == 100
    assert (got[1, "t"]["least_value"], got[1, "t"]["greatest_value"]) == (min(texts), max(texts))
    moved = {(r["load"], r["column_name"]): r for r in mask_drift(value_counts(df, ["feed", "load"], KINDS, "at", "form"), "feed", "load", rare_share=0.02).collect()}
    assert moved[1, "t"]["dominant_mask"] == "Aa a 9 a." and moved[1, "t"]["n_rare_mask"] == 0
    assert moved[2, "t"]["n_rare_mask"] == 1 and moved[2, "t"]["divergence"] > 0


def test_mined_patterns(spark):
    rows = _load(1, 1, ["05.01.2023"] * 3 + ["2023-05-01"] * 2 + ["99.99.2023", None], ["X1"] * 4 + ["Y2", "Z", None], ["t"] * 7)
    counts = value_counts(spark.createDataFrame(rows, ROWS), ["feed", "load"], KINDS, "at", "length")
    assert {tuple(r) for r in mined_patterns(counts).collect()} == {("d", "99.99.9999"), ("c", "A9"), ("t", None)}
    got = {r["column_name"]: r["n_off_pattern"] for r in column_profile(counts, ["feed", "load"]).collect()}
    assert got == {"d": 6, "c": 0, "t": 0}  # no value is a day written yyyy-mm-dd in the mined mask; codes hold digits by rule


def test_every_column_is_profiled(spark):
    folder = "/root/testdata/sf0.001"
    columns = set(spark.read.parquet(f"{folder}/foi_disclosures.parquet").columns)
    for q in ("p2_profile", "p2_mask_drift"):
        assert {r[0] for r in contract.queries()[q](spark, folder).select("column_name").distinct().collect()} == columns


def test_rare_masks(spark):
    rows = _load(1, 1, ["2023-05-01"] * 198 + ["5.1.2023", "4.1.2023"], ["A"] * 200, ["t"] * 199 + ["T!"])
    counts = value_counts(spark.createDataFrame(rows, ROWS), ["feed", "load"], KINDS, "at", "form")
    assert {tuple(r) for r in rare_masks(counts, "feed", "load", rare_share=0.02).collect()} == {(1, 1, "d", "9.9.9999", 2, 0.01, "4.1.2023"), (1, 1, "t", "A!", 1, 0.005, "A!")}
    assert {r["column_name"]: r["n_rare_mask"] for r in mask_drift(counts, "feed", "load", rare_share=0.02).collect()} == {"d": 2, "c": 0, "t": 1}


def test_form_mask(spark):
    df = spark.createDataFrame([("Dear Sir,\r\n send 2,000 of FOI ACT Form 12 13",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(form_mask(F.col("v"))).collect()] == ["Aa,¶a 9,9 a A Aa 9", "", None]


def brute_tree(parents):
    out = {}
    for v in parents:
        path, seen = [v], {v}
        while True:
            p = parents[path[-1]]
            if p is None or p not in parents:
                out[v] = (path[-1], len(path) - 1, "/".join(map(str, reversed(path))))
                break
            if p in seen:
                ring = path[path.index(p) :]
                out[v] = (min(ring), -1, "cycle")
                break
            path.append(p)
            seen.add(p)
    return out


@pytest.mark.parametrize("seed, core", [(0, 0), (1, 0), (0, 2000), (2, 20)])
def test_tree_paths(spark, seed, core):
    rng = random.Random(seed)
    parents = {i: rng.choice([None, rng.randrange(120), i - 1 if i else None, 999]) for i in range(120)}
    rows = [(k, p, "x", 5) for k, p in parents.items()] * 2 + [(None, 3, "x", 5)]
    df = spark.createDataFrame(rows, "v int, p int, label string, least int")
    got = tree_paths(df, "v", "p", core=core)
    assert {r["v"]: (r["root"], r["depth"], r["path"]) for r in got.collect()} == brute_tree(parents)
    pairs = {tuple(r) for r in tree_descendants(got, "v").collect()}
    want = set()
    for v, (_, depth, path) in brute_tree(parents).items():
        ids = path.split("/") if depth > 0 else []
        want |= {(int(a), v, depth - i) for i, a in enumerate(ids[:-1])}
    assert pairs == want


def test_tree_chain_and_empty(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(200)], "k int, up int")
    got = {r["k"]: r["depth"] for r in tree_paths(chain, "k", "up", core=20).collect()}
    assert got == {i: i for i in range(200)}
    assert tree_paths(spark.createDataFrame([], "k int, up int"), "k", "up").count() == 0
    ring = spark.createDataFrame([(i, (i + 1) % 30) for i in range(30)] + [(50, 50)], "k int, up int")
    for core in (0, 2000):
        assert {(r["k"], r["root"], r["depth"]) for r in tree_paths(ring, "k", "up", core=core).collect()} == {(i, 0, -1) for i in range(30)} | {(50, 50, -1)}


SNAP = "no int, k int, at timestamp_ntz, url string, mail string, change_kind string, _key int"


def changes(spark, rows):
    values = {"url": plain_url(F.col("url")), "mail": plain_value(F.col("mail"))}
    return {(r["no"], r["k"], r["change_kind"], r["old_value"], r["new_value"]) for r in snapshot_changes(spark.createDataFrame(rows, SNAP), "no", "k", "at", values, buckets=3).collect()}


def test_snapshot_changes(spark):
    a, b = T(2024, 1, 1), T(2024, 2, 1)
    rows = [
        (1, 1, a, "http://a/", "x@y", "c", 0), (1, 2, a, "http://b", None, "c", 0), (1, 3, a, "u", "m", "c", 0), (1, 3, b, "u2", "m", "c", 0),
        (2, 1, a, " HTTP://A ", "X@Y", "c", 0), (2, 2, a, "http://b", " ", "c", 0), (2, 3, a, "u2/", "new" * 50_000, "c", 0), (2, 4, a, None, None, "c", 0), (2, 4, a, None, None, "c", 0),
        (3, 4, a, "", "", "c", 0), (3, None, a, "x", "y", "c", 0), (None, 7, a, "x", "y", "c", 0), (5, 4, a, "z", "z", "c", 0),
    ]
    assert changes(spark, rows) == {(2, 3, "mail", "m", "new" * 50_000), (2, 4, "added", None, None), (3, 1, "removed", None, None), (3, 2, "removed", None, None), (3, 3, "removed", None, None)}


def test_snapshot_changes_empty(spark):
    assert changes(spark, []) == set()


def test_faulty_references(spark):
    a, b, c = T(2024, 1, 5), T(2024, 3, 5), T(2024, 6, 5)
    bodies = spark.createDataFrame([(1, a, None, None, "x"), (1, b, a, b, "x"), (2, a, c, None, "x"), (3, a, a, None, "x"), (None, a, a, None, "x")], "k int, v timestamp_ntz, listed timestamp_ntz, removed timestamp_ntz, fk string")
    cur = current_rows(bodies, "k", "v", ["listed", "removed"])
    assert cur.count() == 3
    refs = spark.createDataFrame([(10, 1, c, 1), (11, 1, a, 1), (12, 2, b, 1), (13, 3, c, 1), (14, 9, c, 1), (15, None, c, 1), (16, 9, None, 1), (14, 9, c, 1), (None, 9, c, 1)], "id long, body int, at timestamp_ntz, fk int")
    got = faulty_references([reference_rows(refs, "t", "id", "body", "at")], cur, "k", "listed", "removed")
    assert {tuple(r) for r in got.collect()} == {("t", 10, "2024-06", "deleted"), ("t", 12, "2024-03", "late"), ("t", 14, "2024-06", "missing"), ("t", 16, "", "missing")}
    assert got.count() == 4 and sum(r["n_references"] for r in fault_counts(got).collect()) == 4
    none = refs.filter("false")
    assert faulty_references([reference_rows(none, "t", "id", "body", "at")], cur, "k", "listed", "removed").count() == 0
    assert faulty_references([reference_rows(refs, "t", "id", "body", "at")], cur.filter("false"), "k", "listed", "removed").count() == 6


def test_snapshot_index_outlives_deliveries(spark):
    """An index by name: probed by the next delivery, as it was after one that fails, found again by a new object."""
    rows = lambda *x: spark.createDataFrame(x, "k int, url string, mail string")
    make = lambda: SnapshotIndex.open(spark, "test_contacts", "k", ["url", "mail"], 3)
    make().drop()
    assert make().current() is None and make().deliver(rows((1, "a", "m"), (2, "b", None), (3, "c", "x")), 1) is None
    held = make().current()
    with pytest.raises(Exception):
        make().deliver(rows((1, "a", "m")).withColumn("url", F.raise_error(F.lit("broken")).cast("string")), 2)
    assert make().current() == held
    got = make().deliver(rows((1, "a", "n"), (2, None, None), (4, "d", "y")), 2)
    assert {tuple(r) for r in got.collect()} == {(1, "mail", "m", "n"), (2, "url", "b", None), (3, "removed", None, None), (4, "added", None, None)}
    spark.sql(f"DROP TABLE IF EXISTS snapshot_index_{make().current()[0]}")  # as in a new session
    assert make().deliver(rows((1, "a", "n"), (2, None, None), (4, "d", "y")), 3).count() == 0
    assert make().deliver(rows((1, "a", "n")), 9) is None and make().current()[1] == 9
    make().drop()
