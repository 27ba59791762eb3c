"""Relational operators, grids and texts on small fixtures, brute force where SQL is no use."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sedgeline.operators import dedup, grid_repairs, grids, incremental, matching, rollups, texts, windows


def test_keep_first_does_not_depend_on_input_order(spark):
    rows = [(i, i % 3 if i % 7 else None, f"r{i}") for i in range(60)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "i int, k int, n string").repartition(3)
        got = {tuple(r) for r in dedup.keep_first(df, [F.col("k")], ["i"]).collect()}
        assert want is None or got == want
        want = got
    assert want == {(0, None, "r0"), (1, 1, "r1"), (2, 2, "r2"), (3, 0, "r3")}
    empty = spark.createDataFrame([], "i int, k int, n string")
    assert dedup.keep_first(empty, [F.col("k")], ["i"]).count() == 0


def test_keep_first_null_order_comes_last(spark):
    df = spark.createDataFrame([(None, 1), (5, 1)], "i int, k int")
    assert dedup.keep_first(df, [F.col("k")], ["i"]).first()["i"] == 5


def test_ordinals_and_sequences(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "x")], "i int, g string, t string")
    assert [r["n"] for r in dedup.ordinal_suffix(df, F.col("g"), ["i"], "n").orderBy("i").collect()] == ["a", "a-2", "a-3", "b"]
    assert {(r["i"], r["n"]) for r in dedup.sequence_ids(df, ["g"], "t", ["i"], "m", "n").collect()} == {(1, "m001"), (3, "m002"), (4, "m001")}


def test_assigned_ids(spark):
    known = spark.createDataFrame([("a", 7)], "k string, id long")
    new = spark.createDataFrame([(c,) for c in "cbab"] + [(None,)], "k string")
    assert {tuple(r) for r in dedup.assigned_ids(known, new, "k", "id").collect()} == {("b", 8), ("c", 9)}
    assert {tuple(r) for r in dedup.assigned_ids(known.filter("false"), new, "k", "id").collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_keyed_match(spark):
    q = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "n string")
    r = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 3), ("", 4), (None, 5)], "n string, id int")
    got = {x["n"]: (x["match_status"], x["matched_id"]) for x in matching.keyed_match(q, F.col("n"), r, F.col("n"), "id").collect()}
    assert got == {"a": ("exact", 1), "b": ("ambiguous", None), "z": ("unmatched", None), None: ("unmatched", None)}


def test_fuzzy_candidates_are_complete(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(3, 24))).strip() or "x" for _ in range(60)]
    queries = [n[: len(n) // 2] + rng.choice("abz") + n[len(n) // 2 :] for n in names[:30]] + names[:5]
    pairs = matching.fuzzy_candidates(spark.createDataFrame([(x,) for x in queries], "query string"), spark.createDataFrame([(x,) for x in names], "candidate string"), 0.9)
    got = {(r["query"], r["candidate"]) for r in matching.fuzzy_scores(pairs, 0.9).collect()}
    assert got == {(q, n) for q in set(queries) for n in set(names) if matching.ratio(q, n) >= 0.9}


def _bodies(rng, n):
    place = lambda: "".join(rng.choice(["bra", "mal", "elo", "fal", "vor", "kesh", "dun", "row"]) for _ in range(3))
    return sorted({f"{place()} {rng.choice(['county council', 'development company', 'library service', 'health trust', 'education board'])}" for _ in range(n)})


def test_few_of_the_names_are_candidates(spark):
    """Names share most of their letters and grams; at a ratio of 0.9 few pairs are left to score, and none is lost."""
    rng = random.Random(5)
    names = _bodies(rng, 400)
    queries = sorted({n[:k] + "x" + n[k + 1 :] for n in names[::20] for k in (2, 7)})
    pairs = matching.fuzzy_candidates(spark.createDataFrame([(x,) for x in [*queries, None]], "query string"), spark.createDataFrame([(x,) for x in [*names, None]], "candidate string"), 0.9)
    got = {tuple(r) for r in pairs.collect()}
    assert {(q, n) for q in queries for n in names if matching.ratio(q, n) >= 0.9} <= got
    assert len(got) < 0.02 * len(queries) * len(names)


def test_overrides(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    o = spark.createDataFrame([(1, None), (2, "b")], "k int, value string")
    run = lambda policy: {r["k"]: r["v"] for r in matching.overridden(df, o, "k", "v", policy).collect()}
    assert run("wins") == {1: None, 2: "b", 3: "c"} and run("fills") == {1: "a", 2: "b", 3: "c"} and run("strict") == run("wins")
    with pytest.raises(ValueError):
        matching.overridden(df, spark.createDataFrame([(3, "c")], "k int, value string"), "k", "v", "strict")
    with pytest.raises(ValueError):
        matching.overridden(df, spark.createDataFrame([(9, "c")], "k int, value string"), "k", "v", "strict")


def test_longest_contained(spark):
    df = spark.createDataFrame([("not granted in part",), ("granted",), ("ungranted",), (None,)], "v string")
    got = [r["canonical"] for r in matching.longest_contained(df, F.col("v"), [("granted", "G"), ("granted in part", "P")]).collect()]
    assert got == ["P", "G", None, None]


def test_block_remainder(spark):
    rows = [(1, "a", 10, 15, 10), (1, "b", None, 15, 5), (2, "a", None, 9, 9), (2, "b", None, 9, 0), (3, "a", 10, 9, 10), (4, "a", 7, 7, 6), (5, "a", 1, None, 1)]
    df = spark.createDataFrame(rows, "s int, b string, d long, t long, e long")
    got = {(r["s"], r["b"]): (r["amount"], r["problem"], r["withheld"]) for r in rollups.block_remainder(df, "s", "b", "d", "t", "e").collect()}
    assert got[1, "b"] == (5, None, False) and got[2, "a"] == (None, "several_undeclared", True) and got[3, "a"][1] == "over_declared" and got[4, "a"] == (7, None, True) and got[5, "a"][1] == "no_total"


def test_tiers_with_ties(spark):
    df = spark.createDataFrame([(i, 5 if i < 4 else 1) for i in range(7)], "k int, s int")
    got = {r["k"]: r["tier"] for r in rollups.priority_tiers(df, "s", ["k"]).collect()}
    assert [got[i] for i in range(7)] == ["high", "high", "medium", "medium", "low", "low", "low"]


def test_owned(spark):
    items = spark.createDataFrame([(1, 1, 5.0), (2, 1, 1.0), (3, 2, 9.0)], "id int, page int, y double")
    bounds = spark.createDataFrame([("h1", 1, 2.0), ("h2", 1, 5.0)], "h string, page int, y double")
    assert {(r["id"], r["h"]) for r in windows.owned(items, bounds, ["page"], "y", "h").collect()} == {(1, "h2"), (2, None), (3, None)}


def test_fingerprints_and_merge(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, d string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, "n")], "k int, d string")
    assert {(r["k"], r["state"]) for r in incremental.fingerprint_changes(old, new, "k", "d").collect()} == {(1, "unchanged"), (2, "unchanged"), (3, "changed"), (4, "new")}
    assert {tuple(r) for r in incremental.upserted(old, new.filter("k >= 3"), "k").collect()} == {(1, "a"), (2, "b"), (3, "z"), (4, "n")}
    double = lambda d: d.withColumn("d", F.concat("d", "d"))
    assert {tuple(r) for r in incremental.recomputed(old, old, old.filter("k = 2"), "k", double).collect()} == {(1, "a"), (2, "bb"), (3, "c")}


H = ["Ref", "Date", "Text"]


def long_grid(spark, *files):
    rows = [(f"f{k}", i, r, "clash") for k, grid in enumerate(files) for i, r in enumerate(grid)]
    return spark.createDataFrame(rows + [(None, 1, H, "x"), ("f0", None, H, "x"), ("f0", 99, None, "x")], "file string, row_no int, cells array<string>, _at string").repartition(3)


def grids_of(df, n):
    rows = sorted((r["file"], r["row_no"], r["cells"]) for r in df.collect())
    return [[c for f, _, c in rows if f == f"f{k}"] for k in range(n)]


def test_merged_continuations(spark):
    cases = [
        ([H, ["1", "d", "a"], [None, "", "b"], [None, None, "c"]], [H, ["1", "d", "a b c"]]),
        ([H, [None, None, "x"], ["1", "d", "a"]], [H, [None, None, "x"], ["1", "d", "a"]]),
        ([H, *[[None, None, str(i)] for i in range(4)]], [H, *[[None, None, str(i)] for i in range(4)]]),
        ([H, ["1", "d"], [None, None, "x"]], [H, ["1", "d"], [None, None, "x"]]),
        ([["a", "b"], [None, "x"]], [["a", "b"], [None, "x"]]),
        ([H, ["1", "d", None], [None, None, "b"], [None, "e", None], ["2", "d", "z"], [None, None, "y"]], [H, ["1", "d e", "b"], ["2", "d", "z y"]]),
    ]
    got = grid_repairs.merged_continuations(long_grid(spark, *[c for c, _ in cases]))
    assert grids_of(got, len(cases)) == [w for _, w in cases]
    assert {r["n_merged"] for r in got.filter("file = 'f0' and row_no = 1").collect()} == {2}
    assert grid_repairs.merged_continuations(long_grid(spark).filter("false")).count() == 0


def test_repaired_headers(spark):
    synonyms = {"ref": "r", "date received": "d", "text": "t", "date": "d"}
    cases = [
        ([["Log 2020", None, None], ["Ref", "Date", "Text"], [None, "received", None], ["1", "2", "3"]], [["Ref", "Date received", "Text"], ["1", "2", "3"]]),
        ([["Ref", "Date", None], ["1", "2", "3"]], [["Ref", "Date", "Date"], ["1", "2", "3"]]),
        ([["x", "y", "z"], ["Ref", "Date", "Text"], ["1", "2", "3"]], [["Ref", "Date", "Text"], ["1", "2", "3"]]),
        ([[None, "Ref", "no"], ["Text", "Date", "Ref"], ["1", "2", "3"]], [["Text", "Ref", "no"], ["1", "2", "3"]]),
        ([["Ref", "Date"], [None, "w" * 60], ["1", "2"]], [["Ref", "Date"], ["1", "2"]]),
        ([["only"]], [["only"]]),
        ([[]], [[]]),
    ]
    assert grids_of(grid_repairs.repaired_headers(long_grid(spark, *[c for c, _ in cases]), synonyms), len(cases)) == [w for _, w in cases]


def test_pages_and_empty_columns(spark):
    pages = spark.createDataFrame([("f0", 1, 0, ["h", "i"]), ("f0", 1, 1, ["1", "2"]), ("f0", 2, 5, ["H ", "i"]), ("f0", 2, 6, ["3", "4"]), ("f0", 3, 0, ["5", "6"])], "file string, page int, row_no int, cells array<string>")
    got = grid_repairs.merged_pages(pages)
    assert grids_of(got, 1) == [[["h", "i"], ["1", "2"], ["3", "4"], ["5", "6"]]] and sorted(r["row_no"] for r in got.collect()) == [0, 1, 2, 3]
    assert grids_of(grid_repairs.pruned_columns(long_grid(spark, [["a", None, " "], ["b", "", ""]], [["a", None], ["b"]], [["", "x"], [None, None]])), 3) == [[["a"], ["b"]], [["a", None], ["b"]], [["x"], [None]]]


def test_combined_columns(spark):
    files = [
        [["Ref", "Date and Description"], ["1", "05/01/2017 All emails"], ["2", "5 March 2018"], ["3", "no date here"], ["4"], ["5", None]],
        [["Date of Request:", "x"], ["7190 19/01/2017", "a"], ["*9557", "b"], ["06/07/2022 19447", "c"], ["*02/01/2018 9559", "d"], ["18/01/2017", "e"], [None, "f"], ["soon", "g"]],
        [["Date of request", "x"], ["18/01/2017", "e"]],
    ]
    want = [
        [["Ref", "Date", "Description"], ["1", "05/01/2017", "All emails"], ["2", "5 March 2018", None], ["3", "no date here", None], ["4"], ["5", None, None]],
        [["Date of Request:", "Reference", "x"], ["19/01/2017", "7190", "a"], [None, "9557", "b"], ["06/07/2022", "19447", "c"], ["02/01/2018", "9559", "d"], ["18/01/2017", None, "e"], [None, None, "f"], ["soon", None, "g"]],
        [["Date of request", "x"], ["18/01/2017", "e"]],
    ]
    assert grids_of(grid_repairs.split_combined_columns(long_grid(spark, *files), ["date and description"], ["date of request"]), 3) == want


def test_mapped_columns(spark):
    mapping = spark.createDataFrame([("f0", 2, "a"), ("f0", 0, "b"), ("f0", 1, "a"), ("f0", 9, "c"), ("f0", 0, " "), ("gone", 0, "a")], "file string, column int, canonical string")
    got, errors = grid_repairs.mapped_columns(long_grid(spark, [["x", "y", "z"], ["1", "2", "3"], ["4"]], [["p"], ["q"]]), mapping)
    assert grids_of(got, 2) == [[["a", "b"], ["2", "1"], [None, "4"]], [["p"], ["q"]]]
    assert {tuple(r) for r in errors.collect()} == {("f0", 2, "named_twice"), ("f0", 9, "no_such_column"), ("f0", 0, "no_name"), ("gone", 0, "no_such_file")}


def test_grid_expressions(spark):
    df = spark.createDataFrame([(["A", "B", "C"],), (["Ref", "x", None],), ([],), (None,)], "c array<string>")
    assert [r[0] for r in df.select(F.coalesce(grids.is_letter_row(F.col("c")), F.lit(False))).collect()] == [True, False, False, False]
    cases = [(["1", "2"], ["1", None, "2"]), (["1", "", "2", "3"], ["1", "2", "3"]), (["1", "2", "3", "4"], None), (["1", None, "2", "", "3"], ["1", "2", "3"]), (["1"], ["1", None, None]), (["1", "2", "3"], ["1", "2", "3"])]
    df = spark.createDataFrame([(c,) for c, _ in cases], "c array<string>")
    assert [r[0] for r in df.select(grids.realigned(F.col("c"), F.lit(3), F.lit(1))).collect()] == [w for _, w in cases]
    syn = {"our reference": "ref", "date": "date", "decision": "status"}
    df = spark.createDataFrame([("Our  Reference:",), ("Date 2019",), ("Cinneadh/Decision",), ("decision 2020-01-01 00:00:00",), ("Outcome",)], "c string")
    assert [r[0] for r in df.select(grids.canonical_header(F.col("c"), syn)).collect()] == ["ref", "date", "status", "status", None]
    df = spark.createDataFrame([(["1", "2", "3"],)], "c array<string>")
    assert df.select(grids.pivoted(F.col("c"), ["ref", None, "date"]).alias("p")).first()["p"].asDict() == {"ref": "1", "date": "3"}


def test_structure_and_cardinality(spark):
    rows = [("f", [str(i), "2024-01-01", "word", "x"]) for i in range(9)] + [("f", ["only", None, None, None]), ("g", [None, None])]
    grid = spark.createDataFrame(rows, "f string, c array<string>")
    s = {r["f"]: r for r in grids.failed_checks(grids.structure_scores(grid, "f", "c"), {"uniformity": 0.95}, {"fragments": 0.05}).collect()}
    assert set(s) == {"f"} and s["f"]["modal_width"] == 4 and s["f"]["uniformity"] == pytest.approx(0.9) and s["f"]["failed_checks"] == ["uniformity", "fragments"]
    best = grids.column_by_cardinality(grid, "f", "c", ["a", "b", "a", None]).collect()
    assert {(r["f"], r["canonical"]): r["column"] for r in best}["f", "a"] == 0


@pytest.mark.parametrize("text", ["", "a", "x" * 999, "ab\n\ncd " * 80, "line\n" * 100])
def test_split_text(text):
    parts = texts.split_text(text, 100)
    assert "".join(parts) == text and all(0 < len(p) <= 100 for p in parts)


def test_milestones_and_repairs(spark):
    t = "Annual: 2022: start (a) plan (b) build • end"
    assert "".join(texts.milestones(t)) == t and len(texts.milestones(t)) >= 4
    fix = texts.repaired_words({"off ice": "office", "ice": "ICE!"})
    df = spark.createDataFrame([("Off ice OFF ICE a@ice.ie",), (None,)], "v string")
    assert [r[0] for r in df.select(fix("v")).collect()] == ["Office OFFICE a@ice.ie", None]
    assert df.select(texts.suspicious_spans(F.lit("x (cid:3) G r a n t ok"))).first()[0] == ["(cid:3)", "G r a n t"]


def test_scoped_merge_all(spark):
    """Every customer with a finished order is in the scope, whatever the number."""
    rows = contract.queries()["scoped_merge_all"](spark, "/root/testdata/sf0.001").collect()
    finished = {r["o_custkey"] for r in rows if r["o_orderstatus"] in ("F", "f")}
    assert finished and all(r["o_orderstatus"].islower() == (r["o_custkey"] in finished) for r in rows)
