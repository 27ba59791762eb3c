"""Helper operators on small fixtures: refusals, nulls, ties, repeats, empty tables, brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sedgeline.functions import text
from sedgeline.operators import dedup, grids, incremental, matching, pages, rollups, texts


def values(spark, made, cells):
    return [r[0] for r in spark.createDataFrame([(c,) for c in cells], "c string").select(made(F.col("c")).alias("v")).collect()]


@pytest.mark.parametrize(
    "cell, want",
    [
        ("12", ("12", "12", [], None, None)), ("007", ("7", "7", [], None, None)), ("EL/23/6", ("EL/23/6", "EL/23/6", [], 2023, None)), ("EL/23/ 6 /A **", ("EL/23/6/A", "EL/23/6/A **", ["duplicate"], 2023, None)),
        ("EL/23/10A(TF)*", ("EL/23/10A", "EL/23/10A(TF)*", ["non_reportable", "taskforce"], 2023, None)), ("3 ***", ("3", "3 ***", ["non_reportable", "duplicate"], None, None)), ("\x07 4.\x07", (None, None, None, None, "InvalidActionReference")),
        ("EL//6", (None, None, None, None, "InvalidActionReference")), ("1234", (None, None, None, None, "UnresolvedActionNumber")), ("**", (None, None, None, None, "UnresolvedActionNumber")), ("", (None, None, None, None, "UnresolvedActionNumber")), (None, (None, None, None, None, "UnresolvedActionNumber")),
    ],
)
def test_action_reference(spark, cell, want):
    (got,) = values(spark, text.action_reference, [cell])
    assert (got["number"], got["printed"], got["flags"], got["year"], got["error"]) == want


def test_references_and_ordinals(spark):
    assert values(spark, text.parent_reference, ["EL/23/6/A", "EL/23/10A", "EL/23/6", "12", None]) == ["EL/23/6", "EL/23/10", None, None, None]
    assert values(spark, text.edition_year, ["climate-plan-2024-annex-of-actions"]) == [2024]
    with pytest.raises(Exception):
        values(spark, text.edition_year, ["climate-plan"])
    assert [tuple(x) for x in values(spark, text.leading_ordinal, ["1. \x07text", "2) x\ny", "no number", "3 x", ""])] == [(1, "text"), (2, "x\ny"), (None, "no number"), (None, "3 x"), (None, "")]
    got = values(spark, text.cross_references, ["a (Complements Green Plan 2 Actions 1, 2 and 31) b (see Blue Action 4; Red Actions 5 and 6)", "(no plan)", "", None])
    assert [[(x["relationship"], x["plan"], x["number"]) for x in g] for g in got] == [[("complements", "Green Plan 2", "1"), ("complements", "Green Plan 2", "2"), ("complements", "Green Plan 2", "31"), ("references", "Blue", "4"), ("references", "Red", "5"), ("references", "Red", "6")], [], [], []]


def test_guards(spark):
    docs = spark.createDataFrame([(1, "alter no. 1 accept alter no. 2"), (2, "alter accept"), (3, None), (None, "alter alter accept"), (4, "")], "k int, t string").withColumn("n_chars", F.lit("clash"))
    assert [tuple(r) for r in texts.phrase_guard(docs, "k", "t", {"a": "alter", "b": "(?i)ACCEPT"}, {"a": 2, "b": 1}).collect()] == [(1, 2, 1, 30)]
    items = [(1, f"accept {i}", "A" if i else "B", " ") for i in range(10)] + [(2, "accept", "A", "x")] * 3 + [(3, "accept" if i else "no", "A", "x") for i in range(2)] + [(None, "accept", "A", "x")]
    df = spark.createDataFrame(items, "d int, t string, p string, s string")
    dump = lambda *actors, least=3: {r["d"]: r.asDict() for r in texts.dump_guard(df, "d", {"accepted": F.col("t").contains("accept")}, list(actors), least, 0.8).collect()}
    assert set(dump("p")) == {1, 2} and dump("p")[1]["n_top_p"] == 9 and set(dump("p", "s")) == {2} and set(dump("p", least=11)) == set()
    usable, thin = texts.thin_texts(docs, "k", "t", 12)
    assert {r["k"] for r in usable.collect()} == {1, 2, None} and {tuple(r) for r in thin.collect()} == {(3, 0), (4, 0)}


def test_ranked_spreads_groups(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 1, 1, 2]), i, rng.random()) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, i int, v double").withColumn("_n", F.lit(1)).repartition(5)
    got = {r["i"]: r["n"] for r in dedup.ranked(df.drop("_n"), ["g"], [F.desc("v"), F.col("i")], "n").collect()}
    want = {}
    for g in (None, 1, 2):
        want |= {i: k for k, (_, i, _) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1])), 1)}
    assert got == want
    assert dedup.ranked(df.filter("false"), ["g"], ["i"], "n").count() == 0


def test_refusals(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    for run in (lambda: dedup.guarded(df, "k", 1), lambda: dedup.guarded(df.filter("k = 2"), "k", 2), lambda: matching.resolved(df, "v", "fatal"), lambda: matching.included(df, df, spark.createDataFrame([(9,)], "k int"), "k")):
        with pytest.raises(ValueError):
            run()
    assert matching.resolved(df, "v", "drop").count() == 2 and dedup.guarded(df.filter("k = 2"), "k", 1).count() == 1
    register = spark.createDataFrame([("a", 10), ("b", 11), ("b", 12)], "n string, id int")
    assert {tuple(r) for r in matching.crosswalk(df.withColumn("o", F.lit(1)), F.col("v"), register.filter("n = 'a'"), F.col("n"), "id", [F.col("k")]).collect()} == {(1, "a", 1, 10)}
    with pytest.raises(ValueError):
        matching.crosswalk(spark.createDataFrame([("b",)], "v string"), F.col("v"), register, F.col("n"), "id")


def test_best_match_against_brute_force(spark):
    rng = random.Random(8)
    names = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(5, 18))).strip() or "x" for _ in range(40)]
    queries = [n[:k] + rng.choice("xyz") + n[k + 2 :] for n in names[:25] for k in (1, 4)] + ["zzzzzzzz", names[0]]
    got = {r["query"]: (r["candidate"], r["best_score"], r["suggestion"]) for r in matching.best_match(spark.createDataFrame([(q,) for q in queries], "query string"), spark.createDataFrame([(n,) for n in names], "candidate string"), 0.9, 0.6).collect()}
    for q in set(queries):
        score, name = min((-matching.ratio(q, n), n) for n in set(names))
        assert got[q] == ((name if -score >= 0.9 else None, -score, name) if -score >= 0.6 else (None, None, None))


def test_best_match_scores_few_names(monkeypatch):
    """The best name is found by scoring a few of the names that share most of their letters; ties go to the first name."""
    rng, calls = random.Random(2), []
    place = lambda: "".join(rng.choice(["bra", "mal", "elo", "fal", "vor", "kesh", "dun", "row", "é", "𐐷"]) for _ in range(3))
    names = sorted({f"{place()} {rng.choice(['county council', 'development company', 'library service', 'health trust'])}" for _ in range(500)})
    names += ["", "a", "x" * 300, "long " * 40 + "name"]
    queries = [n[:k] + rng.choice("xé") + n[k + 1 :] for n in names[:400:10] for k in (1, 6)]
    odd = ["", "a", "b", "zzzz 9", "x" * 299 + "y", "long " * 39 + "game", names[0] * 3]
    plain = matching.ratio
    want = {q: min((-plain(q, n), n) for n in names) for q in queries + odd}
    monkeypatch.setattr(matching, "ratio", lambda a, b: calls.append(a) or plain(a, b))
    for q in queries + odd:
        found = [(-x, n) for n, x in (side.best(q, 0.6) for side in matching._sides(names, 4000)) if n is not None]
        assert (min(found) if found else None) == (want[q] if -want[q][0] >= 0.6 else None)
        for side in matching._sides(names):
            at, bounds = side.near(q, 0.5)
            assert {n for n in side.names if plain(q, n) >= 0.5} <= {side.names[i] for i in at}
            assert all(plain(q, side.names[i]) <= x for i, x in zip(at, bounds))
    calls.clear()
    for q in queries:
        list(side.best(q, 0.9) for side in matching._sides(names))
    assert len(calls) < 10 * len(queries)


def test_caches_and_dirty_keys(spark):
    asked = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, q int")
    hits, misses = incremental.answered(asked, spark.createDataFrame([("a", "yes")], "k string, r string"), "k")
    assert [tuple(r) for r in hits.collect()] == [("a", 1, "yes")] * 2 and {r["k"] for r in misses.collect()} == {"b", None}
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (4, None)], "k int, v string")
    dirty = incremental.dirty_if_different(old, new, "k", ["v"])
    assert {r["k"] for r in dirty.collect()} == {3, 4}
    now, later = incremental.split_dirty(dirty, old, "k")
    assert [r["k"] for r in now.collect()] == [3] and [r["k"] for r in later.collect()] == [4]


def test_gaps_profiles_and_scores(spark):
    n = spark.createDataFrame([(x,) for x in (1, 2, 2, 5, 12, 31, None)], "k long")
    for block in (4, 10, 100):
        assert {tuple(r) for r in pages.number_gaps(n, "k", block).collect()} == {(3, 4), (6, 11), (13, 30)}
    assert pages.number_gaps(n.filter("false"), "k").count() == 0
    h = spark.createDataFrame([("Date :", "u2", 2), ("date", "u1", 1), (" ", "u", 3), (None, "u", 4)], "h string, u string, o int")
    assert [tuple(r) for r in rollups.header_profile(h, "h", "u", "o").collect()] == [("date", 2, "date", "u1")]
    g = spark.createDataFrame([("f", ["all reco", "rds heldHere", "x"]), ("f", ["Journalist", "all records", None]), ("g", [None])], "f string, c array<string>")
    assert {r["f"]: (r["n_cells"], r["split_word_rate"], r["run_together_rate"]) for r in grids.text_scores(g, "f", "c").collect()} == {"f": (5, 0.4, 0.2), "g": (0, 1.0, 1.0)}
    roles = spark.createDataFrame([("f", [f"A/{i}", "2024-01-01" if i else "55", "n/a"]) for i in range(6)], "f string, c array<string>")
    got = grids.role_scores(roles, "f", "c", {0: "code", 1: "date", 2: "date"}).first()
    assert (got["role_contamination"], got["worst_role_contamination"], got["worst_column"], got["anchored_row_share"]) == (pytest.approx(1 / 12), pytest.approx(1 / 6), 1, 1.0)
