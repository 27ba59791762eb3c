"""Names to a register: exact, by rule, fuzzy; overrides; longest contained synonym."""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedgeline.runtime import stored


def keyed_match(queries: DataFrame, query_key: Column, register: DataFrame, register_key: Column, ident: str) -> DataFrame:
    """Adds match_status (exact, ambiguous, unmatched), matched_id (only if exact) and n_candidates."""
    index = register.select(register_key.alias("_k"), F.col(ident).alias("_id")).filter("_k is not null and _k <> ''").distinct()
    index = index.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_id"))
    got = queries.withColumn("_k", query_key).join(index, "_k", "left")
    status = F.when(F.col("_n") == 1, "exact").when(F.col("_n") > 1, "ambiguous").otherwise("unmatched")
    return got.withColumn("match_status", status).withColumn("matched_id", F.when(F.col("_n") == 1, F.col("_id"))).withColumn("n_candidates", F.coalesce("_n", F.lit(0))).drop("_k", "_n", "_id")


def ratio(a: str, b: str) -> float:
    """Matching-blocks similarity of two strings, query first: it is not symmetric."""
    return SequenceMatcher(None, a, b).ratio()


_CLASSES = 32


class _Names:
    """Names side by side, the shortest first: lengths, letters (position by name) as numbers of an alphabet, counts per class of letters."""

    def __init__(self, names: list[str]):
        self.names, width = names, max(1, len(names[-1]))
        self.lengths = np.fromiter(map(len, names), np.int64, len(names))
        letters = np.array(names, f"<U{width}").view(np.uint32).reshape(len(names), width)
        self.alphabet = np.unique(letters)
        self.letters = np.ascontiguousarray(np.searchsorted(self.alphabet, letters).T.astype(np.min_scalar_type(len(self.alphabet))))
        at = np.repeat(np.arange(len(names)), self.lengths) * _CLASSES + letters[np.arange(width) < self.lengths[:, None]] % _CLASSES
        counts = np.bincount(at, minlength=len(names) * _CLASSES).reshape(len(names), _CLASSES).T
        self.counts = np.ascontiguousarray(counts.astype(np.uint8 if width < 256 else np.int64))

    def near(self, query: str, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the names whose ratio to the query can reach `least`, and a bound that their ratio does not exceed.

        Matching blocks are a common subsequence, so they hold no more letters than the shorter name, the letters common to
        both, or their longest common subsequence.
        """
        size = len(query)

        def bound(common: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            return np.where(lengths + size > 0, 2.0 * common / np.maximum(lengths + size, 1), 1.0)

        at = np.flatnonzero(bound(np.minimum(self.lengths, size), self.lengths) >= least)
        if not len(at):
            return at, np.zeros(0)
        part = slice(at[0], at[-1] + 1)  # lengths rise, so that these lie together
        own = np.bincount(np.array([ord(c) % _CLASSES for c in query], np.int64), minlength=_CLASSES)
        held = np.flatnonzero(own)
        common = np.minimum(self.counts[held, part], own[held, None].clip(max=np.iinfo(self.counts.dtype).max).astype(self.counts.dtype)).sum(0, dtype=np.int64)
        at = at[0] + np.flatnonzero(bound(common, self.lengths[part]) >= least)
        if not len(at):
            return at, np.zeros(0)
        common = np.minimum(self._subsequence(query, at), self.lengths[at])
        bounds = bound(common, self.lengths[at])
        return at[bounds >= least], bounds[bounds >= least]

    def best(self, query: str, least: float) -> tuple[str | None, float]:
        """The first name of the highest ratio from `least` on, and that ratio; (None, least) without one.

        Names are scored from the highest bound on, until none is left that can reach the best ratio.
        """
        at, bounds = self.near(query, least)
        name, best = None, least
        for i in np.argsort(-bounds, kind="stable"):
            if bounds[i] < best:
                break
            other = self.names[at[i]]
            x = ratio(query, other)
            if x > best or x == best and (name is None or other < name):
                name, best = other, x
        return name, best

    def _subsequence(self, query: str, at: np.ndarray) -> np.ndarray:
        """Lengths of the longest common subsequences of the query and the names at these positions, by bits for 64 letters
        of the query at a time; of a longer query the sum over its pieces, which is no less."""
        total = np.zeros(len(at), np.int64)
        letters = self.letters[: self.lengths[at[-1]], at]
        for k in range(0, len(query), 64):
            piece = query[k : k + 64]
            masks = np.zeros(len(self.alphabet), np.uint64)
            for i, c in enumerate(piece):
                j = int(np.searchsorted(self.alphabet, ord(c)))
                if j < len(masks) and self.alphabet[j] == ord(c):
                    masks[j] |= np.uint64(1 << i)
            row = np.full(len(at), np.uint64(0xFFFFFFFFFFFFFFFF))
            for x in letters:
                met = row & masks[x]
                row = (row + met) | (row - met)
            total += np.bitwise_count(~row & np.uint64((1 << len(piece)) - 1))
        return total


def _sides(names: np.ndarray, letters: int = 2_000_000) -> Iterator[_Names]:
    """The names in parts of like length, so that a long one widens few others."""
    got: list[str] = []
    for x in sorted(names, key=len):
        if got and len(x) * (len(got) + 1) > letters:
            yield _Names(got)
            got = []
        got.append(x)
    if got:
        yield _Names(got)


def _blocks(names: DataFrame, size: int) -> DataFrame:
    """The distinct names of a column (nulls left out) as a stored table of lists of `size` names at most."""
    (column,) = names.columns
    names = stored(names.filter(F.col(column).isNotNull()).distinct(), "names")

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        for b in batches:
            held += b[column].tolist()
            while len(held) >= size:
                yield pd.DataFrame({column: [held[:size]]})
                held = held[size:]
        if held:
            yield pd.DataFrame({column: [held]})

    parts = max(1, math.ceil(names.count() / size))
    return stored(names.repartition(parts, column).mapInPandas(lists, f"{column} array<string>"), "names")


def _query_blocks(queries: DataFrame) -> DataFrame:
    return _blocks(queries.select("query"), 2000)


def _register_blocks(register: DataFrame) -> DataFrame:
    return _blocks(register.select("candidate"), 4000)


def fuzzy_candidates(queries: DataFrame, register: DataFrame, least: float) -> DataFrame:
    """All pairs (query, candidate) of distinct names that can reach the ratio, by the bounds of _Names.near(); nulls are left out.

    Blocks of queries meet blocks of the register, and a pair costs some nanoseconds where lengths or letters rule it out.
    """
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, names in zip(b["query"], b["candidate"]):
                for side in _sides(names):
                    for query in block:
                        at, _ = side.near(query, least)
                        if len(at):
                            yield pd.DataFrame({"query": query, "candidate": [side.names[i] for i in at]})

    return _query_blocks(queries).crossJoin(_register_blocks(register)).mapInPandas(pairs, "query string, candidate string")


def fuzzy_scores(pairs: DataFrame, least: float) -> DataFrame:
    """query, candidate, score for pairs whose ratio reaches least."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["score"] = [ratio(x, y) for x, y in zip(b["query"], b["candidate"])]
            yield b[b["score"] >= least]

    return pairs.mapInPandas(score, "query string, candidate string, score double")


def best_and_next(scores: DataFrame, most: int = 3) -> DataFrame:
    """The best candidates of each query, numbered by score, then name."""
    w = Window.partitionBy("query").orderBy(F.desc("score"), "candidate")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def nearest(queries: DataFrame, register: DataFrame, least: float) -> DataFrame:
    """query, candidate, score: the best candidate of each query whose ratio reaches least, by score, then name. Takes blocks of names."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for block, names in zip(b["query"], b["candidate"]):
                for side in _sides(names):
                    for query in block:
                        name, best = side.best(query, least)
                        if name is not None:
                            got.append((query, name, best))
            yield pd.DataFrame(got, columns=["query", "candidate", "score"])

    return best_and_next(queries.crossJoin(register).mapInPandas(score, "query string, candidate string, score double"), 1).drop("rank")


def best_match(queries: DataFrame, register: DataFrame, accept: float = 0.9, floor: float = 0.6) -> DataFrame:
    """query, candidate, best_score, suggestion: of each distinct query the best candidate if it reaches `accept`, else null;
    in any case the best score from `floor` on, and the candidate that has it as a suggestion. Queries without one have nulls.

    The search goes down from `accept` in steps of a tenth; a query that has a candidate at one step needs no lower one."""
    queries = stored(queries.select("query").distinct(), "names")
    names, left, found = _register_blocks(register), queries.filter("query is not null"), []
    steps = [x for x in (accept - k / 10 for k in range(10)) if x > floor + 0.05] + [floor]
    for least in steps:
        found.append(stored(nearest(_query_blocks(left), names, least), "names"))
        left = left.join(found[-1], "query", "left_anti")
        if left.isEmpty():
            break
    best = reduce(DataFrame.unionByName, found).select("query", F.col("candidate").alias("suggestion"), F.col("score").alias("best_score"))
    return queries.join(best, "query", "left").select("query", F.when(F.col("best_score") >= accept, F.col("suggestion")).alias("candidate"), "best_score", "suggestion")


def resolved(df: DataFrame, column: str, policy: str) -> DataFrame:
    """Rows whose column is resolved: `drop` leaves the others out, `fatal` raises at the first, before anything is written."""
    if policy == "fatal" and df.filter(F.col(column).isNull()).limit(1).collect():
        raise ValueError(f"{column} is unresolved in some row")
    return df.filter(F.col(column).isNotNull())


def included(register: DataFrame, directory: DataFrame, additions: DataFrame, key: str) -> DataFrame:
    """Register rows that the directory or the hand-made additions name; an addition the register lacks raises."""
    extra = additions.select(key).distinct()
    if extra.join(register.select(key), key, "left_anti").limit(1).collect():
        raise ValueError(f"an addition names a {key} that the register lacks")
    return register.join(directory.select(key).unionByName(extra).distinct(), key, "left_semi")


def crosswalk(old: DataFrame, old_key: Column, register: DataFrame, register_key: Column, ident: str, rank: list[Column] | None = None) -> DataFrame:
    """old with new_id by key. A key that several ids share is fatal; with rank, of several old rows of an id the first stays."""
    got = keyed_match(old, old_key, register, register_key, ident)
    if got.filter("match_status = 'ambiguous'").limit(1).collect():
        raise ValueError("a key stands for more than one id")
    got = got.filter("match_status = 'exact'").withColumnRenamed("matched_id", "new_id").drop("match_status", "n_candidates")
    if not rank:
        return got
    best = got.groupBy("new_id").agg(F.min(F.struct(*rank, F.struct(*old.columns).alias("_row"))).alias("_b"))
    return best.select("_b._row.*", "new_id")


def overridden(df: DataFrame, overrides: DataFrame, key: str, column: str, policy: str) -> DataFrame:
    """column after overrides (key, value): `wins` (a present override holds, also a null one),
    `fills` (only where column is null), `strict` (as `wins`, and stale or redundant ones raise)."""
    o = overrides.select(F.col(key), F.col("value").alias("_value"), F.lit(True).alias("_has"))
    if policy == "strict":
        joined = overrides.join(df.select(key, F.col(column).alias("_now")), key, "left")
        wrong = joined.withColumn("_seen", F.col("_now").isNotNull() | F.col("value").isNotNull()).filter(F.col("_now").eqNullSafe(F.col("value"))).limit(1).collect()
        if wrong or overrides.join(df, key, "left_anti").limit(1).collect():
            raise ValueError("an override is redundant or names an unknown key")
    got = df.join(o, key, "left")
    has = F.coalesce(F.col("_has"), F.lit(False))
    if policy == "fills":
        has = has & F.col(column).isNull()
    return got.withColumn(column, F.when(has, F.col("_value")).otherwise(F.col(column))).drop("_value", "_has")


def longest_contained(values: DataFrame, value_key: Column, synonyms: list[tuple[str, str]]) -> DataFrame:
    """Adds canonical: the label of the longest synonym that stands in the value at word borders.

    synonyms: (normalised synonym, label); an exact one is the longest possible. Ties go to the
    label first in order. The list is part of the plan (one expression), so rows are not joined at all.
    """
    ordered = sorted(set(synonyms), key=lambda x: (-len(x[0]), x[1], x[0]))
    padded = F.concat(F.lit(" "), F.regexp_replace(value_key, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    held = F.array(*[F.struct(F.concat(F.lit(" "), F.lit(s), F.lit(" ")).alias("s"), F.lit(label).alias("label")) for s, label in ordered])
    first = F.try_element_at(F.filter(held, lambda x: F.contains(F.col("_padded"), x["s"])), F.lit(1))
    return values.withColumn("_padded", padded).withColumn("canonical", first["label"]).drop("_padded")
