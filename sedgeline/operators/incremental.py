"""Recomputing only what changed: dirty keys, scoped merges, fingerprints, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged_by_key(old: DataFrame, new: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """old without the keys of the scope, and new's rows of these keys."""
    keys = scope.select(key).distinct()
    return old.join(keys, key, "left_anti").unionByName(new.join(keys, key, "left_semi"))


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones of their key; other keys stay."""
    return merged_by_key(old, new, new, key)


def recomputed(old: DataFrame, inputs: DataFrame, dirty: DataFrame, key: str, compute) -> DataFrame:
    """old with the dirty keys evicted and computed again from their inputs."""
    keys = dirty.select(key).distinct()
    return old.join(keys, key, "left_anti").unionByName(compute(inputs.join(keys, key, "left_semi")))


def fingerprint_changes(before: DataFrame, now: DataFrame, key: str, digest: str) -> DataFrame:
    """key, state: new, gone, changed or unchanged. A null digest now (the fetch failed) keeps the old one."""
    b = before.select(key, F.col(digest).alias("_b"), F.lit(True).alias("_hb"))
    n = now.select(key, F.col(digest).alias("_n"), F.lit(True).alias("_hn"))
    held = F.coalesce("_n", "_b")
    state = F.when(F.col("_hb").isNull(), "new").when(F.col("_hn").isNull(), "gone").when(held.eqNullSafe(F.col("_b")), "unchanged").otherwise("changed")
    return b.join(n, key, "full").select(key, state.alias("state"), held.alias(digest))


def due(checked_at: Column, now: Column, days: int) -> Column:
    """Whether a check is missing or older than so many days."""
    return F.coalesce(F.date_diff(now, checked_at) > days, F.lit(True))


def answered(requests: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(requests with their recorded answer, requests without one): what a cache keyed by content holds, and what must be asked.

    requests: key and its payload; cache: key and answers, one row per key. A key that is asked twice is missed once.
    """
    known = cache.select(key).distinct()
    return requests.join(cache, key), requests.join(known, key, "left_anti").dropDuplicates([key])


def split_dirty(dirty: DataFrame, ready: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(keys to recompute now, keys deferred to the next run because their inputs are not there yet)."""
    keys = dirty.select(key).filter(F.col(key).isNotNull()).distinct()
    have = ready.select(key).distinct()
    return keys.join(have, key, "left_semi"), keys.join(have, key, "left_anti")


def dirty_if_different(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys of new rows that are not there yet or differ in a column; equal rows leave their key clean."""
    o = old.select(key, F.struct(*columns).alias("_o"), F.lit(True).alias("_had"))
    return new.select(key, F.struct(*columns).alias("_n")).join(o, key, "left").filter(F.col("_had").isNull() | ~F.col("_o").eqNullSafe(F.col("_n"))).select(key).distinct()
