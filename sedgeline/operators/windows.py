"""Ordered scans as windows: fills, islands, clusters, intervals, ownership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filled_forward(value: Column, group: list[str], order: list[str]) -> Column:
    """The last non-null value so far in the group."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def clusters(df: DataFrame, group: list[str], at: Column, gap: Column, order: list[str], name: str) -> DataFrame:
    """Numbers the runs of a group in which neighbours are at most `gap` apart, from 1."""
    w = Window.partitionBy(*group).orderBy(*order)
    fresh = F.coalesce((at - F.lag(at).over(w)) > gap, F.lit(True)).cast("int")
    return df.withColumn("_new", fresh).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def islands(df: DataFrame, group: list[str], number: str) -> DataFrame:
    """Runs of consecutive distinct numbers per group: first, last, length."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(number))
    d = df.select(*group, number).distinct().withColumn("_i", F.col(number) - n)
    return d.groupBy(*group, "_i").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count(F.lit(1)).alias("length")).drop("_i")


def interval_ends(df: DataFrame, group: list[str], start: str, level: str, order: list[str], levels: list[int]) -> DataFrame:
    """Adds interval_end: the start of the next row of the same or a higher level (a smaller number)."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    end = F.lit(None)
    for k in levels:
        end = F.when(F.col(level) == k, F.first(F.when(F.col(level) <= k, F.col(start)), ignorenulls=True).over(w)).otherwise(end)
    return df.withColumn("interval_end", end)


def level_parents(df: DataFrame, group: list[str], node: str, level: str, order: list[str], levels: list[int]) -> DataFrame:
    """Adds parent: the last row before with a higher level (a smaller number)."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parent = F.lit(None)
    for k in levels:
        parent = F.when(F.col(level) == k, F.last(F.when(F.col(level) < k, F.col(node)), ignorenulls=True).over(w)).otherwise(parent)
    return df.withColumn("parent", parent)


def owned(items: DataFrame, boundaries: DataFrame, group: list[str], at: str, owner: str) -> DataFrame:
    """Each item with the owner of the last boundary at or before it, null if none.

    One union and one window per group: an as-of join without a range join. At equal positions
    boundaries come first, of several the greatest owner holds.
    """
    b = boundaries.select(*group, F.col(at), F.lit(0).alias("_kind"), F.col(owner).alias("_owner"))
    i = items.withColumn("_kind", F.lit(1)).withColumn("_owner", F.lit(None).cast(b.schema["_owner"].dataType))
    w = Window.partitionBy(*group).orderBy(at, "_kind", "_owner").rowsBetween(Window.unboundedPreceding, 0)
    both = i.unionByName(b, allowMissingColumns=True)
    return both.withColumn(owner, F.last("_owner", ignorenulls=True).over(w)).filter("_kind = 1").drop("_kind", "_owner")
