"""Keep-first deduplication, ordinals and stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedgeline.runtime import cut


def keep_first(df: DataFrame, keys: list[Column], order: list[str]) -> DataFrame:
    """The first row of each key in the given order, null being a key like any other.

    order must decide (end it with a unique column); of equal rows one stays. The least row of
    each key is found by min(struct), combined on the map side, so that a key that holds a
    third of all rows costs one row per map task and no group is sorted in one task.
    """
    rest = [c for c in df.columns if c not in order]
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    held = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(c) for c in order], *[F.col(c) for c in rest])
    best = df.groupBy(*named).agg(F.min(held).alias("_row"))
    return best.select(*[F.col(f"_row.{c}.v" if c in order else f"_row.{c}").alias(c) for c in df.columns])


def ranked(df: DataFrame, groups: list[str], order: list[str | Column], name: str) -> DataFrame:
    """Adds the row number within its group, in the given order, which must decide.

    Rows are range-partitioned by group and order, so that a group of any size spreads over the partitions; each partition
    numbers its own rows of a group behind those of the partitions before (a table of one row per group and partition).
    """
    ranged = cut(df.repartitionByRange(*[F.col(g) for g in groups], *order).withColumn("_part", F.spark_partition_id()))  # its borders come from a sample: made once
    counts = ranged.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    here = F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*order))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return ranged.withColumn("_here", here).join(offsets, same).select(*df.columns, (F.col("_here") + F.col("_offset")).alias(name))


def ordinal_suffix(df: DataFrame, identity: Column, order: list[str], name: str) -> DataFrame:
    """Adds `name`: the identity, from its second row on with -2, -3 and so forth in the given order."""
    got = ranked(df.withColumn("_identity", identity), ["_identity"], order, "_rank")
    return got.withColumn(name, F.when(F.col("_rank") == 1, F.col("_identity")).otherwise(F.concat_ws("-", "_identity", F.col("_rank").cast("string")))).drop("_identity", "_rank")


def sequence_ids(df: DataFrame, groups: list[str], text: str, order: list[str], prefix: str, name: str) -> DataFrame:
    """First rows of each distinct text in a group, numbered in order as prefix001, prefix002 ..."""
    first = ranked(keep_first(df, [*[F.col(g) for g in groups], F.col(text)], order), groups, order, "_rank")
    n = F.col("_rank")
    return first.withColumn(name, F.concat(F.lit(prefix), F.when(n < 1000, F.lpad(n.cast("string"), 3, "0")).otherwise(n.cast("string")))).drop("_rank")


def guarded(df: DataFrame, key: str, least: int) -> DataFrame:
    """The rows as they are, if there are enough and no key occurs twice; else it raises before anything is written."""
    n, twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.when(F.col("_n") > 1, 1))).first()
    if n < least or twice:
        raise ValueError(f"{n} rows, at least {least} wanted; {twice} keys of {key} occur more than once")
    return df


def assigned_ids(known: DataFrame, new: DataFrame, key: str, ident: str) -> DataFrame:
    """New keys with ids after the greatest known one, in the order of the key.

    The numbering is spread: keys are range-partitioned, counted per partition, and each
    partition numbers its own from its offset (a table with one row per partition).
    """
    top = known.agg(F.coalesce(F.max(ident), F.lit(0)).cast("bigint")).first()[0]
    fresh = new.select(key).filter(F.col(key).isNotNull()).distinct().join(known.select(key).distinct(), key, "left_anti")
    ranged = cut(fresh.repartitionByRange(key).withColumn("_part", F.spark_partition_id()))  # its borders come from a sample: read twice, made once
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_part", "_offset")
    n = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return ranged.withColumn("_rank", n).join(F.broadcast(offsets), "_part").select(key, (F.lit(top) + F.col("_offset") + F.col("_rank")).alias(ident))
