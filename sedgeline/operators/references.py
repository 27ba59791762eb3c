"""Referential checks: references to records that are missing, dropped or listed later."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_rows(df: DataFrame, key: str, version: str, keep: list[str]) -> DataFrame:
    """One row per non-null key: the one with the greatest version; exact ties by the kept values.

    max(struct) is combined on the map side, so a key that holds a third of all rows costs
    one row per map task. Rows with a null key are left out; a null version is the oldest.
    """
    kept = [c for c in keep if c not in (key, version)]
    best = F.max(F.struct(F.col(version), *[F.col(c) for c in kept])).alias("_best")
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key)).agg(best).select(key, "_best.*")


def reference_rows(df: DataFrame, source: str, row_key: str, fk: str, at: str) -> DataFrame:
    """The shape that faulty_references() takes: one row per non-null reference."""
    return df.filter(F.col(fk).isNotNull()).select(
        F.lit(source).alias("source_table"),
        F.col(row_key).cast("bigint").alias("row_key"),
        F.col(fk).cast("bigint").alias("fk"),
        F.col(at).alias("at"),
    )


def faulty_references(references: list[DataFrame], parents: DataFrame, key: str, listed: str, removed: str) -> DataFrame:
    """Each reference whose parent is missing, deleted at that time, or listed only later.

    The distinct keys (with the span of their times, pre-aggregated on the map side) are
    anti-joined to the parents, so that the join is over distinct keys, not rows, and a hot
    key is one row. Only keys that can be faulty are joined back to the rows.

    Null references, and rows without a key of their own, give no rows. A null time can be
    judged only for `missing`; its period is an empty string. Equal rows give one row.
    Without parents every reference is missing; without references there are no rows.
    """
    rows = reduce(DataFrame.unionByName, references)
    keys = rows.groupBy("fk").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    known = parents.select(F.col(key).cast("bigint").alias("fk"), F.col(listed).alias("listed"), F.col(removed).alias("removed"))
    missing = keys.join(known, "fk", "left_anti").select("fk", F.lit(True).alias("missing"), F.lit(None).cast(known.schema["listed"].dataType).alias("listed"), F.lit(None).cast(known.schema["removed"].dataType).alias("removed"))
    dated = keys.join(known, "fk").filter((F.col("removed") <= F.col("last_at")) | (F.col("listed") > F.col("first_at"))).select("fk", F.lit(False).alias("missing"), "listed", "removed")
    return (
        rows.join(missing.unionByName(dated), "fk")
        .withColumn("reason", F.when(F.col("missing"), "missing").when(F.col("removed") <= F.col("at"), "deleted").when(F.col("listed") > F.col("at"), "late"))
        .filter(F.col("reason").isNotNull() & F.col("row_key").isNotNull())
        .select("source_table", "row_key", month_of(F.col("at")).alias("period"), "reason")
        .distinct()
    )


def month_of(at: Column) -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM"), F.lit(""))


def fault_counts(faults: DataFrame) -> DataFrame:
    """Faulty references per table, period and reason."""
    return faults.groupBy("source_table", "period", "reason").agg(F.count(F.lit(1)).alias("n_references"))
