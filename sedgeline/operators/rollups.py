"""Fan-in of counts, reconciliation of sums, league tables, funnels and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedgeline.functions.text import header_key
from sedgeline.operators.dedup import ranked


def status_fan_in(base: DataFrame, key: str, inputs: dict[str, DataFrame]) -> DataFrame:
    """base with, per named input, its count (n_...) and status: success, failed (seen, nothing good), not_attempted.

    inputs hold key and `good` (boolean). They are counted before they are joined, so the
    joins are one row per key each, however often a key occurs.
    """
    out = base
    for name, df in inputs.items():
        counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_all"), F.count(F.when(F.col("good"), F.lit(1))).alias("_good"))
        out = out.join(counts, key, "left")
        out = out.withColumn(f"n_{name}", F.coalesce("_good", F.lit(0))).withColumn(f"{name}_status", F.when(F.col("_good") > 0, "success").when(F.col("_all") > 0, "failed").otherwise("not_attempted")).drop("_all", "_good")
    return out


def coverage(base: DataFrame, key: str, inputs: dict[str, DataFrame]) -> DataFrame:
    """Per input: keys of the base that it covers, that it lacks, and its own keys the base lacks."""
    keys = base.select(key).distinct().withColumn("_base", F.lit(True))
    parts = None
    for name, df in inputs.items():
        seen = df.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("_seen", F.lit(True))
        both = keys.join(seen, key, "full")
        part = both.agg(F.count(F.when(F.col("_base") & F.col("_seen"), 1)).alias("n_covered"), F.count(F.when(F.col("_base") & F.col("_seen").isNull(), 1)).alias("n_missing"), F.count(F.when(F.col("_base").isNull(), 1)).alias("n_orphans")).select(F.lit(name).alias("input"), "*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def reconciled(items: DataFrame, declared: DataFrame, key: str, measure: str, total: str, tolerance: float = 0.005) -> DataFrame:
    """Declared totals against the sum of their items: extracted, delta, withheld (no item, no total or a difference)."""
    sums = items.groupBy(key).agg(F.sum(F.col(measure).cast("decimal(18,2)")).alias("extracted"))
    both = declared.select(key, F.col(total).cast("decimal(18,2)").alias("declared")).join(sums, key, "left")
    delta = F.col("extracted") - F.col("declared")
    return both.withColumn("delta", delta).withColumn("withheld", F.coalesce(F.abs(delta) > tolerance, F.lit(True)))


def block_remainder(blocks: DataFrame, section: str, block: str, declared: str, section_total: str, extracted: str) -> DataFrame:
    """Per block: what it must hold, and whether its section or it alone is withheld.

    One block of a section may lack a declared amount: it takes what is left of the section's total. A
    negative rest, several such blocks, or declared amounts beyond the total are problems of the whole section.
    A block whose extracted sum is not the amount is withheld alone.
    """
    per = blocks.groupBy(section).agg(F.sum(F.coalesce(F.col(declared), F.lit(0))).alias("_sum"), F.count(F.when(F.col(declared).isNull(), 1)).alias("_open"), F.max(section_total).alias("_total"))
    rest = F.col("_total") - F.col("_sum")
    problem = F.when(F.col("_total").isNull(), "no_total").when(F.col("_open") > 1, "several_undeclared").when(rest < 0, "over_declared")
    out = blocks.join(per, section).withColumn("problem", problem).withColumn("amount", F.coalesce(F.col(declared), F.when(F.col("_open") == 1, rest)))
    return out.withColumn("withheld", F.col("problem").isNotNull() | ~F.coalesce(F.col("amount") == F.col(extracted), F.lit(False))).drop("_sum", "_open", "_total")


def league_table(rows: DataFrame, who: str, points: Column, period: Column, most: int = 5) -> DataFrame:
    """The first `most` by points, overall (period null) and per period; ties by name."""
    sums = rows.select(F.col(who), period.alias("period"), points.alias("_p")).rollup(who, "period").agg(F.sum("_p").alias("points")).filter(F.col(who).isNotNull())
    w = Window.partitionBy("period").orderBy(F.desc("points"), who)
    return sums.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def priority_tiers(df: DataFrame, score: str, order: list[str]) -> DataFrame:
    """Thirds by falling score: the first floor(n/3) are high, the next as many medium, the rest low.

    Rows are ranked by ranges of the score (ties by order), so neither many scores nor many rows of one score meet in one task.
    """
    third = df.count() // 3
    at = F.col("_rank")
    return ranked(df, [], [F.desc(score), *order], "_rank").withColumn("tier", F.when(at <= third, "high").when(at <= 2 * third, "medium").otherwise("low")).drop("_rank")


def header_profile(headers: DataFrame, header: str, source: str, order: str) -> DataFrame:
    """Per normalised header: how often it stands, how it is first written, and where; blank ones are left out."""
    h = headers.select(header_key(F.col(header)).alias("header_key"), F.struct(F.col(order), F.col(header).alias("raw"), F.col(source).alias("source")).alias("_at")).filter("header_key <> ''")
    return h.groupBy("header_key").agg(F.count(F.lit(1)).alias("n_headers"), F.min("_at").alias("_at")).select("header_key", "n_headers", F.col("_at.raw").alias("first_written"), F.col("_at.source").alias("first_source"))
