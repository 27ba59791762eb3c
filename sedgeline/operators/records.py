"""Attribution, segmentation, row repairs, greedy matching and evaluation."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attributed(observations: DataFrame, declared: DataFrame, key: str, reference: str, owner: str, year: Column | None = None) -> DataFrame:
    """Each observation with the one owner among its listed ones that declares its reference.

    observations: key, reference and the array `owners`; declared: owner, reference and `year`. Of several, the one of the
    given year; else error `ambiguous`; of none, `undeclared`.
    """
    listed = observations.select(key, F.col(reference).alias("_ref"), *([year.alias("_year")] if year is not None else []), F.explode("owners").alias("_owner"))
    d = declared.select(F.col(owner).alias("_owner"), F.col(reference).alias("_ref"), *(["year"] if year is not None else [])).distinct()
    hit = listed.join(d, ["_owner", "_ref"])
    same = F.col("_year") == F.col("year") if year is not None else F.lit(False)
    n = hit.groupBy(key).agg(F.countDistinct("_owner").alias("_n"), F.min("_owner").alias("_one"), F.countDistinct(F.when(same, F.col("_owner"))).alias("_ny"), F.min(F.when(same, F.col("_owner"))).alias("_oney"))
    j = observations.join(n, key, "left")
    return j.withColumn(owner, F.when(F.col("_n") == 1, F.col("_one")).when(F.col("_ny") == 1, F.col("_oney"))).withColumn("error", F.when(F.col("_n").isNull(), "undeclared").when((F.col("_n") > 1) & ~(F.col("_ny") == 1), "ambiguous")).drop("_n", "_one", "_ny", "_oney")


def first_report(reports: DataFrame, key: str, at: str, order: str) -> DataFrame:
    """The earliest report of each key (ties by the order column)."""
    return reports.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(at, order))).filter("_r = 1").drop("_r")


def sections_of(pages: DataFrame, sections: DataFrame, page: str = "page") -> DataFrame:
    """Each page-bound item with the innermost section that spans its page.

    sections: document, section, level, first_page, last_page. Sections are exploded to their pages, so the
    range join is an equality join.
    """
    spans = sections.select("document", "section", "level", F.explode(F.sequence("first_page", "last_page")).alias(page))
    inner = spans.groupBy("document", page).agg(F.max_by("section", F.struct("level", "section")).alias("section"))
    return pages.join(inner, ["document", page], "left")


def dual_resolved(rows: DataFrame, aliases: DataFrame, prefixes: DataFrame, heading: Column, code: Column) -> DataFrame:
    """Adds recipient and error: heading and code must agree; a code alone counts only if its prefix is one recipient's.

    aliases: alias, recipient; prefixes: prefix, recipient.
    """
    a = aliases.select(F.col("alias").alias("_a"), F.col("recipient").alias("_by_heading"))
    p = prefixes.groupBy(F.col("prefix").alias("_p")).agg(F.collect_set("recipient").alias("_by_code"))
    j = rows.withColumn("_a", heading).withColumn("_p", F.upper(F.regexp_extract(code, r"^([A-Za-z]+)", 1))).join(a, "_a", "left").join(p, "_p", "left")
    agree = F.array_contains("_by_code", F.col("_by_heading"))
    lone = (F.col("_by_heading").isNull()) & (F.size("_by_code") == 1)
    error = F.when(agree | lone, None).when(F.col("_by_heading").isNull() & F.col("_by_code").isNull(), "unresolved").when(F.col("_by_heading").isNull(), "shared_prefix").when(F.col("_by_code").isNull(), "unknown_prefix").otherwise("conflict")
    return j.withColumn("recipient", F.when(agree, F.col("_by_heading")).when(lone, F.col("_by_code")[0])).withColumn("error", error).drop("_a", "_p", "_by_heading", "_by_code")


def row_repairs(rows: DataFrame, repairs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows after repairs (keys, action `set` or `drop`, value): set values replace, dropped rows go."""
    r = repairs.select(*keys, F.col("action").alias("_action"), F.col("value").alias("_value"))
    j = rows.join(r, keys, "left").filter(F.coalesce(F.col("_action"), F.lit("")) != "drop")
    return j.withColumn(value, F.when(F.col("_action") == "set", F.col("_value")).otherwise(F.col(value))).drop("_action", "_value")


def segments(rows: DataFrame, document: str, order: str, kind: str) -> DataFrame:
    """Adds section_no and block_no from row kinds: `heading` opens a section (a repeat of the open one does not),
    `item` opens one if none is open, `anchor` closes the block, and an anchor straight after an anchor closes the section.

    Blank and footnote rows count for nothing. As running counts over each document's rows: a
    section begins at a heading other than the last, or at the first item after a closing anchor.
    """
    w = Window.partitionBy(document).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    counts = F.col(kind).isin("heading", "item", "anchor")
    d = rows.withColumn("_kind", F.when(counts, F.col(kind)))
    d = d.withColumn("_prev", F.last("_kind", ignorenulls=True).over(before)).withColumn("_head", F.last(F.when(F.col(kind) == "heading", F.col("label")), ignorenulls=True).over(before))
    closed = F.coalesce((F.col("_kind") == "anchor") & (F.col("_prev") == "anchor"), F.lit(False))
    d = d.withColumn("_closed", F.last(F.when(F.col("_kind").isNotNull(), closed), ignorenulls=True).over(before))
    opens = F.when((F.col("_kind") == "heading") & (F.coalesce(F.col("label") != F.col("_head"), F.lit(True)) | F.coalesce("_closed", F.lit(True))), 1).when((F.col("_kind") == "item") & F.coalesce("_closed", F.col("_prev").isNull()), 1).otherwise(0)
    d = d.withColumn("section_no", F.sum(opens).over(upto))
    ends = F.coalesce((F.col("_kind") == "anchor"), F.lit(False)).cast("int")
    inner = Window.partitionBy(document, "section_no").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return d.withColumn("block_no", F.coalesce(F.sum(ends).over(inner), F.lit(0))).drop("_kind", "_prev", "_head", "_closed")


def token_iou(a: str, b: str) -> float:
    x, y = set(re.findall(r"\w+", a.lower())), set(re.findall(r"\w+", b.lower()))
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def greedy_matches(gold: list[str], predicted: list[str], least: float = 0.8) -> list[tuple[int, int]]:
    """In the order of gold, each takes its best free prediction with enough overlap, the first of equals."""
    free, out = list(range(len(predicted))), []
    for g, text in enumerate(gold):
        best = max(free, key=lambda k: (token_iou(text, predicted[k]), -k), default=None)
        if best is not None and token_iou(text, predicted[best]) >= least:
            out.append((g, best))
            free.remove(best)
    return out


def matched_per_file(gold: DataFrame, predicted: DataFrame, file: str, least: float = 0.8) -> DataFrame:
    """Per file: gold, predicted and matched texts. Both hold file, seq, text; a file is matched in one task."""
    kind = gold.schema[file].dataType.simpleString()

    def run(key: tuple, g: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        n = len(greedy_matches(list(g.sort_values("seq")["text"]), list(p.sort_values("seq")["text"]), least))
        return pd.DataFrame({file: [key[0]], "n_gold": [len(g)], "n_predicted": [len(p)], "n_matched": [n]})

    return gold.groupBy(file).cogroup(predicted.groupBy(file)).applyInPandas(run, f"{file} {kind}, n_gold int, n_predicted int, n_matched int")


def precision_recall(counts: DataFrame) -> DataFrame:
    """Micro precision, recall and F1 of matched_per_file()."""
    s = counts.agg(*[F.sum(c).alias(c) for c in ("n_gold", "n_predicted", "n_matched")])
    return s.withColumn("precision", F.col("n_matched") / F.nullif("n_predicted", F.lit(0))).withColumn("recall", F.col("n_matched") / F.nullif("n_gold", F.lit(0))).withColumn("f1", 2 * F.col("n_matched") / F.nullif(F.col("n_predicted") + F.col("n_gold"), F.lit(0)))


def latest_period(df: DataFrame, period: str) -> str:
    """The greatest `Qn yyyy`; any other value raises."""
    t = df.select(F.col(period).alias("p")).agg(F.count(F.when(~F.coalesce(F.col("p").rlike("^Q[1-4] [0-9]{4}$"), F.lit(False)), 1)).alias("bad"), F.max(F.when(F.col("p").rlike("^Q[1-4] [0-9]{4}$"), F.struct(F.right(F.col("p"), F.lit(4)).alias("y"), "p"))).alias("m")).first()
    if t["bad"] or t["m"] is None:
        raise ValueError(f"{t['bad']} values of {period} are no quarter")
    return t["m"]["p"]
