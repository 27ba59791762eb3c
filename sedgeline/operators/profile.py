"""Column profiles by character-class masks, and what breaks or moves between loads.

A value is generalised to a mask: a run of capitals becomes `A`, of other letters `a`, each
digit `9`, white space one blank; other characters stay. Long texts have a mask of their form,
without lengths. The most frequent mask of a column is its mined pattern; what departs from it
is a violation. Everything after the first aggregation works on counts, not on rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedgeline.runtime import stored

EPS = 1e-9


@dataclass(frozen=True)
class Checks:
    """From which shares and ratios on a load has a finding; the defaults are those of problem 2.

    pattern_break holds one share per kind of column. earliest: dates before it are out of range.
    """

    blank_shift: float = 0.20
    date_pattern_break: float = 0.30
    code_pattern_break: float = 0.15
    range_break: float = 0.05
    top_share_shift: float = 0.25
    length_ratio: float = 1.5
    earliest: str = "1998-01-01"


def mask(c: Column) -> Column:
    """The character-class mask of a value; null stays null."""
    out = F.regexp_replace(c, r"\p{Nd}", "9")
    out = F.regexp_replace(out, r"[\p{Lu}\p{Lt}]+", "A")
    out = F.regexp_replace(out, r"[\p{L}&&[^A]]+", "a")
    return F.regexp_replace(out, r"\s+", " ")


def form_mask(c: Column) -> Column:
    """For long texts: the mask without lengths. A run of digits becomes one `9`, white space with a line
    break `¶`, and words of one form in a row (small, capital, capitalised, digits) count as one."""
    out = F.regexp_replace(c, r"\p{Nd}+", "9")
    out = F.regexp_replace(out, r"[\p{Lu}\p{Lt}]+", "A")
    out = F.regexp_replace(out, r"[\p{L}&&[^A]]+", "a")
    out = F.regexp_replace(out, r"\s*[\r\n]\s*", "¶")
    out = F.regexp_replace(out, r"\s+", " ")
    for form in ("a", "A", "9", "Aa"):
        out = F.regexp_replace(out, rf"\b{form}( {form})+\b", form)
    return out


def blank(c: Column) -> Column:
    """Null, empty or spaces only."""
    return c.isNull() | (F.trim(c) == "")


def real_date(c: Column) -> Column:
    """The day of a value written yyyy-mm-dd that exists in the calendar, else null."""
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c.try_cast("date"))


def value_counts(rows: DataFrame, keys: list[str], columns: Mapping[str, str], loaded_at: str, texts: str = "value", checks: Checks = Checks()) -> DataFrame:
    """Counts per keys, column and value, with the mask of each value.

    columns maps each profiled column to its kind: `date`, `code` or `text`. Dates and codes are counted by
    value; their masks are worked out once per distinct value, behind the shuffle. A text never
    travels: texts="value" counts it by 128 bits of hash, with its length and, for a mask, `9` if it holds a digit, and adds per keys
    the least and greatest text as rows of n = 0; texts="form" counts forms, texts="length" lengths alone.

    One row of the input becomes one per column; the map side combines equal ones, so a load or value with
    a third of all rows reaches the shuffle as a few rows per task. Null and blank cells are
    counted as blank, null keys are a group of their own (load_findings() leaves it out), repeated
    rows count as often as they occur, texts count in full length, an empty table gives no
    rows, and columns that are not named here are ignored, whatever they are called.
    """
    day, names = F.to_date(F.col(loaded_at)), list(columns)
    null = lambda kind: F.lit(None).cast(kind)
    cells = []
    for i, name in enumerate(names):
        v, text = F.col(name).cast("string"), columns[name] == "text"
        held = F.when(~blank(v), v)
        out = F.lit(0)
        if columns[name] == "date":
            out = (~blank(v) & F.coalesce((real_date(v) < F.lit(checks.earliest).cast("date")) | (real_date(v) > day), F.lit(False))).cast("int")
        hashed = F.when(held.isNotNull(), F.struct(F.xxhash64(held).alias("a"), F.xxhash64(held, F.lit(name)).alias("b")))
        cells.append(F.struct(
            F.lit(i).alias("_no"), blank(v).alias("is_blank"), (null("string") if text else held).alias("value"),
            (hashed["a"] if text and texts == "value" else null("bigint")).alias("_a"), (hashed["b"] if text and texts == "value" else null("bigint")).alias("_b"),
            (form_mask(held) if text and texts == "form" else F.when(held.rlike(r"\p{Nd}"), "9") if text and texts == "value" else null("string")).alias("_form"), (F.length(held) if text and texts != "form" else null("int")).alias("_len"), out.alias("_out"),
        ))
    at = lambda of: F.element_at(F.array(*[F.lit(x) for x in of]), F.col("_no") + 1)
    length = F.coalesce(F.col("_len"), F.length("value"), F.lit(0)).cast("bigint")
    counted = rows.select(*keys, F.inline(F.array(*cells))).groupBy(*keys, "_no", "is_blank", "value", "_a", "_b", "_form", "_len").agg(F.count(F.lit(1)).alias("n"), F.sum("_out").alias("n_outside"))
    kind = at(columns.values())
    shape = F.when(kind == "text", F.col("_form")).otherwise(mask(F.col("value"))).alias("mask")
    out = counted.select(*keys, at(names).alias("column_name"), kind.alias("kind"), "is_blank", "value", shape, "n", "n_outside", (F.col("n") * length).alias("len"), length.alias("least_len"), length.alias("most_len"))
    long = [c for c in names if columns[c] == "text"] if texts == "value" else []
    if not long:
        return out
    ends = [f(F.when(~blank(F.col(c).cast("string")), F.col(c).cast("string"))).alias(f"_{w}{i}") for i, c in enumerate(long) for w, f in (("least", F.min), ("most", F.max))]
    ranges = rows.groupBy(*keys).agg(*ends).select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.array(f"_least{i}", f"_most{i}").alias("_ends")) for i, c in enumerate(long)])))
    ranges = ranges.select(*keys, "column_name", F.explode("_ends").alias("value")).filter("value is not null")
    zero = F.lit(0).cast("bigint")
    return out.unionByName(ranges.select(*keys, "column_name", F.lit("text").alias("kind"), F.lit(False).alias("is_blank"), "value", null("string").alias("mask"), zero.alias("n"), zero.alias("n_outside"), zero.alias("len"), null("bigint").alias("least_len"), null("bigint").alias("most_len")))


def mined_patterns(counts: DataFrame) -> DataFrame:
    """column_name, pattern: the most frequent mask of each column over all its loads, of equals the greatest."""
    m = counts.filter(~F.col("is_blank") & (F.col("n") > 0)).groupBy("column_name", "mask").agg(F.sum("n").alias("n"))
    return m.groupBy("column_name").agg(F.max_by("mask", F.struct("n", "mask")).alias("pattern"))


def column_profile(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys and column: rows, blanks, distinct values, ranges and the figures that the checks use.

    counts as value_counts() gives them. n_off_pattern counts the values that depart from the mined pattern of
    their column: dates whose mask is another or that are no day of the calendar; codes with a
    digit where the pattern has none. Texts have no such rule, only masks.
    """
    by, filled = [*keys, "column_name", "kind"], ~F.col("is_blank")
    real = real_date(F.col("value")).isNotNull()
    digit = F.coalesce(F.col("mask").contains("9") & F.col("value").rlike("[0-9]"), F.lit(False))
    n_if = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    per_mask = stored(counts.groupBy(*by, "is_blank", "mask").agg(  # one row per mask: from here on it is small
        F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, F.lit(1))).alias("n_distinct"), F.min("value").alias("least_value"), F.max("value").alias("greatest_value"),
        n_if(real).alias("n_real_dates"), n_if(digit).alias("n_digit"), F.sum("n_outside").alias("n_outside"), F.max("n").alias("n_top"),
        F.sum("len").alias("sum_len"), F.min("least_len").alias("least_len"), F.max("most_len").alias("most_len"),
    ))
    off = (
        F.when(F.col("kind") == "date", F.when(F.col("mask") == F.col("pattern"), F.col("n") - F.col("n_real_dates")).otherwise(F.col("n")))
        .when((F.col("kind") == "code") & ~F.col("pattern").contains("9"), F.col("n_digit"))
        .otherwise(0)
    )
    of = lambda f, c: f(F.when(filled, F.col(c)))
    none = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return per_mask.join(mined_patterns(per_mask), "column_name", "left").groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        n_if(F.col("is_blank")).alias("n_blank"),
        n_if(filled).alias("n_values"),
        none(of(F.sum, "n_distinct")).alias("n_distinct"),
        F.min("least_value").alias("least_value"),
        F.max("greatest_value").alias("greatest_value"),
        none(of(F.sum, "n_real_dates")).alias("n_real_dates"),
        n_if(filled & F.col("mask").contains("9")).alias("n_with_digit"),
        none(F.sum(F.when(filled, off))).alias("n_off_pattern"),
        F.sum("n_outside").alias("n_outside"),
        none(of(F.max, "n_top")).alias("n_top"),
        F.sum("sum_len").alias("sum_len"),
        of(F.min, "least_len").alias("least_len"),
        of(F.max, "most_len").alias("most_len"),
    )


def load_findings(profile: DataFrame, feed: str, load: str, checks: Checks = Checks()) -> DataFrame:
    """Findings of each load, alone or against the load numbered one less in its feed.

    Shares are over non-blank values (blank_shift: over rows); a share of nothing gives no
    finding. Rows without feed or load number are left out. Of equally frequent values any has the
    same share, so ties do not matter. An empty profile gives no findings.
    """
    w = Window.partitionBy(feed, "column_name").orderBy(load)
    p = profile.filter(F.col(feed).isNotNull() & F.col(load).isNotNull())
    p = p.withColumn("_b", F.when(F.lag(load).over(w) == F.col(load) - 1, F.lag(F.struct("n_rows", "n_blank", "n_values", "n_top", "sum_len")).over(w)))
    share = lambda a, n: F.col(a) / F.nullif(F.col(n), F.lit(0))
    moved = lambda a, n, by: F.abs(share(a, n) - share(f"_b.{a}", f"_b.{n}")) >= by - EPS
    ratio = share("sum_len", "n_values") / share("_b.sum_len", "_b.n_values")
    column = lambda *kinds: F.col("kind").isin(*kinds)
    broken = F.when(column("date"), F.lit(checks.date_pattern_break)).when(column("code"), F.lit(checks.code_pattern_break))
    found = {
        "blank_shift": moved("n_blank", "n_rows", checks.blank_shift),
        "pattern_break": share("n_off_pattern", "n_values") >= broken - EPS,
        "range_break": column("date") & (share("n_outside", "n_real_dates") >= checks.range_break - EPS),
        "top_share_shift": column("date", "code") & moved("n_top", "n_values", checks.top_share_shift),
        "length_shift": column("text") & ((ratio >= checks.length_ratio - EPS) | (ratio <= 1 / checks.length_ratio + EPS)),
    }
    return p.select(F.col(feed), F.col(load), "column_name", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in found.items()]))).alias("finding"))


def mask_drift(counts: DataFrame, feed: str, load: str, rare_share: float = 0.01) -> DataFrame:
    """Per load and column: dominant mask and its share, values with a rare mask, and the
    Jensen-Shannon divergence (base 2, 0 to 1) of its masks from those of the load before.

    A mask is rare when it holds less than rare_share of the column's values in that load.
    Of equally frequent masks the greatest is called dominant. Without a load before, the
    divergence is 0; a load without values has no row.
    """
    by = [feed, load, "column_name"]
    m = counts.filter((F.col("n") > 0) & ~F.col("is_blank") & F.col(feed).isNotNull() & F.col(load).isNotNull()).groupBy(*by, "mask").agg(F.sum("n").alias("n"))
    total = m.groupBy(*by).agg(F.sum("n").alias("_all"), F.max_by("mask", F.struct("n", "mask")).alias("dominant_mask"), F.max("n").alias("_most"))
    share = m.join(total, by).withColumn("p", F.col("n") / F.col("_all"))
    before = share.select(feed, (F.col(load) + 1).alias(load), "column_name", "mask", F.col("p").alias("q"))
    with_before = before.select(*by).distinct().withColumn("_had", F.lit(True))
    pq = share.select(*by, "mask", "p").join(before, [*by, "mask"], "full").fillna(0.0, ["p", "q"])
    mid = (F.col("p") + F.col("q")) / 2
    part = lambda x: F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / mid)).otherwise(0.0)
    divergence = pq.groupBy(*by).agg(F.sum((part("p") + part("q")) / 2).alias("_js")).join(with_before, by)
    rare = share.groupBy(*by).agg(F.sum(F.when(F.col("p") < rare_share, F.col("n")).otherwise(0)).alias("n_rare_mask"), F.count(F.lit(1)).alias("n_masks"))
    return (
        total.join(rare, by).join(divergence, by, "left")
        .select(*by, "dominant_mask", (F.col("_most") / F.col("_all")).alias("dominant_share"), "n_masks", "n_rare_mask", F.coalesce("_js", F.lit(0.0)).alias("divergence"))
    )


def rare_masks(per_value: DataFrame, feed: str, load: str, rare_share: float = 0.01) -> DataFrame:
    """Per load, column and rare mask: its count (n), its share and the least value of that mask.

    per_value as value_counts() gives it; rare as in mask_drift(), so n sums to its n_rare_mask. The
    form of a long text is its own example, since texts do not travel.
    """
    by = [feed, load, "column_name"]
    m = per_value.filter((F.col("n") > 0) & ~F.col("is_blank") & F.col(feed).isNotNull() & F.col(load).isNotNull()).groupBy(*by, "mask").agg(F.sum("n").alias("n"), F.coalesce(F.min("value"), "mask").alias("example"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return m.withColumn("share", F.col("n") / total).filter(F.col("share") < rare_share).select(*by, "mask", "n", "share", "example")
