"""Ragged grids of cells to records: expressions over single rows, and counts per file.

A grid is long: one row per grid row, with file, row_no and cells (array of strings). Repairs that look at more than one
row are in grid_repairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedgeline.functions.text import clean_cell, header_key, stripped

def filled(cells: Column) -> Column:
    """The non-blank cells."""
    return F.filter(cells, lambda c: c.isNotNull() & (stripped(c) != ""))


def cleaned(cells: Column, file_type: str = "") -> Column:
    return F.transform(cells, lambda c: clean_cell(c, file_type))


def is_letter_row(cells: Column) -> Column:
    """The column letters of a sheet (A, B, C ...), two or more."""
    upper = F.transform(filled(cells), lambda c: F.upper(stripped(c)))
    return (F.size(upper) >= 2) & F.forall(F.zip_with(upper, F.sequence(F.lit(1), F.size(upper)), lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: x["c"] == F.chr(x["i"] + 64))


def is_header_row(cells: Column, known: list[str]) -> Column:
    """Two or more cells are known headers."""
    return F.size(F.filter(filled(cells), lambda c: header_key(c).isin(known))) >= 2


def canonical_header(c: Column, synonyms: dict[str, str]) -> Column:
    """The canonical column of a header: as it stands, without a closing time stamp or year, or by its first known part between slashes."""
    table = F.create_map(*[F.lit(x) for pair in sorted(synonyms.items()) for x in pair])
    look = lambda k: F.try_element_at(table, k)
    key = header_key(c)
    untimed = header_key(F.regexp_replace(key, r" [0-9]{4}-[0-9]{2}-[0-9]{2}[t ][0-9:]+$", ""))
    undated = header_key(F.regexp_replace(key, r"[ (-]*(19|20)[0-9]{2}\)?$", ""))
    parts = F.filter(F.transform(F.split(key, "/"), lambda p: look(F.trim(p))), lambda x: x.isNotNull())
    return F.coalesce(look(key), F.when(untimed != key, look(untimed)).when(undated != key, look(undated)).when(key.contains("/"), F.try_element_at(parts, F.lit(1))))


def realigned(cells: Column, width: Column, spacer: Column) -> Column:
    """A row brought to the header's width; null if it can't be told how.

    One cell short: a null is put in at the spacer column, if there is one. One too long: the
    first blank cell goes. Longer: if the filled cells are as many as the headers, these alone.
    Shorter rows end in nulls.
    """
    n = F.size(cells)
    first_blank = F.array_position(F.transform(cells, lambda c: F.coalesce(stripped(c), F.lit("")) == ""), F.lit(True)).cast("int")
    without = F.filter(F.zip_with(cells, F.sequence(F.lit(1), n), lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: x["i"] != first_blank)
    padded = F.slice(F.concat(cells, F.array_repeat(F.lit(None).cast("string"), F.greatest(width - n, F.lit(0)))), F.lit(1), width)
    at = F.coalesce(spacer, F.lit(0))
    inserted = F.concat(F.slice(cells, F.lit(1), at), F.array(F.lit(None).cast("string")), F.slice(cells, at + 1, F.greatest(n - at, F.lit(0))))
    return (
        F.when(n == width, cells)
        .when((n == width - 1) & spacer.isNotNull(), inserted)
        .when((n == width + 1) & (first_blank > 0), F.transform(without, lambda x: x["c"]))
        .when((n > width + 1) & (F.size(filled(cells)) == width), filled(cells))
        .when(n < width, padded)
    )


def pivoted(cells: Column, header: list[str | None]) -> Column:
    """struct of the canonical columns; of several columns of a name the first holds."""
    first = {h: i for i, h in reversed(list(enumerate(header, 1))) if h}
    return F.struct(*[F.try_element_at(cells, F.lit(i)).alias(h) for h, i in sorted(first.items(), key=lambda x: x[1])])


def cell_type(c: Column) -> Column:
    """date, number, code, text; null for blanks."""
    v = stripped(c)
    return F.when(F.coalesce(v, F.lit("")) != "", F.when(v.rlike(r"^[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}$"), "date").when(v.rlike(r"^€?[0-9][0-9,.]*$"), "number").when(v.rlike(r"^[A-Za-z]*[/ -]?[0-9][0-9A-Za-z/ -]*$"), "code").otherwise("text"))


def structure_scores(grid: DataFrame, file: str, cells: str, least_typed: int = 5) -> DataFrame:
    """Per file: modal width, share of rows of that width, share of fragments, purity of the columns' types, and their product.

    Width is up to the last filled cell. The mode is over rows with three or more filled cells, of equals
    the larger. Fragments (one or two filled cells) count only from a mode of four.
    Purity is the mean, over columns with least_typed typed cells, of the share of their most
    frequent type. All of it is counts per file and width, or per file, column and type: no file is gathered.
    """
    last = F.array_max(F.transform(F.zip_with(F.col(cells), F.sequence(F.lit(1), F.size(cells)), lambda c, i: F.when(F.coalesce(stripped(c), F.lit("")) != "", i)), lambda x: x))
    rows = grid.filter(F.size(filled(F.col(cells))) > 0).select(file, cells, F.size(filled(F.col(cells))).alias("k"), F.coalesce(last, F.lit(0)).alias("w"))
    per = rows.groupBy(file, "w").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("k") >= 3, 1)).alias("full"), F.count(F.when(F.col("k") <= 2, 1)).alias("thin"))
    mode = per.groupBy(file).agg(F.max(F.when(F.col("full") > 0, F.struct("full", "w"))).alias("m"), F.sum("n").alias("n_rows"), F.sum("thin").alias("thin"))
    same = per.join(mode.select(file, F.col("m.w").alias("mode")), file).groupBy(file).agg(F.sum(F.when(F.col("w") == F.col("mode"), F.col("n")).otherwise(0)).alias("same"))
    typed = rows.select(file, F.posexplode(cells).alias("column", "c")).withColumn("t", cell_type(F.col("c"))).filter("t is not null").groupBy(file, "column", "t").agg(F.count(F.lit(1)).alias("n"))
    purity = typed.groupBy(file, "column").agg((F.max("n") / F.sum("n")).alias("p"), F.sum("n").alias("n")).filter(F.col("n") >= least_typed).groupBy(file).agg(F.avg("p").alias("purity"))
    out = mode.join(same, file).join(purity, file, "left")
    out = out.select(file, "n_rows", F.coalesce("m.w", F.lit(0)).alias("modal_width"), (F.col("same") / F.col("n_rows")).alias("uniformity"), F.when(F.coalesce("m.w", F.lit(0)) >= 4, F.col("thin") / F.col("n_rows")).otherwise(0.0).alias("fragments"), F.coalesce("purity", F.lit(0.0)).alias("purity"))
    return out.withColumn("score", F.col("uniformity") * F.col("purity") * (1 - F.col("fragments")))


def failed_checks(scores: DataFrame, least: dict[str, float], most: dict[str, float]) -> DataFrame:
    """Adds failed_checks: the names of figures below their least or above their most value."""
    bad = [F.when(F.col(c) < v, F.lit(c)) for c, v in least.items()] + [F.when(F.col(c) > v, F.lit(c)) for c, v in most.items()]
    return scores.withColumn("failed_checks", F.array_compact(F.array(*bad)))


def column_by_cardinality(grid: DataFrame, file: str, cells: str, header: list[str | None]) -> DataFrame:
    """Per file and canonical column the grid column that holds it: the one with most distinct values, then the first."""
    names = F.create_map(*[x for i, h in enumerate(header) if h for x in (F.lit(i), F.lit(h))])
    v = grid.select(file, F.posexplode(cells).alias("column", "c")).withColumn("canonical", F.try_element_at(names, F.col("column"))).withColumn("v", F.lower(stripped(F.col("c")))).filter("canonical is not null")
    n = v.groupBy(file, "canonical", "column").agg(F.countDistinct(F.nullif("v", F.lit(""))).alias("n_distinct"))
    w = Window.partitionBy(file, "canonical").orderBy(F.desc("n_distinct"), "column")
    return n.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


# What a value can be, in the order in which kinds are looked for, and placeholders that are no value at all.
KINDS = ["date", "number", "code"]
NO_VALUES = ["n/a", "na", "nil", "none", "tbc", "-", "–", "—"]
# Short words that may end or begin a cell.
SHORT_WORDS = ["a", "an", "the", "of", "to", "for", "and", "or", "in", "on", "re", "by", "at", "is", "it", "as", "be", "no", "mr", "ms", "dr", "ltd", "na", "sec", "all", "any", "its"]


def cell_breaks(cells: Column) -> Column:
    """How many words of a row are broken by a column's border: a cell ends and the next begins in letters, small ones there, and a part of at most
    three letters on one side is no short word."""
    pairs = F.zip_with(F.slice(cells, F.lit(1), F.greatest(F.size(cells) - 1, F.lit(0))), F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))), lambda a, b: F.struct(F.lower(F.regexp_extract(a, r"([A-Za-z]+)\z", 1)).alias("a"), F.regexp_extract(b, "^([a-z]+)", 1).alias("b")))
    stub = lambda w: (F.length(w) <= 3) & ~w.isin(SHORT_WORDS)
    return F.size(F.filter(pairs, lambda p: (F.coalesce(p["a"], F.lit("")) != "") & (F.coalesce(p["b"], F.lit("")) != "") & (stub(p["a"]) | stub(p["b"]))))


def run_together(cells: Column) -> Column:
    """How many words of a row run into each other: a small letter before a capital that goes on in small ones."""
    return F.aggregate(F.transform(cells, lambda c: F.coalesce(F.regexp_count(c, F.lit(r"[a-z]{2}[A-Z][a-z]")), F.lit(0))), F.lit(0), lambda a, x: a + x)


def text_scores(grid: DataFrame, file: str, cells: str) -> DataFrame:
    """Per file: filled cells, and the rates of broken and run-together words among them."""
    c = F.col(cells)
    return grid.groupBy(file).agg(F.sum(F.size(filled(c))).alias("n_cells"), F.sum(cell_breaks(c)).alias("_b"), F.sum(run_together(c)).alias("_r")).select(
        file, "n_cells", F.coalesce(F.col("_b") / F.nullif("n_cells", F.lit(0)), F.lit(1.0)).alias("split_word_rate"), F.coalesce(F.col("_r") / F.nullif("n_cells", F.lit(0)), F.lit(1.0)).alias("run_together_rate")
    )


def foreign_kind(c: Column, own: str) -> Column:
    """The kind that a cell has instead of the column's own; null if it has that, is plain text, or no value."""
    kind = cell_type(c)
    return F.when(kind.isin(KINDS) & (kind != own) & ~F.lower(stripped(c)).isin(NO_VALUES), kind)


def role_scores(grid: DataFrame, file: str, cells: str, roles: dict[int, str], least: int = 5) -> DataFrame:
    """Per file: the share of foreign cells over columns with a role (0-based column -> kind), the worst such column with its share, and
    the share of rows that an anchor (a date or code column) holds a value of its kind for. Columns with fewer than `least` values are not judged."""
    kinds = F.create_map(*[x for i, k in sorted(roles.items()) for x in (F.lit(i), F.lit(k))])
    v = grid.select(file, F.posexplode(cells).alias("column", "c")).withColumn("own", F.try_element_at(kinds, F.col("column"))).filter(F.col("own").isNotNull() & (F.coalesce(stripped(F.col("c")), F.lit("")) != "") & ~F.lower(stripped(F.col("c"))).isin(NO_VALUES))
    foreign = F.lit(None)
    for k in sorted(set(roles.values())):
        foreign = F.when(F.col("own") == k, foreign_kind(F.col("c"), k)).otherwise(foreign)
    per = v.groupBy(file, "column").agg(F.count(F.lit(1)).alias("n"), F.count(foreign).alias("k")).filter(F.col("n") >= least)
    worst = per.groupBy(file).agg((F.sum("k") / F.sum("n")).alias("role_contamination"), F.max(F.struct((F.col("k") / F.col("n")).alias("s"), (-F.col("column")).alias("c"))).alias("_w"))
    anchors = [F.coalesce(cell_type(F.get(F.col(cells), F.lit(i))) == k, F.lit(False)) for i, k in roles.items() if k in ("date", "code")]
    anchored = F.exists(F.array(*anchors), lambda x: x) if anchors else F.lit(None).cast("boolean")
    rows = grid.groupBy(file).agg(F.avg(anchored.cast("int")).alias("anchored_row_share"))
    return rows.join(worst, file, "left").select(file, "role_contamination", F.col("_w.s").alias("worst_role_contamination"), (-F.col("_w.c")).alias("worst_column"), "anchored_row_share")
