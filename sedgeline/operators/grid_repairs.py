"""Repairs of ragged grids as expressions over long rows: file, row_no, cells (array of strings).

A file's header is its row of the least number. Rows stay rows: what a repair must know of a file (where its header
begins, how it is shaped, which columns are empty) is counted first and joined back, so no file is ever gathered. Other
columns are dropped; rows without a file or a number, and null cells arrays, are left out; an empty grid gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedgeline.functions.dates import bound
from sedgeline.functions.text import header_key, stripped
from sedgeline.operators.grids import canonical_header, filled

KEYS = ["file", "row_no"]


@dataclass(frozen=True)
class GridRules:
    """Fixed values of the repairs. narrow: grids of fewer columns have no continuations. thin_share, full_share: a file with
    more thin rows than the one and fewer full rows than the other is meant to be so. header_rows: rows among which the header
    is looked for. header_lines: further lines a header may have. prose: letters from which a cell in a thin row is prose.
    known_next, known_instead: known columns a row must have to fill the gaps of a header, or to replace one that knows fewer than known_next."""

    narrow: int = 3
    thin_share: float = 0.5
    full_share: float = 0.1
    header_rows: int = 5
    header_lines: int = 6
    prose: int = 50
    known_next: int = 2
    known_instead: int = 3


def rows_of(grid: DataFrame) -> DataFrame:
    return grid.filter("file is not null and row_no is not null and cells is not null").select(*KEYS, "cells")


def _is_filled(c: Column) -> Column:
    return F.coalesce(stripped(c) != "", F.lit(False))


def merged_continuations(grid: DataFrame, rules: GridRules = GridRules()) -> DataFrame:
    """Rows with a single filled cell flow into the row above them, into the same column. Adds n_merged, the rows it took in.

    Not the first row under the header, not where the nearest full row above lacks the column, not in narrow grids, and in
    no file whose shape is such rows (its counts take blank strings as filled).
    """
    g = rows_of(grid)
    not_null = F.size(F.filter("cells", lambda c: c.isNotNull()))
    wide = F.size("cells") >= rules.narrow
    shape = g.groupBy("file").agg(
        F.min("row_no").alias("_header"), (F.count(F.lit(1)) - 1).alias("_n"), F.max(F.size("cells")).alias("_width"),
        F.min_by(F.struct((wide & (not_null == 1)).alias("thin"), (wide & (not_null >= 2)).alias("full")), "row_no").alias("_h"),
        F.count(F.when(wide & (not_null == 1), 1)).alias("_thin"), F.count(F.when(wide & (not_null >= 2), 1)).alias("_full"),
    )
    thin, full = F.col("_thin") - F.col("_h.thin").cast("int"), F.col("_full") - F.col("_h.full").cast("int")
    meant = (F.col("_n") > 0) & (thin > rules.thin_share * F.col("_n")) & (full < rules.full_share * F.col("_n"))
    shape = shape.select("file", "_header", (meant | (F.col("_width") < rules.narrow)).alias("_meant"))
    at = F.array_position(F.transform("cells", _is_filled), F.lit(True)).cast("int")
    order = Window.partitionBy("file").orderBy("row_no")
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    g = g.join(shape, "file").withColumn("_single", wide & (F.size(filled(F.col("cells"))) == 1)).withColumn("_at", at)
    g = g.withColumn("_second", F.row_number().over(order) == 2).withColumn("_above", F.last(F.when(~F.col("_single"), F.size("cells")), ignorenulls=True).over(above))
    flows = F.col("_single") & ~F.col("_meant") & ~F.col("_second") & (F.col("row_no") > F.col("_header")) & (F.col("_at") <= F.col("_above"))
    g = g.withColumn("_flows", F.coalesce(flows, F.lit(False)))
    g = g.withColumn("_lead", F.max(F.when(~F.col("_flows"), F.col("row_no"))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = g.filter("_flows").groupBy("file", F.col("_lead").alias("row_no"), "_at").agg(F.array_sort(F.collect_list(F.struct("row_no", F.element_at("cells", F.col("_at")).alias("c")))).alias("_p"))
    pieces = pieces.select(*KEYS, F.struct("_at", F.array_join(F.transform("_p", lambda x: x["c"]), " ").alias("text"), F.size("_p").alias("n")).alias("_p"))
    more = pieces.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("_p._at", "_p.text"))).alias("_more"), F.sum("_p.n").cast("int").alias("n_merged"))
    added = lambda c, i: F.concat_ws(" ", F.when(_is_filled(c), c), F.try_element_at("_more", i + 1))
    cells = F.when(F.col("_more").isNull(), F.col("cells")).otherwise(F.transform("cells", lambda c, i: F.when(F.try_element_at("_more", i + 1).isNull(), c).otherwise(added(c, i))))
    return g.filter("not _flows").join(more, KEYS, "left").select(*KEYS, cells.alias("cells"), F.coalesce("n_merged", F.lit(0)).alias("n_merged"))


def n_known(cells: Column, synonyms: dict[str, str]) -> Column:
    """How many canonical columns the cells of a row name."""
    names = F.filter(F.transform(F.filter(cells, lambda c: c.isNotNull()), lambda c: canonical_header(c, synonyms)), lambda c: c.isNotNull())
    return F.size(F.array_distinct(names))


def repaired_headers(grid: DataFrame, synonyms: dict[str, str], rules: GridRules = GridRules()) -> DataFrame:
    """The rows from the header on, with the header whole, under the number of its last line; rows above it go.

    The header begins at the first of the top rows with two filled cells, else at the first row. Half-empty rows under it are its
    further lines, and from the second on also rows that name a known column; their cells are added per column, but
    for half-empty rows with prose, which go. A null takes the name to its left. Nulls that remain are filled by a next row that
    names enough known columns; a next row that names many replaces a header that names hardly any.
    """
    g = rows_of(grid)
    order = Window.partitionBy("file").orderBy("row_no")
    numbered = g.withColumn("_i", F.row_number().over(order) - 1)
    start = numbered.filter(F.col("_i") < rules.header_rows).groupBy("file").agg(F.coalesce(F.min(F.when(F.size(filled(F.col("cells"))) >= 2, F.col("_i"))), F.lit(0)).alias("_start"))
    numbered = numbered.join(start, "file").filter("_i >= _start").withColumn("_i", F.col("_i") - F.col("_start"))
    nulls = F.size(F.filter("cells", lambda c: c.isNull()))
    lines = numbered.filter(F.col("_i") <= rules.header_lines + 1).withColumn("_known", n_known(F.col("cells"), synonyms)).withColumn("_thin", (F.size("cells") > 0) & (2 * nulls >= F.size("cells")))
    lines = lines.withColumn("_prose", F.col("_thin") & F.exists("cells", lambda c: F.coalesce(F.length(c) > rules.prose, F.lit(False))))
    top = lines.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("_i", "cells", "_known", "_thin", "_prose"))).alias("top"))
    null = F.array().cast("array<string>")

    def header(top: Column) -> Column:
        """struct(last, cells): the number of the header's last line below its first, and its cells."""
        further = lambda r: r["_thin"] | ((r["_i"] > 1) & (F.size(r["cells"]) > 0) & (r["_known"] > 0))
        count = lambda acc, r: F.struct((acc["n"] + (acc["open"] & further(r)).cast("int")).alias("n"), (acc["open"] & further(r)).alias("open"))
        used = F.aggregate(F.slice(top, 2, rules.header_lines), F.struct(F.lit(0).alias("n"), F.lit(True).alias("open")), count)["n"]
        return bound(used, lambda n: bound(lines_joined(top, n), lambda cells: completed(top, n, cells)))

    def lines_joined(top: Column, used: Column) -> Column:
        """The cells of the header's lines added per column; a null takes the name to its left."""
        lines = F.concat(F.slice(top, 1, 1), F.filter(F.slice(top, F.lit(2), used), lambda r: ~r["_prose"]))
        width = F.size(top[0]["cells"])
        added = lambda i: bound(F.filter(F.transform(lines, lambda r: F.get(r["cells"], i)), lambda c: c.isNotNull()), lambda p: F.when(F.size(p) > 0, F.array_join(p, " ")))
        whole = F.when(width > 0, F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), added)).otherwise(null)
        return F.aggregate(whole, null, lambda acc, c: F.concat(acc, F.array(F.coalesce(c, F.try_element_at(acc, F.lit(-1))))))

    def completed(top: Column, used: Column, cells: Column) -> Column:
        """Nulls filled, or the header replaced, by the row behind it."""
        behind = F.get(top, used + 1)
        fills = F.exists(cells, lambda c: c.isNull()) & F.coalesce(behind["_known"] >= rules.known_next, F.lit(False))
        filled_up = F.when(fills, F.transform(cells, lambda c, i: F.coalesce(c, F.get(behind["cells"], i)))).otherwise(cells)
        state = F.struct((used + fills.cast("int")).alias("last"), filled_up.alias("cells"))

        def replaced(x: Column) -> Column:
            then = F.get(top, x["last"] + 1)
            instead = (n_known(x["cells"], synonyms) < rules.known_next) & F.coalesce(then["_known"] >= rules.known_instead, F.lit(False))
            return F.when(instead, F.struct((x["last"] + 1).alias("last"), then["cells"].alias("cells"))).otherwise(x)

        return bound(state, replaced)

    h = top.select("file", header(F.col("top")).alias("_h")).select("file", F.col("_h.last").alias("_last"), F.col("_h.cells").alias("_header"))
    out = numbered.join(h, "file").filter("_i >= _last")
    return out.select(*KEYS, F.when(F.col("_i") == F.col("_last"), F.col("_header")).otherwise(F.col("cells")).alias("cells"))


def merged_pages(grid: DataFrame) -> DataFrame:
    """The tables of a file's pages (column page) as one, numbered anew from 0; a page's first row that repeats the first
    page's goes (case and surrounding blanks do not count)."""
    g = grid.filter("file is not null and page is not null and row_no is not null and cells is not null").select("file", "page", "row_no", "cells")
    same = F.transform("cells", lambda c: F.lower(stripped(F.coalesce(c, F.lit("")))))
    g = g.withColumn("_same", same)
    first = g.groupBy("file").agg(F.min_by("_same", F.struct("page", "row_no")).alias("_first"), F.min("page").alias("_page"))
    tops = g.groupBy("file", "page").agg(F.min("row_no").alias("_top"))
    g = g.join(first, "file").join(tops, ["file", "page"])
    g = g.filter(~((F.col("page") > F.col("_page")) & (F.col("row_no") == F.col("_top")) & (F.col("_same") == F.col("_first"))))
    return g.select("file", (F.row_number().over(Window.partitionBy("file").orderBy("page", "row_no")) - 1).alias("row_no"), "cells")


def pruned_columns(grid: DataFrame) -> DataFrame:
    """Without the columns that every row of a file has and none fills."""
    g = rows_of(grid)
    sizes = g.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    columns = g.select("file", F.posexplode("cells").alias("_i", "_c")).groupBy("file", "_i").agg(F.count(F.lit(1)).alias("_k"), F.max(_is_filled(F.col("_c"))).alias("_any"))
    gone = columns.filter("not _any").join(sizes, "file").filter("_k = _n").groupBy("file").agg(F.collect_set("_i").alias("_gone"))
    g = g.join(gone, "file", "left")
    return g.select(*KEYS, F.when(F.col("_gone").isNull(), F.col("cells")).otherwise(F.filter("cells", lambda c, i: ~F.array_contains("_gone", i))).alias("cells"))


# How logs print a date, and a request's bare number.
DATE = r"(?:[0-9]{1,2}[/.-][0-9]{1,2}[/.-](?:[0-9]{4}|[0-9]{2})|[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2} [A-Za-z]{3,9} [0-9]{4})"
NUMBER = r"[0-9]{3,6}"


def date_and_text(c: Column) -> Column:
    """array(date, rest) of a cell that begins with a date; any other cell, and a date alone, stays whole with a null behind it."""
    form = rf"(?s)^({DATE})\s+(\S.*)$"
    v = stripped(c)
    return F.when(v.rlike(form), F.array(F.regexp_extract(v, form, 1), F.regexp_extract(v, form, 2))).otherwise(F.array(c, F.lit(None).cast("string")))


def date_and_number(c: Column) -> Column:
    """array(date, number) of a cell that holds a date, a request's number, or both in either order, a star before them aside."""
    v = F.regexp_replace(stripped(c), r"^\*\s*", "")
    two, turned, alone = rf"^({DATE})\s+({NUMBER})$", rf"^({NUMBER})\s+({DATE})$", rf"^({NUMBER})$"
    null = F.lit(None).cast("string")
    return (
        F.when(v.rlike(two), F.array(F.regexp_extract(v, two, 1), F.regexp_extract(v, two, 2)))
        .when(v.rlike(turned), F.array(F.regexp_extract(v, turned, 2), F.regexp_extract(v, turned, 1)))
        .when(v.rlike(alone), F.array(null, v))
        .otherwise(F.array(F.nullif(stripped(c), F.lit("")), null))
    )


def split_combined_columns(grid: DataFrame, combined: list[str], date_headers: list[str], names: tuple[str, str, str] = ("Date", "Description", "Reference")) -> DataFrame:
    """Columns that hold two values as two columns.

    combined: header keys of columns that hold a date and a text; they become names[0] and names[1]. date_headers: header keys of
    date columns; one in which any cell is a bare request number holds dates and numbers and gets a column names[2] behind it.
    Files without such columns stay as they are; rows that are too short for a column get no cell for it.
    """
    g = rows_of(grid)
    first = g.groupBy("file").agg(F.min("row_no").alias("_header"))
    g = g.join(first, "file")
    heads = g.filter("row_no = _header").select("file", F.posexplode("cells").alias("_i", "_h")).withColumn("_key", header_key(F.col("_h")))
    heads = heads.select("file", "_i", F.when(F.col("_key").isin(combined), "text").when(F.col("_key").isin(date_headers), "number").alias("_kind")).filter("_kind is not null")
    numbers = g.filter("row_no > _header").select("file", F.posexplode("cells").alias("_i", "_c")).filter(stripped(F.regexp_replace("_c", r"^\s*\*", "")).rlike(f"^{NUMBER}$")).select("file", "_i").distinct()
    plan = heads.join(numbers.withColumn("_seen", F.lit(True)), ["file", "_i"], "left").filter("_kind = 'text' or _seen").groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("_i", "_kind"))).alias("_plan"))
    kind = lambda i: F.try_element_at("_plan", i)
    head = lambda c, i: F.when(kind(i) == "text", F.array(F.lit(names[0]), F.lit(names[1]))).when(kind(i) == "number", F.array(c, F.lit(names[2]))).otherwise(F.array(c))
    body = lambda c, i: F.when(kind(i) == "text", date_and_text(c)).when(kind(i) == "number", date_and_number(c)).otherwise(F.array(c))
    cells = F.when(F.col("_plan").isNull(), F.col("cells")).when(F.col("row_no") == F.col("_header"), F.flatten(F.transform("cells", head))).otherwise(F.flatten(F.transform("cells", body)))
    return g.join(plan, "file", "left").select(*KEYS, cells.alias("cells"))


def mapped_columns(grid: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the grid with its cells in the order and under the names of a hand-made mapping, the mapping's errors).

    mapping: file, column (0-based), canonical. Columns may change places. Errors: file, column, error: `no_such_file`,
    `no_such_column`, `no_name`, or `named_twice` (of several columns of a name the first holds). Files without a mapping stay.
    """
    g = rows_of(grid)
    width = g.groupBy("file").agg(F.min("row_no").alias("_header"), F.max(F.size("cells")).alias("_width"))
    m = mapping.select("file", F.col("column").alias("_i"), F.nullif(stripped(F.col("canonical")), F.lit("")).alias("_name")).distinct()
    checked = m.join(width, "file", "left").withColumn("_rank", F.row_number().over(Window.partitionBy("file", "_name").orderBy("_i")))
    error = F.when(F.col("_width").isNull(), "no_such_file").when((F.col("_i") < 0) | (F.col("_i") >= F.col("_width")), "no_such_column").when(F.col("_name").isNull(), "no_name").when(F.col("_rank") > 1, "named_twice")
    checked = checked.withColumn("error", error)
    plan = checked.filter("error is null").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("_name", "_i"))).alias("_plan"))
    g = g.join(width.select("file", "_header"), "file").join(plan, "file", "left")
    cells = F.when(F.col("_plan").isNull(), F.col("cells")).when(F.col("row_no") == F.col("_header"), F.transform("_plan", lambda x: x["_name"])).otherwise(F.transform("_plan", lambda x: F.get("cells", x["_i"])))
    return g.select(*KEYS, cells.alias("cells")), checked.filter("error is not null").select("file", F.col("_i").alias("column"), "error")
