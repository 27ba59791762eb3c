"""Page geometry: reading order, columns, furniture, boxes, paragraphs, headings, ownership, coverage.

Lines come long: document, page, x0, y0, x1, y1, size, text. What is counted over a document runs as
aggregates; what depends on the geometry of one page runs per page (a page is small by nature).
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["document", "page"]


def reading_order(lines: DataFrame, grid: float = 3.0) -> DataFrame:
    """Adds line_no per page: by rows of the y grid, then x."""
    return lines.withColumn("line_no", F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.floor(F.col("y0") / grid), "x0", "text")))


def masked_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), "[0-9]+", "#")


def furniture(lines: DataFrame, pages: DataFrame, height: str = "height", band: float = 0.12, share: float = 0.5, least: int = 3) -> DataFrame:
    """Adds is_furniture: in the top or bottom band a page number, or a text (digits masked) that
    stands at the same height (to ten points) on max(least, share) of the document's pages."""
    per_doc = pages.groupBy("document").agg(F.countDistinct("page").alias("_pages"))
    l = lines.join(pages.select("document", "page", F.col(height).alias("_h")), KEYS).withColumn("_mask", masked_text(F.col("text"))).withColumn("_slot", F.floor(F.col("y0") / 10))
    often = l.groupBy("document", "_mask", "_slot").agg(F.countDistinct("page").alias("_n")).join(per_doc, "document").filter(F.col("_n") >= F.greatest(F.lit(least), F.col("_pages") * share)).select("document", "_mask", "_slot", F.lit(True).alias("_often"))
    edge = (F.col("y0") < band * F.col("_h")) | (F.col("y1") > (1 - band) * F.col("_h"))
    number = F.col("_mask").rlike(r"^(page )?#( (of|/) #)?$|^- # -$")
    return l.join(often, ["document", "_mask", "_slot"], "left").withColumn("is_furniture", edge & (number | F.coalesce("_often", F.lit(False)))).drop("_h", "_mask", "_slot", "_often")


def body_size(lines: DataFrame) -> DataFrame:
    """Per document the size that most characters have (ties: the larger)."""
    n = lines.groupBy("document", "size").agg(F.sum(F.length("text")).alias("n"))
    return n.groupBy("document").agg(F.max(F.struct("n", "size")).alias("m")).select("document", F.col("m.size").alias("body_size"))


def text_columns(lines: DataFrame, gap: float = 60.0, least: int = 2) -> DataFrame:
    """Columns per page: runs of left edges closer than the gap, of at least `least` lines, with their median edges."""
    w = Window.partitionBy(*KEYS).orderBy("x0", "y0")
    fresh = F.coalesce((F.col("x0") - F.lag("x0").over(w)) > gap, F.lit(True)).cast("int")
    runs = lines.withColumn("_f", fresh).withColumn("column", F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*KEYS, "column").agg(F.percentile("x0", F.lit(0.5)).alias("left"), F.percentile("x1", F.lit(0.5)).alias("right"), F.count(F.lit(1)).alias("n_lines")).filter(F.col("n_lines") >= least)


def inversions(lines: DataFrame) -> DataFrame:
    """Lines that stand above the one before them in the same block: a suspect order."""
    w = Window.partitionBy(*KEYS, "block").orderBy("seq")
    return lines.withColumn("_y", F.lag("y0").over(w)).filter(F.col("y0") < F.col("_y")).drop("_y")


def merged_boxes(boxes: list[tuple[float, float, float, float]], gap: float) -> list[tuple[float, float, float, float]]:
    """Boxes within a gap of each other are united until none are; in input order."""
    out: list[tuple[float, float, float, float]] = []
    for box in boxes:
        while True:
            near = next((k for k, b in enumerate(out) if box[0] - gap <= b[2] and b[0] - gap <= box[2] and box[1] - gap <= b[3] and b[1] - gap <= box[3]), None)
            if near is None:
                break
            b = out.pop(near)
            box = (min(b[0], box[0]), min(b[1], box[1]), max(b[2], box[2]), max(b[3], box[3]))
        out.append(box)
    return out


def _per_page(lines: DataFrame, schema: str, make: Callable[[pd.DataFrame], list[tuple]]) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {c: lines.schema[c].dataType.simpleString() for c in KEYS}

    def run(key: tuple, page: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *r) for r in make(page)], columns=[*KEYS, *names])

    return lines.groupBy(*KEYS).applyInPandas(run, f"document {kinds['document']}, page {kinds['page']}, {schema}")


def box_clusters(boxes: DataFrame, gap: float = 10.0) -> DataFrame:
    """The united boxes of each page; boxes hold seq for their order."""
    def make(page: pd.DataFrame) -> list[tuple]:
        page = page.sort_values("seq")
        return merged_boxes(list(page[["x0", "y0", "x1", "y1"]].itertuples(index=False, name=None)), gap)

    return _per_page(boxes, "x0 double, y0 double, x1 double, y1 double", make)


LIST_LINE = re.compile(r"^\s*(?:[•‣*–-]|\(?\d{1,3}[.)]|\(?[a-z][.)])\s+")


def paragraphs(lines: DataFrame, heading_ratio: float = 1.1, longest_heading: int = 120) -> DataFrame:
    """Blocks of each page as typed paragraphs: list, heading (larger than the body by the ratio, not too long), paragraph.

    Lines hold seq (reading order), block, and body_size of their document. A word cut at a line's
    end is healed before a lower-case letter.
    """
    def make(page: pd.DataFrame) -> list[tuple]:
        out = []
        for _, block in page.sort_values("seq").groupby("block", sort=False):
            texts = [t.strip() for t in block["text"] if isinstance(t, str) and t.strip()]
            if not texts:
                continue
            if all(LIST_LINE.match(t) for t in texts):
                out.append(("list", "\n".join(texts)))
                continue
            joined = texts[0]
            for t in texts[1:]:
                joined = joined[:-1] + t if re.search(r"\w-$", joined) and t[:1].islower() else f"{joined} {t}"
            large = block["size"].max() >= heading_ratio * block["body_size"].iloc[0]
            out.append(("heading" if large and len(joined) <= longest_heading else "paragraph", joined))
        return [(i, kind, text) for i, (kind, text) in enumerate(out, 1)]

    return _per_page(lines, "paragraph_no int, kind string, text string", make)


def headings(lines: DataFrame, outline: DataFrame, contents: DataFrame, least: int = 2) -> DataFrame:
    """Each document's headings by the first way that gives enough: its outline, its table of contents,
    numbered lines, larger type, or else one heading per page. Adds source.

    lines: document, page, y0, size, text, body_size; outline and contents: document, level, title, page.
    A title of the contents takes its most prominent line (size, then page and height), larger than
    the body.
    """
    toc = contents.join(lines.withColumn("_t", masked_text(F.col("text"))), (lines["document"] == contents["document"]) & (F.col("_t") == masked_text(F.col("title")))).drop(lines["document"]).drop(contents["page"]).filter(F.col("size") >= 1.05 * F.col("body_size"))
    toc = toc.groupBy("document", "level", "title").agg(F.max(F.struct("size", F.col("page"), F.col("y0"))).alias("b")).select("document", "level", "title", F.col("b.page").alias("page"))
    number = F.regexp_extract("text", r"^\s*([0-9]+(?:\.[0-9]+)*)\.?\s+\p{Lu}", 1)
    short = (F.length("text") <= 120) & ~F.col("text").rlike(r"[.;,]\s*$")
    numbered = lines.filter((number != "") & short).select("document", F.size(F.split(number, r"\.")).alias("level"), F.trim("text").alias("title"), "page")
    rank = F.dense_rank().over(Window.partitionBy("document").orderBy(F.desc("size")))
    large = lines.filter((F.col("size") >= 1.1 * F.col("body_size")) & short).withColumn("level", rank).select("document", "level", F.trim("text").alias("title"), "page")
    flat = lines.groupBy("document", "page").agg(F.lit(1).alias("level")).select("document", "level", F.concat(F.lit("Page "), F.col("page").cast("string")).alias("title"), "page")
    ways = {"outline": outline.select("document", "level", "title", "page"), "contents": toc, "numbering": numbered, "type": large, "pages": flat}
    every = None
    for order, (name, df) in enumerate(ways.items()):
        part = df.select("document", F.col("level").cast("int").alias("level"), "title", "page", F.lit(order).alias("_o"), F.lit(name).alias("source"))
        every = part if every is None else every.unionByName(part)
    counts = every.groupBy("document", "_o").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= least) | F.col("_o").isin(0, 4)).groupBy("document").agg(F.min("_o").alias("_o"))
    return every.join(counts, ["document", "_o"]).drop("_o")


def page_coverage(pages: DataFrame, covered: DataFrame) -> DataFrame:
    """Pages of each document that no section covers (document, first_page, last_page), as runs."""
    gone = pages.select("document", "page").distinct().join(covered.select("document", "first_page", "last_page"), "document", "left")
    gone = gone.groupBy("document", "page").agg(F.max(F.coalesce(F.col("page").between(F.col("first_page"), F.col("last_page")), F.lit(False))).alias("c")).filter(~F.col("c"))
    i = gone.withColumn("_i", F.col("page") - F.row_number().over(Window.partitionBy("document").orderBy("page")))
    return i.groupBy("document", "_i").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page")).drop("_i")


def number_gaps(numbers: DataFrame, number: str, block: int = 100_000) -> DataFrame:
    """Gaps in a set of numbers as ranges (first_missing, last_missing): neighbours are compared within blocks of numbers,
    and the ends of blocks with each other (a table of one row per block)."""
    t = numbers.filter(F.col(number).isNotNull()).select(F.col(number).alias("_k")).distinct().withColumn("_block", F.floor(F.col("_k") / block))
    inner = t.withColumn("_next", F.lead("_k").over(Window.partitionBy("_block").orderBy("_k")))
    ends = inner.groupBy("_block").agg(F.min("_k").alias("_low"), F.max("_k").alias("_high"))
    across = ends.select(F.col("_high").alias("_k"), F.lead("_low").over(Window.orderBy("_block")).alias("_next"))
    return inner.select("_k", "_next").unionByName(across).filter("_next > _k + 1").select((F.col("_k") + 1).alias("first_missing"), (F.col("_next") - 1).alias("last_missing"))


def even_ligatures(glyphs: DataFrame) -> DataFrame:
    """Adds shared_width: glyphs without width share that of the glyph before them evenly. glyphs: document, page, seq, width."""
    w = Window.partitionBy(*KEYS).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    g = glyphs.withColumn("_g", F.sum((F.col("width") > 0).cast("int")).over(w))
    return g.withColumn("shared_width", F.sum("width").over(Window.partitionBy(*KEYS, "_g")) / F.count(F.lit(1)).over(Window.partitionBy(*KEYS, "_g"))).drop("_g")
