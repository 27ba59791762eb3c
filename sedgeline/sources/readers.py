"""Scans: step JSON, NDJSON parts, CSV under a header contract, pipe tables, HTML links, SQL, office sheets."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def step_json(spark: SparkSession, path: str, schema: StructType, field: str = "results") -> DataFrame:
    """The records under one field of JSON documents; bad documents give none."""
    whole = StructType().add("_", "string").add(field, ArrayType(schema))
    return spark.read.schema(whole).option("multiLine", True).json(path).select(F.explode(field).alias("r")).select("r.*")


def ndjson_parts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All parts of a folder of NDJSON; order is a matter of the reader, not of files."""
    return spark.read.schema(schema).json(path)


def csv_contract(spark: SparkSession, path: str, header: list[str], encoding: str = "UTF-8") -> DataFrame:
    """CSV whose header must be exactly this; anything else raises before a row is read.

    A byte order mark is no part of the header. All columns are strings. Of a folder the first file is checked here, letter
    by letter; each further file against its own header as it is read, so that one with other columns, or the same in another
    order, raises instead of loading them askew.
    """
    first = spark.read.option("encoding", encoding).text(path).limit(1).collect()
    got = next(iter(spark.read.option("encoding", encoding).csv(spark.sparkContext.parallelize([first[0][0].lstrip("\ufeff")])).collect()), []) if first else []
    if list(got) != header:
        raise ValueError(f"header is {list(got)}, the contract says {header}")
    schema = StructType()
    for c in header:
        schema = schema.add(c, "string")
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("encoding", encoding).option("multiLine", True).csv(path)


def pipe_tables(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of markdown pipe tables: key, table_no, row_no, cells. Rule rows go; a table ends at a line without pipes."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [], [])
            for k, t in zip(b["k"].to_pylist(), b["t"].to_pylist()):
                table, row, inside = 0, 0, False
                for line in t.splitlines():
                    bare = line.strip()
                    if not (bare.startswith("|") and bare.count("|") >= 2):
                        inside = False
                        continue
                    if not inside:
                        inside, table, row = True, table + 1, 0
                    cells = [c.strip() or None for c in bare.strip("|").split("|")]
                    if all(c and set(c) <= set("-: ") for c in cells):
                        continue
                    for column, v in zip(out, (k, table, row, cells)):
                        column.append(v)
                    row += 1
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b["k"].type), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.string()))], names=[key, "table_no", "row_no", "cells"])

    return documents.filter(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"{key} {kind}, table_no int, row_no int, cells array<string>")


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        href = dict(attrs).get("href") if tag == "a" else None
        if href:
            self.found.append([href, ""])
            self.open = True

    def handle_endtag(self, tag):
        self.open = self.open and tag != "a"

    def handle_data(self, data):
        if self.open:
            self.found[-1][1] += data


def links_of(html: str, base: str) -> list[tuple[str, str]]:
    """(absolute address, text) of each link of a page, in order."""
    p = _Links()
    p.feed(html)
    return [(urljoin(base, h), " ".join(t.split())) for h, t in p.found]


def page_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """url, pos, href, text of every link of each page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(u, i, h, t) for u, page in zip(b["u"].to_pylist(), b["h"].to_pylist()) for i, (h, t) in enumerate(links_of(page, u or ""))]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate((("url", pa.string()), ("pos", pa.int32()), ("href", pa.string()), ("text", pa.string())))})

    return pages.filter(F.col(html).isNotNull()).select(F.col(url).alias("u"), F.col(html).alias("h")).mapInArrow(run, "url string, pos int, href string, text string")


def scored_links(links: DataFrame, weights: dict[str, int], vetoes: list[str], least: int) -> DataFrame:
    """The best link of each page: the weight of its best token (text and address); a veto token makes it 0; the first of equals."""
    words = F.split(F.lower(F.concat_ws(" ", "text", "href")), "[^a-z0-9]+")
    score = F.greatest(F.lit(0), *[F.when(F.array_contains(words, w), v).otherwise(0) for w, v in sorted(weights.items())])
    scored = links.withColumn("score", F.when(F.arrays_overlap(words, F.array(*[F.lit(v) for v in vetoes])), 0).otherwise(score)).filter(F.col("score") >= least)
    best = F.max(F.struct("score", (-F.col("pos")).alias("first"), "href", "text")).alias("b")
    return scored.groupBy("url").agg(best).select("url", "b.href", "b.text", "b.score")


def sql_table(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query of another database by JDBC; numbered partitions are given as options."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def recorded_pages(spark: SparkSession, path: str, schema: StructType, field: str = "results", number: str = "page") -> DataFrame:
    """The records of a paged interface from its recorded answers (one JSON document a page), up to the first empty page.

    Pages are counted from their number field; one that is missing ends the list as an empty one does.
    """
    whole = StructType().add(number, "integer").add(field, ArrayType(schema))
    pages = spark.read.schema(whole).option("multiLine", True).json(path).select(F.col(number).alias("_no"), F.col(field).alias("_rows"))
    full = pages.filter("size(_rows) > 0").select("_no").distinct()
    first_gap = full.select((F.col("_no") + 1).alias("_no")).join(full, "_no", "left_anti").agg(F.min("_no").alias("_end"))
    return pages.join(F.broadcast(first_gap), F.col("_no") < F.col("_end")).select(F.explode("_rows").alias("r")).select("r.*")


class _Text(HTMLParser):
    """Text below the first element of a tag, or of a class or id; scripts and styles aside."""

    BLOCKS = {"p", "div", "li", "tr", "br", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "table"}
    EMPTY = {"br", "img", "hr", "input", "meta", "link", "col", "source", "wbr"}

    def __init__(self, selector: str) -> None:
        super().__init__()
        self.selector, self.depth, self.hidden, self.done, self.parts = selector, 0, 0, False, []

    def _wanted(self, tag: str, attrs: dict) -> bool:
        if self.selector.startswith("#"):
            return attrs.get("id") == self.selector[1:]
        if self.selector.startswith("."):
            return self.selector[1:] in (attrs.get("class") or "").split()
        return tag == self.selector

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        if tag in self.BLOCKS:
            self.parts.append("\n")
        if tag not in self.EMPTY and not self.done and (self.depth or self._wanted(tag, dict(attrs))):
            self.depth += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        if tag in self.BLOCKS:
            self.parts.append("\n")
        if self.depth and tag not in self.EMPTY:
            self.depth -= 1
            self.done = self.depth == 0

    def handle_data(self, data):
        if self.depth and not self.hidden:
            self.parts.append(data)


def selected_text(html: str, selectors: list[str]) -> str | None:
    """The text of the first selector (tag, .class or #id) that a page has, a block a line; null if it has none."""
    for s in selectors:
        p = _Text(s)
        p.feed(html)
        text = "\n".join(filter(None, (" ".join(line.split()) for line in "".join(p.parts).split("\n"))))
        if text:
            return text
    return None


def page_texts(pages: DataFrame, url: str, html: str, selectors: list[str]) -> DataFrame:
    """url, text of each page that holds one of the selectors; a page without, or a null one, has a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["u"].cast(pa.string()), pa.array([selected_text(h, selectors) if h else None for h in b["h"].to_pylist()], pa.string())], names=["url", "text"])

    return pages.select(F.col(url).alias("u"), F.col(html).alias("h")).mapInArrow(run, "url string, text string")


def qualifying_page(url: Column, body: Column, keywords: list[str]) -> Column:
    """Whether a page is itself what a link to it would be: text and path both hold one of the words."""
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1))
    held = lambda c: F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(c, k))
    return F.coalesce(held(F.lower(body)) & held(path), F.lit(False))


def probe_outcome(status: Column, error: Column, body: Column, parked: list[str]) -> Column:
    """What a recorded answer says of a site: `nxdomain`, `blocked`, `dead`, `parked` or `ok`."""
    low = F.lower(F.coalesce(body, F.lit("")))
    return (
        F.when(F.lower(error).rlike("nxdomain|name or service not known|getaddrinfo"), "nxdomain").when(status.isin(401, 403, 429), "blocked")
        .when(error.isNotNull() | status.isNull() | (status >= 400), "dead").when(F.exists(F.array(*[F.lit(p.lower()) for p in parked]), lambda p: F.contains(low, p)), "parked").otherwise("ok")
    )
