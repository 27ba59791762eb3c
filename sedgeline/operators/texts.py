"""Long texts: outlines, references, chunks, milestones, word repairs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def outline(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Markdown headings of each text: line, level, title, the heading above, and where its section ends.

    The last heading of a higher level above, and the first of the same or a higher level below,
    come from one window per text and level; a text's lines are exploded, never gathered.
    """
    lines = documents.filter(F.col(text).isNotNull()).select(key, F.size(F.split(text, r"\r?\n")).alias("n_lines"), F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))
    heads = lines.filter(F.col("line").rlike(r"^#{1,6}[ \t]+\S")).select(key, "n_lines", "line_no", F.length(F.regexp_extract("line", "^(#+)", 1)).alias("level"), F.trim(F.regexp_replace("line", r"^#+[ \t]+", "")).alias("title"))
    w = Window.partitionBy(key).orderBy("line_no")
    up, down = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    parent, end = F.lit(None), F.lit(None)
    for k in range(1, 7):
        parent = F.when(F.col("level") == k, F.last(F.when(F.col("level") < k, F.col("line_no")), ignorenulls=True).over(up)).otherwise(parent)
        end = F.when(F.col("level") == k, F.first(F.when(F.col("level") <= k, F.col("line_no")), ignorenulls=True).over(down)).otherwise(end)
    return heads.withColumn("parent_line", parent).withColumn("end_line", F.coalesce(end, F.col("n_lines"))).drop("n_lines")


def file_references(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct `XX/123` file numbers of each text and how often they stand in it."""
    return documents.select(key, F.explode(F.regexp_extract_all(text, F.lit(r"\b([A-Z]{2}/[0-9]{2,6})\b"), F.lit(1))).alias("reference")).groupBy(key, "reference").agg(F.count(F.lit(1)).alias("n_uses"))


def split_text(text: str, most: int, overlap: int = 0) -> list[str]:
    """Pieces of at most `most` characters that cover the text.

    A piece ends at the last blank line in its second half, else at the last line end there,
    else where it is full; each further piece begins `overlap` characters earlier.
    """
    out, at = [], 0
    while at < len(text):
        end = min(at + most, len(text))
        if end < len(text):
            for mark in ("\n\n", "\n"):
                k = text.rfind(mark, at + most // 2, end)
                if k > at:
                    end = k + len(mark)
                    break
        out.append(text[at:end])
        if end >= len(text):
            break
        at = max(end - overlap, at + 1)
    return out


def chunks(documents: DataFrame, key: str, text: str, most: int = 2000, overlap: int = 0) -> DataFrame:
    """key, chunk_no, chunk: the pieces of split_text(), for each non-null text."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, nos, parts = [], [], []
            for k, t in zip(b["k"].to_pylist(), b["t"].to_pylist()):
                for i, part in enumerate(split_text(t, most, overlap), 1):
                    keys.append(k)
                    nos.append(i)
                    parts.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b["k"].type), pa.array(nos, pa.int32()), pa.array(parts, pa.string())], names=[key, "chunk_no", "chunk"])

    return documents.filter(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"{key} {kind}, chunk_no int, chunk string")


MARKERS = re.compile(r"(?:(?<=\s)|^)(?:\(?[ivx]{1,4}\)|\(?[a-z]\)|(?:Q[1-4]\s+)?(?:19|20)\d{2}\s*[:–-]|[•‣])(?=\s)")


def milestones(text: str) -> list[str]:
    """A cell of several milestones as slices, one from each marker to the next; together they are the text."""
    cuts = sorted({0, *(m.start() for m in MARKERS.finditer(text)), len(text)})
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def repaired_words(repairs: dict[str, str]):
    """A pandas UDF that replaces known broken spans, longest first, without overlap, keeping case; spans in URLs and addresses stay."""
    pattern = re.compile("|".join(re.escape(k) for k in sorted(repairs, key=lambda k: (-len(k), k))) or "(?!)", re.IGNORECASE)
    guard = re.compile(r"\S+@\S+|https?://\S+|www\.\S+", re.IGNORECASE)
    low = {k.lower(): v for k, v in repairs.items()}

    def one(text: str) -> str:
        kept = [m.span() for m in guard.finditer(text)]

        def swap(m: re.Match) -> str:
            if any(a <= m.start() < b for a, b in kept):
                return m.group()
            got = low[m.group().lower()]
            return got.upper() if m.group().isupper() else got[:1].upper() + got[1:] if m.group()[:1].isupper() else got

        return pattern.sub(swap, text)

    @F.pandas_udf(StringType())
    def repair(values: pd.Series) -> pd.Series:
        return values.map(one, na_action="ignore")

    return repair


def suspicious_spans(c: Column) -> Column:
    """Spans shaped like reading artefacts: glyph codes, spaced-out words, replacement signs."""
    return F.regexp_extract_all(c, F.lit(r"(\(cid:[0-9]+\)|\b(?:\p{L} ){3,}\p{L}\b|\S*\x{FFFD}\S*)"), F.lit(1))


def phrase_guard(documents: DataFrame, key: str, text: str, phrases: dict[str, str], least: dict[str, int]) -> DataFrame:
    """Documents in which every phrase (name -> pattern) stands at least so often: key, the counts and the length, as evidence.

    Such documents are schedules of set wording rather than what their kind says, and are set aside before they are read.
    """
    counts = [F.regexp_count(F.col(text), F.lit(p)).alias(f"n_{name}") for name, p in phrases.items()]
    got = documents.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, *counts, F.length(text).alias("n_chars"))
    for name, n in least.items():
        got = got.filter(F.col(f"n_{name}") >= n)
    return got


def dump_guard(items: DataFrame, document: str, marks: dict[str, Column], actors: list[str], least_items: int, share: float) -> DataFrame:
    """Documents whose extracted items are a dump of set wording: least_items or more, and in at least that share of them each
    mark holds and each actor column names the same one. Items are counted per document and actor first, so that a
    document of many items is a few rows per task."""
    base = items.filter(F.col(document).isNotNull()).groupBy(document).agg(F.count(F.lit(1)).alias("n_items"), *[F.count(F.when(m, 1)).alias(f"n_{name}") for name, m in marks.items()])
    for a in actors:
        per = items.filter(F.trim(F.col(a)) != "").groupBy(document, F.trim(F.col(a)).alias("_a")).agg(F.count(F.lit(1)).alias("_k"))
        top = per.groupBy(document).agg(F.max(F.struct("_k", "_a")).alias("_t")).select(document, F.col("_t._a").alias(f"top_{a}"), F.col("_t._k").alias(f"n_top_{a}"))
        base = base.join(top, document)
    for c in [*(f"n_{name}" for name in marks), *(f"n_top_{a}" for a in actors)]:
        base = base.filter(F.col(c) >= share * F.col("n_items"))
    return base.filter(F.col("n_items") >= least_items)


def thin_texts(documents: DataFrame, key: str, text: str, least: int) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined): texts with at least so many characters besides white space at their ends, and the keys of the rest."""
    n = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return documents.filter(n >= least), documents.filter(n < least).select(key, n.alias("n_chars"))
