"""Office files through their open packages: workbooks, letters, CSV that calls itself a workbook, bundles.

Files are read whole, one at a time, in Arrow batches: a file is small by nature. A package that declares a document type is refused, since
entities could be made to swell; a file that can't be read gives one row with an error instead of stopping the others.
"""

from __future__ import annotations

import csv
import gzip
import io
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Name spaces of the packages' parts.
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
LETTER = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def parsed(data: bytes) -> ElementTree.Element:
    """A part of a package; one with a document type is refused."""
    if b"<!DOCTYPE" in data or b"<!ENTITY" in data:
        raise ValueError("the part declares a document type")
    return ElementTree.fromstring(data)


def column_number(cell: str) -> int:
    """0-based column of a cell's name: A1 is 0, AA7 is 26."""
    n = 0
    for ch in cell:
        if not ch.isalpha():
            break
        n = 26 * n + ord(ch.upper()) - 64
    return n - 1


def workbook_grids(data: bytes) -> list[list[list[str | None]]]:
    """The sheets of a workbook in their order, each as rows of texts; rows and cells that are left out stand as nulls."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in s.iter(f"{SHEET}t")) for s in parsed(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target") for r in parsed(z.read("xl/_rels/workbook.xml.rels")).iter(f"{PACKAGE}Relationship")}
        out = []
        for sheet in parsed(z.read("xl/workbook.xml")).iter(f"{SHEET}sheet"):
            path = targets[sheet.get(f"{RELATION}id")].lstrip("/")
            rows: list[list[str | None]] = []
            for row in parsed(z.read(path if path.startswith("xl/") else f"xl/{path}")).iter(f"{SHEET}row"):
                cells: list[str | None] = []
                for c in row.iter(f"{SHEET}c"):
                    at = column_number(c.get("r", "")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    v, kind = c.find(f"{SHEET}v"), c.get("t")
                    text = "".join(t.text or "" for t in c.iter(f"{SHEET}t")) if kind == "inlineStr" else v.text if v is not None else None
                    cells[at] = shared[int(text)] if kind == "s" and text is not None else text
                rows += [[]] * (int(row.get("r", len(rows) + 1)) - 1 - len(rows))
                rows.append(cells)
            out.append(rows)
        return out


def sheet_grid(data: bytes) -> tuple[list[list[str | None]], int, str]:
    """(rows of the first sheet, further sheets that hold something, what the file was). A file that is no package is read as CSV."""
    if data[:4] == b"PK\x03\x04":
        first, *others = workbook_grids(data) or [[]]
        return first, sum(any(c for r in s for c in r) for s in others), "workbook"
    if data[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        raise ValueError("old binary workbooks are not read")
    text = data.decode("utf-8-sig", errors="replace")
    return [[c or None for c in r] for r in csv.reader(io.StringIO(text))], 0, "csv"


def letter_text(data: bytes) -> str:
    """The paragraphs of a letter, one a line, tabs and breaks kept."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = parsed(z.read("word/document.xml"))
    marks = {f"{LETTER}tab": "\t", f"{LETTER}br": "\n"}
    return "\n".join("".join(marks.get(x.tag, x.text or "" if x.tag == f"{LETTER}t" else "") for x in p.iter()) for p in body.iter(f"{LETTER}p"))


def _scan(spark: SparkSession, path: str, schema: pa.Schema, ddl: str, read: Callable[[bytes], dict]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, data in zip(b["path"].to_pylist(), b["content"].to_pylist()):
                try:
                    row = read(data) | {"error": None}
                except Exception as e:  # whatever is wrong with one file, the others are read
                    row = {"error": f"{type(e).__name__}: {e}"}
                yield pa.RecordBatch.from_pylist([{"path": p} | row], schema=schema)

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInArrow(run, ddl)


def sheets(spark: SparkSession, path: str) -> DataFrame:
    """path, rows (first sheet), n_other_sheets (that hold something), kind (`workbook`, or `csv` under another name), error."""
    grid = pa.list_(pa.list_(pa.string()))
    schema = pa.schema([("path", pa.string()), ("rows", grid), ("n_other_sheets", pa.int32()), ("kind", pa.string()), ("error", pa.string())])
    return _scan(spark, path, schema, "path string, rows array<array<string>>, n_other_sheets int, kind string, error string", lambda d: dict(zip(("rows", "n_other_sheets", "kind"), sheet_grid(d))))


def letters(spark: SparkSession, path: str) -> DataFrame:
    """path, text and error of word-processor files."""
    schema = pa.schema([("path", pa.string()), ("text", pa.string()), ("error", pa.string())])
    return _scan(spark, path, schema, "path string, text string, error string", lambda d: {"text": letter_text(d)})


def workbook_bytes(header: list[str], rows: list[list[str | None]], name: str = "Sheet1") -> bytes:
    """A workbook of one sheet of texts, the same bytes for the same rows."""
    cell = lambda c: "<c/>" if c is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(c)}</t></is></c>'
    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [header, *rows])
    xml = '<?xml version="1.0" encoding="UTF-8"?>'
    kinds, office = "application/vnd.openxmlformats-officedocument.spreadsheetml", RELATION.strip("{}")
    parts = {
        "[Content_Types].xml": f'{xml}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/></Types>',
        "_rels/.rels": f'{xml}<Relationships xmlns="{PACKAGE.strip("{}")}"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{xml}<workbook xmlns="{SHEET.strip("{}")}" xmlns:r="{office}"><sheets><sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{xml}<Relationships xmlns="{PACKAGE.strip("{}")}"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'{xml}<worksheet xmlns="{SHEET.strip("{}")}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for part, text in parts.items():
            z.writestr(zipfile.ZipInfo(part, (1980, 1, 1, 0, 0, 0)), text.encode(), zipfile.ZIP_DEFLATED)
    return out.getvalue()


def workbooks(df: DataFrame, group: str, columns: list[str], most_rows: int = 1_048_575) -> DataFrame:
    """group, content: a workbook of the named columns for each group, rows in their order. A workbook can hold so many rows and no
    more, so a greater group raises."""
    import pandas as pd

    kind = df.schema[group].dataType.simpleString()

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > most_rows:
            raise ValueError(f"{key[0]}: {len(rows)} rows do not fit a sheet")
        held = sorted([None if v is None or v != v else str(v) for v in r] for r in rows[columns].itertuples(index=False, name=None)) if len(columns) == 1 else [[None if v is None or v != v else str(v) for v in r] for r in rows.sort_values(columns)[columns].itertuples(index=False, name=None)]
        return pd.DataFrame({group: [key[0]], "content": [workbook_bytes(columns, held)]})

    return df.select(group, *columns).groupBy(group).applyInPandas(run, f"{group} {kind}, content binary")


def bundle(files: dict[str, bytes]) -> bytes:
    """A compressed archive of named contents: sorted, without times or owners, the same bytes for the same contents."""
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w", format=tarfile.USTAR_FORMAT) as tar:
        for name, data in sorted(files.items()):
            info = tarfile.TarInfo(name)
            info.size, info.mtime, info.mode, info.uid, info.gid, info.uname, info.gname = len(data), 0, 0o644, 0, 0, "", ""
            tar.addfile(info, io.BytesIO(data))
    return gzip.compress(raw.getvalue(), mtime=0)
