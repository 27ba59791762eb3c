"""Sinks: NDJSON parts with a manifest, CSV, JSON-LD, one file set per group, versions, error logs."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedgeline.functions.hashes import set_fingerprint
from sedgeline.functions.urls import loggable_url
from sedgeline.operators.dedup import assigned_ids


def json_line(columns: list[str]) -> Column:
    """A row as one line of JSON, keys in this order, nulls kept out, line separators escaped."""
    line = F.to_json(F.struct(*columns))
    return F.replace(F.replace(line, F.lit("\u2028"), F.lit("\\u2028")), F.lit("\u2029"), F.lit("\\u2029"))


def write_parts(df: DataFrame, path: str, key: str, order: str, columns: list[str], rows_per_file: int = 1_000_000) -> None:
    """NDJSON under key=value folders, sorted by order within a file; only written keys are replaced.

    Keys are spread by key and a hash of the order column, as many ways as the rows need (AQE joins
    small ones), so a hot key is written by many tasks, each file at most rows_per_file.
    """
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        out = df.select(F.col(key), F.col(order).alias("_order"), json_line(columns).alias("value"))
        (
            out.repartition(F.col(key), F.pmod(F.xxhash64("_order"), F.lit(16))).sortWithinPartitions(key, "_order").drop("_order")
            .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(key).text(path)
        )
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def manifest(df: DataFrame, key: str, order: str, columns: list[str], day: str | None = None) -> DataFrame:
    """Per key: rows, duplicates of the order column, the span of a date column if one is named, and a digest that
    does not depend on the order of rows but on how often each occurs."""
    lines = df.select(F.col(key), F.col(order).alias("_order"), json_line(columns).alias("_line"), (F.col(day) if day else F.lit(None)).cast("string").alias("_day"))
    span = [F.min("_day").alias("first_day"), F.max("_day").alias("last_day")] if day else []
    return lines.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) - F.countDistinct("_order")).alias("n_duplicates"), *span, set_fingerprint(F.col("_line")).alias("digest"))


def manifest_totals(parts: DataFrame) -> DataFrame:
    """The head of a manifest: number of parts and rows over all of them."""
    return parts.agg(F.count(F.lit(1)).alias("n_parts"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n_duplicates"), F.lit(0)).alias("n_duplicates"))


def manifest_problems(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys whose parts are missing, extra, changed or hold a row twice."""
    e = expected.select(key, F.struct("n_rows", "digest").alias("_e"))
    f = found.select(key, F.struct("n_rows", "digest").alias("_f"), "n_duplicates")
    problem = F.when(F.col("_f").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(F.col("_e") != F.col("_f"), "changed").when(F.col("n_duplicates") > 0, "duplicate_rows")
    return e.join(f, key, "full").select(key, problem.alias("problem")).filter("problem is not null")


def part_changes(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """key, change: the parts of a manifest that were added, changed or removed since another."""
    both = before.select(key, F.struct("n_rows", "digest").alias("_b")).join(now.select(key, F.struct("n_rows", "digest").alias("_n")), key, "full")
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.col("_b") != F.col("_n"), "changed")
    return both.select(key, change.alias("change")).filter("change is not null")


def _part_name(path: Column) -> Column:
    """The file's name with the folder of its key."""
    return F.regexp_extract(path, r"((?:[^/]+=[^/]*/)*[^/]+)$", 1)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """file, n_bytes and SHA-256 of the bytes of each written part file (each is bounded by rows_per_file)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path)
    return files.select(_part_name(F.col("path")).alias("file"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def part_problems(spark: SparkSession, path: str, schema: StructType, order: str) -> DataFrame:
    """file, problem: lines of written parts that do not parse, that are not as json_line() would write them, whose order
    value occurs twice, or that stand before a lesser one. An untouched folder has none."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", _part_name(F.col("_metadata.file_path")).alias("file"), F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("i")).alias("_at"))
    r = lines.withColumn("r", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    key = F.col(f"r.{order}")
    canonical = r.select("file", "_at", "value", key.alias("_key"), F.col("r.*")).withColumn("_again", json_line(schema.fieldNames()))
    seen = canonical.withColumn("_before", F.lag("_key").over(Window.partitionBy("file").orderBy("_at"))).withColumn("_n", F.count("_key").over(Window.partitionBy("_key")))
    found = F.array_compact(F.array(
        F.when(F.col("_key").isNull(), "does_not_parse"), F.when(F.col("_key").isNotNull() & (F.col("value") != F.col("_again")), "not_canonical"),
        F.when(F.col("_n") > 1, "duplicate"), F.when(F.col("_key") < F.col("_before"), "out_of_order"),
    ))
    return seen.select("file", F.explode(found).alias("problem")).distinct()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def jsonld_lines(df: DataFrame, context: dict[str, str], ident: Column, kind: str) -> DataFrame:
    """One JSON-LD node per row, each with its context, so that a data set of any size is a set of lines."""
    head = F.create_map(*[F.lit(x) for pair in sorted(context.items()) for x in pair])
    return df.select(F.to_json(F.struct(head.alias("@context"), ident.alias("@id"), F.lit(kind).alias("@type"), *df.columns)).alias("value"))


def write_groups(df: DataFrame, path: str, group: str, measures: list[Column]) -> DataFrame:
    """One folder of JSON per group, and the index: group and its measures (returned)."""
    df.write.mode("overwrite").partitionBy(group).json(path)
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), *measures)


def write_version(df: DataFrame, root: str, version: str) -> None:
    """An immutable version, and the same as `latest`; an existing version raises and `latest` stays."""
    df.write.mode("errorifexists").parquet(f"{root}/{version}")
    df.sparkSession.read.parquet(f"{root}/{version}").write.mode("overwrite").parquet(f"{root}/latest")


def write_if_changed(df: DataFrame, path: str, key: str) -> bool:
    """Writes only if the rows differ from what lies there; says whether it wrote."""
    spark = df.sparkSession
    digest = lambda d: d.agg(F.count(F.lit(1)), set_fingerprint(F.to_json(F.struct(*sorted(d.columns)), {"ignoreNullFields": "false"}))).first()
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs)
    if there and digest(spark.read.parquet(path)) == digest(df):
        return False
    df.repartitionByRange(key).write.mode("overwrite").parquet(path)
    return True


def safe_errors(errors: DataFrame, url: str, message: str) -> DataFrame:
    """Error rows for a log: addresses as hosts, secrets blanked, messages of at most 200 characters."""
    blanked = F.regexp_replace(F.col(message), r"(?i)\b(token|secret|password|api[_-]?key)\b\s*[=:]\s*\S+", "$1=***")
    return errors.withColumn(url, loggable_url(F.col(url))).withColumn(message, F.substring(blanked, 1, 200))


def jsonld_document(df: DataFrame, path: str, context: dict[str, str], ident: Column, kind: str) -> None:
    """One JSON-LD document per part file: a context, and its rows as the lines of one `@graph`."""
    head = json.dumps({"@context": dict(sorted(context.items()))}, ensure_ascii=False)[:-1]
    node = F.to_json(F.struct(ident.alias("@id"), F.lit(kind).alias("@type"), *df.columns))

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for b in batches:
            lines = b["value"].to_pylist()
            yield pa.RecordBatch.from_pydict({"value": [f'{head}, "@graph": [{x}' if first and not k else f",{x}" for k, x in enumerate(lines)]})
            first = first and not lines
        yield pa.RecordBatch.from_pydict({"value": [f'{head}, "@graph": []}}' if first else "]}"]})

    df.select(node.alias("value")).mapInArrow(wrap, "value string").write.mode("overwrite").text(path)


def index_lines(df: DataFrame, title: Column, link: Column, note: Column, form: str) -> DataFrame:
    """One line per row of an index: `markdown` (a list of links with notes) or `html` (list items, escaped)."""
    if form == "markdown":
        return df.select(F.concat(F.lit("- ["), F.regexp_replace(title, r"([\[\]])", r"\\$1"), F.lit("]("), link, F.lit(")"), F.when(F.coalesce(note, F.lit("")) != "", F.concat(F.lit(": "), note)).otherwise("")).alias("value"))
    safe = lambda c: F.replace(F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    return df.select(F.concat(F.lit('<li><a href="'), safe(link), F.lit('">'), safe(title), F.lit("</a> "), safe(note), F.lit("</li>")).alias("value"))


def load_ordered(spark: SparkSession, url: str, table: str, df: DataFrame, known: DataFrame, key: str, ident: str, batch: int = 100) -> DataFrame:
    """Loads rows whose key the target lacks, with numbers that go on behind the known ones; returns the id map of all keys.

    known: key and ident of what the target holds (read it with sql_table()).
    """
    mapped = assigned_ids(known, df, key, ident)
    load_table(df.join(mapped, key), url, table, batch)
    return known.select(key, ident).unionByName(mapped.select(key, ident))


def load_table(df: DataFrame, url: str, table: str, batch: int = 100, mode: str = "append") -> None:
    """Rows into another database by JDBC, so many per statement batch."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).mode(mode).save()


def orphaned_groups(found: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Groups that lie there but that the manifest does not list."""
    return found.select(key).distinct().join(listed.select(key).distinct(), key, "left_anti")
