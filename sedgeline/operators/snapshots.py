"""Changes between consecutive full snapshots, through a bucketed index of key and hashes that outlives a delivery."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.runtime import bounded_rows, remove_path, scratch_path, shared_dir

BLANK = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def plain_value(c: Column) -> Column:
    """Surrounding white space and case do not count; null is the empty string."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), BLANK, ""))


def plain_url(c: Column) -> Column:
    """As plain_value, without one trailing slash."""
    return F.regexp_replace(plain_value(c), "/$", "")


class SnapshotIndex:
    """The last snapshot as a bucketed and sorted table of key, and per compared column a 64-bit hash and the value.

    deliver() probes it with the next snapshot: new rows meet the hash columns alone (column pruning); old values
    are fetched from the same buckets for changed keys only, which also rules out hash
    collisions in what is reported as changed. The new rows are bucketed alike, so neither join shuffles. They
    become the index by one rename of a pointer, after the changes are written: a delivery that fails leaves the
    index as it was, and can be given again. open() finds the index of a name in a later session.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, values: list[str], buckets: int):
        self.spark, self.root, self.key, self.values, self.buckets = spark, root.rstrip("/"), key, list(values), buckets
        self.fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @classmethod
    def open(cls, spark: SparkSession, name: str, key: str, values: list[str], buckets: int = 16) -> SnapshotIndex:
        """The index of that name in the shared folder; empty if nothing was delivered yet."""
        return cls(spark, f"{shared_dir(spark)}/sedgeline_indexes/{name}", key, values, buckets)

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def current(self) -> tuple[str, int] | None:
        """(version, number) of the snapshot that the index holds."""
        if not self.fs.exists(self._path(f"{self.root}/current")):
            return None
        version, number = self.spark.read.text(f"{self.root}/current").first()[0].split()
        return version, int(number)

    def _point(self, version: str, number: int) -> None:
        """The pointer is written aside and renamed over the old one."""
        aside = self._path(f"{self.root}/current.{version}")
        out = self.fs.create(aside, True)
        out.write(f"{version} {number}\n".encode())
        out.close()
        self.fs.delete(self._path(f"{self.root}/current"), False)
        self.fs.rename(aside, self._path(f"{self.root}/current"))

    def _table(self, version: str) -> str:
        """The version as a table of the catalogue; a session that does not know it yet reads its folder."""
        name = f"snapshot_index_{version}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join([self.spark.read.parquet(f"{self.root}/{version}").schema.fields[0].dataType.simpleString().join(("_key ", "")), *(f"_h{i} bigint, _v{i} string" for i in range(len(self.values)))])
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{self.root}/{version}') CLUSTERED BY (_key) SORTED BY (_key) INTO {self.buckets} BUCKETS")
        return name

    def _forget(self, version: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS snapshot_index_{version}")
        remove_path(self.spark, f"{self.root}/{version}")

    def deliver(self, rows: DataFrame, number: int, path: str | None = None) -> DataFrame | None:
        """The changes against the last delivery, written to path (by default a scratch folder) before the index is swapped.

        rows: key and values, one row per key, no null keys; they are read once. Against a delivery whose number is not
        one less, and at the first one, nothing is compared and null is returned.
        Returns key, change_kind (`added`, `removed`, or the column's name), and for changed columns old_value and new_value.
        """
        last, version = self.current(), uuid.uuid4().hex
        n = range(len(self.values))
        try:
            held = rows.select(F.col(self.key).alias("_key"), *[c for i, v in enumerate(self.values) for c in (F.xxhash64(v).alias(f"_h{i}"), F.col(v).cast("string").alias(f"_v{i}"))])
            held.repartition(self.buckets, "_key").write.format("parquet").bucketBy(self.buckets, "_key").sortBy("_key").option("path", f"{self.root}/{version}").saveAsTable(f"snapshot_index_{version}")
            changes = None
            if last and last[1] == number - 1:
                path = path or scratch_path(self.spark, "changes")
                new = self.spark.table(self._table(version)).select("_key", *[F.col(f"_h{i}").alias(f"_g{i}") for i in n], *[F.col(f"_v{i}").alias(f"_n{i}") for i in n], F.lit(True).alias("_new"))
                old = self.spark.table(self._table(last[0]))
                probe = new.join(old.select("_key", *[f"_h{i}" for i in n], F.lit(True).alias("_old")), "_key", "full")
                touched = probe.filter(F.col("_new").isNull() | F.col("_old").isNull() | reduce(Column.__or__, [F.col(f"_h{i}") != F.col(f"_g{i}") for i in n]))
                fetched = touched.join(old.select("_key", *[F.col(f"_v{i}").alias(f"_o{i}") for i in n]), "_key", "left")
                fetched.select(F.col("_key").alias(self.key), F.inline(self._found())).write.parquet(path)
                changes = self.spark.read.parquet(path)
            self._point(version, number)
        except BaseException:
            self._forget(version)
            raise
        if last:
            self._forget(last[0])
        return changes

    def _found(self) -> Column:
        null = F.lit(None).cast("string")
        of = lambda name, a, b: F.struct(F.lit(name).alias("change_kind"), a.alias("old_value"), b.alias("new_value"))
        changed = F.array(*[F.when(~F.col(f"_o{i}").eqNullSafe(F.col(f"_n{i}")), of(v, F.col(f"_o{i}"), F.col(f"_n{i}"))) for i, v in enumerate(self.values)])
        return (
            F.when(F.col("_old").isNull(), F.array(of("added", null, null)))
            .when(F.col("_new").isNull(), F.array(of("removed", null, null)))
            .otherwise(F.filter(changed, lambda x: x.isNotNull()))
        )

    def drop(self) -> None:
        last = self.current()
        if last:
            self._forget(last[0])
        remove_path(self.spark, self.root)


def snapshot_changes(snapshots: DataFrame, number: str, key: str, version: str, values: Mapping[str, Column], buckets: int | None = None, most_snapshots: int = 10_000) -> DataFrame:
    """Added, removed and changed keys of each snapshot against the one numbered one less.

    Within a snapshot the row with the greatest version holds, of equal versions the one with
    the greatest values. Values are compared in full length; other columns are ignored; an empty table gives no rows. Rows with a null key or
    number are left out. A snapshot whose predecessor is absent yields nothing. The snapshots are read once, the rows that hold
    stored by number, and delivered one after the other to a SnapshotIndex of their own, which is dropped at the end.

    Returns number, key, change_kind (`added`, `removed`, or the column's name) and, for
    changed columns, old_value and new_value (null for added and removed).
    """
    spark, names = snapshots.sparkSession, list(values)
    best = F.max(F.struct(F.col(version), *[values[n].alias(f"_c{i}") for i, n in enumerate(names)])).alias("_best")
    held = snapshots.filter(F.col(number).isNotNull() & F.col(key).isNotNull()).groupBy(number, key).agg(best)
    held = held.select(F.col(number).alias("_no"), F.col(number).alias("_number"), F.col(key).alias("_k"), *[F.col(f"_best._c{i}").alias(f"_c{i}") for i in range(len(names))])
    path = scratch_path(spark, "snapshots")
    held.write.partitionBy("_no").parquet(path)
    kept = spark.read.schema(held.schema).parquet(path)
    counts = bounded_rows(kept.groupBy("_number").count(), most_snapshots, "snapshot numbers")
    if buckets is None:  # about a million keys each
        buckets = max(16, -(-max((r["count"] for r in counts), default=0) // 1_000_000))
    index = SnapshotIndex.open(spark, f"once_{uuid.uuid4().hex}", "_k", [f"_c{i}" for i in range(len(names))], buckets)
    parts = []
    try:
        for no in sorted(r["_number"] for r in counts):
            changes = index.deliver(kept.filter(F.col("_no") == no).drop("_no", "_number"), no)
            if changes is not None:
                parts.append(changes.withColumn("_number", F.lit(no).cast(snapshots.schema[number].dataType)))
    finally:
        index.drop()
        remove_path(spark, path)
    if not parts:
        kind = F.struct(F.lit("x").alias("change_kind"), F.lit("").alias("old_value"), F.lit("").alias("new_value"))
        return snapshots.filter(F.lit(False)).select(F.col(number), F.col(key), F.inline(F.array(kind)))
    shown = F.coalesce(*[F.when(F.col("change_kind") == f"_c{i}", n) for i, n in enumerate(names)], F.col("change_kind"))
    return reduce(DataFrame.unionByName, parts).select(F.col("_number").alias(number), F.col("_k").alias(key), shown.alias("change_kind"), "old_value", "new_value")
