"""Session-level helpers shared by all operators: tables, lineage cuts, size proofs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Where the session names none, a local session (tests, a single machine) gets one of its own; on a cluster that raises, since
    executors cannot read each other's disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            named = current.get()
        elif context.master.split("[")[0] == "local":
            named = tempfile.mkdtemp(prefix="sedgeline-")
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder for an intermediate table, below the folder of this session, so that clearing it harms no other session."""
    return f"{shared_dir(spark)}/sedgeline/{spark.sparkContext.applicationId}/{what}_{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Replace the lineage of df by files in the shared folder (reliable checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, what: str = "table", free: bool = False) -> DataFrame:
    """As cut(), but as compressed Parquet: for wide or large intermediate tables.

    free: the shuffle files of the write go when it ends, not when the driver collects its garbage; df itself should not run again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, what)
    before = spark.conf.get(_FREE, "false")
    if free:
        spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(_FREE, before)
    return spark.read.parquet(path)


def clear_stored(spark: SparkSession) -> None:
    """Delete what this session stored; results that still read it end with it."""
    remove_path(spark, f"{shared_dir(spark)}/sedgeline/{spark.sparkContext.applicationId}")


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table that must be small by its nature; refuse beyond the stated bound."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; raise the bound or use the joined form")
    return rows


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system (local, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
