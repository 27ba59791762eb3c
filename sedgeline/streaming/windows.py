"""Event-time windows, deduplication and keyed state; the same functions for batches and streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def timed(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events with ts as an instant, and a watermark where they stream."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.withWatermark("ts", late) if e.isStreaming else e


def tumbling(events: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Counts and sums per window and type; with a slide, windows overlap."""
    w = F.window("ts", size, slide or size)
    g = events.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "event_type", "n_events", "total")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    """A user's events without a pause of the gap, as one row."""
    g = events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return g.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), "n_events")


def first_seen(events: DataFrame, keys: list[str]) -> DataFrame:
    """The first event of each key; a stream keeps keys only as long as its watermark needs."""
    return events.dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def paced(events: DataFrame, key: str, least_gap_s: float) -> DataFrame:
    """key, ts, allowed: whether so many seconds have passed since the key's last allowed event (keyed state, event time)."""
    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        for f in frames:
            f = f.sort_values("ts")
            ok = []
            for t in f["ts"]:
                now = t.timestamp()
                ok.append(last is None or now - last >= least_gap_s)
                last = now if ok[-1] else last
            yield pd.DataFrame({key: k[0], "ts": f["ts"], "allowed": ok})
        if last is not None:
            state.update((last,))

    kind = events.schema[key].dataType.simpleString()
    return events.select(key, "ts").groupBy(key).applyInPandasWithState(run, f"{key} {kind}, ts timestamp, allowed boolean", "last double", "append", GroupStateTimeout.NoTimeout)
