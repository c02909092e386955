"""Streams: a watched folder, limits on repeated events, and resolution by micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def watched_folder(spark: SparkSession, path: str, pattern: str = "*.pdf", files_per_batch: int = 1000) -> DataFrame:
    """path, modificationTime, length, content of files as they arrive. Files are never moved; the checkpoint knows them."""
    return spark.readStream.format("binaryFile").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(path)


def stable_files(observed: DataFrame, checks: int = 4) -> DataFrame:
    """path, stable from sightings (path, ts, size): true if two sizes in a row of the first `checks` agree and are not 0."""
    w = Window.partitionBy("path").orderBy("ts")
    o = observed.withColumns({"n": F.row_number().over(w), "before": F.lag("size").over(w)})
    return o.groupBy("path").agg(F.coalesce(F.bool_or((F.col("n") <= checks) & (F.col("size") == F.col("before")) & (F.col("size") > 0)), F.lit(False)).alias("stable"))


def rate_limited(events: DataFrame, seconds: float = 0.8) -> DataFrame:
    """Events (path, ts) at least `seconds` after the last accepted one of their path."""

    def accept(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values("ts")
        kept = []
        for ts in rows["ts"]:
            now = ts.timestamp()
            if last is None or now - last >= seconds:
                kept.append(ts)
                last = now
        state.update((last,))
        yield pd.DataFrame({"path": [key[0]] * len(kept), "ts": pd.Series(kept, dtype="datetime64[us]")})

    return events.groupBy("path").applyInPandasWithState(accept, "path string, ts timestamp", "last double", "append", GroupStateTimeout.NoTimeout)


def run_batches(stream: DataFrame, build: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Apply a batch query to each micro-batch and append its rows as one table; a batch written twice replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        build(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="5 seconds")).start()


def lanes(verdicts: DataFrame, seconds: str = "seconds", fast: float = 5.0, slow: float = 90.0) -> DataFrame:
    """Add lane: 0 decided fast, 1 deferred, 2 resumed without limit after a time-out."""
    return verdicts.withColumn("lane", F.when(F.col(seconds) <= fast, 0).when(F.col(seconds) <= slow, 1).otherwise(2))
