"""One row for each file from its event log, times as text, and daily figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seconds_between(a: Column, b: Column) -> Column:
    """Whole-second difference, not below 0; null if either is null."""
    return F.greatest(F.unix_timestamp(b) - F.unix_timestamp(a), F.lit(0))


def hms(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(s / 3600)), two(F.floor((s % 3600) / 60)), two(s % 60))


def tracker(events: DataFrame) -> DataFrame:
    """file, runs, hot_secs, edm_secs, total_secs, total_hms, status of the last run of each file.

    HOT_START opens a run; other events belong to the latest run that is open before them. events: file, event_id, ts, kind.
    """
    w = Window.partitionBy("file").orderBy("ts", "event_id")
    e = events.withColumn("run", F.sum((F.col("kind") == "HOT_START").cast("int")).over(w))
    at = lambda k: F.max(F.when(F.col("kind") == k, F.col("ts")))
    first = lambda k: F.min(F.when(F.col("kind") == k, F.col("ts")))
    r = e.groupBy("file", "run").agg(first("HOT_START").alias("hs"), at("HOT_END").alias("he"), first("EDM_START").alias("es"), at("EDM_END").alias("ee"), F.max_by("kind", F.struct("ts", "event_id")).alias("last_kind"))
    hot, edm = seconds_between(F.col("hs"), F.col("he")), seconds_between(F.col("es"), F.col("ee"))
    r = r.withColumns({"hot_secs": hot, "edm_secs": edm}).withColumn("total_secs", F.coalesce("hot_secs", F.lit(0)) + F.coalesce("edm_secs", F.lit(0)))
    status = F.when(F.col("last_kind") == "NEEDS_REVIEW", "NEEDS-REVIEW").when(F.col("last_kind") == "EDM_END", "COMPLETE").otherwise("IN-PROGRESS")
    last = r.withColumns({"n": F.row_number().over(Window.partitionBy("file").orderBy(F.desc("run"))), "runs": F.max("run").over(Window.partitionBy("file"))}).where("n = 1")
    return last.select("file", "runs", "hot_secs", "edm_secs", "total_secs", hms(F.col("total_secs")).alias("total_hms"), status.alias("status"))


def detection_tier(method: Column, prefix_only: bool = False) -> Column:
    """Tier of a detection method by its name. Audits look for OCR-EXACT anywhere, batches at the start only."""
    m = F.upper(F.coalesce(method, F.lit("")))
    medium = m.startswith("OCR-EXACT") if prefix_only else m.contains("OCR-EXACT")
    return F.when(m.rlike("^(FILENAME|TEXTLAYER-EXACT|TEXT-LAYER)"), "High").when(medium, "Medium").otherwise("Low")


def status_of(outcome: Column) -> Column:
    return F.when(outcome == "REJECTED", "REJECTED").when(outcome == "NEEDS-REVIEW", "NEEDS-REVIEW").otherwise("IN-PROGRESS")


def idle_gaps(events: DataFrame, by: str, quiet_seconds: int) -> DataFrame:
    """by, session, first, last, n: arrivals with pauses shorter than `quiet_seconds` between them."""
    w = Window.partitionBy(by).orderBy("ts", "event_id")
    gap = F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(w))
    e = events.withColumn("starts", F.coalesce((gap >= quiet_seconds).cast("int"), F.lit(1)))
    e = e.withColumn("session", F.sum("starts").over(w))
    return e.groupBy(by, "session").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))
