"""What closes a file's record: tiers and stage rows looked up (the last row wins), batches added to the tracker, the finished audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.operators.lifecycle import detection_tier, hms
from docroute.sources.readers import last_wins

#: Steps whose milliseconds an audit event lists.
STEPS = ("metadata", "download", "extract", "compare", "route")


def tiers(cache: DataFrame) -> DataFrame:
    """awb, tier of the last row of each key. cache: row_no, awb, method; keys and methods are trimmed, rows without a key go."""
    rows = cache.select("row_no", F.trim("awb").alias("awb"), F.trim("method").alias("method")).where("awb <> ''")
    return last_wins(rows, "awb", "row_no").select("awb", detection_tier(F.col("method"), prefix_only=True).alias("tier"))


def stage_rows(cache: DataFrame) -> DataFrame:
    """The last row of each processed file: name trimmed, nameless rows gone."""
    return last_wins(cache.withColumn("processed_name", F.trim("processed_name")).where("processed_name <> ''"), "processed_name", "row_no")


def with_tier(files: DataFrame, cache: DataFrame) -> DataFrame:
    """files (awb) with their key's tier, Low where the cache has none."""
    t = tiers(cache).select(F.col("awb").alias("key_"), F.col("tier").alias("tier_"))
    return files.join(t, F.col("awb") == F.col("key_"), "left").withColumn("tier", F.coalesce("tier_", F.lit("Low"))).drop("key_", "tier_")


def batch_added(rows: DataFrame, calls: DataFrame) -> DataFrame:
    """The tracker after batches were added: each call completes the last open row of its key, or adds a complete one where none is open.

    rows: row_no, awb, processed_name, status (open: IN-PROGRESS or null), hot_secs, edm_secs; calls, in order of call_no: call_no, awb, batch,
    added_at. A row that a call has completed is open no more, so the n-th call of a key takes its n-th open row from the end. A call
    without key finds none. Added rows have no row_no; rows that no call takes have no batch and no total.
    """
    last, first = Window.partitionBy("awb").orderBy(F.desc("row_no")), Window.partitionBy("awb").orderBy("call_no")
    is_open = F.coalesce(F.col("status") == "IN-PROGRESS", F.lit(True))
    o = rows.where(is_open & (F.col("awb") != "")).withColumn("turn_", F.row_number().over(last))
    c = calls.select(F.col("awb").alias("key_"), F.row_number().over(first).alias("call_"), "call_no", "batch", "added_at")
    taken = o.join(c, (F.col("awb") == F.col("key_")) & (F.col("turn_") == F.col("call_")), "full")
    added = F.col("row_no").isNull() & F.col("call_no").isNotNull()
    total = F.coalesce("hot_secs", F.lit(0)) + F.coalesce("edm_secs", F.lit(0))
    name = F.when(added, F.concat("key_", F.lit(".pdf"))).otherwise(F.col("processed_name"))
    done = F.col("call_no").isNotNull()
    hit = done & ~added
    taken = taken.select(
        "row_no", F.coalesce("awb", "key_").alias("awb"), name.alias("processed_name"), F.when(done, "COMPLETE").otherwise(F.col("status")).alias("status"), "hot_secs", "edm_secs",
        "call_no", "batch", "added_at", F.when(hit, total).alias("total_secs"), F.when(hit, hms(total)).alias("total_hms"),
    )
    rest = rows.where(~(is_open & F.coalesce(F.col("awb") != "", F.lit(False)))).select("row_no", "awb", "processed_name", "status", "hot_secs", "edm_secs")
    return taken.unionByName(rest, allowMissingColumns=True)


def _whole(text: Column) -> Column:
    return F.regexp_extract(F.trim(text), r"^[+-]?\d+$", 0).try_cast("long")


def finished(checks: DataFrame) -> DataFrame:
    """ts, awb, file, event (JSON) and the sheet's result, dup_pages, total_pages, ratio, secs, method, notes of each finished check.

    checks: ts, awb, file, status, route, reason, match_stats, cache, started_at and ended_at, <step>_ms of each step. Match statistics read
    "duplicates / pages and more"; what is no number stays null, and so does all behind it; the ratio is 0 for no pages. The time is whole, not
    the sum of its steps; milliseconds have one place, seconds two, rounded half up in whole numbers. A missing cache is a MISS. Keys without a value are left out of the event.
    """
    tenths = F.floor((F.unix_micros("ended_at") - F.unix_micros("started_at") + 50) / 100)
    parts = F.split("match_stats", "/")
    dup = F.when(F.size(parts) > 1, _whole(F.get(parts, F.lit(0))))
    pages = F.when(dup.isNotNull(), _whole(F.regexp_extract(F.get(parts, F.lit(1)), r"^\s*(\S*)", 1)))
    c = checks.withColumns({"tenths_": tenths, "total_ms": tenths / 10, "dup_pages": dup, "total_pages": pages, "cache": F.coalesce("cache", F.lit("MISS")), "match_stats": F.coalesce("match_stats", F.lit("N/A"))})
    timings = F.struct(*[F.col(f"{s}_ms").alias(s) for s in STEPS], F.col("total_ms").alias("total_active"))
    event = F.to_json(F.struct(F.lit("EDM_CHECK").alias("stage"), "ts", "file", "awb", "status", "route", "reason", "match_stats", timings.alias("timings_ms"), "cache"))
    ratio = F.when(F.col("total_pages") == 0, 0.0).otherwise(F.bround(F.try_divide(F.col("dup_pages").cast("double"), "total_pages"), 3))
    return c.select(
        "ts", "awb", "file", event.alias("event"), F.col("status").alias("result"), "dup_pages", "total_pages", ratio.alias("ratio"),
        (F.floor((F.col("tenths_") + 50) / 100) / 100).alias("secs"), F.col("cache").alias("method"), F.col("reason").alias("notes"),
    )
