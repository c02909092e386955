"""Audit rows of the three stages, the dashboard recomputed from them, and appends whose columns may grow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hotfolder_rows(events: DataFrame, tier: Column) -> DataFrame:
    """ts, awb, file, method, tier, secs (2 places), result."""
    return events.select("ts", "awb", "file", "method", tier.alias("tier"), F.round("secs", 2).alias("secs"), "result")


def check_rows(events: DataFrame) -> DataFrame:
    """ts, awb, file, result, dup_pages, total_pages, ratio (3 places)."""
    return events.select("ts", "awb", "file", "result", "dup_pages", "total_pages", F.round(F.try_divide(F.col("dup_pages").cast("double"), "total_pages"), 3).alias("ratio"))


def _lines(day: DataFrame, section: str, lines: list[tuple[str, Column, Column]]) -> DataFrame:
    """One pass over a day's rows; label, value and note of each line."""
    row = day.agg(*[c for k, (_, value, note) in enumerate(lines) for c in (value.alias(f"v{k}"), note.alias(f"n{k}"))])
    each = [F.struct(F.lit(section).alias("section"), F.lit(k).alias("line"), F.lit(label).alias("label"), F.col(f"v{k}").cast("string").alias("value"), F.col(f"n{k}").alias("note")) for k, (label, _, _) in enumerate(lines)]
    return row.select(F.inline(F.array(*each)))


def dashboard(hot: DataFrame, checks: DataFrame, batches: DataFrame, day: Column) -> DataFrame:
    """section, line, label, value and note of a day's dashboard; every section is one aggregate over its rows."""
    of_day = lambda df: df.where(F.to_date("ts") == day)
    n = lambda c, value: F.count_if(F.upper(c) == value)
    no = F.lit(None).cast("string")
    warn = lambda count, text: F.when(count > 0, F.lit(text))
    result, tier = F.col("result"), F.col("tier")
    mean = F.coalesce(F.format_string("%.1fs", F.avg(F.when(F.col("secs") != 0, F.col("secs")))), F.lit("N/A"))
    hot_lines = [
        ("Files Processed", F.count("*"), no), ("Complete", n(result, "COMPLETE"), no),
        ("Needs Review", n(result, "NEEDS_REVIEW"), warn(n(result, "NEEDS_REVIEW"), "manual check required")), ("Failed", n(result, "FAILED"), warn(n(result, "FAILED"), "check log")),
        ("Avg Processing Time", F.when(F.avg("secs").isNull(), "N/A").otherwise(mean), no), *[(f"Tier {t}", F.count_if(tier == t), no) for t in ("High", "Medium", "Low")],
    ]
    kinds = ("CLEAN", "PARTIAL-CLEAN", "REJECTED", "CLEAN-UNCHECKED")
    total = F.count_if(F.upper(result).isin(*kinds))
    rate = F.when(total > 0, F.format_string("%.0f%%", F.bround((n(result, "CLEAN") + n(result, "PARTIAL-CLEAN")) * 100.0 / total, 0))).otherwise("N/A")
    check_lines = [("Files Checked", total, no), *[(k, n(result, k), warn(n(result, k), "duplicates found") if k == "REJECTED" else no) for k in kinds], ("Clean Rate", rate, no)]
    kind = F.col("event_type")
    batch_lines = [(k, n(kind, k), warn(n(kind, k), "check logs") if k == "TIFF_FAILED" else no) for k in ("BATCH_BUILT", "TIFF_CONVERTED", "TIFF_FAILED")]
    return _lines(of_day(hot), "HOTFOLDER", hot_lines).union(_lines(of_day(checks), "CHECK", check_lines)).union(_lines(of_day(batches), "BATCH", batch_lines))


def append_rows(rows: DataFrame, path: str, key: str | None = None) -> None:
    """Append rows to a Parquet log whose columns may grow: new columns are added, missing ones are null; by `key`, a row is written once.

    Of rows with one key in an append any one is written, and rows that stand in the log are left out. One append at a time: two at once do not see each other.
    """
    spark = rows.sparkSession
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if key and at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        rows = rows.join(read_log(spark, path).select(key), key, "left_anti")
    if key:
        rows = rows.dropDuplicates([key])
    rows.write.mode("append").parquet(path)


def read_log(spark, path: str) -> DataFrame:
    """A log with all columns that any append had."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_json(rows: DataFrame, path: str) -> None:
    """Append events as JSON lines, keys without a value left out."""
    rows.write.mode("append").json(path)


def versioned_copies(outputs: DataFrame, present: DataFrame) -> DataFrame:
    """file, copy and status of batches that go to the print folder: a name that is there gets the next free _v2, _v3 ...

    outputs: file (ends in .pdf), ok (the source could be read); present: file. Only the versions of names in question are looked at,
    and the first free number is the first whose predecessor run ends: numbers in use from 2 on without a gap.
    """
    stem = lambda c: F.regexp_replace(c, r"\.pdf$", "")
    used = present.select(F.regexp_replace(stem("file"), r"_v\d+$", "").alias("stem"), F.coalesce(F.nullif(F.regexp_extract(stem("file"), r"_v(\d+)$", 1), F.lit("")).cast("int"), F.lit(1)).alias("v"))
    used = used.groupBy("stem").agg(F.array_sort(F.collect_set("v")).alias("used"))
    o = outputs.select("file", "ok", stem("file").alias("stem")).join(used, "stem", "left")
    have = F.coalesce("used", F.array().cast("array<int>"))
    free = F.array_min(F.array_except(F.sequence(F.lit(2), F.size(have) + 2), have))
    name = F.when(F.array_contains(have, 1), F.concat("stem", F.lit("_v"), free.cast("string"), F.lit(".pdf"))).otherwise(F.col("file"))
    return o.select("file", F.when(F.col("ok"), name).alias("copy"), F.when(F.col("ok"), "OK").otherwise("ERROR").alias("status"))
