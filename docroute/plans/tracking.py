"""Queries on file lifecycles and daily figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from docroute.operators import lifecycle as L
from docroute.sources.fixtures import LIFECYCLE_SQL, lifecycle_events, table


def tracker_rows(spark, sf_dir):
    return L.tracker(lifecycle_events(spark, sf_dir))


def tracker_summary(spark, sf_dir):
    t = tracker_rows(spark, sf_dir)
    s = t.groupBy("status").agg(F.count("*").alias("files"), F.avg(F.when(F.col("total_secs") > 0, F.col("total_secs"))).alias("mean"))
    return s.select("status", "files", L.hms(F.floor(F.coalesce("mean", F.lit(0.0)))).alias("mean_hms"))


def daily_audit(spark, sf_dir):
    """Counts and mean seconds of each day; seconds of 0 do not count."""
    e = lifecycle_events(spark, sf_dir)
    n = lambda k: F.count_if(F.col("kind") == k)
    return e.groupBy(F.to_date("ts").cast("string").alias("day")).agg(
        F.count("*").alias("total"), n("HOT_END").alias("complete"), n("NEEDS_REVIEW").alias("review"), F.round(F.avg(F.when(F.col("value") > 0, F.col("value"))), 4).alias("mean_secs")
    )


def dashboard(spark, sf_dir):
    """Sections of label, value and note over the whole log."""
    e = lifecycle_events(spark, sf_dir)
    n = lambda k: F.count_if(F.col("kind") == k)
    a = e.agg(F.count("*").alias("all"), n("HOT_END").alias("done"), n("NEEDS_REVIEW").alias("review"), n("EDM_END").alias("edm"), n("EDM_START").alias("edm_start"))
    note = lambda c, text: F.when(F.col(c) > 0, F.lit(text))
    rate = F.coalesce(F.concat(F.round(F.try_divide(100.0 * F.col("edm"), F.col("edm_start")), 0).cast("int").cast("string"), F.lit("%")), F.lit("N/A"))
    rows = [
        (1, "Files Processed", F.col("all").cast("string"), None), (2, "Complete", F.col("done").cast("string"), None), (3, "Needs Review", F.col("review").cast("string"), note("review", "manual check required")),
        (4, "Files Checked", F.col("edm_start").cast("string"), None), (5, "Checked Rate", rate, None),
    ]
    s = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(k).alias("label"), v.alias("value"), (F.lit(None).cast("string") if m is None else m).alias("note")) for i, k, v, m in rows])
    return a.select(F.inline(s))


def folder_counts(spark, sf_dir):
    return tracker_rows(spark, sf_dir).groupBy("status").agg(F.count("*").alias("files"))


def idle_sessions(spark, sf_dir):
    """Arrivals of each file with pauses under an hour."""
    s = L.idle_gaps(lifecycle_events(spark, sf_dir), "file", 3600)
    return s.groupBy("file").agg(F.max("session").alias("sessions"), F.max("n").alias("longest"))


def latest_open(spark, sf_dir):
    """The last event of each file that is not the end of its check: a last-row-wins look-up."""
    e = lifecycle_events(spark, sf_dir).where("kind <> 'EDM_END'")
    return e.groupBy("file").agg(F.max_by(F.struct("event_id", "kind"), F.struct("ts", "event_id")).alias("x")).select("file", "x.event_id", "x.kind")


def json_cache(spark, sf_dir):
    """Existence facts from JSON texts: a bare number or an object."""
    e = table(spark, sf_dir, "events")
    p = F.from_json("props", "map<string,string>")
    return e.groupBy(F.col("user_id")).agg(F.sum(F.coalesce(F.try_element_at(p, F.lit("k")).try_cast("long"), F.lit(0))).alias("k_sum"), F.count_if(F.map_contains_key(p, "k")).alias("with_k"))


_HMS = "concat(lpad((({0})::BIGINT // 3600)::VARCHAR, 2, '0'), ':', lpad((({0})::BIGINT % 3600 // 60)::VARCHAR, 2, '0'), ':', lpad((({0})::BIGINT % 60)::VARCHAR, 2, '0'))"
_SECS = "greatest(floor(epoch({b}))::BIGINT - floor(epoch({a}))::BIGINT, 0)"
_E = f"e AS ({LIFECYCLE_SQL})"
_TRACK = f"""{_E}, w AS (SELECT *, sum(CASE WHEN kind = 'HOT_START' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY ts, event_id) AS run FROM e),
 g AS (SELECT file, run, min(ts) FILTER (WHERE kind = 'HOT_START') AS hs, max(ts) FILTER (WHERE kind = 'HOT_END') AS he, min(ts) FILTER (WHERE kind = 'EDM_START') AS es, max(ts) FILTER (WHERE kind = 'EDM_END') AS ee, arg_max(kind, (ts, event_id)) AS k FROM w GROUP BY file, run),
 h AS (SELECT file, run, CASE WHEN hs IS NULL OR he IS NULL THEN CASE WHEN hs IS NULL AND he IS NULL THEN 0 ELSE 0 END ELSE {_SECS.format(a='hs', b='he')} END AS hot_secs,
  CASE WHEN es IS NULL OR ee IS NULL THEN 0 ELSE {_SECS.format(a='es', b='ee')} END AS edm_secs, k FROM g),
 t AS (SELECT file, max(run) OVER (PARTITION BY file)::BIGINT AS runs, hot_secs, edm_secs, hot_secs + edm_secs AS total_secs, {_HMS.format('hot_secs + edm_secs')} AS total_hms,
  CASE k WHEN 'NEEDS_REVIEW' THEN 'NEEDS-REVIEW' WHEN 'EDM_END' THEN 'COMPLETE' ELSE 'IN-PROGRESS' END AS status, row_number() OVER (PARTITION BY file ORDER BY run DESC) AS n FROM h)"""
QUERIES = {f.__name__: f for f in (tracker_rows, tracker_summary, daily_audit, dashboard, folder_counts, idle_sessions, latest_open, json_cache)}
ORACLES = {
    "tracker_rows": f"WITH {_TRACK} SELECT file, runs, hot_secs, edm_secs, total_secs, total_hms, status FROM t WHERE n = 1",
    "tracker_summary": f"WITH {_TRACK} SELECT status, count(*) AS files, {_HMS.format('floor(coalesce(avg(CASE WHEN total_secs > 0 THEN total_secs END), 0))')} AS mean_hms FROM t WHERE n = 1 GROUP BY status",
    "daily_audit": f"WITH {_E} SELECT ts::DATE::VARCHAR AS day, count(*) AS total, count(*) FILTER (WHERE kind = 'HOT_END') AS complete, count(*) FILTER (WHERE kind = 'NEEDS_REVIEW') AS review, round(avg(CASE WHEN value > 0 THEN value END), 4) AS mean_secs FROM e GROUP BY 1",
    "dashboard": f"""WITH {_E}, a AS (SELECT count(*) AS n, count(*) FILTER (WHERE kind = 'HOT_END') AS d, count(*) FILTER (WHERE kind = 'NEEDS_REVIEW') AS r, count(*) FILTER (WHERE kind = 'EDM_START') AS s, count(*) FILTER (WHERE kind = 'EDM_END') AS x FROM e)
 SELECT 1 AS place, 'Files Processed' AS label, n::VARCHAR AS value, NULL AS note FROM a UNION ALL SELECT 2, 'Complete', d::VARCHAR, NULL FROM a UNION ALL SELECT 3, 'Needs Review', r::VARCHAR, CASE WHEN r > 0 THEN 'manual check required' END FROM a
 UNION ALL SELECT 4, 'Files Checked', s::VARCHAR, NULL FROM a UNION ALL SELECT 5, 'Checked Rate', CASE WHEN s = 0 THEN 'N/A' ELSE concat(round(100.0::DOUBLE * x / s, 0)::INT, '%') END, NULL FROM a""",
    "folder_counts": f"WITH {_TRACK} SELECT status, count(*) AS files FROM t WHERE n = 1 GROUP BY status",
    "idle_sessions": f"""WITH {_E}, g AS (SELECT *, CASE WHEN floor(epoch(ts))::BIGINT - floor(epoch(lag(ts) OVER (PARTITION BY file ORDER BY ts, event_id)))::BIGINT < 3600 THEN 0 ELSE 1 END AS s FROM e),
 x AS (SELECT file, sum(s) OVER (PARTITION BY file ORDER BY ts, event_id) AS session FROM g), y AS (SELECT file, session, count(*) AS n FROM x GROUP BY ALL) SELECT file, max(session)::BIGINT AS sessions, max(n) AS longest FROM y GROUP BY file""",
    "latest_open": f"WITH {_E} SELECT file, event_id, kind FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY ts DESC, event_id DESC) AS n FROM e WHERE kind <> 'EDM_END') WHERE n = 1",
    "json_cache": "SELECT user_id, sum(coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0))::BIGINT AS k_sum, count(*) FILTER (WHERE json_exists(props, '$.k')) AS with_k FROM events GROUP BY user_id",
}
