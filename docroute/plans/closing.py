"""Queries on look-ups, batches added to the tracker, the finished audit and logs that were written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docroute.operators import audit as A
from docroute.operators import closing as C
from docroute.sources.fixtures import KEY, table
from docroute.sources.scratch import shared_dir

#: Events as rows of the stage cache: keys with spare blanks, some without; several rows a key.
_CACHE = f"""SELECT event_id AS row_no, CASE WHEN event_id % 11 = 0 THEN '  ' ELSE concat(' ', {KEY.format('user_id')}, ' ') END AS awb,
  CASE event_type WHEN 'signup' THEN 'Filename' WHEN 'view' THEN ' ocr-exact-main' WHEN 'click' THEN 'Text-Layer-Full' WHEN 'purchase' THEN 'Rotation-OCR-EXACT' END AS method,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat({KEY.format('user_id')}, CASE WHEN event_id % 2 = 1 THEN '_2' ELSE '' END, '.pdf ') END AS processed_name FROM {{events}}"""
_FILES = f"SELECT o_orderkey, {KEY.format('o_orderkey % 4000')} AS awb, concat({KEY.format('o_orderkey % 4000')}, CASE WHEN o_custkey % 2 = 1 THEN '_2' ELSE '' END, '.pdf') AS name FROM {{orders}}"
#: Events as tracker rows, a third of them open; orders as batches added, several a key.
_ROWS = f"""SELECT event_id AS row_no, {KEY.format('user_id')} AS awb, concat({KEY.format('user_id')}, '.pdf') AS processed_name, CASE event_type WHEN 'view' THEN 'IN-PROGRESS' WHEN 'click' THEN NULL ELSE 'COMPLETE' END AS status,
  CASE WHEN event_id % 3 > 0 THEN event_id % 5000 END AS hot_secs, CASE WHEN event_id % 4 > 0 THEN event_id % 700 END AS edm_secs FROM {{events}}"""
_CALLS = f"SELECT o_orderkey AS call_no, CASE WHEN o_orderkey % 17 > 0 THEN {KEY.format('o_orderkey % 4000')} END AS awb, o_orderkey % 50 AS batch, o_orderdate AS added_at FROM {{orders}}"
_STATS = "CASE l_linenumber WHEN 1 THEN 'N/A' WHEN 2 THEN concat(cast(l_partkey % 9 as string), '/x') ELSE concat(cast(l_partkey % 9 as string), ' / ', cast(l_suppkey % 17 as string), ' pages') END"
_CHECKS = f"""SELECT l_orderkey, l_linenumber, l_shipdate AS ts, {KEY.format('l_orderkey')} AS awb, concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '.pdf') AS file,
  CASE l_returnflag WHEN 'A' THEN 'CLEAN' WHEN 'R' THEN 'REJECTED' ELSE 'PARTIAL-CLEAN' END AS status, CASE l_returnflag WHEN 'R' THEN 'REJECTED' ELSE 'CLEAN' END AS route, concat('line ', cast(l_linenumber as string)) AS reason, {_STATS} AS match_stats,
  CASE WHEN l_partkey % 3 = 0 THEN 'HIT' END AS cache, cast(l_suppkey as double) AS metadata_ms, CASE WHEN l_linenumber > 3 THEN cast(l_partkey as double) END AS download_ms, l_partkey * 1001 + l_suppkey AS took_us
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS once FROM {{lines}}) l WHERE once = 1"""


def _sql(spark, sf_dir, text):
    """The text's rows in Spark; {events} and the like name the tables."""
    at = {"events": "events", "orders": "orders", "lines": "lineitem"}
    at = {k: v for k, v in at.items() if f"{{{k}}}" in text}
    for v in at.values():
        table(spark, sf_dir, v).createOrReplaceTempView(f"{v}_of_records")
    return spark.sql(text.format(**{k: f"{v}_of_records" for k, v in at.items()}))


def tier_lookup(spark, sf_dir):
    """Each file's tier by its key's last cache row, and the last cache row of its name."""
    cache = _sql(spark, sf_dir, _CACHE)
    stage = C.stage_rows(cache).select(F.col("processed_name").alias("name"), F.col("row_no").alias("stage_row"), F.trim("method").alias("stage_method"))
    return C.with_tier(_sql(spark, sf_dir, _FILES), cache).join(stage, "name", "left").select("o_orderkey", "tier", "stage_row", "stage_method")


def batches_added(spark, sf_dir):
    """The tracker's rows after all batches."""
    t = C.batch_added(_sql(spark, sf_dir, _ROWS), _sql(spark, sf_dir, _CALLS))
    return t.select("row_no", "awb", "processed_name", "status", "call_no", "batch", "total_secs", "total_hms")


def _finished(spark, sf_dir):
    c = _sql(spark, sf_dir, _CHECKS).withColumns({f"{s}_ms": F.lit(None).cast("double") for s in C.STEPS if s not in ("metadata", "download")})
    start = F.timestamp_micros(F.col("l_orderkey") * 1_000_000)
    return C.finished(c.withColumns({"started_at": start, "ended_at": F.timestamp_micros(F.unix_micros(start) + F.col("took_us"))}))


def finished_audit(spark, sf_dir):
    """Sheet rows and what their events say."""
    said = lambda key: F.get_json_object("event", f"$.{key}")
    f = _finished(spark, sf_dir)
    return f.select(
        "file", "awb", "result", "dup_pages", "total_pages", "ratio", "secs", "method", "notes", said("stage").alias("stage"), said("route").alias("route"), said("match_stats").alias("match_stats"),
        *[said(f"timings_ms.{s}").cast("double").alias(f"{s}_ms") for s in ("metadata", "download", "total_active")],
    )


def appended_logs(spark, sf_dir):
    """The sheet and the event log as read again: two appends, the second with more columns and once more with rows that stand there."""
    base = f"{shared_dir(spark)}/logs-{uuid.uuid4().hex}"
    rows, late = _finished(spark, sf_dir), F.pmod(F.hash("file"), F.lit(2)) == 1
    plain = rows.select("file", "result", "secs")
    A.append_rows(plain.where(~late), f"{base}/sheet", "file")
    again = rows.select("file", "result", "secs", "notes")
    A.append_rows(again.union(again.where(late)), f"{base}/sheet", "file")
    A.append_json(rows.where(~late).select("file", "ratio"), f"{base}/events")
    A.append_json(rows.where(late).select("file", "ratio"), f"{base}/events")
    events = spark.read.schema("file string, ratio double").json(f"{base}/events")
    sheet = A.read_log(spark, f"{base}/sheet")
    known = F.coalesce(F.col("notes").isNotNull() == late, F.lit(False))
    return sheet.join(events, "file").select("file", "result", "secs", "ratio", known.alias("as_written"))


_DUCK = {"events": "events", "orders": "orders", "lines": "lineitem"}
_TIERS = "CASE WHEN upper(trim(method)) LIKE 'FILENAME%' OR upper(trim(method)) LIKE 'TEXTLAYER-EXACT%' OR upper(trim(method)) LIKE 'TEXT-LAYER%' THEN 'High' WHEN upper(trim(method)) LIKE 'OCR-EXACT%' THEN 'Medium' ELSE 'Low' END"
_HMS = "concat(lpad(({0} // 3600)::VARCHAR, 2, '0'), ':', lpad(({0} % 3600 // 60)::VARCHAR, 2, '0'), ':', lpad(({0} % 60)::VARCHAR, 2, '0'))"
_SHEET = f"""c AS ({_CHECKS.format(**_DUCK)}), b AS (SELECT *, (took_us + 50) // 100 AS tenths, tenths / 10.0::DOUBLE AS total_ms, CASE WHEN l_linenumber > 1 THEN split_part(match_stats, '/', 1)::BIGINT END AS dup_pages,
  CASE WHEN l_linenumber > 2 THEN regexp_extract(match_stats, '/ ([0-9]+)', 1)::BIGINT END AS total_pages FROM c),
 a AS (SELECT *, CASE WHEN total_pages = 0 THEN 0.0 ELSE round_even(dup_pages / total_pages::DOUBLE, 3) END::DOUBLE AS ratio, (tenths + 50) // 100 / 100.0::DOUBLE AS secs FROM b)"""
QUERIES = {f.__name__: f for f in (tier_lookup, batches_added, finished_audit, appended_logs)}
ORACLES = {
    "tier_lookup": f"""WITH c AS ({_CACHE.format(**_DUCK)}), f AS ({_FILES.format(**_DUCK)}), t AS (SELECT trim(awb) AS awb, {_TIERS} AS tier FROM c WHERE trim(awb) <> '' QUALIFY row_number() OVER (PARTITION BY trim(awb) ORDER BY row_no DESC) = 1),
 s AS (SELECT trim(processed_name) AS name, row_no, trim(method) AS method FROM c WHERE trim(processed_name) <> '' QUALIFY row_number() OVER (PARTITION BY trim(processed_name) ORDER BY row_no DESC) = 1)
 SELECT o_orderkey, coalesce(tier, 'Low') AS tier, row_no AS stage_row, method AS stage_method FROM f LEFT JOIN t USING (awb) LEFT JOIN s USING (name)""",
    # The n-th call of a key completes a row if n rows are open: by counts here, by a join of ranks there.
    "batches_added": f"""WITH r AS ({_ROWS.format(**_DUCK)}), k AS ({_CALLS.format(**_DUCK)}), o AS (SELECT awb, list(row_no ORDER BY row_no DESC) AS open FROM r WHERE status IS NULL OR status = 'IN-PROGRESS' GROUP BY awb),
 m AS (SELECT awb, list({{'call_no': call_no, 'batch': batch}} ORDER BY call_no) AS calls FROM k WHERE awb IS NOT NULL GROUP BY awb),
 x AS (SELECT awb, unnest(calls, recursive := true), unnest(range(len(calls))) AS i FROM m), y AS (SELECT x.*, o.open[i + 1] AS row_no FROM x LEFT JOIN o USING (awb)),
 u AS (SELECT r.*, y.call_no, y.batch, coalesce(hot_secs, 0) + coalesce(edm_secs, 0) AS secs FROM r LEFT JOIN y ON y.row_no = r.row_no)
 SELECT row_no, awb, processed_name, CASE WHEN call_no IS NULL THEN status ELSE 'COMPLETE' END AS status, call_no, batch, CASE WHEN call_no IS NOT NULL THEN secs END AS total_secs, CASE WHEN call_no IS NOT NULL THEN {_HMS.format('secs')} END AS total_hms FROM u
 UNION ALL SELECT NULL, awb, concat(awb, '.pdf'), 'COMPLETE', call_no, batch, NULL, NULL FROM y WHERE row_no IS NULL UNION ALL SELECT NULL, NULL, NULL, 'COMPLETE', call_no, batch, NULL, NULL FROM k WHERE awb IS NULL""",
    "finished_audit": f"""WITH {_SHEET} SELECT file, awb, status AS result, dup_pages, total_pages, ratio, secs, coalesce(cache, 'MISS') AS method, reason AS notes, 'EDM_CHECK' AS stage, route, match_stats, metadata_ms, download_ms, total_ms AS total_active_ms FROM a""",
    "appended_logs": f"WITH {_SHEET} SELECT file, status AS result, secs, ratio, TRUE AS as_written FROM a",
}
