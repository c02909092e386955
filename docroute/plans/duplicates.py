"""Queries on the duplicate check from pages to routes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docroute.operators import duplicates as D
from docroute.operators import routing as R
from docroute.plans.pages import _ROUTE
from docroute.sources.fixtures import table
from docroute.sources.scratch import shared_dir

#: Lines as pages: even orders are incoming files, odd ones archived documents of the same customer. A text is a word of 20 letters, i of
#: which are common to both sides, so the best stretch of two has a similarity of 200 m / (20 + m), m the smaller i.
_PAGES = """SELECT o_custkey AS awb, o_orderkey AS file_id, l_linenumber AS page_no, l_linenumber = 7 AS exempt, l_partkey % 389 AS page_hash,
  (l_suppkey * 31 + l_partkey) % 127 * 72340172838076673 AS phash, CASE WHEN l_partkey % 16 = 0 THEN '' ELSE {text} END AS text, {ocr} AS ocr, o_custkey % 3 = 0 AS token_signal
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS once FROM lineitem) l JOIN orders o ON o_orderkey = l_orderkey WHERE once = 1"""
_WORD = "concat(repeat('x', cast({i} as int)), repeat('{fill}', 20 - cast({i} as int)))"
_I, _J = "(l_suppkey % 9)", "(l_partkey % 10)"


def _pages_sql(fill: str, other: str) -> str:
    return _PAGES.format(text=_WORD.format(i=_I, fill=fill), ocr=_WORD.format(i=_J, fill=other))


def _sides(spark, sf_dir):
    for name in ("lineitem", "orders"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"{name}_of_pages")
    at = lambda q: spark.sql(q.replace("FROM lineitem", "FROM lineitem_of_pages").replace("JOIN orders o", "JOIN orders_of_pages o"))
    inc, arc = at(_pages_sql("y", "w")).where("file_id % 2 = 0"), at(_pages_sql("z", "v")).where("file_id % 2 = 1")
    return inc, arc.withColumnsRenamed({"file_id": "doc", "page_no": "doc_page"})


def _keep(spark):
    base = f"{shared_dir(spark)}/duplicates-{uuid.uuid4().hex}"

    def keep(df, name):
        path = f"{base}/{name}-{uuid.uuid4().hex[:6]}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


def duplicate_check(spark, sf_dir):
    inc, arc = _sides(spark, sf_dir)
    return D.check(inc, arc, inc.select("file_id", "token_signal").distinct(), _keep(spark))


def duplicate_routes(spark, sf_dir):
    """What becomes of each incoming file after the whole check."""
    inc, _ = _sides(spark, sf_dir)
    pages = inc.select("file_id", "page_no").join(duplicate_check(spark, sf_dir).select("file_id", "page_no", "method"), ["file_id", "page_no"], "left")
    return R.routes(pages).select("file_id", "total", "dup", "confidence", "route", "rejected_pages", "clean_pages")


def _fold(name: str, rows: str) -> str:
    """CTEs of the claims of `rows`, one row after the other: {name}(file_id, k, claimed, docs, focus, needed, tier, page_no, doc, doc_page, score, took)."""
    free = "(r.focus IS NULL OR r.focus = o.doc)"
    took = f"({free} AND o.score IS NOT NULL AND NOT list_contains(r.claimed, o.page_no))"
    count = "len(list_filter(r.docs, lambda d: d = o.doc)) + 1"
    return f"""{name}_o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY tier, page_no, doc, doc_page) AS k FROM ({rows})),
{name} AS (SELECT DISTINCT file_id, 0::BIGINT AS k, []::BIGINT[] AS claimed, []::BIGINT[] AS docs, NULL::BIGINT AS focus, FALSE AS needed, NULL::INT AS tier, NULL::BIGINT AS page_no, NULL::BIGINT AS doc, NULL::BIGINT AS doc_page, NULL::DOUBLE AS score, FALSE AS took FROM {name}_o
 UNION ALL SELECT r.file_id, o.k, CASE WHEN {took} THEN list_append(r.claimed, o.page_no) ELSE r.claimed END, CASE WHEN {took} THEN list_append(r.docs, o.doc) ELSE r.docs END,
  CASE WHEN {took} AND {count} >= {R.FOCUS_PAGES} THEN o.doc ELSE r.focus END, r.needed OR ({free} AND o.score IS NULL), o.tier, o.page_no, o.doc, o.doc_page, o.score, {took}
  FROM {name} r JOIN {name}_o o ON o.file_id = r.file_id AND o.k = r.k + 1),
{name}_s AS (SELECT file_id, arg_max(focus, k) AS focus, bool_or(needed) AS needed, count(*) FILTER (WHERE took) AS dup, count(*) FILTER (WHERE took AND tier <= 3) AS signals FROM {name} GROUP BY file_id),
{name}_l AS (SELECT i.*, s.focus FROM inc i LEFT JOIN {name}_s s USING (file_id) WHERE NOT EXISTS (FROM {name} r WHERE r.took AND r.file_id = i.file_id AND r.page_no = i.page_no))"""


def _score(a: str, b: str) -> str:
    """By construction: letters in common are at the front of both words."""
    m = f"least(length(replace(replace({a}, 'y', ''), 'w', '')), length(replace(replace({b}, 'z', ''), 'v', '')))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE 200.0 * {m} / (20 + {m}) END"


_FOCUS = "(l.focus IS NULL OR l.focus = arc.doc)"
_ANY_I, _ANY_D = "CASE WHEN l.text = '' THEN l.ocr ELSE l.text END", "CASE WHEN arc.text = '' THEN arc.ocr ELSE arc.text END"
_CHECK = f"""WITH RECURSIVE inc AS MATERIALIZED (SELECT * FROM ({_pages_sql('y', 'w')}) WHERE file_id % 2 = 0 AND NOT exempt),
arc AS MATERIALIZED (SELECT awb, file_id AS doc, page_no AS doc_page, page_hash, phash, text, ocr FROM ({_pages_sql('z', 'v')}) WHERE file_id % 2 = 1),
h AS (SELECT file_id, page_no, doc, doc_page, CASE WHEN inc.page_hash = arc.page_hash THEN 1 WHEN bit_count(xor(inc.phash, arc.phash)) <= {R.PHASH_DISTANCE} THEN 2 END AS tier,
  CASE WHEN inc.page_hash = arc.page_hash THEN 100.0 ELSE bit_count(xor(inc.phash, arc.phash)) END::DOUBLE AS score FROM inc JOIN arc USING (awb)),
hr AS MATERIALIZED (SELECT * FROM h WHERE tier IS NOT NULL),
{_fold('a', 'FROM hr')},
tp AS (SELECT l.file_id, l.page_no, arc.doc, arc.doc_page, l.text = '' OR arc.text = '' AS missing, {_score('l.text', 'arc.text')} AS score FROM a_l l JOIN arc USING (awb) WHERE {_FOCUS}),
tm AS (SELECT file_id, page_no, doc, min(doc_page) FILTER (WHERE score >= 50) AS hit, min(doc_page) FILTER (WHERE missing) AS miss FROM tp GROUP BY ALL),
br AS MATERIALIZED (FROM hr UNION ALL SELECT file_id, page_no, doc, doc_page, 3, score FROM tp WHERE score >= 50 UNION ALL SELECT file_id, page_no, doc, miss, 3, NULL FROM tm WHERE miss < coalesce(hit, 1000000)),
{_fold('b', 'FROM br')},
w AS (SELECT DISTINCT l.file_id FROM b_l l JOIN arc USING (awb) WHERE l.page_no <= 3 AND arc.doc_page <= 5 AND {_score('l.ocr', _ANY_D)} >= 50),
g AS (SELECT f.file_id, coalesce(signals, 0) = 0 AND NOT token_signal AS cold, coalesce(needed, FALSE) AS needed, w.file_id IS NOT NULL AS hit, s.focus IS NOT NULL AND dup > 0 AS safe
  FROM (SELECT DISTINCT file_id, token_signal FROM ({_pages_sql('y', 'w')}) WHERE file_id % 2 = 0) f LEFT JOIN b_s s USING (file_id) LEFT JOIN w USING (file_id)),
sp AS (SELECT l.file_id, l.page_no, arc.doc, arc.doc_page, 4, {_score(_ANY_I, _ANY_D)} AS score FROM b_l l JOIN g USING (file_id) JOIN arc USING (awb)
  WHERE (needed OR cold) AND (hit OR coalesce(safe, FALSE)) AND {_FOCUS} AND (cold OR (l.page_no <= 10 AND arc.doc_page <= 10))),
{_fold('c', 'FROM br UNION ALL FROM sp WHERE score >= 50')}, """
_CLAIMED = "SELECT file_id, page_no, ['HASH', 'PHASH', 'TEXT', 'OCR'][tier] AS method, doc, doc_page, round(score, 6) AS score FROM c WHERE took"

QUERIES = {f.__name__: f for f in (duplicate_check, duplicate_routes)}
ORACLES = {
    "duplicate_check": f"{_CHECK} z AS (SELECT 1) {_CLAIMED}",
    "duplicate_routes": f"""{_CHECK} m AS ({_CLAIMED}), x AS (SELECT f.file_id, f.page_no, method FROM ({_pages_sql('y', 'w')}) f LEFT JOIN m ON m.file_id = f.file_id AND m.page_no = f.page_no WHERE f.file_id % 2 = 0),
 n AS (SELECT file_id, count(*) AS total, count(method) AS dup, count(*) FILTER (WHERE method = 'HASH') AS h, count(*) FILTER (WHERE method = 'PHASH') AS p, count(*) FILTER (WHERE method IN ('TEXT', 'OCR')) AS t FROM x GROUP BY file_id),
 q AS (SELECT *, CASE WHEN h >= 1 OR (p >= 2 AND t >= 1) THEN 'HIGH' WHEN p >= 3 OR (t >= 3 AND p >= 1) THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM n), v AS (SELECT *, {_ROUTE} AS route FROM q),
 e AS (SELECT *, CASE route WHEN 'REJECTED' THEN total WHEN 'PARTIAL-CLEAN' THEN dup ELSE 0 END AS rejected_pages FROM v)
 SELECT file_id, total, dup, confidence, route, rejected_pages, total - rejected_pages AS clean_pages FROM e""",
}
