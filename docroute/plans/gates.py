"""Queries on gates, sources of text, page outputs, audit rows and the dashboard."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from docroute.functions import extract as X
from docroute.operators import audit as A
from docroute.operators import evidence as E
from docroute.operators import gates as G
from docroute.operators import lifecycle as L
from docroute.operators import resolve as R
from docroute.operators import routing
from docroute.plans.identify import _C, _CLEAN, _T, joined
from docroute.plans.pages import _ROUTE, _SIDES, _sides
from docroute.sources.fixtures import KEY, REF_KEYS_SQL, ref_keys, stage_texts, table

DAY = "2024-01-10"


def scan_gate(spark, sf_dir):
    """The gate before scanned pages are compared, for orders whose keys stand for signals."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    methods = F.when(k % 4 == 0, F.array().cast("array<string>")).when(k % 4 == 1, F.array(F.lit("HASH"))).when(k % 4 == 2, F.array(F.lit("OCR"))).otherwise(F.array(F.lit("OCR"), F.lit("TEXT")))
    f = o.select("o_orderkey", methods.alias("methods"), (k % 3 == 0).alias("token_signal"), (F.col("o_custkey") % 2 == 0).alias("scan_needed"), (k % 5 == 0).alias("window_hit"), (k % 7 == 0).alias("focused"), (k % 6).alias("dup_pages"))
    return G.scan_gate(f).select("o_orderkey", "run_scan", "scan_pages")


def scan_window(spark, sf_dir):
    """Pairs of pages that the window looks at, by file; every fourth page is settled before."""
    inc, arc = _sides(spark, sf_dir)
    p = G.window_pairs(inc.withColumn("skip", F.col("page_no") % 4 == 2), arc, "awb")
    return p.groupBy("file_id").agg(F.count("*").alias("pairs"), F.count_if("first").alias("first"), F.max("doc_page").cast("long").alias("last_page"))


def text_choice(spark, sf_dir):
    """Whole texts as they are, or with numbers that spaces have torn apart put together if that shows more candidates."""
    together = F.regexp_replace("text", "([0-9]) +([0-9])", "$1$2")
    n = lambda c: G.unique_candidates(F.regexp_extract_all(c, F.lit(X.TWELVE), F.lit(1)))
    d = table(spark, sf_dir, "documents").select("doc_id", "text", together.alias("together"))
    chosen = G.better_text(F.col("text"), F.col("together"), n(F.col("text")), n(F.col("together")))
    return d.select("doc_id", F.length(chosen).cast("long").alias("chars"), F.md5(chosen.cast("binary")).alias("digest"))


def candidate_counts(spark, sf_dir):
    """Different candidates of each stage text; repeats and other strings do not count."""
    clean = X.clean_candidates("text")
    return stage_texts(spark, sf_dir).select("file_id", G.unique_candidates(F.concat(clean, clean, F.array(F.lit("12"), F.lit("x")))).cast("long").alias("n"))


def probe_exit(spark, sf_dir):
    t, v = stage_texts(spark, sf_dir), F.col("variant")
    known = F.when(v == 0, F.array("awb")).when(v == 1, F.array("awb", "awb")).when(v == 2, F.array("awb", F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return t.select("file_id", G.probe_exit(F.lit(""), F.col("text"), known).alias("v")).select("file_id", "v.awb", "v.method").where("method is not null")


def page_outputs(spark, sf_dir):
    """Where each page of an incoming file goes, by exact matches."""
    inc, arc = _sides(spark, sf_dir)
    hit = routing.exact_pages(inc, arc, "awb").select("file_id", "page_no", F.lit("HASH").alias("method"))
    pages = inc.select("file_id", "page_no").join(hit, ["file_id", "page_no"], "left")
    return G.page_outputs(pages.withColumn("dup", F.col("method").isNotNull()), routing.routes(pages)).withColumn("out_page", F.col("out_page").cast("long"))


def archive_exists(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 4
    status = F.when(k % 5 == 1, 404).when(k % 5 == 2, 401).when(k % 5 == 3, 500).otherwise(200)
    found, keep = G.exists_in_archive(status, k % 3, F.when(c == 0, F.lit(True)).when(c == 1, F.lit(False)))
    return table(spark, sf_dir, "orders").select("o_orderkey", found.alias("found"), keep.alias("to_cache"))


def context_forms(spark, sf_dir):
    """Numbers by their neighbourhood: behind ACI, on carrier and air waybill lines, near keywords."""
    far = "\n".join(["filler of fifty characters that holds no mark of it"] * 2)
    n = F.col("o_orderkey") % 7
    say = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in x])
    a = F.col("awb")
    text = F.when(n == 0, say("ACI NO: ", a)).when(n == 1, say("top\nFEDEX\n", a)).when(n == 2, say("Air Waybill No ", a)).when(n == 3, say("noise ", a))
    text = text.when(n == 4, say("BILL NO\n\n", a)).when(n == 5, say("AWB\n" + far + "\n", a)).otherwise(F.lit("MAWB of nothing"))
    t = ref_keys(spark, sf_dir).withColumn("text", text)
    return t.select(
        "o_orderkey", joined(X.aci_candidates("text")).alias("aci"), joined(X.carrier_candidates("text")).alias("carrier"), joined(X.airway_candidates("text")).alias("airway"),
        joined(X.keyword_adjacent("text", X.clean_candidates("text"))).alias("adjacent"), joined(X.near_keyword_candidates("text")).alias("near"),
    )


#: Texts whose numbers stand at all distances from a keyword, by up to 50 characters and 25 lines, before and behind it.
_MARKS = ("AWB", "Tracking #", "M-A-W-B", "bill  no", "nothing", "FED EX TRACKING")
_REACH_SQL = f"""SELECT o_orderkey, awb AS one, {KEY.format('(o_orderkey + 1)')} AS two, {KEY.format('(o_orderkey + 2)')} AS three,
 concat({KEY.format('(o_orderkey + 2)')}, repeat(concat(chr(10), '.'), cast(o_custkey % 25 as int)), chr(10), CASE o_orderkey % {len(_MARKS)} {" ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MARKS))} END,
 repeat(concat(chr(10), '-'), cast(o_orderkey % 23 as int)), repeat(' ', cast(o_custkey % 3 as int)), awb, repeat(concat('~', chr(10)), cast(o_custkey % 19 as int)), ' ', {KEY.format('(o_orderkey + 1)')}) AS text
 FROM (SELECT k.o_orderkey, awb, o_custkey FROM ({REF_KEYS_SQL}) k JOIN orders o ON o.o_orderkey = k.o_orderkey)"""


def keyword_reach(spark, sf_dir):
    """Which of three numbers of a text stand next to a keyword."""
    k = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.expr(KEY.format("o_orderkey")).alias("awb"))
    mark = F.element_at(F.array(*map(F.lit, _MARKS)), (F.col("o_orderkey") % len(_MARKS) + 1).cast("int"))
    fill = lambda x, n: F.repeat(F.lit(x), n.cast("int"))
    two, three = (F.expr(KEY.format(f"(o_orderkey + {n})")) for n in (1, 2))
    text = F.concat(three, fill("\n.", F.col("o_custkey") % 25), F.lit("\n"), mark, fill("\n-", F.col("o_orderkey") % 23), fill(" ", F.col("o_custkey") % 3), F.col("awb"), fill("~\n", F.col("o_custkey") % 19), F.lit(" "), two)
    near = X.keyword_adjacent("text", X.clean_candidates("text"))
    has = lambda c: F.array_contains("near", c)
    return k.select("o_orderkey", "awb", two.alias("two"), three.alias("three"), text.alias("text")).withColumn("near", near).select("o_orderkey", has(F.col("awb")).alias("one"), has(F.col("two")).alias("two"), has(F.col("three")).alias("three"))


_WORDS = "|".join(re.escape(w) for w in X.CONTEXT_KEYWORDS).replace("\\ ", " ").replace("\\#", "#").replace("\\-", "-")
_BARE = "|".join(sorted({"".join(c for c in w if c.isalnum()) for w in X.CONTEXT_KEYWORDS}))


def _marked(x: str) -> str:
    return f"(regexp_matches({x}, '{_WORDS}') OR regexp_matches(regexp_replace({x}, '[^A-Z0-9]+', '', 'g'), '{_BARE}'))"


def _reached(c: str) -> str:
    at, most = f"strpos(text, {c})", X.CONTEXT_CHARS
    window = f"upper(substring(text, greatest({at} - {most}, 1), {at} + 11 + {most} - greatest({at} - {most}, 1) + 1))"
    return f"({_marked(window)} OR len(list_filter(range(1, len(lines) + 1), lambda i: contains(lines[i], {c}) AND len(list_filter(marks, lambda j: abs(i - j) <= 1)) > 0)) > 0)"


def page_kinds(spark, sf_dir):
    """Exempt pages, tiers of detection methods and states of outcomes."""
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, F.concat(F.lit("Cargo Control Document 400-"), "awb")).when(k % 4 == 1, F.concat(F.lit("Feuille de recapitulation 400 "), "awb")).when(k % 4 == 2, F.lit("CARGO CONTROL DOCUMENT")).otherwise(F.concat(F.lit("400-"), "awb"))
    method = F.when(k % 5 == 0, "Filename").when(k % 5 == 1, "Text-Layer-400").when(k % 5 == 2, "OCR-Exact-High").when(k % 5 == 3, "Rescue OCR-exact")
    outcome = F.when(k % 3 == 0, "REJECTED").when(k % 3 == 1, "NEEDS-REVIEW").otherwise("CLEAN")
    return ref_keys(spark, sf_dir).select("o_orderkey", routing.cargo_control_page(text).alias("exempt"), L.detection_tier(method).alias("audit_tier"), L.detection_tier(method, True).alias("batch_tier"), L.status_of(outcome).alias("status"))


def case_diagnosis(spark, sf_dir):
    t = stage_texts(spark, sf_dir)
    c = R.tiered_candidates(t, ref_keys(spark, sf_dir), "file_id")
    return E.diagnose(t.select("file_id", F.col("awb").alias("expected")), c)


def synthetic_cases(spark, sf_dir):
    """Forty positive and forty negative cases, and one for each confusable digit."""
    return E.synthetic_cases(ref_keys(spark, sf_dir).select("awb"), 40, 40, 42)


def _events(spark, sf_dir):
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select("ts", "event_id", F.col("user_id").cast("string").alias("awb"), F.concat(F.lit("f"), k.cast("string")).alias("file"), ((k % 1000) / 8.0).alias("secs"))
    method = F.when(k % 4 == 0, "Filename").when(k % 4 == 1, "OCR-Exact").otherwise("Tolerance")
    hot = e.select("*", method.alias("method"), F.when(k % 3 == 0, "Complete").when(k % 3 == 1, "needs_review").otherwise("FAILED").alias("result"))
    check = e.select("*", F.when(k % 5 == 0, "CLEAN").when(k % 5 == 1, "rejected").when(k % 5 == 2, "PARTIAL-CLEAN").when(k % 5 == 3, "CLEAN-UNCHECKED").otherwise("ERROR").alias("result"), (k % 7).alias("dup_pages"), (k % 11 + 1).alias("total_pages"))
    return hot, check, e.select("ts", F.when(k % 2 == 0, "BATCH_BUILT").otherwise("TIFF_CONVERTED").alias("event_type"))


def audit_rows(spark, sf_dir):
    """Rows of the hotfolder's and the checker's audit, side by side."""
    hot, check, _ = _events(spark, sf_dir)
    h = A.hotfolder_rows(hot, L.detection_tier(F.col("method")))
    return h.select("file", "method", "tier", "secs", "result").join(A.check_rows(check).select("file", F.col("result").alias("verdict"), "ratio"), "file")


def day_dashboard(spark, sf_dir):
    hot, check, batch = _events(spark, sf_dir)
    return A.dashboard(A.hotfolder_rows(hot, L.detection_tier(F.col("method"))), A.check_rows(check), batch, F.lit(DAY).cast("date"))


def print_copies(spark, sf_dir):
    """Names under which batches are copied: the first free version."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    name = lambda v: F.concat(F.lit("B"), F.col("k").cast("string"), F.lit(v))
    have = F.array(F.when(F.col("k") % 3 == 0, name(".pdf")), F.when((F.col("k") % 6 == 0) | (F.col("k") % 5 == 0), name("_v2.pdf")), F.when(F.col("k") % 12 == 0, name("_v4.pdf")))
    present = p.select(F.explode(have).alias("file")).where("file is not null")
    return A.versioned_copies(p.select(name(".pdf").alias("file"), (F.col("k") % 9 != 0).alias("ok")), present)


_HOT = """h AS (SELECT ts, event_id AS k, concat('f', event_id) AS file, CASE event_id % 4 WHEN 0 THEN 'Filename' WHEN 1 THEN 'OCR-Exact' ELSE 'Tolerance' END AS method, CASE event_id % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS tier,
 round((event_id % 1000) / 8.0::DOUBLE, 2) AS secs, CASE event_id % 3 WHEN 0 THEN 'Complete' WHEN 1 THEN 'needs_review' ELSE 'FAILED' END AS result,
 CASE event_id % 5 WHEN 0 THEN 'CLEAN' WHEN 1 THEN 'rejected' WHEN 2 THEN 'PARTIAL-CLEAN' WHEN 3 THEN 'CLEAN-UNCHECKED' ELSE 'ERROR' END AS verdict, round((event_id % 7) / (event_id % 11 + 1)::DOUBLE, 3) AS ratio FROM events)"""
_DASH = f"""WITH {_HOT}, d AS (SELECT * FROM h WHERE ts::DATE = DATE '{DAY}'),
 a AS (SELECT count(*) AS n, count(*) FILTER (WHERE k % 3 = 0) AS c, count(*) FILTER (WHERE k % 3 = 1) AS r, count(*) FILTER (WHERE k % 3 = 2) AS f, avg(secs) FILTER (WHERE secs <> 0) AS s, count(*) FILTER (WHERE tier = 'High') AS th, count(*) FILTER (WHERE tier = 'Medium') AS tm, count(*) FILTER (WHERE tier = 'Low') AS tl,
  count(*) FILTER (WHERE k % 5 = 0) AS ec, count(*) FILTER (WHERE k % 5 = 1) AS er, count(*) FILTER (WHERE k % 5 = 2) AS ep, count(*) FILTER (WHERE k % 5 = 3) AS eu, count(*) FILTER (WHERE k % 2 = 0) AS bb, count(*) FILTER (WHERE k % 2 = 1) AS bt FROM d)
"""
_LINES = [
    ("HOTFOLDER", 0, "Files Processed", "n", "NULL"), ("HOTFOLDER", 1, "Complete", "c", "NULL"), ("HOTFOLDER", 2, "Needs Review", "r", "CASE WHEN r > 0 THEN 'manual check required' END"), ("HOTFOLDER", 3, "Failed", "f", "CASE WHEN f > 0 THEN 'check log' END"),
    ("HOTFOLDER", 4, "Avg Processing Time", "coalesce(format('{:.1f}s', s), 'N/A')", "NULL"), ("HOTFOLDER", 5, "Tier High", "th", "NULL"), ("HOTFOLDER", 6, "Tier Medium", "tm", "NULL"), ("HOTFOLDER", 7, "Tier Low", "tl", "NULL"),
    ("CHECK", 0, "Files Checked", "ec + er + ep + eu", "NULL"), ("CHECK", 1, "CLEAN", "ec", "NULL"), ("CHECK", 2, "PARTIAL-CLEAN", "ep", "NULL"), ("CHECK", 3, "REJECTED", "er", "CASE WHEN er > 0 THEN 'duplicates found' END"), ("CHECK", 4, "CLEAN-UNCHECKED", "eu", "NULL"),
    ("CHECK", 5, "Clean Rate", "CASE WHEN ec + er + ep + eu > 0 THEN format('{:.0f}%', round_even((ec + ep) * 100.0::DOUBLE / (ec + er + ep + eu), 0)) ELSE 'N/A' END", "NULL"),
    ("BATCH", 0, "BATCH_BUILT", "bb", "NULL"), ("BATCH", 1, "TIFF_CONVERTED", "bt", "NULL"), ("BATCH", 2, "TIFF_FAILED", "0", "NULL"),
]
_FORM = "CASE WHEN o_orderkey % 7 {} THEN awb ELSE '' END"
QUERIES = {f.__name__: f for f in (scan_gate, scan_window, text_choice, candidate_counts, probe_exit, page_outputs, archive_exists, context_forms, keyword_reach, page_kinds, case_diagnosis, synthetic_cases, audit_rows, day_dashboard, print_copies)}
ORACLES = {
    "scan_gate": """WITH f AS (SELECT *, o_orderkey % 4 IN (0, 2) AND o_orderkey % 3 <> 0 AS cold FROM orders),
 r AS (SELECT *, (o_custkey % 2 = 0 OR cold) AND (o_orderkey % 5 = 0 OR (o_orderkey % 7 = 0 AND o_orderkey % 6 > 0)) AS run_scan FROM f)
 SELECT o_orderkey, run_scan, CASE WHEN run_scan AND NOT cold THEN 10 END AS scan_pages FROM r""",
    "scan_window": f"""WITH {_SIDES} SELECT file_id, count(*) AS pairs, count(*) FILTER (WHERE page_no = 1 AND doc_page = 1) AS first, max(doc_page) AS last_page FROM inc JOIN arc USING (awb)
 WHERE page_no <= 3 AND page_no % 4 <> 2 AND doc_page <= 5 GROUP BY file_id""",
    "text_choice": """WITH d AS (SELECT doc_id, text, regexp_replace(text, '([0-9]) +([0-9])', '\\1\\2', 'g') AS together FROM documents),
 n AS (SELECT *, len(list_distinct(list_filter(regexp_extract_all(text, '[0-9]+'), lambda x: length(x) = 12))) AS a, len(list_distinct(list_filter(regexp_extract_all(together, '[0-9]+'), lambda x: length(x) = 12))) AS b FROM d),
 c AS (SELECT doc_id, CASE WHEN length(trim(text)) > 20 AND b > a THEN together ELSE text END AS t FROM n) SELECT doc_id, length(t) AS chars, md5(t) AS digest FROM c""",
    "candidate_counts": f"WITH {_T} SELECT file_id, len({_CLEAN}) AS n FROM t",
    "probe_exit": f"WITH {_T} SELECT file_id, awb, CASE variant WHEN 3 THEN 'Probe-400' ELSE 'Probe-Exact-High' END AS method FROM t WHERE variant IN (0, 1, 3)",
    "page_outputs": f"""WITH {_SIDES}, x AS (SELECT inc.file_id, inc.page_no, m.doc IS NOT NULL AS d FROM inc LEFT JOIN m ON inc.file_id = m.file_id AND inc.page_no = m.page_no),
 a AS (SELECT file_id, count(*) AS total, count(*) FILTER (WHERE d) AS dup, CASE WHEN count(*) FILTER (WHERE d) > 0 THEN 'HIGH' ELSE 'LOW' END AS confidence FROM x GROUP BY file_id), b AS (SELECT file_id, {_ROUTE} AS route FROM a),
 o AS (SELECT file_id, page_no, CASE route WHEN 'REJECTED' THEN 'rejected' WHEN 'PARTIAL-CLEAN' THEN CASE WHEN d THEN 'rejected' ELSE 'clean' END ELSE 'clean' END AS output FROM x JOIN b USING (file_id))
 SELECT *, row_number() OVER (PARTITION BY file_id, output ORDER BY page_no) AS out_page FROM o""",
    "archive_exists": """WITH c AS (SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS cached, CASE WHEN o_orderkey % 5 = 1 THEN FALSE WHEN o_orderkey % 5 IN (0, 4) THEN o_orderkey % 3 > 0 END AS fresh FROM orders)
 SELECT o_orderkey, coalesce(cached, fresh) AS found, cached IS NULL AND fresh IS NOT NULL AS to_cache FROM c""",
    "context_forms": f"""SELECT o_orderkey, {_FORM.format('= 0')} AS aci, {_FORM.format('= 1')} AS carrier, {_FORM.format('= 2')} AS airway, {_FORM.format('IN (0, 1, 2, 4)')} AS adjacent, {_FORM.format('IN (0, 1, 2, 4, 5)')} AS near FROM ({REF_KEYS_SQL})""",
    "keyword_reach": f"""WITH t AS ({_REACH_SQL}), l AS (SELECT *, string_split(text, chr(10)) AS lines FROM t),
 m AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda j: {_marked('upper(lines[j])')}) AS marks FROM l)
 SELECT o_orderkey, {_reached('one')} AS one, {_reached('two')} AS two, {_reached('three')} AS three FROM m""",
    "page_kinds": f"""SELECT o_orderkey, o_orderkey % 4 IN (0, 1) AS exempt, CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'High' WHEN o_orderkey % 5 IN (2, 3) THEN 'Medium' ELSE 'Low' END AS audit_tier,
 CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'High' WHEN o_orderkey % 5 = 2 THEN 'Medium' ELSE 'Low' END AS batch_tier, CASE o_orderkey % 3 WHEN 0 THEN 'REJECTED' WHEN 1 THEN 'NEEDS-REVIEW' ELSE 'IN-PROGRESS' END AS status FROM ({REF_KEYS_SQL})""",
    "case_diagnosis": f"""WITH {_C} SELECT t.file_id, count(*) FILTER (WHERE tier = 'High') AS n_high, count(*) FILTER (WHERE tier = 'Standard') AS n_std, coalesce(bool_or(candidate = t.awb AND tier = 'High'), FALSE) AS in_high, coalesce(bool_or(candidate = t.awb AND tier = 'Standard'), FALSE) AS in_std,
 coalesce(bool_or(candidate = t.awb AND tier = 'High' AND known), FALSE) AS known_high, coalesce(bool_or(candidate = t.awb AND tier = 'Standard' AND known), FALSE) AS known_std FROM t LEFT JOIN cands USING (file_id) GROUP BY t.file_id""",
    "synthetic_cases": f"""WITH keys AS ({REF_KEYS_SQL}), k AS (SELECT awb, md5(concat(awb, '|42')) AS o FROM keys ORDER BY o, awb LIMIT 40),
 d AS (SELECT unnest(['0', '1', '2', '5', '6', '7', '8']) AS d, unnest(['O', 'I', 'Z', 'S', 'G', 'T', 'B']) AS c),
 f AS (SELECT d, c, arg_min(awb, o) AS awb FROM d JOIN k ON contains(awb, d) GROUP BY d, c),
 p AS (SELECT awb, list_filter(list_transform(range(0, 12), lambda i: (i + substring(awb, 11, 2)::INT % 12) % 12 + 1), lambda q: contains('0125678', substring(awb, q, 1)))[1] AS q FROM k),
 n AS (SELECT substring(translate(md5(concat('n', i, '|42')), 'abcdef', '012345'), 1, 12) AS token FROM range(40) r(i))
 SELECT 'forced' AS kind, awb AS expected, concat('AWB NUMBER: ', substring(awb, 1, instr(awb, d) - 1), c, substring(awb, instr(awb, d) + 1)) AS text FROM f
 UNION ALL SELECT 'positive', awb, concat('AWB NUMBER: ', CASE WHEN q IS NULL THEN awb ELSE concat(substring(awb, 1, q - 1), translate(substring(awb, q, 1), '0125678', 'OIZSGTB'), substring(awb, q + 1)) END) FROM p
 UNION ALL SELECT 'negative', NULL, concat('Customer id ', token) FROM n WHERE token NOT IN (SELECT awb FROM keys)""",
    "audit_rows": f"WITH {_HOT} SELECT file, method, tier, secs, result, verdict, ratio FROM h",
    "day_dashboard": _DASH + " UNION ALL ".join(f"SELECT '{s}' AS section, {k} AS line, '{label}' AS label, ({value})::VARCHAR AS value, {note} AS note FROM a" for s, k, label, value, note in _LINES),
    "print_copies": """SELECT concat('B', p_partkey, '.pdf') AS file, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 3 <> 0 THEN concat('B', p_partkey, '.pdf') WHEN p_partkey % 6 = 0 OR p_partkey % 5 = 0 THEN concat('B', p_partkey, '_v3.pdf') ELSE concat('B', p_partkey, '_v2.pdf') END AS copy,
 CASE WHEN p_partkey % 9 = 0 THEN 'ERROR' ELSE 'OK' END AS status FROM part""",
}
