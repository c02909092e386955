"""Queries on identifiers: extraction, tiers, exact and tolerant resolution, stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from docroute.functions import extract as X
from docroute.operators import resolve as R
from docroute.sources.fixtures import REF_KEYS_SQL, STAGE_TEXTS_SQL, ref_keys, stage_texts
from docroute.sources.scratch import keeper

joined = lambda c: F.array_join(F.array_sort(c), ",")


def extract_forms(spark, sf_dir):
    """Each extractor on each stage text."""
    t = stage_texts(spark, sf_dir)
    return t.select(
        "file_id", joined(X.clean_candidates("text")).alias("clean"), joined(X.text_candidates("text")).alias("plain"), joined(X.label_candidates("text")).alias("labelled"),
        X.tight_400("text").alias("tight_400"), joined(X.any_text_keys("text")).alias("any_text"), X.norm_digits(F.regexp_extract("text", r"\S+$", 0)).alias("normalised"),
    )


def extract_names(spark, sf_dir):
    """Keys from file names, processed names and batch names."""
    k = ref_keys(spark, sf_dir)
    n = F.col("o_orderkey") % 5
    name = F.when(n == 0, F.concat("awb", F.lit(".pdf"))).when(n == 1, F.concat("awb", F.lit("_2.PDF"))).when(n == 2, F.concat(F.lit("in/400-"), "awb", F.lit(".pdf")))
    name = name.when(n == 3, F.concat(F.lit("scan "), F.substring("awb", 1, 4), F.lit(" "), F.substring("awb", 5, 4), F.lit(" "), F.substring("awb", 9, 4), F.lit("_x.pdf"))).otherwise(F.lit("page 12.pdf"))
    k = k.withColumn("name", name)
    return k.select("o_orderkey", "name", X.filename_key("name").alias("from_name"), X.processed_name_key("name").alias("from_processed"), X.is_batch_name("name").alias("batch"))


def _tiered(spark, sf_dir, *ids):
    return R.tiered_candidates(stage_texts(spark, sf_dir), ref_keys(spark, sf_dir), *ids)


def tiered_candidates(spark, sf_dir):
    return _tiered(spark, sf_dir, "file_id")


def _shown(df):
    return df.withColumn("ties", F.array_join("ties", ","))


def resolve_exact(spark, sf_dir):
    c = _tiered(spark, sf_dir, "file_id").withColumn("hits", F.lit(1)).persist()
    return _shown(R.prioritize(c, ref_keys(spark, sf_dir), "file_id", include_tolerance=False)).select("file_id", "status", "awb", "method", "ties")


def resolve_full(spark, sf_dir):
    c = keeper(spark, "resolve")(_tiered(spark, sf_dir, "file_id").withColumn("hits", F.lit(1)), "candidates")
    return _shown(R.prioritize(c, ref_keys(spark, sf_dir), "file_id")).select("file_id", "status", "awb", "method", "distance", "ties")


def close_keys(spark, sf_dir):
    return R.close_keys(_tiered(spark, sf_dir, "file_id").where(~F.col("known")), ref_keys(spark, sf_dir))


def stage_cascade(spark, sf_dir):
    """Three texts of a document are its stages; the first that decides wins."""
    keys = ref_keys(spark, sf_dir)
    pools = R.accumulate(_tiered(spark, sf_dir, "doc", "stage_seq"), "doc", "stage_seq").persist()
    return _shown(R.first_decisive(R.prioritize(pools, keys, "doc", "stage_seq"), "doc", "stage_seq")).select("doc", "status", "awb", "method", "stage", "ties")


def confusion_metrics(spark, sf_dir):
    """Precision and recall of exact and tolerant resolution; a wrong key on a positive counts as false negative and false positive."""
    cases = stage_texts(spark, sf_dir).select("file_id", F.when(~F.col("variant").isin(6, 7, 8), F.col("awb")).alias("expected"))
    out = None
    for name, q in (("exact", resolve_exact), ("full", resolve_full)):
        p = cases.join(q(spark, sf_dir).select("file_id", F.col("awb").alias("got")), "file_id", "left")
        hit, wrong = F.col("expected").eqNullSafe(F.col("got")), F.col("got").isNotNull() & (F.col("expected").isNull() | (F.col("expected") != F.col("got")))
        n = lambda c: F.count_if(c)
        p = p.agg(
            n(F.col("expected").isNotNull() & hit).alias("tp"), n(wrong).alias("fp"), n(F.col("expected").isNull() & hit).alias("tn"), n(F.col("expected").isNotNull() & ~hit).alias("fn"),
        )
        p = p.select(F.lit(name).alias("mode"), "tp", "fp", "tn", "fn", F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"), F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0)).alias("recall"))
        f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
        p = p.withColumn("f1", F.round(f1, 6)).withColumns({c: F.round(c, 6) for c in ("precision", "recall")})
        out = p if out is None else out.unionByName(p)
    return out


#: The same rules for DuckDB, whose expressions have no look-around: tokens of the stage texts are at least two other characters apart.
_D12 = "list_filter(regexp_extract_all(text, '[0-9]+'), lambda x: length(x) = 12)"
_G444 = r"list_transform(regexp_extract_all(text, '(?:^|[^0-9])([0-9]{4}[\s\-][0-9]{4}[\s\-][0-9]{4})(?:[^0-9]|$)', 1), lambda x: regexp_replace(x, '[^0-9]', '', 'g'))"
_CLEAN = f"list_distinct(list_concat({_D12}, {_G444}))"


def _norm(x: str) -> str:
    bare = rf"regexp_replace(upper({x}), '[\s\-:/._]+', '', 'g')"
    return f"CASE WHEN length({bare}) = 12 AND length(regexp_replace({bare}, '[^0-9]', '', 'g')) >= 8 AND regexp_matches(translate({bare}, 'OQDILZSGBT', '0001125687'), '^[0-9]{{12}}$') THEN translate({bare}, 'OQDILZSGBT', '0001125687') END"


def _normed(xs: str) -> str:
    return f"list_filter(list_transform({xs}, lambda x: {_norm('x')}), lambda x: x IS NOT NULL)"


_SPANS = r"regexp_extract_all(upper(text), '[A-Z0-9][A-Z0-9\-\s:/._]{8,30}[A-Z0-9]')"
_LABELLED = "list_distinct(" + _normed(
    "list_concat("
    r"regexp_extract_all(text, '(?i)\b(?:HAWB|MAWB|AWB(?:\s*(?:NO|NUMBER))?)\b[^0-9]{0,15}([0-9][0-9\-\s]{10,24})', 1), "
    r"regexp_extract_all(text, '(?:^|[^0-9])400(?:[\s\-]{0,2})([0-9](?:[\s\-]?[0-9]){11})(?:[^0-9]|$)', 1), "
    r"regexp_extract_all(text, '(?i)\b(?:TRACK(?:ING)?(?:\s*(?:NO|NUMBER|#))?|TRK(?:\s*(?:NO|NUMBER|#))?)\b[^0-9]{0,20}([A-Z0-9][A-Z0-9\-\s:/._]{10,30})', 1))"
) + ")"
_PLAIN = f"list_distinct(list_concat({_normed(_SPANS)}, {_CLEAN}))"
_WINDOWS = "list_transform(range(1, 6), lambda i: substring(regexp_extract(text, '([0-9]{16})', 1), i, 12))"
_KEYWORD = "regexp_matches(upper(text), 'AWB|TRACKING|TRK')"
_T = f"t AS ({STAGE_TEXTS_SQL}), keys AS ({REF_KEYS_SQL})"
_C = f"""{_T},
e AS (SELECT file_id, doc, stage_seq, text, {_LABELLED} AS labelled, {_PLAIN} AS plain FROM t),
w AS (SELECT file_id, unnest(CASE WHEN regexp_matches(text, '[0-9]{{16}}') THEN {_WINDOWS} ELSE [] END) AS c FROM t),
u AS (SELECT file_id, doc, stage_seq, unnest(list_distinct(list_concat(labelled, plain))) AS c, labelled, text FROM e
  UNION ALL SELECT e.file_id, doc, stage_seq, w.c, labelled, text FROM e JOIN w USING (file_id) SEMI JOIN keys ON w.c = keys.awb),
c AS (SELECT DISTINCT file_id, doc, stage_seq, c AS candidate, CASE WHEN list_contains(labelled, c) OR ({_KEYWORD} AND contains(text, c)) THEN 'High' ELSE 'Standard' END AS tier, c IN (SELECT awb FROM keys) AS known
  FROM u WHERE regexp_matches(c, '^[1-9][0-9]{{11}}$')),
cands AS (SELECT * FROM c WHERE tier = 'High' OR NOT (CAST(substring(candidate, 1, 4) AS INT) BETWEEN 2015 AND 2035 AND CAST(substring(candidate, 5, 2) AS INT) BETWEEN 1 AND 12))"""
_CLOSE = """x AS (SELECT DISTINCT candidate FROM {source}),
pool AS (SELECT candidate, awb FROM x JOIN keys ON substring(candidate, 1, 4) = substring(awb, 1, 4) UNION SELECT candidate, awb FROM x JOIN keys ON substring(candidate, 9, 4) = substring(awb, 9, 4)),
pairs AS (SELECT candidate, awb FROM pool UNION ALL SELECT candidate, awb FROM (SELECT * FROM x ANTI JOIN pool USING (candidate)), keys),
close AS (SELECT candidate, awb, hamming(candidate, awb) AS distance FROM pairs WHERE hamming(candidate, awb) <= 2)"""


def _verdict(ids: str, source: str, include: bool = True) -> str:
    """CTEs up to `v`: ids, status, awb, method, distance, hits, ties."""
    exact = lambda tier: f"coalesce(list_sort(list(DISTINCT candidate) FILTER (WHERE known AND tier = '{tier}')), [])"
    near = lambda tier, most: f"""SELECT {ids}, min(distance) AS distance, list_sort(list(DISTINCT awb)) AS ks, max(hits) AS hits FROM (
      SELECT {ids}, awb, hits, distance, min(distance) OVER (PARTITION BY {ids}) AS least FROM {source} JOIN close USING (candidate) WHERE tier = '{tier}' AND distance <= {most}) WHERE distance = least GROUP BY {ids}"""  # noqa: E731
    tol = f", th AS ({near('High', 2)}), ts AS ({near('Standard', 1)})" if include else ""
    far = "len(th.ks) > 1 THEN 5 WHEN len(th.ks) = 1 AND th.hits >= CASE WHEN th.distance <= 1 THEN 1 ELSE 2 END THEN 6 WHEN len(ts.ks) > 1 THEN 7 WHEN len(ts.ks) = 1 AND ts.hits >= 2 AND n_std = 1 THEN 8" if include else "FALSE THEN 0"
    pick = lambda a, b, c, d: f"CASE k WHEN 1 THEN {a} WHEN 2 THEN {a} WHEN 3 THEN {b} WHEN 4 THEN {b}" + (f" WHEN 5 THEN {c} WHEN 6 THEN {c} WHEN 7 THEN {d} WHEN 8 THEN {d}" if include else "") + " END"
    extra, joins = ("th.distance AS hd, th.ks AS hk, ts.distance AS sd, ts.ks AS sk", f"LEFT JOIN th USING ({ids}) LEFT JOIN ts USING ({ids})") if include else ("0 AS hd", "")
    ties = pick("high", "std", "hk", "sk")
    return f"""p AS (SELECT {ids}, {exact('High')} AS high, {exact('Standard')} AS std, count(DISTINCT candidate) FILTER (WHERE tier = 'Standard') AS n_std FROM {source} GROUP BY {ids}){tol},
k AS (SELECT p.*, {extra}, CASE WHEN len(high) > 1 THEN 1 WHEN len(high) = 1 THEN 2 WHEN len(std) > 1 THEN 3 WHEN len(std) = 1 THEN 4 WHEN {far} ELSE 0 END AS k FROM p {joins}),
v AS (SELECT {ids}, CASE WHEN k = 0 THEN 'none' WHEN k % 2 = 1 THEN 'tie' ELSE 'matched' END AS status, CASE WHEN k > 0 AND k % 2 = 0 THEN ({ties})[1] END AS awb,
  {pick("'Exact-High'", "'Exact-Standard'", "'Tolerance2-High'", "'Tolerance2-Standard'")} AS method, {"CASE WHEN k = 6 THEN hd WHEN k = 8 THEN sd END" if include else "NULL"} AS distance,
  CASE WHEN k % 2 = 1 THEN array_to_string({ties}, ',') END AS ties FROM k)"""


_joined = lambda x: f"array_to_string(list_sort({x}), ',')"
_ONE = "one AS (SELECT *, 1 AS hits FROM cands)"
_FULL = f"WITH {_C}, {_CLOSE.format(source='cands')}, {_ONE}, "
_METRICS = """SELECT '{mode}' AS mode, count(*) FILTER (WHERE e IS NOT NULL AND e IS NOT DISTINCT FROM g) AS tp, count(*) FILTER (WHERE g IS NOT NULL AND e IS DISTINCT FROM g) AS fp,
 count(*) FILTER (WHERE e IS NULL AND g IS NULL) AS tn, count(*) FILTER (WHERE e IS NOT NULL AND e IS DISTINCT FROM g) AS fn
 FROM (SELECT CASE WHEN variant NOT IN (6, 7, 8) THEN t.awb END AS e, r.awb AS g FROM t LEFT JOIN ({r}) r USING (file_id))"""


def _rates(rows: str) -> str:
    return f"""SELECT mode, tp, fp, tn, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1
 FROM (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM ({rows}))"""


_EXACT = f"WITH {_C}, {_ONE}, {_verdict('file_id', 'one', False)} SELECT file_id, status, awb, method, ties FROM v"
_RESOLVE = f"{_FULL}{_verdict('file_id', 'one')} SELECT file_id, status, awb, method, distance, ties FROM v"

QUERIES = {f.__name__: f for f in (extract_forms, extract_names, tiered_candidates, resolve_exact, resolve_full, close_keys, stage_cascade, confusion_metrics)}
ORACLES = {
    "extract_forms": f"""WITH {_T} SELECT file_id, {_joined(_CLEAN)} AS clean, {_joined(_PLAIN)} AS plain, {_joined(_LABELLED)} AS labelled,
 nullif(CASE WHEN variant = 3 THEN substring(text, 5, 12) ELSE '' END, '') AS tight_400,
 {_joined(r"list_distinct(list_concat(regexp_extract_all(text, '\b[0-9]{12}\b'), list_filter(list_transform(regexp_extract_all(text, '[0-9][0-9\-\s]{10,30}[0-9]'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: length(x) = 12)))")} AS any_text,
 {_norm(r"regexp_extract(text, '[^ ]+$')")} AS normalised FROM t""",
    "extract_names": rf"""WITH k AS (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN concat(awb, '.pdf') WHEN 1 THEN concat(awb, '_2.PDF') WHEN 2 THEN concat('in/400-', awb, '.pdf')
  WHEN 3 THEN concat('scan ', substring(awb, 1, 4), ' ', substring(awb, 5, 4), ' ', substring(awb, 9, 4), '_x.pdf') ELSE 'page 12.pdf' END AS name FROM ({REF_KEYS_SQL}))
SELECT o_orderkey, name, CASE WHEN o_orderkey % 5 < 4 THEN awb END AS from_name, CASE WHEN o_orderkey % 5 < 2 THEN awb END AS from_processed, o_orderkey % 5 < 2 AS batch FROM k""",
    "tiered_candidates": f"WITH {_C} SELECT file_id, candidate, tier, known FROM cands",
    "resolve_exact": _EXACT,
    "resolve_full": _RESOLVE,
    "close_keys": f"WITH {_C}, {_CLOSE.format(source='(SELECT * FROM cands WHERE NOT known)')} SELECT candidate, awb, distance FROM close",
    "stage_cascade": f"""WITH {_C}, {_CLOSE.format(source='cands')}, st AS (SELECT DISTINCT doc, stage_seq FROM cands),
 acc AS (SELECT st.doc, st.stage_seq, candidate, max(tier = 'High') AS high, bool_or(known) AS known, count(DISTINCT c.stage_seq) AS hits FROM st JOIN cands c ON st.doc = c.doc AND c.stage_seq <= st.stage_seq GROUP BY ALL),
 pools AS (SELECT doc, stage_seq, candidate, CASE WHEN high THEN 'High' ELSE 'Standard' END AS tier, known, hits FROM acc),
 {_verdict('doc, stage_seq', 'pools')}, r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY status = 'none', stage_seq) AS n FROM v)
 SELECT doc, status, awb, method, CASE WHEN status <> 'none' THEN stage_seq END AS stage, ties FROM r WHERE n = 1""",
    "confusion_metrics": f"WITH {_T} " + _rates(_METRICS.format(mode="exact", r=_EXACT) + " UNION ALL " + _METRICS.format(mode="full", r=_RESOLVE)),
}
