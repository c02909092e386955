"""Queries on boxes, probes, persistence, snapshots, session caches, guarded deletes and generated cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from docroute.functions import extract as X
from docroute.operators import evidence as E
from docroute.operators import resolve as R
from docroute.plans.identify import _C, _CLEAN, _T, _norm, _tiered
from docroute.sources.fixtures import REF_KEYS_SQL, ref_keys, stage_texts, table


def _words(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr("p_partkey div 20 AS doc", "substring_index(p_name, ' ', 1) AS token", "p_partkey % 20 * 40 AS x", "p_size * 7 AS y", "p_partkey")


def reading_order(spark, sf_dir):
    return E.reading_order(_words(spark, sf_dir), "doc")


def box_neighbours(spark, sf_dir):
    n = E.box_neighbours(_words(spark, sf_dir), "doc", F.col("p_partkey") % 20 == 0, width=200)
    return n.groupBy("doc").agg(F.count("*").alias("near"), F.sum("x").alias("xs"), F.sum("y").alias("ys"))


def turned_hint(spark, sf_dir):
    return E.turned_hint(_words(spark, sf_dir), "doc")


def rotation_probe(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    s = E.probe_score(F.col("l_quantity").cast("int"), (F.col("l_partkey") % 4 == 0).cast("int"), (F.col("l_suppkey") % 20).cast("int"))
    p = E.rotation_probe(l.select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") % 4 * 90).alias("angle"), s.alias("score")), "doc")
    return p.withColumn("order", F.array_join("order", ","))


def persistent_keys(spark, sf_dir):
    """Documents whose three texts show a key of even number at least twice behind a label."""
    c = R.accumulate(_tiered(spark, sf_dir, "doc", "stage_seq"), "doc", "stage_seq").where("stage_seq = 2").withColumn("hits", F.col("hits") + 1)
    return E.persistent(c, ref_keys(spark, sf_dir).where("o_orderkey % 2 = 0"), "doc")


def stage_snapshots(spark, sf_dir):
    return E.snapshots(_tiered(spark, sf_dir, "doc"), "doc")


def session_cache(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_custkey") % 3).alias("k"), "o_orderstatus")
    return E.cache_hits(o, ["o_orderpriority", "o_orderkey"], "k", F.col("o_orderstatus") != "P").select("o_orderkey", "hit")


def guarded_delete(spark, sf_dir):
    return E.may_delete(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("batch"), (F.col("l_returnflag") != "R").alias("done")), "batch")


def skip_existing(spark, sf_dir):
    """Orders without any line: outputs that are still to be made."""
    return table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


def confusion_cases(spark, sf_dir):
    """One letter for a digit, every third token in groups; what normalisation makes of it."""
    k = ref_keys(spark, sf_dir)
    token = E.confuse(F.col("awb"), (F.col("o_orderkey") % 12).cast("int"))
    mark = F.get(F.array(*map(F.lit, (" ", "-", "/", "."))), (F.col("o_orderkey") % 4).cast("int"))
    k = k.withColumn("token", F.when(F.col("o_orderkey") % 3 == 0, E.grouped(token, mark)).otherwise(token))
    return k.select("o_orderkey", "token", (X.norm_digits("token") == F.col("awb")).alias("found"))


def clean_gate(spark, sf_dir):
    """Strict numbers alone: one key is a match, several are a tie."""
    c = stage_texts(spark, sf_dir).select("file_id", F.explode(X.clean_candidates("text")).alias("candidate")).where(~X.disqualified(F.col("candidate")) & ~X.date_like(F.col("candidate")))
    c = c.join(ref_keys(spark, sf_dir).select(F.col("awb").alias("candidate")), "candidate", "left_semi")
    g = c.groupBy("file_id").agg(F.array_sort(F.collect_set("candidate")).alias("found"))
    return g.select("file_id", F.when(F.size("found") == 1, "matched").otherwise("tie").alias("status"), F.array_join("found", ",").alias("found"))


def pipeline_summary(spark, sf_dir):
    """A line for each order with its resolution and its pages; what is missing has defaults."""
    k = ref_keys(spark, sf_dir)
    r = clean_gate(spark, sf_dir).withColumnRenamed("file_id", "o_orderkey")
    pages = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("pages"), F.sum("l_quantity").alias("seconds"))
    j = k.join(r, "o_orderkey", "left").join(pages, "o_orderkey", "left")
    return j.select(
        "o_orderkey", F.coalesce("found", F.lit("")).alias("awb"), F.coalesce("status", F.lit("UNKNOWN")).alias("detection"), F.coalesce("pages", F.lit(0)).alias("pages"),
        F.bround(F.coalesce("seconds", F.lit(0.0)) / 60, 4).alias("minutes"),
    )


def run_outcomes(spark, sf_dir):
    """Converted, skipped and failed lines of a month, and their total."""
    l = table(spark, sf_dir, "lineitem")
    n = lambda f: F.count_if(F.col("l_returnflag") == f)
    return l.groupBy((F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("run")).agg(n("N").alias("converted"), n("A").alias("skipped"), n("R").alias("failed"), F.count("*").alias("total"))


_W = "w AS (SELECT p_partkey // 20 AS doc, string_split(p_name, ' ')[1] AS token, p_partkey % 20 * 40 AS x, p_size * 7 AS y, p_partkey FROM part)"
_EACH = "{0} AS (SELECT doc, angle, max(score) AS score FROM (SELECT l_orderkey AS doc, l_linenumber % 4 * 90 AS angle, l_quantity::INT + 120 * (l_partkey % 4 = 0)::INT + 2 * (l_suppkey % 20) AS score FROM lineitem) GROUP BY ALL)"
_GATE = f"""{_T}, g AS (SELECT file_id, unnest({_CLEAN}) AS c FROM t),
 h AS (SELECT file_id, list_sort(list(c)) AS f FROM g WHERE regexp_matches(c, '^[1-9]') AND NOT (substring(c, 1, 4)::INT BETWEEN 2015 AND 2035 AND substring(c, 5, 2)::INT BETWEEN 1 AND 12) AND c IN (SELECT awb FROM keys) GROUP BY file_id),
 r AS (SELECT file_id, CASE WHEN len(f) = 1 THEN 'matched' ELSE 'tie' END AS status, array_to_string(f, ',') AS found FROM h)"""
QUERIES = {f.__name__: f for f in (reading_order, box_neighbours, turned_hint, rotation_probe, persistent_keys, stage_snapshots, session_cache, guarded_delete, skip_existing, confusion_cases, clean_gate, pipeline_summary, run_outcomes)}
ORACLES = {
    "reading_order": f"WITH {_W} SELECT doc, string_agg(token, ' ' ORDER BY round_even(y / 10.0::DOUBLE, 0), x, token) AS text FROM w GROUP BY doc",
    "box_neighbours": f"""WITH {_W} SELECT w.doc, count(*) AS near, sum(w.x)::BIGINT AS xs, sum(w.y)::BIGINT AS ys FROM w JOIN w l ON w.doc = l.doc AND l.p_partkey % 20 = 0
 AND (abs(w.y - l.y) <= 40 OR w.y - l.y BETWEEN 0 AND 120) AND abs(w.x - l.x) <= 200 GROUP BY w.doc""",
    "turned_hint": f"WITH {_W} SELECT doc, max(y) - min(y) > 1.5 * (max(x) - min(x)) AS turned FROM w GROUP BY doc",
    "rotation_probe": f"""WITH {_EACH.format("e")}, d AS (SELECT DISTINCT doc FROM e), a AS (SELECT d.doc, a.angle, coalesce(score, 0) AS score FROM d CROSS JOIN (VALUES (0), (90), (180), (270)) a(angle) LEFT JOIN e ON e.doc = d.doc AND e.angle = a.angle),
 r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY score DESC, angle) AS n FROM a),
 g AS (SELECT doc, max(score) FILTER (WHERE n = 1) - max(score) FILTER (WHERE n = 2) AS margin, CASE WHEN max(score) FILTER (WHERE n = 1) - max(score) FILTER (WHERE angle = 0) >= 80 THEN max(angle) FILTER (WHERE n = 1) ELSE 0 END AS angle FROM r GROUP BY doc)
 SELECT g.doc, g.angle, margin, CASE WHEN margin >= 300 THEN 'CERTAIN' WHEN margin >= 120 THEN 'LIKELY' ELSE 'UNCERTAIN' END AS certainty, string_agg(r.angle::VARCHAR, ',' ORDER BY r.angle <> g.angle, n) AS "order" FROM g JOIN r USING (doc) GROUP BY ALL""",
    "persistent_keys": f"""WITH {_C}, p AS (SELECT doc, candidate, max(tier = 'High') AS high, count(DISTINCT stage_seq) + 1 AS hits FROM cands WHERE doc IN (SELECT doc FROM cands WHERE stage_seq = 2) GROUP BY ALL),
 f AS (SELECT doc, list_sort(list(candidate)) AS c FROM p WHERE high AND hits >= 2 AND candidate IN (SELECT awb FROM keys WHERE o_orderkey % 2 = 0) GROUP BY doc)
 SELECT doc, CASE WHEN len(c) = 1 THEN 'matched' ELSE 'tie' END AS status, CASE WHEN len(c) = 1 THEN c[1] END AS awb, CASE WHEN len(c) > 1 THEN array_to_string(c, ',') END AS ties FROM f""",
    "stage_snapshots": f"WITH {_C} SELECT doc, count(DISTINCT candidate) AS n, array_to_string(list_sort(list(DISTINCT candidate))[1:20], ',') AS sample FROM cands GROUP BY doc",
    "session_cache": "SELECT o_orderkey, coalesce(lag(o_custkey % 3) OVER w = o_custkey % 3 AND lag(o_orderstatus) OVER w <> 'P', FALSE) AS hit FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey)",
    "guarded_delete": "SELECT l_orderkey AS batch, count(*) FILTER (WHERE l_returnflag <> 'R') AS copied, count(*) AS expected, count(*) FILTER (WHERE l_returnflag = 'R') = 0 AS ok FROM lineitem GROUP BY 1",
    "skip_existing": "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "confusion_cases": f"""WITH k AS ({REF_KEYS_SQL}), p AS (SELECT *, list_filter(list_transform(range(0, 12), lambda i: (i + o_orderkey % 12) % 12 + 1), lambda q: contains('01256 78', substring(awb, q, 1)))[1] AS q FROM k),
 c AS (SELECT *, CASE WHEN q IS NULL THEN awb ELSE concat(substring(awb, 1, q - 1), translate(substring(awb, q, 1), '0125678', 'OIZSGTB'), substring(awb, q + 1)) END AS c FROM p),
 t AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN concat(substring(c, 1, 4), m, substring(c, 5, 4), m, substring(c, 9, 4)) ELSE c END AS token FROM (SELECT *, [' ', '-', '/', '.'][o_orderkey % 4 + 1] AS m FROM c))
 SELECT o_orderkey, token, {_norm('token')} = awb AS found FROM t""",
    "clean_gate": f"WITH {_GATE} SELECT * FROM r",
    "pipeline_summary": f"""WITH {_GATE}, p AS (SELECT l_orderkey AS o_orderkey, count(*) AS pages, sum(l_quantity) AS s FROM lineitem GROUP BY 1)
 SELECT o_orderkey, coalesce(found, '') AS awb, coalesce(status, 'UNKNOWN') AS detection, coalesce(pages, 0) AS pages, round_even(coalesce(s, 0) / 60, 4) AS minutes FROM keys LEFT JOIN r ON file_id = o_orderkey LEFT JOIN p USING (o_orderkey)""",
    "run_outcomes": "SELECT year(l_shipdate) * 100 + month(l_shipdate) AS run, count(*) FILTER (WHERE l_returnflag = 'N') AS converted, count(*) FILTER (WHERE l_returnflag = 'A') AS skipped, count(*) FILTER (WHERE l_returnflag = 'R') AS failed, count(*) AS total FROM lineitem GROUP BY 1",
}
