"""Queries on arrivals: thinning, key versions, the existence log, cut-off checks, noisy stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from docroute.operators import arrivals as A
from docroute.operators import resolve as R
from docroute.plans.duplicates import _keep
from docroute.plans.identify import _CLOSE, _shown, _verdict
from docroute.sources.fixtures import KEY, REF_KEYS_SQL, ref_keys, table
from docroute.sources.readers import existence_cache

GAP = 6 * 3_600_000_000


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))


def thinned_events(spark, sf_dir):
    """Events of a user at least six hours after the last accepted one."""
    return A.thinned(_events(spark, sf_dir), "user_id", "at", GAP, _keep(spark)).select(F.col("path").alias("user_id"), F.col("at").alias("accepted_at"))


def keys_on_arrival(spark, sf_dir):
    """Each view with the version of its user's key that was valid then; sign-ups and purchases make versions."""
    e = _events(spark, sf_dir)
    files = e.where("event_type = 'view'").select("user_id", "at", "event_id")
    versions = e.where("event_type IN ('signup', 'purchase')").groupBy("user_id", "at").agg(F.max("event_id").alias("version"), F.max_by("value", "event_id").alias("key_value"))
    return A.as_of(files, versions, "user_id", "at").select("event_id", "user_id", "version", "key_value")


def _log(spark, sf_dir):
    """Sets (JSON answers) and evictions of existence facts, as they come; an eviction has no fact."""
    e = _events(spark, sf_dir).select(F.col("user_id").cast("string").alias("awb"), "at", "event_id", "event_type", "value")
    n = F.col("event_id") % 3
    exists = F.when(F.col("value") > 20, "true").otherwise("false")
    body = F.when(n == 0, F.concat(F.lit('{"'), "awb", F.lit('":'), exists, F.lit("}"))).otherwise(F.concat(F.lit('{"'), "awb", F.lit('":{"exists":'), exists, F.lit(',"checked_at":"'), F.col("at").cast("string"), F.lit('"}}')))
    sets = e.where("event_type <> 'error'").withColumn("body", body)
    facts = existence_cache(sets.select("body", "at", "event_id"), "at", "event_id")
    gone = e.where("event_type = 'error'").select("awb", F.lit(None).cast("boolean").alias("exists"), F.lit(None).cast("string").alias("checked_at"), "at", "event_id")
    return facts.unionByName(gone)


def existence_log(spark, sf_dir):
    """What is known to exist after all sets and evictions, compacted in two halves and once more with the first one's entries again."""
    log, order = _log(spark, sf_dir), ["at", "event_id"]
    early, late = log.where("event_id % 2 = 0"), log.where("event_id % 2 = 1")
    once = A.compacted(A.compacted(late, "awb", order).unionByName(early), "awb", order)
    again = A.compacted(once.unionByName(early), "awb", order)
    return A.existing(again).select("awb", "exists", "checked_at")


_STAGES = "SELECT l_orderkey AS file, l_linenumber AS stage, l_quantity AS seconds, l_returnflag = 'R' AND l_quantity > 20 AS decided FROM lineitem"


def cut_off_checks(spark, sf_dir):
    """Lines as stages that take as many seconds as pieces."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("file"), F.col("l_linenumber").cast("long").alias("stage")).agg(F.max("l_quantity").cast("double").alias("seconds"), F.max((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 20)).alias("decided"))
    return A.cut_off(l, "file", "stage", "seconds", "decided")


_NAMES = ("Text-Layer", "OCR-Invert", "Rotation-180", "ROI-Rotation-270")


def noisy_cascade(spark, sf_dir):
    """Stages with up to six numbers each, some of them noisy; what these alone find does not decide."""
    k = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"), F.floor(F.col("o_orderkey") / 4).alias("doc"), (F.col("o_orderkey") % 4).alias("stage_seq"))
    number = lambda i: F.expr(KEY.format(f"(n - n % 4 + {i})"))
    text = F.concat_ws(" + ", *[F.when((F.col("n") + F.floor(F.col("n") / 7)) % 6 >= i, F.concat(F.lit("A "), number(3 * i))) for i in range(6)])
    keys = ref_keys(spark, sf_dir)
    c = R.tiered_candidates(k.withColumn("text", text), keys, "doc", "stage_seq")
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("stage_seq") + 1).cast("int"))
    c = _keep(spark)(A.held_back(c, "doc", "stage_seq", name), "held")
    pools = _keep(spark)(R.accumulate(c, "doc", "stage_seq"), "pools")
    v = R.first_decisive(R.prioritize(pools, keys, "doc", "stage_seq"), "doc", "stage_seq")
    return _shown(v).select("doc", "status", "awb", "method", "stage", "ties")


QUERIES = {f.__name__: f for f in (thinned_events, keys_on_arrival, existence_log, cut_off_checks, noisy_cascade)}
_AT = "e AS (SELECT *, epoch_us(ts) AS us FROM events)"
_LIST = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES))
ORACLES = {
    "thinned_events": f"""WITH RECURSIVE {_AT}, r AS (SELECT user_id, min(us) AS us FROM e GROUP BY user_id
 UNION ALL SELECT r.user_id, (SELECT min(e.us) FROM e WHERE e.user_id = r.user_id AND e.us >= r.us + {GAP}) AS us FROM r WHERE r.us IS NOT NULL)
 SELECT user_id, us AS accepted_at FROM r WHERE us IS NOT NULL""",
    "keys_on_arrival": f"""WITH {_AT}, v AS (SELECT user_id, us, max(event_id) AS version, arg_max(value, event_id) AS key_value FROM e WHERE event_type IN ('signup', 'purchase') GROUP BY ALL)
 SELECT f.event_id, f.user_id, v.version, v.key_value FROM (SELECT * FROM e WHERE event_type = 'view') f ASOF LEFT JOIN v ON f.user_id = v.user_id AND f.us >= v.us""",
    "existence_log": f"""WITH {_AT}, l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) AS n FROM e)
 SELECT user_id::VARCHAR AS awb, value > 20 AS exists, CASE WHEN event_id % 3 <> 0 THEN us::VARCHAR END AS checked_at FROM l WHERE n = 1 AND event_type <> 'error'""",
    "cut_off_checks": f"""WITH s AS (SELECT file, stage, max(seconds)::DOUBLE AS seconds, bool_or(decided) AS decided FROM ({_STAGES}) GROUP BY ALL),
 a AS (SELECT *, sum(seconds) OVER (PARTITION BY file ORDER BY stage) AS spent, count(*) FILTER (WHERE decided) OVER (PARTITION BY file ORDER BY stage) - decided::INT AS earlier FROM s)
 SELECT file, CASE WHEN max(spent) > {A.BUDGET} THEN 2 ELSE 1 END AS passes, count(*) FILTER (WHERE spent <= {A.BUDGET}) AS kept_stages, min(stage) FILTER (WHERE spent > {A.BUDGET}) AS resumed_at,
  min(stage) FILTER (WHERE decided) AS decided_at, round(max(spent), 6) AS seconds FROM a WHERE earlier = 0 GROUP BY file""",
    "noisy_cascade": f"""WITH keys AS ({REF_KEYS_SQL}), u AS (SELECT DISTINCT o_orderkey // 4 AS doc, o_orderkey % 4 AS stage_seq, {KEY.format('(o_orderkey - o_orderkey % 4 + 3 * i)')} AS candidate
  FROM orders, range(6) t(i) WHERE (o_orderkey + o_orderkey // 7) % 6 >= i),
 d AS (SELECT *, 'Standard' AS tier, candidate IN (SELECT awb FROM keys) AS known FROM u WHERE NOT (substring(candidate, 1, 4)::INT BETWEEN 2015 AND 2035 AND substring(candidate, 5, 2)::INT BETWEEN 1 AND 12)),
 m AS (SELECT *, count(*) OVER (PARTITION BY doc, stage_seq) AS many FROM d), cands AS (SELECT * FROM m WHERE NOT (stage_seq IN (1, 2) AND many > 3)),
 {_CLOSE.format(source='cands')}, st AS (SELECT DISTINCT doc, stage_seq FROM cands),
 pools AS (SELECT st.doc, st.stage_seq, candidate, 'Standard' AS tier, bool_or(known) AS known, count(DISTINCT c.stage_seq) AS hits FROM st JOIN cands c ON st.doc = c.doc AND c.stage_seq <= st.stage_seq GROUP BY ALL),
 {_verdict('doc, stage_seq', 'pools')}, r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY status = 'none', stage_seq) AS n FROM v)
 SELECT doc, status, awb, method, CASE WHEN status <> 'none' THEN stage_seq END AS stage, ties FROM r WHERE n = 1""",
}
