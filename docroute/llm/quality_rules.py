"""Quality rules with thresholds that adapt to each language and source.

Every rule's metric is a whole number, and a count for each of its bins is a quantile sketch: values below 1024 (all
shares) have bins of their own and are exact, larger ones (mean lengths of over 102 code points a word) are known to a
512th part, so a sketch stays small whatever the texts. Counts of groups add up, to a language's and to the corpus's. A group's limits come from its own sketch, or from its
language's or the corpus's when it has few documents. Only DataFrame functions are used.

Null and empty texts have no words and fail the base rule. Null languages and sources are groups like others.
Repeated rows are judged one by one and get equal verdicts. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import Scratch

#: A metric's limits are median +- SPREAD x interquartile range +- its slack. Parts of 1000; word_length: tenths of a code point.
SLACK = {"symbols": 30, "dup_lines": 150, "repeats": 150, "word_length": 15}
SPREAD = 4
#: Documents that a group needs for limits of its own.
LEAST = 200
#: Leading bits of a metric that its bin keeps: values below 1024 are exact, larger ones to a 512th part.
BIN_BITS = 10


def features(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts that the rules use, for every row."""
    d = documents.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select(
        "doc_id", "lang", "source",
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.array_remove(F.split(F.regexp_replace("text", r"[\x09-\x0D]", " "), " ", -1), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    d = d.select(
        "doc_id", "lang", "source", "n_symbols", "words",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    at = lambda p, k: F.get("words", (p + k).cast("int"))
    windows = F.transform("words", lambda w, i: F.xxhash64(w, at(i, 1), at(i, 2)))
    d = d.withColumn("windows", F.when(F.col("n") >= 3, F.slice(windows, F.lit(1), F.col("n") - 2)))
    # Windows of which a part of the hash stands twice are candidates (neighbours among sorted longs of hash and place); the
    # candidates, sorted by their words, show which windows are really alike. A place has 31 bits, as many as an array can count.
    bits, mask = 31, (1 << 31) - 1
    key, place = lambda v: F.shiftright(v, bits), lambda v: v.bitwiseAND(F.lit(mask).cast("long"))
    packed = F.sort_array(F.transform("windows", lambda h, i: F.shiftleft(h, bits).bitwiseOR(i.cast("long"))))
    d = d.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), packed))
    no = F.lit(False)
    twin = lambda v, j: F.coalesce(key(v) == key(F.get("windows", j)), no)
    near = F.filter("windows", lambda v, j: twin(v, j - 1) | twin(v, j + 1))
    d = d.withColumn("spots", F.array_sort(F.transform(near, lambda v: F.struct(at(place(v), 0).alias("a"), at(place(v), 1).alias("b"), at(place(v), 2).alias("c"), place(v).alias("p")))))
    words = lambda v: F.struct(v["a"], v["b"], v["c"])
    same = lambda v, j: F.coalesce(words(v) == words(F.get("spots", j)), no)
    twice = F.filter("spots", lambda v, j: same(v, j - 1) | same(v, j + 1))
    d = d.withColumn("places", F.sort_array(F.transform(twice, lambda v: v["p"])))
    steps = F.transform("places", lambda p, j: F.least(F.lit(3).cast("long"), F.coalesce(F.get("places", j + 1) - p, F.lit(3).cast("long"))))
    return d.select(
        "doc_id", "lang", "source", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long")).alias("n_repeat_words"), "n_lines",
    )


def _metrics() -> dict[str, Column]:
    def whole(x: str) -> Column:
        return F.expr(f"{x} - ({x}) % shiftleft(1L, cast(greatest(length(bin({x})) - {BIN_BITS}, 0) AS int))")

    return {
        "symbols": whole("1000 * n_symbols div greatest(word_chars, 1)"),
        "dup_lines": whole("1000 * n_dup_lines div greatest(n_lines, 1)"),
        "repeats": whole("1000 * n_repeat_words div greatest(n_words, 1)"),
        "word_length": whole("10 * word_chars div greatest(n_words, 1)"),
    }


def sketches(rows: DataFrame) -> DataFrame:
    """Counts of documents for each language, source, metric and value; sketches merge by adding counts."""
    bins = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("bin")) for k, v in _metrics().items()]))
    return rows.where("n_words > 0").select("lang", "source", bins.alias("b")).groupBy("lang", "source", "b.metric", "b.bin").agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """Documents and quartiles of merged sketches: the least value that a quarter, half, three quarters do not exceed."""
    merged = sketch.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "metric")
    merged = merged.select(*keys, "metric", "bin", F.sum("n").over(w.orderBy("bin")).alias("below"), F.sum("n").over(w).alias("total"))
    q = lambda part: F.min(F.when(F.col("below") * 4 >= F.col("total") * part, F.col("bin")))
    return merged.groupBy(*keys, "metric").agg(F.max("total").alias("docs"), q(1).alias("q1"), q(2).alias("q2"), q(3).alias("q3"))


def thresholds(sketch: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source and for each metric the lowest and highest value that is kept."""
    own, lang, all_ = _quartiles(sketch, "lang", "source"), _quartiles(sketch, "lang"), _quartiles(sketch)
    pack = lambda name: F.struct("docs", "q1", "q2", "q3").alias(name)
    lang = lang.select(F.col("lang").alias("lang_"), F.col("metric").alias("metric_"), pack("of_lang"))
    all_ = all_.select(F.col("metric").alias("metric__"), pack("of_all"))
    own = own.select("lang", "source", "metric", pack("own"))
    t = own.join(lang, own.lang.eqNullSafe(F.col("lang_")) & (F.col("metric") == F.col("metric_"))).join(F.broadcast(all_), F.col("metric") == F.col("metric__"))
    best = F.when(F.col("own.docs") >= least, F.col("own")).when(F.col("of_lang.docs") >= least, F.col("of_lang")).otherwise(F.col("of_all"))
    t = t.select("lang", "source", "metric", best.alias("s"))
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])[F.col("metric")]
    reach = SPREAD * (F.col("s.q3") - F.col("s.q1")) + slack
    t = t.select("lang", "source", "metric", (F.col("s.q2") - reach).alias("low"), (F.col("s.q2") + reach).alias("high"))
    limit = lambda k, side: F.max(F.when(F.col("metric") == k, F.col(side)))
    return t.groupBy("lang", "source").agg(*[limit(k, "high").alias(f"{k}_high") for k in SLACK], limit("word_length", "low").alias("word_length_low"))


def quality_rules(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """Features, base_failed and kept for every document.

    The features are written once and read for the sketches and for the verdicts; only rows of numbers are shuffled.
    """
    work = Scratch(documents.sparkSession, "quality-rules")
    rows = work.table(features(documents), "features")
    t = thresholds(sketches(rows), least)
    t = t.withColumnsRenamed({"lang": "lang_", "source": "source_"})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.lit(True)
    for k, v in _metrics().items():
        within = within & (v <= F.col(f"{k}_high"))
    within = within & (_metrics()["word_length"] >= F.col("word_length_low"))
    out = rows.join(t, rows.lang.eqNullSafe(t.lang_) & rows.source.eqNullSafe(t.source_), "left")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.coalesce(within, F.lit(False))).alias("kept"),
    )


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    value = {
        "symbols": "1000 * n_symbols // greatest(word_chars, 1)",
        "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
        "repeats": "1000 * n_repeat_words // greatest(n_words, 1)",
        "word_length": "10 * word_chars // greatest(n_words, 1)",
    }
    metric = {k: f"({x} - ({x}) % (1::BIGINT << greatest(length(bin(({x})::BIGINT)) - {BIN_BITS}, 0)))" for k, x in value.items()}
    values = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS metric, {v} AS bin FROM f WHERE n_words > 0" for k, v in metric.items())
    quart = lambda q: f"list_sort(list(bin))[(({q} * count(*) + 3) // 4)::BIGINT] AS q{q}"
    level = lambda keys: f"SELECT {keys}metric, count(*) AS docs, {quart(1)}, {quart(2)}, {quart(3)} FROM v GROUP BY {keys}metric"
    slack = "CASE o.metric " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SLACK.items()) + " END"
    pick = lambda q: f"CASE WHEN o.docs >= {LEAST} THEN o.q{q} WHEN l.docs >= {LEAST} THEN l.q{q} ELSE a.q{q} END AS q{q}"
    high = ", ".join(f"max(CASE WHEN metric = '{k}' THEN q2 + {SPREAD} * (q3 - q1) + slack END) AS {k}_high" for k in metric)
    ok = " AND ".join(f"{v} <= {k}_high" for k, v in metric.items()) + f" AND {metric['word_length']} >= word_length_low"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS g
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
n AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM t, (VALUES (0), (1), (2)) k(k) GROUP BY r),
f AS (SELECT doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines FROM w LEFT JOIN n USING (r)),
v AS ({values}),
o AS ({level("lang, source, ")}), l AS ({level("lang, ")}), a AS ({level("")}),
s AS (SELECT o.lang, o.source, o.metric, {pick(1)}, {pick(2)}, {pick(3)}, {slack} AS slack
      FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric JOIN a ON o.metric = a.metric),
h AS (SELECT lang, source, {high}, max(CASE WHEN metric = 'word_length' THEN q2 - {SPREAD} * (q3 - q1) - slack END) AS word_length_low
      FROM s GROUP BY lang, source),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({ok}, FALSE) AS kept
FROM b LEFT JOIN h ON b.lang IS NOT DISTINCT FROM h.lang AND b.source IS NOT DISTINCT FROM h.source"""


ORACLE = _oracle()
