"""Queries on duplicate pages: tokens, fingerprints, matches, prefilter and routes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docroute.operators import prefilter as P
from docroute.operators import routing as R
from docroute.sources.fixtures import FILE_PAGES_SQL, file_pages, table


def numeric_top_tokens(spark, sf_dir):
    """Most frequent numbers of each source's documents; a document is a page."""
    d = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("page_no"), "text")
    return R.numeric_tokens(d, "source").select("source", "token", "n")


def page_fingerprints(spark, sf_dir):
    f = R.fingerprints(file_pages(spark, sf_dir), "file_id")
    return f.select("file_id", F.col("page_count").cast("long"), F.size("hash_map").cast("long").alias("hashes"), F.array_join(F.array_sort(F.map_values("hash_map")), ",").alias("first_pages"))


def _sides(spark, sf_dir):
    """Even orders are incoming files; odd ones are archived documents of the same customer group."""
    p = file_pages(spark, sf_dir)
    by = (F.floor(F.col("file_id") / 40)).alias("awb")
    inc = p.where("file_id % 2 = 0").select(by, "file_id", "page_no", "page_hash")
    arc = p.where("file_id % 2 = 1").select(by, F.col("file_id").alias("doc"), F.col("page_no").alias("doc_page"), "page_hash")
    return inc, arc


def exact_page_matches(spark, sf_dir):
    return R.exact_pages(*_sides(spark, sf_dir), "awb")


def page_routes(spark, sf_dir):
    """Routes of incoming files by exact page matches."""
    inc, arc = _sides(spark, sf_dir)
    hit = R.exact_pages(inc, arc, "awb").select("file_id", "page_no", F.lit("HASH").alias("method"))
    r = R.routes(inc.select("file_id", "page_no").join(hit, ["file_id", "page_no"], "left"))
    return r.withColumns({"dup_pages": F.array_join("dup_pages", ","), "other_pages": F.array_join("other_pages", ",")})


def archive_prefilter(spark, sf_dir):
    """Scores of a group's archived documents for each incoming file, by common hashes and page counts."""
    inc, arc = _sides(spark, sf_dir)
    i = inc.groupBy("awb", "file_id").agg(F.collect_set("page_hash").alias("ih"), F.count("*").alias("pages"))
    a = arc.groupBy("awb", "doc").agg(F.collect_set("page_hash").alias("ah"), F.count("*").alias("doc_pages"))
    p = i.join(a, "awb").select("file_id", "doc", F.size(F.array_intersect("ih", "ah")).alias("hash_hits"), F.lit(0).alias("phash_hits"), F.lit(0.0).alias("token_share"), (F.col("pages") - F.col("doc_pages")).alias("page_gap"), "pages")
    return R.prefilter(p)


#: Lines as pages with sparse hashes and numbers; two customers are one key.
_SIGNS = """SELECT o_custkey - o_custkey % 2 AS awb, o_orderkey AS file_id, l_linenumber AS page_no, l_linenumber = 6 AS exempt, CASE WHEN l_partkey % 19 > 0 THEN l_partkey % 389 END AS page_hash,
  CASE WHEN l_suppkey % 13 > 0 THEN (l_suppkey * 31 + l_partkey * 7) % 32749 * 281479271743489 END AS phash,
  concat('n ', cast(100000 + l_partkey % 97 as string), CASE WHEN l_linenumber % 2 = 0 THEN ' no 12345' ELSE '' END, ' of ', cast(2000000 + l_suppkey % 53 as string)) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS once FROM {lines}) l JOIN {orders} o ON o_orderkey = l_orderkey WHERE once = 1"""


def prefilter_signals(spark, sf_dir):
    """The documents that each file is compared with, by hashes, near hashes, frequent numbers and page counts."""
    # Lines are dealt by order once: their window, the join and a file's signs all keep to it.
    table(spark, sf_dir, "lineitem").repartition("l_orderkey").createOrReplaceTempView("lineitem_of_signs")
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_of_signs")
    p = spark.sql(_SIGNS.format(lines="lineitem_of_signs", orders="orders_of_signs"))
    return P.kept_documents(p.where("file_id % 2 = 0"), p.where("file_id % 2 = 1").withColumnsRenamed({"file_id": "doc", "page_no": "doc_page"}))


def phash_near(spark, sf_dir):
    """Pairs of hashes at distance 10 or less: sign bits of embeddings, every third one once more with 0 to 13 of its bits turned."""
    bits = F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.lit(0).cast("long"), lambda h, i: F.shiftleft(h, 1).bitwiseOR((F.element_at("embedding", i) > 0).cast("long")))
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), bits.alias("h"))
    # Turned bits stand five apart, from the second on.
    mask = F.aggregate(F.sequence(F.lit(0), F.lit(12)), F.lit(0).cast("long"), lambda m, i: F.when(i < F.floor(F.col("id") / 3) % 14, m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i * 5 + 1))).otherwise(m))
    copies = F.array(F.struct(F.col("id").alias("id"), F.col("h").alias("h")), F.when(F.col("id") % 3 == 0, F.struct((-F.col("id") - 1).alias("id"), F.col("h").bitwiseXOR(mask).alias("h"))))
    e = e.select(F.explode(copies).alias("x")).where("x is not null").select("x.id", "x.h")
    return R.phash_pairs(e, e).where("a < b")


def routing_cases(spark, sf_dir):
    """Confidence and route of every combination of page counts that lines show."""
    l = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 3).alias("h"), (F.col("l_suppkey") % 4).alias("p"), (F.col("l_linenumber") % 3).alias("t"), (F.col("l_orderkey") % 4).alias("o"), (F.col("l_partkey") % 5).alias("rest")).distinct()
    l = l.withColumn("dup", F.col("h") + F.col("p") + F.col("t") + F.col("o")).withColumn("total", F.col("dup") + F.col("rest")).where("total > 0")
    l = l.withColumn("confidence", R.confidence(F.col("h"), F.col("p"), F.col("t"), F.col("o")))
    return l.withColumn("route", R.route(F.col("dup"), F.col("total"), F.col("confidence"))).drop("rest")


def method_summary(spark, sf_dir):
    """Counts of each method for a file, methods in order of first page."""
    l = table(spark, sf_dir, "lineitem")
    m = F.when(F.col("l_returnflag") == "A", "HASH").when(F.col("l_returnflag") == "R", "PHASH")
    p = file_pages(spark, sf_dir).select("file_id", "page_no")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    d = l.select(F.col("l_orderkey").alias("file_id"), F.row_number().over(w).alias("page_no"), m.alias("method")).join(p, ["file_id", "page_no"]).where("method is not null")
    f = d.groupBy("file_id", "method").agg(F.count("*").alias("n"), F.min("page_no").alias("first"))
    return f.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "method"))), lambda x: x["method"]), "|").alias("methods"), F.sum("n").alias("pages"))


_SIDES = f"""p AS ({FILE_PAGES_SQL}), inc AS (SELECT file_id // 40 AS awb, * FROM p WHERE file_id % 2 = 0),
arc AS (SELECT file_id // 40 AS awb, file_id AS doc, page_no AS doc_page, page_hash FROM p WHERE file_id % 2 = 1),
m AS (SELECT file_id, page_no, doc, doc_page FROM (SELECT inc.file_id, inc.page_no, doc, doc_page, row_number() OVER (PARTITION BY inc.file_id, inc.page_no ORDER BY doc, doc_page) AS n FROM inc JOIN arc USING (awb, page_hash)) WHERE n = 1)"""
_CONF = "CASE WHEN h >= 1 THEN 'HIGH' WHEN p >= 2 AND t + o >= 1 THEN 'HIGH' WHEN p >= 3 THEN 'MEDIUM' WHEN t + o >= 3 AND p >= 1 THEN 'MEDIUM' ELSE 'LOW' END"
_ROUTE = "CASE WHEN dup = 0 THEN 'CLEAN' WHEN dup = total AND confidence = 'LOW' THEN 'CLEAN-UNCHECKED' WHEN dup = total THEN 'REJECTED' WHEN dup > 5 AND dup >= 0.7 * total AND confidence <> 'LOW' THEN 'REJECTED' ELSE 'PARTIAL-CLEAN' END"
QUERIES = {f.__name__: f for f in (numeric_top_tokens, page_fingerprints, exact_page_matches, page_routes, archive_prefilter, prefilter_signals, phash_near, routing_cases, method_summary)}
ORACLES = {
    "numeric_top_tokens": r"""WITH x AS (SELECT source, doc_id, regexp_extract_all(text, '\b[0-9]{6,16}\b') AS ts FROM documents),
 y AS (SELECT source, doc_id, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM x),
 z AS (SELECT source, token, count(*) AS n, min((doc_id, pos)) AS f FROM y GROUP BY source, token)
 SELECT source, token, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, f) AS r FROM z) WHERE r <= 12""",
    "page_fingerprints": f"""WITH p AS ({FILE_PAGES_SQL}), f AS (SELECT file_id, page_hash, min(page_no) AS page_no, count(*) AS n FROM p GROUP BY ALL)
 SELECT file_id, sum(n)::BIGINT AS page_count, count(*) AS hashes, array_to_string(list_sort(list(page_no)), ',') AS first_pages FROM f GROUP BY file_id""",
    "exact_page_matches": f"WITH {_SIDES} SELECT * FROM m",
    "page_routes": f"""WITH {_SIDES}, a AS (SELECT inc.file_id, count(*) AS total, count(m.doc) AS dup, coalesce(list_sort(list(inc.page_no) FILTER (WHERE m.doc IS NOT NULL)), []) AS d, coalesce(list_sort(list(inc.page_no) FILTER (WHERE m.doc IS NULL)), []) AS r
   FROM inc LEFT JOIN m ON inc.file_id = m.file_id AND inc.page_no = m.page_no GROUP BY inc.file_id),
 b AS (SELECT *, CASE WHEN dup >= 1 THEN 'HIGH' ELSE 'LOW' END AS confidence FROM a), c AS (SELECT *, {_ROUTE} AS route FROM b),
 e AS (SELECT *, CASE route WHEN 'REJECTED' THEN total WHEN 'PARTIAL-CLEAN' THEN dup ELSE 0 END AS rejected_pages FROM c)
 SELECT file_id, total, dup, confidence, route, rejected_pages, total - rejected_pages AS clean_pages, array_to_string(d, ',') AS dup_pages, array_to_string(r, ',') AS other_pages FROM e""",
    "archive_prefilter": f"""WITH {_SIDES}, i AS (SELECT awb, file_id, count(*) AS pages FROM inc GROUP BY ALL), a AS (SELECT awb, doc, count(*) AS doc_pages FROM arc GROUP BY ALL),
 h AS (SELECT file_id, doc, count(DISTINCT page_hash) AS hits FROM inc JOIN arc USING (awb, page_hash) GROUP BY ALL),
 s AS (SELECT file_id, doc, coalesce(hits, 0) AS hits, round(2.5::DOUBLE * coalesce(hits, 0) + 0.5::DOUBLE * (1 - least(1.0::DOUBLE, abs(pages - doc_pages) / greatest(pages, 1)::DOUBLE)), 9) AS score FROM i JOIN a USING (awb) LEFT JOIN h USING (file_id, doc)),
 r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY score DESC, doc) AS rank, count(*) OVER (PARTITION BY file_id) AS n FROM s)
 SELECT file_id, doc, score, rank, n <= 3 OR hits > 0 OR rank <= 3 AS kept FROM r""",
    "prefilter_signals": f"""WITH p AS MATERIALIZED ({_SIGNS.format(lines='lineitem', orders='orders')}), inc AS (SELECT * FROM p WHERE file_id % 2 = 0), arc AS (SELECT awb, file_id AS doc, page_no AS doc_page, page_hash, phash, text FROM p WHERE file_id % 2 = 1),
 f AS (SELECT awb, file_id, count(*) AS pages FROM inc GROUP BY ALL), d AS (SELECT awb, doc, count(*) AS doc_pages FROM arc GROUP BY ALL),
 h AS (SELECT file_id, doc, count(DISTINCT page_hash) AS hash_hits FROM inc JOIN arc USING (awb, page_hash) WHERE NOT exempt GROUP BY ALL),
 n AS (SELECT file_id, doc, count(DISTINCT page_no) AS phash_hits FROM inc JOIN arc USING (awb) WHERE NOT exempt AND bit_count(xor(inc.phash, arc.phash)) <= {R.PHASH_DISTANCE} GROUP BY ALL),
 w AS (SELECT file_id AS id, file_id % 2 AS side, page_no, regexp_extract_all(text, '\\b[0-9]{{6,16}}\\b') AS ts FROM p WHERE file_id % 2 = 1 OR NOT exempt),
 x AS (SELECT id, side, page_no, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM w), y AS (SELECT id, side, token, count(*) AS n, min((page_no, pos)) AS first FROM x GROUP BY ALL),
 z AS (SELECT id, side, token FROM (SELECT *, row_number() OVER (PARTITION BY id, side ORDER BY n DESC, first) AS r FROM y) WHERE r <= {R.TOP_TOKENS}), c AS (SELECT id AS file_id, count(*) AS tokens FROM z WHERE side = 0 GROUP BY id),
 t AS (SELECT f.file_id, d.doc, count(*) AS token_hits FROM f JOIN d USING (awb) JOIN z a ON a.id = f.file_id AND a.side = 0 JOIN z b ON b.id = d.doc AND b.side = 1 AND a.token = b.token GROUP BY ALL),
 s AS (SELECT file_id, doc, pages, doc_pages, tokens, coalesce(hash_hits, 0) AS hash_hits, coalesce(phash_hits, 0) AS phash_hits, coalesce(token_hits, 0) AS token_hits, count(*) OVER (PARTITION BY file_id) AS docs
  FROM f JOIN d USING (awb) LEFT JOIN h USING (file_id, doc) LEFT JOIN n USING (file_id, doc) LEFT JOIN t USING (file_id, doc) LEFT JOIN c USING (file_id)),
 v AS (SELECT *, token_hits / greatest(coalesce(tokens, 0), 1)::DOUBLE AS share, round(2.5::DOUBLE * hash_hits + 1.5::DOUBLE * phash_hits + 2.0::DOUBLE * (token_hits / greatest(coalesce(tokens, 0), 1)::DOUBLE) + 0.5::DOUBLE * (1 - least(1.0::DOUBLE, abs(pages - doc_pages) / greatest(pages, 1)::DOUBLE)), 9) AS score FROM s),
 r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY score DESC, doc) <= {R.TOP_DOCS} AS top FROM v)
 SELECT file_id, doc, hash_hits, phash_hits, token_hits, score, top FROM r WHERE docs <= {R.FEW_DOCS} OR top OR hash_hits > 0 OR phash_hits >= 1 OR share >= 0.2""",
    "phash_near": """WITH s AS (SELECT vec_id, list_transform(embedding[1:64], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END) AS l FROM embeddings),
 e AS (SELECT vec_id, array_to_string(l, '') AS h FROM s UNION ALL SELECT -vec_id - 1, array_to_string(list_transform(l, lambda x, i: CASE WHEN (64 - i - 1) % 5 = 0 AND (64 - i - 1) >= 0 AND (64 - i - 1) // 5 < (vec_id // 3) % 14 THEN CASE x WHEN '1' THEN '0' ELSE '1' END ELSE x END), '') FROM s WHERE vec_id % 3 = 0)
 SELECT a.vec_id AS a, b.vec_id AS b, hamming(a.h, b.h) AS distance FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE hamming(a.h, b.h) <= 10""",
    "routing_cases": f"""WITH l AS (SELECT DISTINCT l_partkey % 3 AS h, l_suppkey % 4 AS p, l_linenumber % 3 AS t, l_orderkey % 4 AS o, l_partkey % 5 AS rest FROM lineitem),
 d AS (SELECT h, p, t, o, h + p + t + o AS dup, h + p + t + o + rest AS total, {_CONF} AS confidence FROM l) SELECT *, {_ROUTE} AS route FROM d WHERE total > 0""",
    "method_summary": """WITH d AS (SELECT l_orderkey AS file_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS page_no, CASE l_returnflag WHEN 'A' THEN 'HASH' WHEN 'R' THEN 'PHASH' END AS method FROM lineitem),
 f AS (SELECT file_id, method, count(*) AS n, min(page_no) AS first FROM d WHERE method IS NOT NULL GROUP BY ALL)
 SELECT file_id, string_agg(method, '|' ORDER BY first) AS methods, sum(n)::BIGINT AS pages FROM f GROUP BY file_id""",
}
