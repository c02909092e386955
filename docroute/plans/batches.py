"""Queries on print batches."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docroute.operators import batching as B
from docroute.sources.fixtures import CLEAN_FILES_SQL, clean_files


def _packed(spark, sf_dir):
    c = clean_files(spark, sf_dir).withColumn("size", F.col("pages") + B.COVER)
    return B.next_fit(c, ["tier", "run"], ["mtime", "o_orderkey"], "size")


def next_fit_plan(spark, sf_dir):
    return _packed(spark, sf_dir).select("tier", "run", "o_orderkey", "seq", "batch_no", "start_page", "size")


def batch_pages(spark, sf_dir):
    g = _packed(spark, sf_dir).groupBy("tier", "run", "batch_no").agg(F.sum("size").alias("pages"), F.count("*").alias("files"))
    return g.withColumn("name", B.batch_name("PRINT", F.col("tier"), F.col("batch_no")))


def batch_estimate(spark, sf_dir):
    """Batches for each run, summed over tiers."""
    return _packed(spark, sf_dir).groupBy("run", "tier").agg(F.max("batch_no").alias("b")).groupBy("run").agg(F.sum("b").alias("batches"))


def tier_breakdown(spark, sf_dir):
    return clean_files(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("files"), F.sum("pages").alias("pages"), F.count_distinct("run").alias("runs"))


def sequence_numbers(spark, sf_dir):
    w = Window.partitionBy("tier", "run").orderBy("mtime", "o_orderkey")
    return clean_files(spark, sf_dir).select("o_orderkey", "tier", "run", F.row_number().over(w).alias("seq"))


def collision_names(spark, sf_dir):
    """File names of the orders of a customer: the first keeps the stem."""
    c = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_custkey").cast("string").alias("stem"), "o_orderdate")
    return B.collision_name(c, "stem", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "name")


_PACKED = f"""RECURSIVE c AS ({CLEAN_FILES_SQL}), o AS (SELECT *, pages + 1 AS size, row_number() OVER (PARTITION BY tier, run ORDER BY mtime, o_orderkey) AS seq FROM c),
 s AS (SELECT tier, run, o_orderkey, seq, 1::BIGINT AS batch_no, 1::BIGINT AS start_page, size, size AS used FROM o WHERE seq = 1
  UNION ALL SELECT o.tier, o.run, o.o_orderkey, o.seq, CASE WHEN s.used > 0 AND s.used + o.size > 48 THEN s.batch_no + 1 ELSE s.batch_no END, CASE WHEN s.used > 0 AND s.used + o.size > 48 THEN 1 ELSE s.used + 1 END, o.size, CASE WHEN s.used > 0 AND s.used + o.size > 48 THEN o.size ELSE s.used + o.size END
   FROM s JOIN o ON o.tier = s.tier AND o.run = s.run AND o.seq = s.seq + 1)"""
QUERIES = {f.__name__: f for f in (next_fit_plan, batch_pages, batch_estimate, tier_breakdown, sequence_numbers, collision_names)}
ORACLES = {
    "next_fit_plan": f"WITH {_PACKED} SELECT tier, run, o_orderkey, seq, batch_no, start_page, size FROM s",
    "batch_pages": f"WITH {_PACKED} SELECT tier, run, batch_no, sum(size)::BIGINT AS pages, count(*) AS files, concat('PRINT_T', substring(tier, 1, 1), '_', lpad(batch_no::VARCHAR, 3, '0'), '.pdf') AS name FROM s GROUP BY tier, run, batch_no",
    "batch_estimate": f"WITH {_PACKED} SELECT run, sum(b)::BIGINT AS batches FROM (SELECT run, tier, max(batch_no) AS b FROM s GROUP BY ALL) GROUP BY run",
    "tier_breakdown": f"SELECT tier, count(*) AS files, sum(pages)::BIGINT AS pages, count(DISTINCT run) AS runs FROM ({CLEAN_FILES_SQL}) GROUP BY tier",
    "sequence_numbers": f"SELECT o_orderkey, tier, run, row_number() OVER (PARTITION BY tier, run ORDER BY mtime, o_orderkey) AS seq FROM ({CLEAN_FILES_SQL})",
    "collision_names": "SELECT o_orderkey, concat(o_custkey, CASE WHEN n > 1 THEN concat('_', n) ELSE '' END, '.pdf') AS name FROM (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)",
}
