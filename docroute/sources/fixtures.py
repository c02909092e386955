"""Input views derived from the driver's tables, as Spark builders and as DuckDB SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


KEY = "cast(100000000000 + ({} * 382258049) % 899999999999 as string)"
_TEXT = """CASE {k} % 12
  WHEN 0 THEN concat('AWB NO: ', awb)
  WHEN 1 THEN concat('TRK: ', translate(awb, '0158', 'OISB'))
  WHEN 2 THEN concat('Tracking: ', substring(awb, 1, 4), ' ', substring(awb, 5, 4), ' ', substring(awb, 9, 4))
  WHEN 3 THEN concat('400-', awb)
  WHEN 4 THEN concat('Ref. ', substring(awb, 1, 11), cast((cast(substring(awb, 12, 1) as int) + 1) % 10 as string))
  WHEN 5 THEN concat('A ', awb, ' + ', {other})
  WHEN 6 THEN concat('Date ', '201907', substring(awb, 7, 6))
  WHEN 7 THEN concat('Ref. ', '0', substring(awb, 2, 11))
  WHEN 8 THEN 'no digits on this page'
  WHEN 9 THEN concat('Long 77', awb, '42')
  WHEN 10 THEN concat('Ref. ', awb)
  ELSE concat('Ref. ', substring(awb, 1, 10), cast((cast(substring(awb, 11, 1) as int) + 3) % 10 as string), cast((cast(substring(awb, 12, 1) as int) + 7) % 10 as string))
END"""

REF_KEYS_SQL = f"SELECT o_orderkey, {KEY.format('o_orderkey')} AS awb FROM orders"
STAGE_TEXTS_SQL = (
    "SELECT o_orderkey AS file_id, o_orderkey % 12 AS variant, (o_orderkey - o_orderkey % 3) / 3 AS doc, o_orderkey % 3 AS stage_seq, awb, "
    + _TEXT.format(k="o_orderkey", other=KEY.format("(o_orderkey + 1)"))
    + f" AS text FROM ({REF_KEYS_SQL}) k"
).replace("(o_orderkey - o_orderkey % 3) / 3", "cast((o_orderkey - o_orderkey % 3) / 3 as bigint)")


def ref_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, awb: the valid 12-digit keys."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(KEY.format("o_orderkey")).alias("awb"))


def stage_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_id, variant, doc, stage_seq, awb, text: one text of each kind of the confusion fixtures in turn."""
    k = ref_keys(spark, sf_dir)
    return k.select(
        F.col("o_orderkey").alias("file_id"), (F.col("o_orderkey") % 12).alias("variant"), ((F.col("o_orderkey") - F.col("o_orderkey") % 3) / 3).cast("long").alias("doc"),
        (F.col("o_orderkey") % 3).alias("stage_seq"), "awb", F.expr(_TEXT.format(k="o_orderkey", other=KEY.format("(o_orderkey + 1)"))).alias("text"),
    )


_PAGE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
FILE_PAGES_SQL = f"""SELECT l_orderkey AS file_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_PAGE_ORDER}) AS page_no,
  md5(concat(cast(l_partkey % 50 as varchar), '|', cast(l_suppkey % 10 as varchar))) AS page_hash FROM lineitem"""


def file_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_id, page_no, page_hash: pages of incoming files; hashes have few values, so files share pages."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS file_id", f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {_PAGE_ORDER}) AS page_no",
        "md5(cast(concat(cast(l_partkey % 50 as string), '|', cast(l_suppkey % 10 as string)) as binary)) AS page_hash",
    )


LIFECYCLE_SQL = """SELECT user_id AS file, event_id, ts,
  CASE event_type WHEN 'signup' THEN 'HOT_START' WHEN 'view' THEN 'HOT_END' WHEN 'click' THEN 'EDM_START' WHEN 'purchase' THEN 'EDM_END' ELSE 'NEEDS_REVIEW' END AS kind,
  value FROM events"""


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, event_id, ts, kind, value: the lifecycle log of files."""
    kinds = F.create_map(*[F.lit(x) for kv in (("signup", "HOT_START"), ("view", "HOT_END"), ("click", "EDM_START"), ("purchase", "EDM_END")) for x in kv])
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("file"), "event_id", "ts", F.coalesce(kinds[F.col("event_type")], F.lit("NEEDS_REVIEW")).alias("kind"), "value")


_TIER = "CASE WHEN {p} IN ('1-URGENT', '2-HIGH') THEN 'High' WHEN {p} = '3-MEDIUM' THEN 'Medium' ELSE 'Low' END"
CLEAN_FILES_SQL = f"""SELECT k.awb, o.o_orderkey, o.o_orderdate AS mtime, {_TIER.format(p='o.o_orderpriority')} AS tier, year(o.o_orderdate) * 100 + month(o.o_orderdate) AS run, l.pages
  FROM orders o JOIN ({REF_KEYS_SQL}) k ON k.o_orderkey = o.o_orderkey JOIN (SELECT l_orderkey, count(*) AS pages FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey"""


def clean_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """awb, o_orderkey, mtime, tier, run, pages: files that go to print; a run is a month."""
    pages = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("pages"))
    o = table(spark, sf_dir, "orders")
    return o.join(pages, o.o_orderkey == pages.l_orderkey).selectExpr(
        f"{KEY.format('o_orderkey')} AS awb", "o_orderkey", "o_orderdate AS mtime", f"{_TIER.format(p='o_orderpriority')} AS tier",
        "year(o_orderdate) * 100 + month(o_orderdate) AS run", "pages",
    )
