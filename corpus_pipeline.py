"""Documents to packed training sequences: quality, near duplicates, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.llm import jaccard_join, mixing, packing, quality_classifier, substring_dedup
from docroute.llm.common import Scratch, row_once, text_hash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shuffled(spark: SparkSession) -> None:
    """Joins of tables that grow with the input are shuffled at every size; small ones are broadcast where the code asks for it.

    Each table that Spark broadcasts by itself is built on the driver in a thread of its own, and the hundreds of joins of all stages
    leave the driver with the memory of over a hundred of them.
    """
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier selects. It learns from the labels of the documents that arrive here."""
    shuffled(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    return quality_classifier.score(docs.select(*COLUMNS), model, COLUMNS).where("selected").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return jaccard_join.distinct_documents(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stood before."""
    return substring_dedup.without_repeats(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    docs = docs.select(*COLUMNS)
    taken = mixing.mix(docs).groupBy(F.col("doc_id").alias("doc_"), F.col("th").alias("th_")).agg(F.sum("copies").alias("copies")).where("copies > 0")
    taken = Scratch(spark, "mix-taken").table(taken, "taken")
    d = docs.withColumn("th__", text_hash())
    out = d.join(taken, (F.col("th__") == F.col("th_")) & d["doc_id"].cast("long").eqNullSafe(F.col("doc_")))
    out = out.withColumn("once__", row_once(["th_", "doc_"])).where("once__ = 1")
    return out.withColumn("copy__", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack(Scratch(spark, "pieces").table(packing.tokenize(docs), "pieces"))


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("source_mixing", source_mix),
    ("best_fit_packing", pack),
]

#: Trained weights and random rounding are beyond SQL; the tests compare each stage with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again."""
    work = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
