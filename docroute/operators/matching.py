"""Page matching over all tiers: exact hash, perceptual hash, embedded text, scanned text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.functions.similarity import text_similarity
from docroute.operators.routing import FOCUS_PAGES, PHASH_DISTANCE, cargo_control_page

TEXT_SIMILARITY = 50.0
TIERS = ("HASH", "PHASH", "TEXT", "OCR")


def page_pairs(incoming: DataFrame, archive: DataFrame, text_at: float = TEXT_SIMILARITY) -> DataFrame:
    """file_id, page_no, doc, doc_page, tier (1 to 4), score of pages of one key that match.

    incoming: awb, file_id, page_no, page_hash, phash, text, ocr; archive: awb, doc, doc_page and the same. Fuzzy scores are
    computed only for pairs that neither hash settles. Cargo control pages match nothing.
    """
    i = incoming.where(~F.coalesce(cargo_control_page(F.col("text")), F.lit(False)))
    a = archive.select("awb", "doc", "doc_page", *[F.col(c).alias(f"a_{c}") for c in ("page_hash", "phash", "text", "ocr")])
    p = i.join(a, "awb")
    near = F.bit_count(F.col("phash").bitwiseXOR(F.col("a_phash")))
    p = p.withColumn("tier", F.when(F.col("page_hash") == F.col("a_page_hash"), 1).when(near <= PHASH_DISTANCE, 2)).withColumn("distance", near)
    sure = p.where("tier is not null").select("file_id", "page_no", "doc", "doc_page", "tier", F.when(F.col("tier") == 1, 100.0).otherwise(F.col("distance").cast("double")).alias("score"))
    rest = p.where("tier is null")
    by_text = rest.withColumn("score", text_similarity("text", "a_text"))
    best = lambda c, other: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.trim(other), F.lit(""))
    by_text = by_text.withColumn("o", F.when(F.col("score") >= text_at, F.lit(0.0)).otherwise(text_similarity(best("text", F.col("ocr")), best("a_text", F.col("a_ocr")))))
    fuzzy = by_text.withColumn("tier", F.when(F.col("score") >= text_at, 3).when(F.col("o") >= text_at, 4)).where("tier is not null")
    return sure.unionByName(fuzzy.select("file_id", "page_no", "doc", "doc_page", "tier", F.when(F.col("tier") == 3, F.col("score")).otherwise(F.col("o")).alias("score")))


def claim(pairs: DataFrame, focus_pages: int = FOCUS_PAGES) -> DataFrame:
    """file_id, page_no, method, doc, doc_page, score: each page is claimed once, by the first tier, document and page.

    When a document has claimed `focus_pages` pages of a file, only that document is looked at from then on. The fold runs
    over one file's matches.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        claimed, counts, focus, out = set(), {}, None, []
        for r in pdf.sort_values(["tier", "page_no", "doc", "doc_page"]).itertuples(index=False):
            if r.page_no in claimed or (focus is not None and r.doc != focus):
                continue
            claimed.add(r.page_no)
            counts[r.doc] = counts.get(r.doc, 0) + 1
            if focus is None and counts[r.doc] >= focus_pages:
                focus = r.doc
            out.append((r.file_id, r.page_no, TIERS[r.tier - 1], r.doc, r.doc_page, r.score))
        return pd.DataFrame(out, columns=["file_id", "page_no", "method", "doc", "doc_page", "score"])

    p = pairs.select(F.col("file_id").cast("long"), F.col("page_no").cast("int"), F.col("doc").cast("long"), F.col("doc_page").cast("int"), F.col("tier").cast("int"), F.col("score").cast("double"))
    return p.groupBy("file_id").applyInPandas(fold, "file_id long, page_no int, method string, doc long, doc_page int, score double")
