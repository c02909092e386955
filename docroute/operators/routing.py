"""Duplicate pages: fingerprints, prefilter, tiered matching, confidence and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_TOKENS, PHASH_DISTANCE, TOP_DOCS, FEW_DOCS, FOCUS_PAGES = 12, 10, 3, 3, 3
REJECT_PAGES, REJECT_RATIO = 5, 0.70


def numeric_tokens(pages: DataFrame, *ids: str, top: int = TOP_TOKENS) -> DataFrame:
    """ids, token, n, rank: the most frequent numbers of 6 to 16 digits; ties by first place."""
    t = pages.select(*ids, "page_no", F.posexplode(F.regexp_extract_all("text", F.lit(r"\b(\d{6,16})\b"), F.lit(1))).alias("pos", "token"))
    t = t.groupBy(*ids, "token").agg(F.count("*").alias("n"), F.min(F.struct("page_no", "pos")).alias("first"))
    w = Window.partitionBy(*ids).orderBy(F.desc("n"), "first")
    return t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(*ids, "token", "n", "rank")


def fingerprints(pages: DataFrame, *ids: str) -> DataFrame:
    """ids, page_count and hash_map (hash to first page)."""
    first = pages.groupBy(*ids, "page_hash").agg(F.min("page_no").alias("page_no"), F.count("*").alias("same"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("page_hash", "page_no"))))
    return first.groupBy(*ids).agg(F.sum("same").alias("page_count"), entries.alias("hash_map"))


def exact_pages(incoming: DataFrame, archive: DataFrame, by: str) -> DataFrame:
    """file_id, page_no, doc, doc_page: the first archive page (by document, then page) with an incoming page's hash.

    incoming: file_id, page_no, page_hash and the key `by`; archive: doc, doc_page, page_hash and `by`.
    """
    a = archive.groupBy(by, "page_hash").agg(F.min(F.struct("doc", "doc_page")).alias("m"))
    return incoming.join(a, [by, "page_hash"]).select("file_id", "page_no", F.col("m.doc").alias("doc"), F.col("m.doc_page").alias("doc_page"))


def near_hashes(left: DataFrame, right: DataFrame, *by: str, most: int = PHASH_DISTANCE) -> DataFrame:
    """`by`, ha, hb and distance of the different 64-bit hashes (column h) of two sides that differ in at most `most` bits (11 at most).

    Of four bands of 16 bits one differs in two bits at most. Either side brings each band as it is and with each one bit turned
    (17 keys), so bands two bits apart meet in the middle: the left side turns the lower bit, the right one the higher. A pair is
    taken once, at its first near band. With columns `by`, only hashes equal in these meet. Sides are sorted and merged at every size:
    Spark takes the keys for no more rows than there are hashes, and the driver could not hold the table it would broadcast.
    """
    if most > 11:
        raise ValueError("four bands find eleven bits at most")
    band = lambda h, k: F.shiftrightunsigned(h, 16 * k).bitwiseAND(F.lit(0xFFFF))
    keys = [(k, i, band(F.col("h"), k) if i < 0 else band(F.col("h"), k).bitwiseXOR(F.lit(1 << i))) for k in range(4) for i in range(-1, 16)]
    key = F.explode(F.array(*[F.struct(F.lit(k).alias("band"), F.lit(i).alias("turned"), bits.alias("bits")) for k, i, bits in keys]))
    spread = lambda df, h, turned: df.select(*by, "h").distinct().select(*by, F.col("h").alias(h), key.alias("k")).select(*by, h, F.col("k.band"), F.col("k.bits"), F.col("k.turned").alias(turned))
    once = (F.col("tb") == -1) | ((F.col("ta") >= 0) & (F.col("ta") < F.col("tb")))
    p = spread(left, "ha", "ta").join(spread(right, "hb", "tb").hint("merge"), [*by, "band", "bits"]).where(once)
    distance = F.bit_count(F.col("ha").bitwiseXOR(F.col("hb")))
    first = F.lit(None).cast("int")
    for k in reversed(range(4)):
        first = F.when(F.bit_count(band(F.col("ha"), k).bitwiseXOR(band(F.col("hb"), k))) <= 2, F.lit(k)).otherwise(first)
    return p.where((distance <= most) & (F.col("band") == first)).select(*by, "ha", "hb", distance.alias("distance"))


def phash_pairs(left: DataFrame, right: DataFrame, most: int = PHASH_DISTANCE) -> DataFrame:
    """left id a, right id b and distance of hashes (columns id, h) that differ in at most `most` bits. Equal hashes of a side are one row until the end."""
    p = near_hashes(left, right, most=most)
    p = p.join(left.select(F.col("id").alias("a"), F.col("h").alias("ha")).hint("merge"), "ha").join(right.select(F.col("id").alias("b"), F.col("h").alias("hb")).hint("merge"), "hb")
    return p.select("a", "b", "distance")


def prefilter(pairs: DataFrame, *more: str, by: str | None = None) -> DataFrame:
    """file_id, doc, `more`, score, rank, kept. pairs: file_id, doc, hash_hits, phash_hits, token_share, page_gap, pages.

    A document is kept for any strong signal or as one of the best three, unless all its signals are cold. Files
    with few documents keep them all. `by`: the column with a file's key; pairs that come dealt by it stay where they are.
    """
    near = 1 - F.least(F.lit(1.0), F.abs("page_gap") / F.greatest("pages", F.lit(1)))
    p = pairs.withColumn("score", F.round(2.5 * F.col("hash_hits") + 1.5 * F.col("phash_hits") + 2.0 * F.col("token_share") + 0.5 * near, 9))
    w = Window.partitionBy(*filter(None, (by, "file_id")))
    p = p.withColumns({"rank": F.row_number().over(w.orderBy(F.desc("score"), "doc")), "docs": F.count("*").over(w)})
    top = F.col("rank") <= TOP_DOCS
    strong = (F.col("hash_hits") > 0) | (F.col("phash_hits") >= 1) | (F.col("token_share") >= 0.2) | top
    cold = (F.col("hash_hits") == 0) & (F.col("phash_hits") <= 0) & (F.col("token_share") <= 0.05) & ~top
    return p.select("file_id", "doc", *more, "score", "rank", ((F.col("docs") <= FEW_DOCS) | (strong & ~cold)).alias("kept"))


def cargo_control_page(text: Column) -> Column:
    """Cargo control documents (a title in English or French, and a number behind 400) are exempt from duplicate checks."""
    return F.upper(text).rlike("CARGO CONTROL DOCUMENT|FEUILLE DE RECAPITULATION") & text.rlike(r"400[\s\-]?\d{10,12}")


def confidence(h: Column, p: Column, t: Column, o: Column) -> Column:
    """How sure a rejection is, from the numbers of pages by exact hash, perceptual hash, text and scan."""
    return F.when(h >= 1, "HIGH").when((p >= 2) & (t + o >= 1), "HIGH").when(p >= 3, "MEDIUM").when((t + o >= 3) & (p >= 1), "MEDIUM").otherwise("LOW")


def route(dup: Column, total: Column, conf: Column) -> Column:
    """CLEAN, CLEAN-UNCHECKED, PARTIAL-CLEAN or REJECTED."""
    return (
        F.when(dup == 0, "CLEAN").when((dup == total) & (conf == "LOW"), "CLEAN-UNCHECKED").when(dup == total, "REJECTED")
        .when((dup > REJECT_PAGES) & (dup / total >= REJECT_RATIO) & (conf != "LOW"), "REJECTED").otherwise("PARTIAL-CLEAN")
    )


def routes(pages: DataFrame) -> DataFrame:
    """One row for each file, from pages (file_id, page_no, method or null; methods HASH, PHASH, TEXT, OCR)."""
    n = lambda m: F.count_if(F.col("method") == m)
    f = pages.groupBy("file_id").agg(
        F.count("*").alias("total"), F.count("method").alias("dup"), n("HASH").alias("h"), n("PHASH").alias("p"), n("TEXT").alias("t"), n("OCR").alias("o"),
        F.array_sort(F.collect_list(F.when(F.col("method").isNotNull(), F.col("page_no")))).alias("dup_pages"), F.array_sort(F.collect_list("page_no")).alias("all_pages"),
    )
    f = f.withColumn("confidence", confidence(F.col("h"), F.col("p"), F.col("t"), F.col("o"))).withColumn("route", route(F.col("dup"), F.col("total"), F.col("confidence")))
    rejected = F.when(F.col("route") == "REJECTED", F.col("total")).when(F.col("route") == "PARTIAL-CLEAN", F.col("dup")).otherwise(F.lit(0))
    return f.select("file_id", "total", "dup", "confidence", "route", rejected.alias("rejected_pages"), (F.col("total") - rejected).alias("clean_pages"), "dup_pages", F.array_except("all_pages", "dup_pages").alias("other_pages"))
