"""Which archived documents of a key are worth a look page by page.

Every file and document is one row with its hashes, perceptual hashes and frequent numbers, and where a key has few pages these rows meet
directly. A key with many pages gets no row for every file and document: each signal is an inverted index then, and files meet documents over
a hash, a near perceptual hash or a frequent number that both have. What shares nothing can only be among the best three by its number of
pages, and for that a handful of documents beside each number of pages do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.operators.routing import PHASH_DISTANCE, TOP_DOCS, TOP_TOKENS, near_hashes, numeric_tokens, prefilter
from docroute.sources.scratch import keeper

_HITS = ("hash_hits", "phash_hits", "token_hits")
#: Pages of the other side that a key's page may meet on average before the inverted indices take over.
CROWDED = 500


def signals(incoming: DataFrame, archive: DataFrame, by: str) -> DataFrame:
    """`by`, file_id, doc and hits of those that share anything: different hashes, pages with a near perceptual hash, frequent numbers."""
    pair = [by, "file_id", "doc"]

    def row(df, name, n):
        return df.groupBy(*pair).agg(*[(n if c == name else F.lit(0)).cast("long").alias(c) for c in _HITS])

    hashes = incoming.select(by, "file_id", "page_hash").distinct().join(archive.select(by, "doc", "page_hash").distinct(), [by, "page_hash"])
    close = near_hashes(incoming.select(by, F.col("phash").alias("h")), archive.select(by, F.col("phash").alias("h")), by).select(by, "ha", "hb")
    pages = incoming.groupBy(by, "file_id", F.col("phash").alias("ha")).agg(F.count("*").alias("n"))
    close = close.join(pages, [by, "ha"]).join(archive.select(by, "doc", F.col("phash").alias("hb")).distinct(), [by, "hb"]).select(*pair, "ha", "n").distinct()
    own = numeric_tokens(incoming, by, "file_id").select(by, "file_id", "token")
    theirs = numeric_tokens(archive.withColumnRenamed("doc_page", "page_no"), by, "doc").select(by, "doc", "token")
    parts = row(hashes, "hash_hits", F.count("*")).union(row(close, "phash_hits", F.sum("n"))).union(row(own.join(theirs, [by, "token"]), "token_hits", F.count("*")))
    return parts.groupBy(*pair).agg(*[F.sum(c).alias(c) for c in _HITS])


def nearest(files: DataFrame, docs: DataFrame, by: str) -> DataFrame:
    """`by`, file_id, doc: a few documents of each file, the best three by number of pages (ties: by doc) among them.

    Of documents with fewer pages the best three are those with most pages, of the others those with fewest; where none comes near, all are
    equal and the first three are best. files: `by`, file_id, pages; docs: `by`, doc, doc_pages. The windows run over different numbers of pages.
    """
    least = lambda df, *part: df.withColumn("r_", F.row_number().over(Window.partitionBy(*part).orderBy("doc"))).where(F.col("r_") <= TOP_DOCS)
    sizes = least(docs, by, "doc_pages").groupBy(by, F.col("doc_pages").alias("pages")).agg(F.array_sort(F.collect_list("doc")).alias("docs_"))
    up, down = Window.partitionBy(by).orderBy("pages"), Window.partitionBy(by).orderBy(F.desc("pages"))
    three = lambda w: F.flatten(F.collect_list("docs_").over(w.rowsBetween(1 - TOP_DOCS, 0)))
    sizes = sizes.select(by, "pages", three(up).alias("below_"), three(down).alias("above_"))
    wanted = files.select(by, "pages").distinct().select(by, "pages", F.lit(True).alias("wanted_"))
    places = wanted.join(sizes, [by, "pages"], "full")
    last = lambda c, w: F.coalesce(F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.array().cast(places.schema[c].dataType))
    beside = places.select(by, "pages", "wanted_", F.array_union(last("below_", up), last("above_", down)).alias("docs_")).where("wanted_")
    beside = files.join(beside, [by, "pages"]).select(by, "file_id", F.explode("docs_").alias("doc"))
    return beside.union(files.join(least(docs, by), by).select(by, "file_id", "doc")).distinct()


def profiles(pages: DataFrame, by: str, own: str, page: str, counted: Column) -> DataFrame:
    """A row for each `own` of a key: `by`, own, pages, and of its counted pages the different hashes, the perceptual hashes with their numbers, and the most frequent numbers.

    Numbers are written behind a 1, so that they fit a long with their zeros. Groups of `own` alone are enough, so pages that come dealt by it stay.
    """
    none = F.lit(None)
    kind = pages.schema["page_hash"].dataType
    entry = lambda k, h, n, at: F.struct(F.lit(k).alias("kind"), h.cast(kind).alias("hash"), n.cast("long").alias("n"), at.cast("long").alias("at"))
    numbers = F.coalesce(F.regexp_extract_all("text", F.lit(r"\b(\d{6,16})\b"), F.lit(1)), F.array().cast("array<string>"))
    first = F.shiftleft(F.col(page).cast("long"), 32)
    signs = F.concat(F.array(entry(1, none, F.col("phash"), none)), F.transform(numbers, lambda t, i: entry(2, none, F.concat(F.lit("1"), t), first + i)))
    entries = F.concat(F.array(entry(0, F.when(counted, F.col("page_hash")), none, none)), F.when(counted, signs).otherwise(F.array_repeat(signs[0], 0)))
    e = pages.select(by, own, F.inline(entries)).groupBy(by, own, "kind", "hash", "n").agg(F.count("*").alias("times"), F.min("at").alias("at"))
    of = lambda k, c: F.collect_list(F.when((F.col("kind") == k) & F.col("n").isNotNull(), c))
    top = F.slice(F.array_sort(of(2, F.struct((-F.col("times")).alias("times"), "at", "n"))), 1, TOP_TOKENS)
    return e.groupBy(by, own).agg(
        F.sum(F.when(F.col("kind") == 0, F.col("times"))).alias("pages"), F.collect_list("hash").alias("hashes"), of(1, F.struct("n", "times")).alias("phashes"), F.transform(top, lambda x: x["n"]).alias("numbers")
    )


def met(files: DataFrame, docs: DataFrame, by: str) -> DataFrame:
    """`by`, file_id, doc, hits, pages, doc_pages and tokens of every file and document of a key, from their profiles."""
    theirs = docs.select(by, "doc", F.col("pages").alias("doc_pages"), F.col("hashes").alias("d_hashes"), F.transform("phashes", lambda x: x["n"]).alias("d_phashes"), F.col("numbers").alias("d_numbers"))
    close = lambda x: F.exists("d_phashes", lambda y: F.bit_count(x["n"].bitwiseXOR(y)) <= PHASH_DISTANCE)
    near = F.aggregate("phashes", F.lit(0).cast("long"), lambda n, x: n + F.when(close(x), x["times"]).otherwise(F.lit(0).cast("long")))
    both = lambda a, b: F.size(F.array_intersect(a, b)).cast("long")
    p = files.join(theirs.hint("merge"), by)
    return p.select(by, "file_id", "doc", both("hashes", "d_hashes").alias("hash_hits"), near.alias("phash_hits"), both("numbers", "d_numbers").alias("token_hits"), "pages", "doc_pages", F.size("numbers").alias("tokens"))


def _crowded(incoming: DataFrame, archive: DataFrame, files: DataFrame, docs: DataFrame, by: str) -> DataFrame:
    """What `met` has, without those that share nothing and are not nearest by pages."""
    counts = files.select(by, "file_id", "pages", F.size("numbers").alias("tokens")), docs.select(by, "doc", F.col("pages").alias("doc_pages"))
    near = nearest(*counts, by).select(by, "file_id", "doc", *[F.lit(0).cast("long").alias(c) for c in _HITS])
    pairs = signals(incoming, archive, by).union(near).groupBy(by, "file_id", "doc").agg(*[F.sum(c).alias(c) for c in _HITS])
    return pairs.join(counts[0], [by, "file_id"]).join(counts[1], [by, "doc"]).select(by, "file_id", "doc", *_HITS, "pages", "doc_pages", "tokens")


def kept_documents(incoming: DataFrame, archive: DataFrame, by: str = "awb", crowded: int = CROWDED) -> DataFrame:
    """file_id, doc, hash_hits, phash_hits, token_hits, score and top (one of the best three) of the documents that each file is compared with.

    incoming: `by`, file_id, page_no, exempt, page_hash, phash, text; archive: `by`, doc, doc_page, page_hash, phash, text. Exempt pages count as
    pages only. Missing hashes and texts give no signal, ties go by doc, a page that stands twice counts twice. Files without any archived
    document have no row. A file has one key.
    """
    keep = keeper(incoming.sparkSession, "prefilter")
    counts = ~F.coalesce("exempt", F.lit(False))
    files = keep(profiles(incoming, by, "file_id", "page_no", counts), "files")
    docs = keep(profiles(archive, by, "doc", "doc_page", F.lit(True)), "documents")
    size = lambda df, n: df.groupBy(by).agg(F.sum("pages").alias(n))
    mine, theirs = F.col("mine").cast("double"), F.col("theirs")
    many = keep(size(files, "mine").join(size(docs, "theirs"), by).where(mine * theirs > crowded * (mine + theirs)).select(by), "crowded")

    def kept(pairs):
        share = F.col("token_hits") / F.greatest("tokens", F.lit(1))
        p = prefilter(pairs.withColumns({"token_share": share, "page_gap": F.col("pages") - F.col("doc_pages")}), *_HITS, by=by)
        return p.where("kept").select("file_id", "doc", *_HITS, "score", (F.col("rank") <= TOP_DOCS).alias("top"))

    if many.isEmpty():
        return kept(met(files, docs, by))
    of = lambda df, how: df.join(many, by, how)
    rest = kept(met(of(files, "left_anti"), of(docs, "left_anti"), by))
    return rest.union(kept(_crowded(*[of(df, "left_semi") for df in (incoming.where(counts), archive, files, docs)], by)))
