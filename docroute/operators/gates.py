"""Gates before expensive comparisons, choice between sources of text, and what becomes of a file's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.functions import extract as X

ANCHOR_PAGES, WINDOW_PAGES, SCAN_PAGES = 3, 5, 10


def window_pairs(incoming: DataFrame, archive: DataFrame, by: str) -> DataFrame:
    """Pairs of pages that decide whether scanned text is compared at all: a file's first three pages against a document's first five.

    incoming: `by`, file_id, page_no, skip (already matched, or exempt); archive: `by`, doc, doc_page. The pages are cut down before
    the join, so a key brings 15 pairs for a file and document at most. first: page 1 against page 1, which is looked at before.
    """
    i = incoming.where((F.col("page_no") <= ANCHOR_PAGES) & ~F.col("skip"))
    return i.join(archive.where(F.col("doc_page") <= WINDOW_PAGES), by).withColumn("first", (F.col("page_no") == 1) & (F.col("doc_page") == 1))


def scan_gate(files: DataFrame) -> DataFrame:
    """Add run_scan, and scan_pages (null: all), to files of methods (array of those that matched), token_signal, scan_needed, window_hit, focused and dup_pages.

    The window is looked at if a scan is needed or nothing else gave a signal; without its hit, duplicates that
    concentrate on one document still lead to a scan. Files with no other signal are scanned whole.
    """
    cold = (F.size(F.array_intersect("methods", F.array(*map(F.lit, ("HASH", "PHASH", "TEXT"))))) == 0) & ~F.col("token_signal")
    run = (F.col("scan_needed") | cold) & (F.col("window_hit") | (F.col("focused") & (F.col("dup_pages") > 0)))
    return files.withColumns({"run_scan": run, "scan_pages": F.when(run & ~cold, F.lit(SCAN_PAGES))})


def better_text(raw: Column, ordered: Column, n_raw: Column, n_ordered: Column) -> Column:
    """The words in reading order if they show more candidates than the text layer does; layers of 20 characters or less stay."""
    return F.when((F.length(F.trim(raw)) > 20) & (n_ordered > n_raw), ordered).otherwise(raw)


def unique_candidates(candidates: Column) -> Column:
    """How many different twelve-digit candidates an array holds; null: none."""
    return F.size(F.array_distinct(F.filter(F.coalesce(candidates, F.array().cast("array<string>")), lambda c: c.rlike(r"^\d{12}$"))))


def probe_exit(digit_text: Column, general_text: Column, known_high: Column) -> Column:
    """awb and method where the probes' texts decide at once: a number behind 400, or one known key of the high tier (array)."""
    tight = F.coalesce(X.tight_400(digit_text), X.tight_400(general_text))
    exact = F.when(F.size(F.array_distinct(known_high)) == 1, F.get(known_high, 0))
    verdict = lambda awb, method: F.struct(awb.alias("awb"), F.lit(method).alias("method"))
    return F.when(tight.isNotNull(), verdict(tight, "Probe-400")).when(exact.isNotNull(), verdict(exact, "Probe-Exact-High"))


def page_outputs(pages: DataFrame, routes: DataFrame) -> DataFrame:
    """file_id, page_no, output, out_page: where each page goes. pages: file_id, page_no, dup; routes: file_id, route.

    Clean files go whole to `clean`, rejected ones to `rejected`; of a partly clean file the duplicates go to a rejected file
    and the others to a clean one, either in page order.
    """
    from pyspark.sql import Window

    route = F.col("route")
    part = F.when(F.col("dup"), "rejected").otherwise("clean")
    out = pages.join(routes.select("file_id", "route"), "file_id").withColumn("output", F.when(route == "REJECTED", "rejected").when(route == "PARTIAL-CLEAN", part).otherwise("clean"))
    w = Window.partitionBy("file_id", "output").orderBy("page_no")
    return out.select("file_id", "page_no", "output", F.row_number().over(w).alias("out_page"))


def exists_in_archive(status: Column, documents: Column, cached: Column) -> tuple[Column, Column]:
    """(exists, to_cache) of a look-up by its HTTP status and number of documents: true, false, or null for not known.

    What the cache knows is taken from it; 404 and answers are kept, failures and expired tokens are not.
    """
    fresh = F.when(status == 404, F.lit(False)).when(status == 200, documents > 0)
    return F.coalesce(cached, fresh), cached.isNull() & fresh.isNotNull()
