"""The duplicate check from pages to claims: hashes, then texts, then scanned texts behind their gates.

Texts are compared only where it can matter: for pages that no hash has claimed, with documents that are still in question, and for
pairs whose bounds reach the threshold. A page's signature is made once; bounds on pairs of signatures are plain expressions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroute.functions.similarity import text_similarity
from docroute.operators.gates import scan_gate, window_pairs
from docroute.operators.matching import TEXT_SIMILARITY, TIERS
from docroute.operators.routing import FOCUS_PAGES, PHASH_DISTANCE

#: Classes that code points fall into when they are counted; fewer classes make the bounds looser, never wrong.
CLASSES = 64
_INTS = T.ArrayType(T.IntegerType())
_SIGNATURE = T.StructType().add("n", T.IntegerType()).add("counts", _INTS).add("n_words", T.IntegerType()).add("word_counts", _INTS).add("words", T.ArrayType(T.LongType()))


def _counts(text: str) -> list[int]:
    return np.bincount(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) % CLASSES, minlength=CLASSES).tolist()


def signature_of(text: str | None) -> tuple[int, list[int], int, list[int], list[int]]:
    """Length without spare white space and counts of characters, the same for the text of its different words, and these words' hashes."""
    words = (text or "").split()
    own = sorted(set(words))
    plain, once = " ".join(words), " ".join(own)
    # White space counts as spaces, all of it, so that no order of the words has more of a class.
    loose = _counts("".join(" " if c.isspace() else c for c in text or ""))
    return len(plain), loose, len(once), _counts(once), [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in own]


@F.pandas_udf(_SIGNATURE)
def signature(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = _SIGNATURE.fieldNames()
    for t in texts:
        known = {x: signature_of(x) for x in set(t)}
        yield pd.DataFrame([known[x] for x in t], columns=names)


def _bound(a: Column, b: Column, n: str, counts: str) -> Column:
    """No stretch of a text, and no order of its words, has a higher ratio than 200 c / (n + c): c characters in common, n the shorter length."""
    zero = F.lit(0)
    c = F.aggregate(F.zip_with(a[counts], b[counts], lambda x, y: F.least(x, y)), zero, lambda x, y: x + y)
    return F.coalesce(F.try_divide(200.0 * c, F.least(a[n], b[n]) + c), F.lit(0.0))


def may_reach(a: Column, b: Column, score: float = TEXT_SIMILARITY) -> Column:
    """Whether two texts may have this similarity, by their signatures. Texts with a word in common may always."""
    return F.arrays_overlap(a["words"], b["words"]) | (_bound(a, b, "n", "counts") >= score) | (_bound(a, b, "n_words", "word_counts") >= score)


def alike(pairs: DataFrame, a: str, b: str, score: float = TEXT_SIMILARITY) -> DataFrame:
    """The pairs whose texts in columns a and b reach the score, with `score`. Signatures are in sig_<column>."""
    close = pairs.where(may_reach(F.col(f"sig_{a}"), F.col(f"sig_{b}"), score))
    return close.withColumn("score", text_similarity(a, b)).where(F.col("score") >= score)


CLAIMS = "file_id long, page_no int, method string, doc long, doc_page int, score double, needed boolean, focus long"


def claims(rows: DataFrame, focus_pages: int = FOCUS_PAGES) -> DataFrame:
    """Each page goes to its first match by tier, page, document and its page; and a row without page for each file: what is needed, and the focus.

    rows: file_id, page_no, doc, doc_page, tier, score; without score, a text to compare was missing. Once a document has `focus_pages` pages of
    a file, others are not looked at. A file's rows come in order from sorted partitions and are read as a stream.
    """
    names, kinds = [c.split()[0] for c in CLAIMS.split(", ")], (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.bool_(), pa.int64())

    def batch(out):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def fold(batches):
        last, claimed, counts, focus, needed = None, set(), {}, None, False
        for b in batches:
            out = []
            for file, page, doc, doc_page, tier, score in zip(*(b.column(c).to_pylist() for c in _MATCH), strict=True):
                if file != last:
                    if last is not None:
                        out.append((last, None, None, None, None, None, needed, focus))
                    last, claimed, counts, focus, needed = file, set(), {}, None, False
                if focus is not None and doc != focus:
                    continue
                if score is None:
                    needed = True
                elif page not in claimed:
                    claimed.add(page)
                    counts[doc] = counts.get(doc, 0) + 1
                    focus = doc if counts[doc] >= focus_pages else focus
                    out.append((file, page, TIERS[tier - 1], doc, doc_page, score, None, None))
            if out:
                yield batch(out)
        if last is not None:
            yield batch([(last, None, None, None, None, None, needed, focus)])

    rows = rows.select(*[F.col(c).cast(k).alias(c) for c, k in _MATCH.items()])
    return rows.repartition("file_id").sortWithinPartitions("file_id", "tier", "page_no", "doc", "doc_page").mapInArrow(fold, CLAIMS)


_MATCH = {"file_id": "long", "page_no": "int", "doc": "long", "doc_page": "int", "tier": "int", "score": "double"}


def _left(incoming: DataFrame, claimed: DataFrame) -> DataFrame:
    """Pages that nothing has claimed, with their file's focus."""
    done = claimed.where("page_no is not null").select("file_id", "page_no")
    focus = claimed.where("page_no is null").select("file_id", "focus")
    return incoming.join(done, ["file_id", "page_no"], "left_anti").join(focus, "file_id", "left")


def check(incoming: DataFrame, archive: DataFrame, files: DataFrame, keep, text_at: float = TEXT_SIMILARITY) -> DataFrame:
    """file_id, page_no, method, doc, doc_page and score of every page that repeats an archived one.

    incoming: awb, file_id, page_no, exempt, page_hash, phash, text, ocr; archive: awb, doc, doc_page and the same last four; files: file_id
    and token_signal. keep(df, name) writes a table and reads it again: pages with signatures and each tier's claims are used several times.
    """
    empty = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    best = lambda df: df.withColumn("any", F.when(empty(F.col("text")), F.coalesce("ocr", F.lit(""))).otherwise(F.col("text")))
    either = lambda own: F.when(empty(F.col("text")), F.col(f"sig_{own}ocr")).otherwise(F.col(f"sig_{own}text"))
    signed = lambda df, own: df.withColumns({f"sig_{own}{c}": signature(c) for c in ("text", "ocr")}).withColumn(f"sig_{own}any", either(own))
    inc = keep(signed(best(incoming.where("not exempt")), ""), "incoming")
    arc = signed(best(archive), "d_")
    arc = keep(arc.select("awb", "doc", "doc_page", *[F.col(c).alias(f"d_{c}") for c in ("page_hash", "phash", "text", "any")], "sig_d_text", "sig_d_any"), "archive")
    place = ["file_id", "page_no", "doc", "doc_page"]

    near = F.bit_count(F.col("phash").bitwiseXOR(F.col("d_phash")))
    tier = F.when(F.col("page_hash") == F.col("d_page_hash"), 1).when(near <= PHASH_DISTANCE, 2)
    hashes = inc.select("awb", "file_id", "page_no", "page_hash", "phash").join(arc.select("awb", "doc", "doc_page", "d_page_hash", "d_phash"), "awb")
    rows = hashes.withColumn("tier", tier).where("tier is not null").select(*place, "tier", F.when(F.col("tier") == 1, 100.0).otherwise(near.cast("double")).alias("score"))
    rows = keep(rows, "hashes")
    first = keep(claims(rows), "claims")

    in_focus = F.col("focus").isNull() | (F.col("doc") == F.col("focus"))
    pairs = _left(inc.select("awb", "file_id", "page_no", "text", "sig_text"), first).join(arc.select("awb", "doc", "doc_page", "d_text", "sig_d_text"), "awb").where(in_focus)
    missing = empty(F.col("text")) | empty(F.col("d_text"))
    matched = keep(alike(pairs.where(~missing), "text", "d_text", text_at).select(*place, F.lit(3).alias("tier"), "score"), "texts")
    # A document's pages are looked at up to the first match; a missing text behind it is not noticed.
    blank = pairs.where(missing).groupBy(*place[:3]).agg(F.min("doc_page").alias("doc_page"))
    until = matched.groupBy(*place[:3]).agg(F.min("doc_page").alias("until"))
    blank = blank.join(until, place[:3], "left").where(F.col("until").isNull() | (F.col("doc_page") < F.col("until")))
    rows = keep(rows.union(matched).union(blank.select(*place, F.lit(3), F.lit(None).cast("double"))), "rows")
    second = keep(claims(rows), "claims")

    found = second.where("page_no is not null").groupBy("file_id").agg(F.collect_set("method").alias("methods"), F.count("*").alias("dup_pages"))
    state = second.where("page_no is null").select("file_id", F.col("needed").alias("scan_needed"), F.col("focus").isNotNull().alias("focused"))
    f = files.select("file_id", "token_signal").join(found, "file_id", "left").join(state, "file_id", "left")
    none = F.array().cast("array<string>")
    f = f.select("file_id", "token_signal", F.coalesce("methods", none).alias("methods"), F.coalesce("dup_pages", F.lit(0)).alias("dup_pages"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("scan_needed", "focused")])
    left = _left(inc.select("awb", "file_id", "page_no", "ocr", "any", "sig_ocr", "sig_any"), second).withColumn("skip", F.lit(False))
    window = window_pairs(left.select("awb", "file_id", "page_no", "ocr", "sig_ocr", "skip"), arc.select("awb", "doc", "doc_page", "d_any", "sig_d_any"), "awb")
    hits = alike(window, "ocr", "d_any", text_at).select("file_id").distinct().withColumn("window_hit", F.lit(True))
    gate = scan_gate(f.join(hits, "file_id", "left").withColumn("window_hit", F.coalesce("window_hit", F.lit(False)))).where("run_scan").select("file_id", "scan_pages")
    last = F.coalesce("scan_pages", F.lit(1 << 30))
    scans = left.join(gate, "file_id").where(F.col("page_no") <= last).join(arc.select("awb", "doc", "doc_page", "d_any", "sig_d_any"), "awb").where(in_focus & (F.col("doc_page") <= last))
    scans = alike(scans, "any", "d_any", text_at).select(*place, F.lit(4).alias("tier"), "score")
    return claims(rows.union(scans)).where("page_no is not null").select("file_id", "page_no", "method", "doc", "doc_page", F.round("score", 6).alias("score"))
