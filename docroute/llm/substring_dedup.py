"""Removal of repeated passages: paragraph MinHash banding, exact verification, components.

Paragraphs are lines of MIN_WORDS words or more. Bands are tuned for RECALL at the wanted similarity; paragraphs that
collide in a band are verified by exact Jaccard similarity on whole texts (near.py), and of each component the first paragraph
stays.

A passage inside longer paragraphs is no near copy of either, so windows of PASSAGE words over whole texts (newlines are
white space, so lines of any length count) are banded as well: the band of a window is the least hash of its runs of GRAM
words, a minimum that is alike in every copy, so that equal windows always collide. The windows of a band that stand
together are a stretch; equal stretches are one class, and only where a band has several classes are their windows compared,
one stretch of each class. Stretches and windows are the same if all their words are (128 bits: band and hash of the
words); windows overlap, so what is found reaches to a passage's exact ends. A word goes if a window with it stands in an
earlier document, so the first copy of each passage stays. A document of PASSAGE words or more whose text stands in an
earlier one goes as a whole.

"First" is by doc_id, hash of the text, and line; rows of the same doc_id and text are one document and are cut
alike. Null and empty texts lose nothing. Other columns are not read. Shared runs of fewer than PASSAGE words that are no
paragraph of their own stay.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import SIMILARITY, Scratch, as_bytes, fixed, hash_words, minhashes, permutations, shingles_of, text_hash, with_texts, word_hashes
from docroute.llm.near import class_keys, in_buckets, near_classes

MIN_WORDS = 20
#: Words of the shortest passage that goes wherever it stands, and of the runs that bring its copies together.
PASSAGE, GRAM = 50, 8
#: One window in so many is looked up first.
PROBE = 8
RECALL = 0.997
ROWS = 2
SEED = 7
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def bands_for(recall: float, similarity: float, rows: int = ROWS) -> int:
    """The fewest bands of `rows` minima that reach the recall at this similarity."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


def least_grams(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """List, first word and least hash of GRAM words of every window of PASSAGE words of lists of hashed words."""
    n = np.maximum(counts - PASSAGE + 1, 0)
    owner = np.repeat(np.arange(len(counts)), n)
    start = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    grams, of = shingles_of(h, counts, GRAM)
    wide, width = PASSAGE - GRAM + 1, 1
    if not len(owner):
        return owner, start, grams[:0]
    while 2 * width <= wide:
        grams = np.minimum(grams[:-width], grams[width:])
        width *= 2
    if width < wide:
        grams = np.minimum(grams[: width - wide], grams[wide - width :])
    return owner, start, grams[(np.cumsum(of) - of)[owner] + start]


UNIT = "type int, doc_id long, th long, line int, key binary, sig binary, mark long, first long, n int, kind long"
_KINDS = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
TEXT, PARAGRAPH, STRETCH = range(3)


def units(documents: DataFrame, bands: int, rows: int = ROWS) -> DataFrame:
    """Of every text, in one reading: itself (key), its paragraphs (line, key, sig) and its stretches of windows.

    A stretch has its band (mark), first word, number of windows, a hash of its words (kind), and the line it is in, or -1.
    Texts of fewer than PASSAGE words have no row of their own and no stretches.
    """
    names = [c.split()[0] for c in UNIT.split(", ")]

    def record(b, type_, at, **columns):
        at, none = pa.array(at), [None] * len(at)
        columns |= {"type": [type_] * len(at), "doc_id": b.column("doc_id").take(at), "th": b.column("th").take(at)}
        return pa.record_batch([c if isinstance(c := columns.get(x, none), pa.Array) else pa.array(c, k) for x, k in zip(names, _KINDS, strict=True)], names)

    def run(batches):
        memo, odd = word_hashes(), permutations(bands * rows, SEED)
        for b in batches:
            texts = b.column("text").to_pylist()
            lines = [[x.split() for x in t.split(b"\n")] for t in texts]
            many = np.fromiter(map(len, lines), np.int64, len(lines))
            n = np.fromiter((len(x) for t in lines for x in t), np.int64, int(many.sum()))
            h = np.fromiter((memo[w] for t in lines for x in t for w in x), np.uint64, int(n.sum()))
            owner = np.repeat(np.arange(len(texts)), many)
            line = np.arange(len(n)) - np.repeat(np.cumsum(many) - many, many)
            wide = np.flatnonzero(n >= MIN_WORDS)
            if len(wide):
                s, of = shingles_of(h[np.repeat(n >= MIN_WORDS, n)], n[wide])
                yield record(b, PARAGRAPH, owner[wide], line=line[wide].astype(np.int32), key=class_keys(s, of)[0], sig=fixed(minhashes(s, of, odd)))
            counts = np.bincount(owner, n, len(texts)).astype(np.int64)
            long = np.flatnonzero(counts >= PASSAGE)
            if not len(long):
                continue
            yield record(b, TEXT, long, key=[xxhash.xxh3_128_digest(texts[k]) for k in long.tolist()])
            text, start, mark = least_grams(h, counts)
            first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (mark[1:] != mark[:-1])]))
            last = np.append(first[1:], len(text)) - 1
            at, raw = (np.cumsum(counts) - counts)[text[first]] + start[first], h.tobytes()
            end = at + (last - first) + PASSAGE
            of_word = np.repeat(line, n)
            kind = [xxhash.xxh3_64_intdigest(raw[8 * x : 8 * y]) for x, y in zip(at.tolist(), end.tolist(), strict=True)]
            inside = np.where(of_word[at] == of_word[end - 1], of_word[at], -1)
            yield record(
                b, STRETCH, text[first], line=inside.astype(np.int32), mark=mark[first].view(np.int64), first=start[first], n=(last - first + 1).astype(np.int32),
                kind=np.array(kind, np.uint64).view(np.int64),
            )

    d = documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), as_bytes().alias("text"))
    return d.mapInArrow(run, UNIT)


WINDOWS = "doc_id long, th long, mark long, origin long, piece long, windows array<bigint>"

WINDOW_COLUMNS = ["doc_id", "th", "mark", "origin", "piece", "windows"]


def _windows(batches):
    """Hashes of the windows of wanted stretches, in pieces of at most PASSAGE windows: the first one's place, and all hashes in a row."""
    memo = word_hashes()
    for b in batches:
        rows, marks, origins, starts, sizes, hashes = [], [], [], [], [], []
        for k, (text, places) in enumerate(zip(b.column("text").to_pylist(), b.column("places").to_pylist(), strict=True)):
            own = shingles_of(*hash_words([text.split()], memo), PASSAGE)[0]
            for p in places:
                for at in range(p["first"], p["first"] + p["n"], PASSAGE):
                    size = min(PASSAGE, p["first"] + p["n"] - at)
                    rows.append(k), marks.append(p["mark"]), origins.append(p["first"]), starts.append(at), sizes.append(size), hashes.append(own[at : at + size])
        if rows:
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(np.concatenate(hashes).view(np.int64)))
            row = pa.array(rows)
            yield pa.record_batch([b.column("doc_id").take(row), b.column("th").take(row), pa.array(marks, pa.int64()), pa.array(origins, pa.int64()), pa.array(starts, pa.int64()), lists], WINDOW_COLUMNS)


def repeated_windows(work: Scratch, seen: DataFrame) -> DataFrame:
    """doc_id, th, mark, origin (their stretch's first word), first and words of the windows that stand in an earlier document; `seen` are pieces.

    Two windows of a piece overlap or touch, so all words between two that repeat go. Every PROBE-th window and the last one of a
    piece are looked up first; what lies between those that repeat needs no look-up of its own. All others get one.
    """
    doc, i = F.struct("doc_id", "th"), F.col("i")
    single = lambda rows: rows.select("doc_id", "th", "mark", "origin", "piece", *rows.columns[6:], F.size("windows").alias("size"), F.posexplode("windows").alias("i", "window"))
    probe = (i % PROBE == 0) | (i == F.col("size") - 1)
    heads = single(seen).groupBy("mark", "window").agg(F.min(doc).alias("head"), F.max(doc).alias("z")).where(~F.col("head").eqNullSafe(F.col("z")))
    heads = work.table(heads.select("mark", "window", "head"), "heads")
    later = lambda rows: rows.join(heads, ["mark", "window"]).where(doc > F.col("head"))
    met = later(single(seen).where(probe)).groupBy("doc_id", "th", "mark", "origin", "piece").agg(F.min("i").alias("low"), F.max("i").alias("high"))
    met = work.table(met, "met")
    ends = met.select(F.col("doc_id").alias("doc_"), F.col("th").alias("th_"), F.col("piece").alias("piece_"), "low", "high")
    known = seen.join(ends, (F.col("th") == F.col("th_")) & (F.col("piece") == F.col("piece_")) & F.col("doc_id").eqNullSafe(F.col("doc_")), "left")
    known = known.select(*WINDOW_COLUMNS, "low", "high")
    rest = later(single(known).where(~probe & (F.col("low").isNull() | (i < F.col("low")) | (i > F.col("high")))))
    spans = met.select("doc_id", "th", "mark", "origin", (F.col("piece") + F.col("low")).alias("first"), (F.col("high") - F.col("low") + PASSAGE).alias("words"))
    out = work.table(spans.union(rest.select("doc_id", "th", "mark", "origin", F.col("piece") + i, F.lit(PASSAGE))), "parts")
    work.drop(heads, met)
    return out


def shared_passages(work: Scratch, documents: DataFrame, found: DataFrame, gone: DataFrame, copies: DataFrame) -> DataFrame:
    """doc_id, th, first and words of what stood in an earlier document. `found` are stretches; lines of `gone` and texts of `copies` go anyway."""
    row, doc = F.xxhash64("doc_id", "th"), F.struct("doc_id", "th")
    several = lambda rows: rows.groupBy("mark").agg(F.min(row).alias("a"), F.max(row).alias("z")).where("a <> z").select("mark")
    # Bands of several documents first, so that only these meet the lines and texts that go; then once more without those.
    again = work.table(several(found), "again")
    line = gone.select(F.col("doc_id").alias("doc_"), F.col("th").alias("th_"), F.col("line").alias("line_"))
    whole = copies.select(F.col("doc_id").alias("doc_"), F.col("th").alias("th_"))
    same = (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("doc_"))
    left = found.join(again, "mark").join(whole, same, "left_anti").join(line, same & (F.col("line") == F.col("line_")), "left_anti")
    left = work.table(left.select("doc_id", "th", "mark", "first", "n", "kind"), "left")
    kinds = left.groupBy("mark", "kind", "n").agg(F.min(F.struct("doc_id", "th", "first")).alias("least"), F.count("*").alias("copies"))
    kinds = work.table(kinds, "kinds")
    # Copies of whole stretches: those in later documents go, those in the first one's own document share what befalls it.
    head = kinds.where("copies > 1").select(F.col("mark").alias("mark_"), F.col("kind").alias("kind_"), F.col("n").alias("n_"), F.struct("least.doc_id", "least.th").alias("head"), F.col("least.first").alias("origin"))
    members = left.join(head, (F.col("mark") == F.col("mark_")) & (F.col("kind") == F.col("kind_")) & (F.col("n") == F.col("n_")))
    members = members.where((doc > F.col("head")) | (doc.eqNullSafe(F.col("head")) & (F.col("first") > F.col("origin"))))
    members = work.table(members.select("doc_id", "th", "mark", "first", "n", "origin", (doc > F.col("head")).alias("later")), "members")
    later = members.where("later").select("doc_id", "th", "first", (F.col("n") + PASSAGE - 1).alias("words"))
    twins = members.where("not later").select(F.col("doc_id").alias("doc_"), F.col("th").alias("th_"), F.col("mark").alias("mark_"), F.col("origin").alias("origin_"), F.col("first").alias("twin")).distinct()
    # Stretches that differ but may share windows: one of each class.
    mixed = work.table(kinds.groupBy("mark").agg(F.count("*").alias("classes")).where("classes > 1").select("mark"), "mixed")
    places = kinds.join(mixed, "mark").groupBy(F.col("least.doc_id").alias("doc_"), F.col("least.th").alias("th_")).agg(F.collect_list(F.struct("mark", "least.first", "n")).alias("places"))
    places = work.table(places, "places")
    seen = work.table(with_texts(documents, places.where("th_ is not null"), WINDOWS, _windows), "windows")
    parts = repeated_windows(work, seen)
    own = parts.join(twins, same & (F.col("mark") == F.col("mark_")) & (F.col("origin") == F.col("origin_")))
    own = own.select("doc_id", "th", F.col("first") - F.col("origin") + F.col("twin"), "words")
    out = work.table(later.union(parts.select("doc_id", "th", "first", "words")).union(own), "passages")
    work.drop(again, left, kinds, members, mixed, places, seen, parts)
    return out


def _lines(batches):
    """The texts of wanted lines."""
    for b in batches:
        rows = []
        for text, places in zip(b.column("text").to_pylist(), b.column("places").to_pylist(), strict=True):
            lines = text.split(b"\n")
            rows += [(p["key"], p["component"], p["size"], p["copies"], lines[p["line"]]) for p in places]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["key", "component", "size", "copies", "text"])


def repeated(work: Scratch, documents: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """doc_, th_ and places that stood before: whole lines (line) or words (first, words); and the documents whose whole text did."""
    bands = bands_for(recall, similarity)
    every = work.table(units(documents, bands), "units")
    found = every.where(F.col("type") == PARAGRAPH).select("doc_id", "th", "line", "key", "sig")
    texts = every.where(F.col("type") == TEXT).select("doc_id", "th", "key")
    head = texts.groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    copies = texts.join(work.table(head, "heads"), "key").where(F.struct("doc_id", "th") > F.col("head")).select("doc_id", "th").distinct()
    copies = work.table(copies, "copies")
    place = F.struct("doc_id", "th", "line")
    classes = found.groupBy("key").agg(F.min(F.struct("doc_id", "th", "line", "sig")).alias("r"), F.count("*").alias("copies"))
    classes = work.table(classes.select("key", F.struct("r.doc_id", "r.th", "r.line").alias("rep"), "r.sig", "copies"), "classes")
    buckets = [F.xxhash64(F.lit(k), F.substring("sig", 4 * ROWS * k + 1, 4 * ROWS)) for k in range(bands)]

    def fetch(members: DataFrame) -> DataFrame:
        wanted = F.struct(F.col("rep.line").alias("line"), "key", "component", "size", "copies")
        m = members.groupBy(F.col("rep.doc_id").alias("doc_"), F.col("rep.th").alias("th_")).agg(F.collect_list(wanted).alias("places"))
        return with_texts(documents, work.table(m, "wanted").where("th_ is not null"), "key binary, component binary, size long, copies long, text binary", _lines)

    near = work.table(near_classes(work, classes, in_buckets(classes, buckets), bands * ROWS, fetch, similarity, 4.0), "near")
    linked = work.table(classes.select("key", "rep", "copies").join(near.where("links > 0"), "key"), "linked")
    first = work.table(linked.groupBy("component").agg(F.min("rep").alias("first")), "first")
    linked = linked.join(first, "component").select("key", "first")
    copied = classes.where("copies > 1").join(near, "key", "left_anti").select("key", F.col("rep").alias("first"))
    groups = work.table(linked.union(copied), "groups")
    gone = found.select("doc_id", "th", "line", "key").join(groups.where("first is not null"), "key").where(~place.eqNullSafe(F.col("first")))
    gone = work.table(gone.select("doc_id", "th", "line"), "gone")
    work.drop(classes)
    stretches = every.where(F.col("type") == STRETCH).select("doc_id", "th", "line", "mark", "first", "n", "kind")
    passages = shared_passages(work, documents, stretches, gone, copies)
    work.drop(every)
    places = gone.unionByName(passages, allowMissingColumns=True).groupBy(F.col("doc_id").alias("doc_"), F.col("th").alias("th_"))
    places = places.agg(F.collect_set(F.struct("line", "first", "words")).alias("places"))
    whole = copies.withColumnsRenamed({"doc_id": "c_doc", "th": "c_th"})
    places = places.join(whole, (F.col("th_") == F.col("c_th")) & F.col("doc_").eqNullSafe(F.col("c_doc")), "left_anti")
    return work.table(places, "places"), copies


def cut(text: bytes, whole: set[int], passages: tuple[tuple[int, int], ...] = ()) -> tuple[bytes, int, int]:
    """The text without repeated paragraphs (whole lines) and passages (first word, words), and how many of either are gone."""
    lines = text.split(b"\n")
    every = [np.full(len(line.split()), i in whole) for i, line in enumerate(lines)]
    gone = np.concatenate(every)
    if passages:
        first, words = (np.array(x, np.int64) for x in zip(*passages, strict=True))
        edges = np.bincount(first, minlength=len(gone) + 1) - np.bincount(first + words, minlength=len(gone) + 1)
        gone |= np.cumsum(edges)[:-1] > 0
    kept, runs, inside, base = [], 0, False, 0
    for i, line in enumerate(lines):
        own = gone[base : base + len(every[i])]
        base += len(every[i])
        if i in whole:
            inside = False
            continue
        if len(own):
            runs += int(own[0] and not inside) + int((own[1:] & ~own[:-1]).sum())
            inside = bool(own[-1])
        if not own.any():
            kept.append(line)
            continue
        spans = [m.span() for m in _WORD.finditer(line)]
        out, done = [], 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
        for a, z in zip(edges[::2], edges[1::2], strict=True):
            out.append(line[done : spans[a][0]])
            done = spans[z - 1][1]
        left = b"".join([*out, line[done:]])
        if left.strip():
            kept.append(left)
    return b"\n".join(kept), len(whole), runs


def _cut(batches):
    for b in batches:
        out = []
        for doc, th, text, places in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "text", "places")), strict=True):
            passages = tuple((p["first"], p["words"]) for p in places if p["first"] is not None)
            kept, lines, runs = cut(text, {p["line"] for p in places if p["first"] is None}, passages)
            out.append((doc, th, lines, runs, len(text) - len(kept), hashlib.sha256(kept).hexdigest(), kept.decode()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = zip(*out, strict=True) if out else [[]] * 7
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "th", "paragraphs_removed", "passages_removed", "bytes_removed", "kept_sha256", "kept"])


def substring_dedup(documents: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, th, paragraphs_removed, passages_removed, bytes_removed, kept_sha256 and kept of documents with repeats."""
    work = Scratch(documents.sparkSession, "substrings")
    places, copies = repeated(work, documents, similarity, recall)
    schema = "doc_id long, th long, paragraphs_removed long, passages_removed long, bytes_removed long, kept_sha256 string, kept string"
    out = with_texts(documents, places.where("th_ is not null"), schema, _cut).where("bytes_removed > 0")
    # Of a whole copy nothing is left, so its text need not travel.
    d = documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), F.octet_length("text").cast("long").alias("bytes"))
    whole = d.join(copies.withColumnsRenamed({"doc_id": "doc_", "th": "th_"}), (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("doc_")))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return out.union(whole.select("doc_id", "th", zero, one, "bytes", F.sha2(F.lit(""), 256), F.lit("")))


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents with their repeated passages cut; those of which no word is left are dropped."""
    work = Scratch(documents.sparkSession, "substrings-out")
    cut_ = substring_dedup(documents).select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th"), F.col("kept").alias("__kept")).dropDuplicates(["__doc", "__th"])
    cut_ = work.table(cut_, "cut")
    # The row travels as one struct, so that no column of it can clash with another.
    d = documents.select(F.struct(*documents.columns).alias("__row"), text_hash().alias("__own"), F.col("doc_id").cast("long").alias("__id"))
    out = d.join(cut_.hint("merge"), (F.col("__own") == F.col("__th")) & F.col("__id").eqNullSafe(F.col("__doc")), "left")
    out = out.where(F.col("__kept").isNull() | F.col("__kept").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("__kept"), "n_chars": F.length("__kept").cast("long")}
    pick = lambda c: F.when(F.col("__kept").isNull(), F.col("__row")[c]).otherwise(new[c]) if c in new else F.col("__row")[c]
    return out.select(*[pick(c).alias(c) for c in documents.columns])


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Scratch(spark, "substrings-out")
    gone = substring_dedup(documents).drop("kept").withColumnsRenamed({"doc_id": "doc_", "th": "th_"}).dropDuplicates(["doc_", "th_"])
    gone = work.table(gone, "gone")
    text = F.coalesce("text", F.lit(""))
    every = documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    out = every.join(gone, (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("doc_")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("doc_id", "n_bytes", zero("paragraphs_removed"), zero("passages_removed"), zero("bytes_removed"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
