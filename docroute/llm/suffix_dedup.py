"""Removal of long repeated byte strings across all documents, by longest previous factors.

A byte is removed if it is covered by a string of `length` bytes that also starts elsewhere. Sorting all suffixes of a
corpus is out of reach, and not needed: only suffixes with equal heads matter, and these are brought together by
content. Each window of `least` bytes (`length`, or `short` where that is asked for too) belongs to the least of its k-mers'
hashes (its anchor), which is the same wherever the window stands. So a bucket of one anchor holds whole runs of the
suffix order. In a bucket the suffixes' heads of `length` bytes are sorted byte by byte (prefix doubling), ties by place.
The longest previous factor of a suffix, cut at `length`, is the longer of its common prefixes with the previous and the next
smaller place in that order. In a run of equal heads places ascend, so the previous smaller place is the left neighbour, and
only the first suffix of a run has no earlier factor of that length. `mode` "later" removes what has an earlier copy, "all"
removes every copy, the first of a run too. With `short`, runs of heads that agree in so many bytes are read from the
same order.

The windows of an anchor are one stretch of text. Equal stretches are a class, known by hash and counted before any text
moves; texts are fetched only for anchors with two classes or more. Anchors with very many classes are compared by
grouping their windows in Spark instead of in a task; there windows are the same if 128 bits are (anchor and hash).

Null texts are empty. Matches never cross documents. Rows that agree in doc_id and text are two places with equal text,
so all their long strings repeat (in "later" mode they count as one document). Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, as_bytes, group_starts, mix, text_hash, whole_groups, with_texts

LENGTH, KMER = 400, 64
#: The query also tells what repeats at this length: fifty words of four letters and a space.
SHORT = 250
#: Windows of a text that are handled at once.
AT_ONCE = 1 << 22
#: Classes of an anchor that one task compares.
CROWD = 2000
#: One window in so many of a crowded anchor's stretch is looked up first.
PROBE = 8
_BASE = 0x9E3779B97F4A7C15
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, for hashes of all substrings from one running sum."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            one = np.ones(1, np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(n - 1, _BASE, np.uint64)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([one, np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
        return self.up, self.down

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums, from 0, of letters times powers."""
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[data] * self.get(len(data) + 1)[0][: len(data)], dtype=np.uint64)])

    def hashes(self, sums: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the n bytes from each place."""
        return mix((sums[at + n] - sums[at]) * self.down[at])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each window of `width` values: suffix minima of a block meet prefix minima of the next."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors_of(data: bytes, powers: Powers, least: int = LENGTH, kmer: int = KMER, length: int | None = None) -> list[tuple[np.ndarray, ...]]:
    """(hash, first window, last window, bytes, class) of each anchor: the windows that belong to it stand together.

    A stretch's bytes reach `length` beyond its last window's start, where the text does.
    """
    out, length = [], length or least
    for start in range(0, len(data) - least + 1, AT_ONCE):
        part = data[start : start + AT_ONCE + least - 1]
        text = np.frombuffer(part, np.uint8)
        sums = powers.sums(text)
        h = powers.hashes(sums, np.arange(len(text) - kmer + 1), kmer)
        # The low bits hold the place, so that the leftmost of equal hashes is chosen.
        low = window_minima((h & ~np.uint64((1 << 23) - 1)) | np.arange(len(h), dtype=np.uint64), least - kmer + 1)
        at = (low & np.uint64((1 << 23) - 1)).astype(np.int64)
        first = group_starts(at)
        last = np.append(first[1:], len(at)) - 1
        end = np.minimum(last + start + length, len(data))
        kind = [xxhash.xxh3_64_intdigest(data[a + start : z]) for a, z in zip(first.tolist(), end.tolist(), strict=True)]
        out.append((h[at[first]], first + start, last + start, end - first - start, np.array(kind, np.uint64)))
    return out


ANCHOR = "doc_id long, th long, anchor long, first long, last long, bytes long, kind long"


def anchors(documents: DataFrame, least: int, kmer: int, length: int) -> DataFrame:
    """doc_id, th, anchor, first and last window, bytes and class of each anchor of every text."""

    def run(batches):
        powers = Powers()
        for b in batches:
            docs, ths, parts, rows = b.column("doc_id").to_pylist(), b.column("th").to_pylist(), [], []
            for k, data in enumerate(b.column("text").to_pylist()):
                for p in anchors_of(data, powers, least, kmer, length):
                    parts.append(p)
                    rows.append(np.full(len(p[0]), k))
            if not parts:
                continue
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            row = pa.array(np.concatenate(rows))
            yield pa.record_batch([pa.array(docs, pa.int64()).take(row), pa.array(ths, pa.int64()).take(row), *(pa.array(c.view(np.int64)) for c in columns)], [c.split()[0] for c in ANCHOR.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), as_bytes().alias("text"))
    return rows.where(F.octet_length("text") >= least).mapInArrow(run, ANCHOR)


STRETCH = "doc_id long, th long, anchor long, first long, last long, copies long, classes long, text binary"


def _stretches(batches):
    """The bytes of wanted stretches."""
    names = [c.split()[0] for c in STRETCH.split(", ")]
    for b in batches:
        rows = []
        for doc, th, text, places in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "text", "places")), strict=True):
            rows += [(doc, th, p["anchor"], p["first"], p["last"], p["copies"], p["classes"], text[p["first"] : p["first"] + p["bytes"]]) for p in places]
        columns = zip(*rows, strict=True) if rows else [[]] * 8
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, [pa.int64()] * 7 + [pa.binary()], strict=True)], names)


def heads(texts: list[bytes], lengths: tuple[int, ...], wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """For each length, the ranks of suffixes by their first so many bytes; equal heads, equal ranks.

    Suffixes are the places in all texts one after the other, or the `wanted` ones of these. Prefix doubling: suffixes are ranked by
    7 bytes, then by two or three times as many, as that many ranks make one number. A head of another length is two or three
    heads that overlap. An end of a text comes before any byte.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    left = np.repeat(np.cumsum(size), size) - np.arange(len(data))
    bits = np.uint64(max(len(data).bit_length(), 1))
    times = 3 if 3 * int(bits) <= 64 else 2

    def ranked(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        own = key[order]
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(np.append(True, own[1:] != own[:-1])) if len(key) else 0
        return rank

    def joined(rank: np.ndarray, steps: list[int], width: np.uint64, at: np.ndarray | None = None) -> np.ndarray:
        """The ranks so many bytes on, side by side in one number; 0 past the end."""
        key = np.zeros(len(data) if at is None else len(at), np.uint64)
        for k in steps:
            if at is None:
                own = np.zeros(len(data), np.uint64)
                own[: max(len(data) - k, 0)] = rank[k:]
                own[left <= k] = 0
            else:
                own = np.where(left[at] > k, rank[np.minimum(at + k, len(data) - 1)], np.uint64(0))
            key = (key << width) | own
        return key

    rank, done, out = ranked(joined(data.astype(np.uint64) + np.uint64(1), list(range(7)), np.uint64(9))), 7, {}
    while True:
        for n in lengths:
            if done <= n <= times * done and n not in out:
                out[n] = ranked(joined(rank, sorted({*range(0, n - done, done), n - done}), bits, wanted))
        if len(out) == len(set(lengths)):
            return [out[n] for n in lengths]
        rank, done = ranked(joined(rank, [done * k for k in range(times)], bits)), times * done


def factors(left: np.ndarray, rank: np.ndarray, length: int, mode: str) -> np.ndarray:
    """Which suffixes have a factor of `length` bytes elsewhere ("all") or at an earlier place ("later").

    Suffixes are in order of place, with the bytes they have left and their ranks by heads of `length`.
    """
    long = np.flatnonzero(left >= length)
    own = rank[long]
    order = np.argsort(own, kind="stable")
    equal = own[order][1:] == own[order][:-1]
    previous, following = np.append(False, equal)[: len(own)], np.append(equal, False)[: len(own)]
    return np.sort(long[order[previous if mode == "later" else previous | following]])


RANGE = "doc_id long, th long, start long, stop long, length int"


def _compare(lengths: tuple[int, ...], mode: str):
    """Stretches of whole anchors, in order of place, to ranges of bytes that repeat."""

    def run(batches):
        for t in whole_groups(batches, "anchor", 1000):
            texts = t.column("text").to_pylist()
            first = t.column("first").combine_chunks()
            many = t.column("last").to_numpy() - first.to_numpy() + 1
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            text = np.repeat(np.arange(len(texts)), many)
            spot = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            for n, rank in zip(lengths, heads(texts, lengths, (np.cumsum(size) - size)[text] + spot), strict=True):
                hit = factors(size[text] - spot, rank, n, mode)
                owner, at = text[hit], spot[hit]
                begins = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(owner) != 0))) if len(at) else at
                ends = np.append(begins[1:], len(at)) - 1
                row, a, b = pa.array(owner[begins]), at[begins], at[ends] if len(at) else at
                base = first.take(row).to_numpy(zero_copy_only=False)
                columns = [t.column("doc_id").combine_chunks().take(row), t.column("th").combine_chunks().take(row), pa.array(base + a), pa.array(base + b + n), pa.array(np.full(len(a), n, np.int32))]
                yield pa.record_batch(columns, ["doc_id", "th", "start", "stop", "length"])

    return run


def _crowded(work: Scratch, stretches: DataFrame, lengths: tuple[int, ...], mode: str) -> DataFrame:
    """The same for anchors of very many classes: windows grouped by Spark.

    Two windows of a stretch overlap, as all hold its anchor, so all bytes between two that repeat go. Every PROBE-th window and the last
    one of a stretch are looked up first; what lies between those that repeat needs no look-up of its own. All others get one.
    """

    def run(batches):
        powers = Powers()
        for b in batches:
            texts = b.column("text").to_pylist()
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            sums = powers.sums(np.frombuffer(b"".join(texts), np.uint8))
            first, last = (b.column(c).to_numpy(zero_copy_only=False) for c in ("first", "last"))
            for n in lengths:
                many = np.minimum(last - first + 1, size - n + 1).clip(0)
                owner = np.repeat(np.arange(len(texts)), many)
                place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                h, full = powers.hashes(sums, (np.cumsum(size) - size)[owner] + place, n), np.flatnonzero(many)
                lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(many[full])).astype(np.int32), pa.array(h.view(np.int64)))
                row = pa.array(full)
                columns = [*(b.column(c).take(row) for c in ("anchor", "doc_id", "th", "first")), pa.array(np.full(len(full), n, np.int32)), lists]
                yield pa.record_batch(columns, ["anchor", "doc_id", "th", "first", "length", "windows"])

    rows = stretches.select("anchor", "doc_id", "th", "first", "last", "text").mapInArrow(run, "anchor long, doc_id long, th long, first long, length int, windows array<bigint>")
    rows = work.table(rows, "windows")
    i, own = F.col("i"), ["doc_id", "th", "first", "length"]
    place = F.struct("doc_id", "th", (F.col("first") + i).alias("start"))
    single = lambda rows: rows.select("anchor", *own, *rows.columns[6:], F.size("windows").alias("size"), F.posexplode("windows").alias("i", "h"))
    seen = single(rows).groupBy("anchor", "h", "length").agg(F.count("*").alias("n"), F.min(place).alias("least")).where("n > 1")
    seen = work.table(seen.select("anchor", "h", "length", "least"), "seen")

    def again(rows: DataFrame) -> DataFrame:
        out = rows.join(seen, ["anchor", "h", "length"])
        return out.where(place > F.col("least")) if mode == "later" else out

    probe = (i % PROBE == 0) | (i == F.col("size") - 1)
    met = work.table(again(single(rows).where(probe)).groupBy(*own).agg(F.min("i").alias("low"), F.max("i").alias("high")), "met")
    ends = met.select(F.col("doc_id").alias("doc_"), F.col("th").alias("th_"), F.col("first").alias("first_"), F.col("length").alias("length_"), "low", "high")
    same = (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("doc_")) & (F.col("first") == F.col("first_")) & (F.col("length") == F.col("length_"))
    known = rows.join(ends, same, "left").select(*rows.columns, "low", "high")
    rest = again(single(known).where(~probe & (F.col("low").isNull() | (i < F.col("low")) | (i > F.col("high")))))
    found = met.select(*own, "low", "high").union(rest.select(*own, "i", "i"))
    return found.select("doc_id", "th", (F.col("first") + F.col("low")).alias("start"), (F.col("first") + F.col("high") + F.col("length")).alias("stop"), "length")


def repeats(work: Scratch, documents: DataFrame, length: int = LENGTH, kmer: int = KMER, mode: str = "all", short: int | None = None) -> DataFrame:
    """doc_id, th, start, stop and length of byte ranges that repeat, at `length` and at `short`; ranges may overlap."""
    lengths = tuple(sorted({length, short or length}))
    found = work.table(anchors(documents, lengths[0], kmer, length), "anchors")
    again = work.table(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "again")
    left = work.table(found.join(again, "anchor"), "left")
    work.drop(found, again)
    # A class: equal bytes and as many windows.
    span = F.col("last") - F.col("first")
    kinds = left.groupBy("anchor", "kind", "bytes", span.alias("span")).agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "th", "first")).alias("least"))
    kinds = work.table(kinds, "kinds")
    # Copies of whole stretches.
    many = kinds.where("copies > 1").select("anchor", F.col("kind").alias("kind_"), F.col("bytes").alias("bytes_"), F.col("span").alias("span_"), "least")
    same = left.join(work.table(many, "copied"), "anchor").where((F.col("kind") == F.col("kind_")) & (F.col("bytes") == F.col("bytes_")) & (span == F.col("span_")))
    if mode == "later":
        same = same.where(~F.struct("doc_id", "th", "first").eqNullSafe(F.col("least")))
    same = same.withColumn("length", F.explode(F.array(*[F.lit(n) for n in lengths]))).where("bytes >= length")
    whole = same.select("doc_id", "th", F.col("first").alias("start"), F.least(F.col("last") + F.col("length"), F.col("first") + F.col("bytes")).alias("stop"), "length")
    # Stretches that differ but share windows: one text of each class.
    several = work.table(kinds.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1"), "several")
    chosen = kinds.join(several.where("classes > 1"), "anchor")
    place = F.struct("anchor", F.col("least.first").alias("first"), (F.col("least.first") + F.col("span")).alias("last"), "bytes", "copies", "classes")
    places = chosen.groupBy(F.col("least.doc_id").alias("doc_"), F.col("least.th").alias("th_")).agg(F.collect_list(place).alias("places"))
    places = work.table(places, "places")
    # A row that stands twice brings its stretches twice; one of them is enough.
    stretches = with_texts(documents, places.where("th_ is not null"), STRETCH, _stretches)
    few = stretches.where(F.col("classes") <= CROWD).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "th", "first")
    part = few.mapInArrow(_compare(lengths, mode), RANGE)
    if several.where(F.col("classes") > CROWD).limit(1).count():
        part = part.union(_crowded(work, stretches.where(F.col("classes") > CROWD), lengths, mode))
    out = work.table(whole.union(part), "repeats")
    work.drop(left, kinds, several, places)
    return out


def joined(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Ranges that overlap or touch as one."""
    out: list[list[int]] = []
    for start, stop in sorted(ranges):
        if not out or start > out[-1][1]:
            out.append([start, stop])
        else:
            out[-1][1] = max(out[-1][1], stop)
    return out


def _cut(length: int):
    def run(batches):
        for b in batches:
            out = []
            for doc, th, text, places in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "text", "places")), strict=True):
                spans = joined([(p["start"], p["stop"]) for p in places if p["length"] == length])
                others = joined([(p["start"], p["stop"]) for p in places if p["length"] != length])
                kept, done = [], 0
                for start, stop in spans:
                    kept.append(text[done:start])
                    done = stop
                kept = b"".join([*kept, text[done:]])
                out.append((doc, th, len(text) - len(kept), [{"start": s, "stop": e} for s, e in spans], hashlib.sha256(kept).hexdigest(), kept, sum(e - s for s, e in others)))
            names = ["doc_id", "th", "n_removed", "spans", "kept_sha256", "kept", "n_short"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string(), pa.binary(), pa.int64()]
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def cut_repeats(documents: DataFrame, length: int = LENGTH, kmer: int = KMER, mode: str = "all", short: int | None = None) -> DataFrame:
    """doc_id, th, n_removed, spans, kept_sha256 and kept (bytes), and n_short of the documents with repeats.

    n_short: the bytes that repeat at length `short`, which are told but not cut (0 without `short`).
    """
    work = Scratch(documents.sparkSession, "suffixes")
    ranges = repeats(work, documents, length, kmer, mode, short)
    places = ranges.groupBy(F.col("doc_id").alias("doc_"), F.col("th").alias("th_")).agg(F.collect_set(F.struct("start", "stop", "length")).alias("places"))
    places = work.table(places, "ranges")
    schema = "doc_id long, th long, n_removed long, spans array<struct<start:bigint,stop:bigint>>, kept_sha256 string, kept binary, n_short long"
    return with_texts(documents, places.where("th_ is not null"), schema, _cut(length))


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's columns at 400 bytes, and `n_repeated_250`: the bytes in strings of 250 bytes that start elsewhere too."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Scratch(spark, "suffixes-out")
    cut = cut_repeats(documents, short=SHORT).select(F.col("doc_id").alias("doc_"), F.col("th").alias("th_"), "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "n_short")
    cut = work.table(cut.dropDuplicates(["doc_", "th_"]), "cut")
    text = F.coalesce("text", F.lit(""))
    every = documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    out = every.join(cut, (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("doc_")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return out.select(
        "doc_id", "n_bytes", zero("n_removed").alias("n_removed"), zero("n_spans").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), zero("n_short").alias("n_repeated_250")
    )
