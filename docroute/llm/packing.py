"""Best-fit packing of token sequences, bulk-synchronous.

Documents are tokenized where they are read; longer ones than a sequence are cut. Pieces are range-sorted by
length, which gives each its rank among those of equal length. A sweep takes the lengths from the longest down and
matches each class of pieces with its successor, the class of least gaps that hold it; the k-th piece takes the k-th
gap (conflicts are settled by rank), the gaps shrink, and this repeats until all are placed. Lengths and gaps are
whole numbers up to the capacity, so sweeps work on counts of classes, of which there are at most `capacity`; pieces and
sequences themselves are never gathered. This gives best-fit decreasing, the same as if done one by one.

Null and empty texts are their end token alone. Rows that agree in all columns are packed one by one, in any order.
Other columns are not read; an empty table packs to nothing.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import Memo, Scratch, prepare, ranked

CAPACITY, END = 1024, 2
#: A vocabulary's name among the public tokenizers, or a path.
VOCABULARY = "byte_bpe_50k.json"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where a space is next to other white space or an end of the text, words cannot be told apart by spaces alone.
_ODD = re.compile(r"\s\s|^\s|\s$")

_encoders: dict[tuple[str, bool], Callable[[str], bytes]] = {}


def letters() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(vocabulary: str = VOCABULARY, special: bool = True) -> Callable[[str], bytes]:
    """Text to the bytes of its ids (unsigned, 32 bits, little-endian). The ids of words are remembered.

    The vocabulary file's tokens and ids are used, and its merges are in the order of its ids. With `special`, the file's added
    tokens get their ids where a text spells them out, as is the tokenizer's default; without, they are ordinary text.
    """
    if (vocabulary, special) not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary), encoding="utf-8") as f:
            file = json.load(f)
        added, of = {t["content"]: t["id"] for t in file["added_tokens"]}, letters()
        ranks = {bytes(map(of.__getitem__, w)): k for w, k in file["model"]["vocab"].items() if w not in added}
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        pack_ = lambda ids: np.array(ids, "<u4").tobytes()
        spaced = Memo(lambda w: pack_(own.encode_ordinary(" " + w)), 500_000)
        marks = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added and special else None

        def plain(text: str) -> bytes:
            if _ODD.search(text):
                return pack_(own.encode_ordinary(text))
            first, *rest = text.split(" ")
            return pack_(own.encode_ordinary(first)) + b"".join([spaced[w] for w in rest])

        def encode(text: str) -> bytes:
            parts = marks.split(text) if marks else [text]
            return plain(text) if len(parts) == 1 else b"".join([pack_([added[x]]) if k % 2 else plain(x) for k, x in enumerate(parts)])

        _encoders[vocabulary, special] = encode
    return _encoders[vocabulary, special]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first may be shorter, the others are full."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def tokenize(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece, and the ids themselves if asked for."""
    prepare(documents.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def run(batches):
        encode, last = encoder(vocabulary), np.array([end], "<u4").tobytes()
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = encode(text) + last
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + n)]
                    rows.append((doc, k, start, n, zlib.crc32(own), *([np.frombuffer(own, "<u4").astype(np.int32)] * keep_ids)))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds[: len(names)], strict=True)], names)

    return documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def sweeps(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on classes: (length, first rank, end rank, first sequence, offset, pieces of each) of every match.

    A run is a range of sequences with equal contents; runs wait by their gap. A sequence takes as many pieces of a
    class as its gap holds, since what is left of the least gap is the next least. Each step uses up a class or a run.
    """
    waiting: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []
    out, sequences = [], 0

    def wait(gap: int, run: tuple[int, int]) -> None:
        if not gap:
            return
        if gap not in waiting:
            waiting[gap] = []
            insort(gaps, gap)
        waiting[gap].append(run)

    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                new = -(-(n - rank) // (capacity // length))
                wait(capacity, (sequences, new))
                sequences += new
                continue
            gap = gaps[at]
            first, many = waiting[gap].pop()
            each = min(gap // length, n - rank)
            took = min(many, (n - rank) // each)
            if took < many:
                waiting[gap].append((first + took, many - took))
            if not waiting[gap]:
                del waiting[gap], gaps[at]
            out.append((length, rank, rank + took * each, first, capacity - gap, each))
            wait(gap - each * length, (first, took))
            rank += took * each
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32) of 1 to `capacity` tokens."""
    spark = pieces.sparkSession
    work = Scratch(spark, "packing")
    keys = [F.col(c) for c in ("length", "doc_id", "piece", "start", "ids_crc32")]
    rows = ranked(work, pieces, keys)
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for length in sorted(counts):
        before[length] = total
        total += counts[length]
    plan = [(length, before[length] + a, before[length] + b, *rest) for length, a, b, *rest in sweeps(counts, capacity)]
    # A row for each match of classes: bounded by the capacity, whatever the input.
    match = spark.createDataFrame(plan, "of long, low long, high long, first long, at long, each long")
    joined = rows.join(F.broadcast(match), (rows.length == match.of) & (rows["rank"] >= match.low) & (rows["rank"] < match.high))
    place = F.col("rank") - F.col("low")
    return joined.select(*pieces.columns, (F.col("first") + F.expr("(rank - low) div each")).alias("sequence_id"), (F.col("at") + place % F.col("each") * F.col("length")).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from packed pieces that kept theirs; a group is one sequence."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    return packed.groupBy("sequence_id").agg(F.flatten(parts).alias("ids"))


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = Scratch(spark, "pieces").table(tokenize(documents), "pieces")
    return pack(pieces)
