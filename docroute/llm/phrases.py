"""Collocations of two to four words by position bitmaps, in the manner of SPAM.

Texts of one language are laid end to end in shards of at most SHARD positions, with a gap for each border of pieces. In a shard each word
has a bitmap of its positions, compressed: only blocks of 32 positions that are not empty are kept, and a block with one position
takes a byte. A phrase has the bitmap of its last words' positions. Shifting it by one and ANDing it with the bitmaps of the words
gives its extensions, a popcount their number in the shard; phrases grow depth first, a slice of roots at a time, so that no
more than a slice's bitmaps are held for each length. Gaps are no word's position, so no phrase crosses them.

A phrase cannot be frequent if a part of it is not. Counts of words, then those of pairs, are summed over all shards by Spark, and only
frequent ones go back to the shards that hold them; there, phrases of three and four words grow along frequent pairs, and their
popcounts are summed the same way. All counts are exact, over all documents; scores are decimal arithmetic.

Null texts are empty, a null language is `und`. Repeated rows count as often as they stand. A text of more than SHARD positions is
dealt over several shards, of which each sees the three words after it. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, as_bytes, group_starts

LONGEST, LEAST, TOP = 4, 30, 2000
#: Positions of a shard: 65536 blocks of 32, less the words after it. A task holds those of two shards, of all languages together.
SHARD = (1 << 21) - 64
#: Results of ANDs that are held at once.
SLICE = 1 << 21
_BORDERS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(_BORDERS + b"\t", b"\n" * len(_BORDERS) + b" ")
_TOKEN = re.compile(rb"[^ \n]+|\n")


def runs(text: bytes, shard: int = SHARD) -> Iterator[tuple[list[bytes], int]]:
    """Words and gaps of a text, and how many of them may begin a phrase; a long text comes in several runs that overlap."""
    text = text.lower().translate(_PLAIN)
    if len(text) < shard:
        found = _TOKEN.findall(text)
        yield found, len(found)
        return
    every, held = (m[0] for m in _TOKEN.finditer(text)), []
    while True:
        held += islice(every, shard + LONGEST - 2 - len(held))
        own = len(held) if len(held) < shard + LONGEST - 2 else shard - 1
        yield held, own
        if own == len(held):
            return
        held = held[own:]


def pack(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A byte for each block, the place of its only bit or 255; and the blocks of several bits."""
    many = np.bitwise_count(bits) > 1
    code = np.bitwise_count(bits - np.uint32(1))
    code[many] = 255
    return code, bits[many]


def unpack(code: np.ndarray, rest: np.ndarray) -> np.ndarray:
    many = code == 255
    bits = np.left_shift(np.uint32(1), np.where(many, 0, code).astype(np.uint32))
    bits[many] = rest
    return bits


def merged(owner: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by owner and block, with the bits of equal ones together."""
    key = (owner << 17) | block
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = group_starts(key)
    return key[at] >> 17, key[at] & 0x1FFFF, np.bitwise_or.reduceat(bits[order], at) if len(at) else bits[:0]


class Bitmaps:
    """The bitmaps of a shard's words, by word and, for ANDs with all of them at once, by block."""

    def __init__(self, sizes: np.ndarray, block: np.ndarray, bits: np.ndarray):
        self.word, self.block, self.bits = np.repeat(np.arange(len(sizes)), sizes), block.astype(np.int64), bits
        order = np.argsort(block, kind="stable")
        self.of_block, self.in_block = self.word[order], bits[order]
        self.many = np.bincount(self.block, minlength=(1 << 16) + 2)
        self.first = np.cumsum(self.many) - self.many

    def extend(self, owner: np.ndarray, block: np.ndarray, bits: np.ndarray, only: np.ndarray | None = None) -> Iterator[tuple]:
        """Bitmaps of all phrases one word longer, slice by slice: their owner and word, entries' counts, blocks, bits and popcounts.

        Entries come sorted by owner. `only` is a bitmap (a word for each block) that the results must lie in.
        """
        over = bits >> np.uint32(31) != 0
        moved = bits << np.uint32(1)
        owner, block, bits = merged(np.concatenate([owner, owner[over]]), np.concatenate([block, block[over] + 1]), np.concatenate([moved, np.ones(int(over.sum()), np.uint32)]))
        if only is not None:
            bits = bits & only[block]
        keep = (bits != 0) & (self.many[block] > 0)
        owner, block, bits = owner[keep], block[keep], bits[keep]
        if not len(owner):
            return
        work = np.cumsum(self.many[block])
        heads = group_starts(owner)
        before = np.append((work - self.many[block])[heads], work[-1])
        a = 0
        while a < len(heads):
            z = max(a + 1, int(np.searchsorted(before, before[a] + SLICE, "right")) - 1)
            i, j = heads[a], heads[z] if z < len(heads) else len(owner)
            yield self._all(owner[i:j], block[i:j], bits[i:j])
            a = z

    def _all(self, owner: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple:
        n = self.many[block]
        which = np.repeat(np.arange(len(block)), n)
        at = np.arange(len(which)) + np.repeat(self.first[block] - (np.cumsum(n) - n), n)
        met = bits[which] & self.in_block[at]
        keep = np.flatnonzero(met)
        which, met, word = which[keep], met[keep], self.of_block[at[keep]]
        key = (owner[which] << 32) | word
        order = np.argsort(key, kind="stable")
        key, met, where = key[order], met[order], block[which[order]]
        at = group_starts(key)
        sizes = np.diff(np.append(at, len(key)))
        counts = np.add.reduceat(np.bitwise_count(met).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        return key[at] >> 32, key[at] & 0xFFFFFFFF, sizes, where, met, counts


def first_of(block: np.ndarray, bits: np.ndarray, end: int) -> np.ndarray:
    """The bits of positions before `end`."""
    last = np.uint32((1 << (end & 31)) - 1)
    return np.where(block < end >> 5, bits, np.where(block == end >> 5, bits & last, np.uint32(0)))


def _before(keep: np.ndarray, sizes: np.ndarray, block: np.ndarray, bits: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, block and bits of the phrases to keep, without positions from `end` on."""
    owner, rows = np.repeat(np.arange(len(keep)), sizes), np.repeat(keep, sizes)
    owner, block, bits = owner[rows], block[rows], bits[rows]
    if len(block) and block.max() >= end >> 5:
        bits = first_of(block, bits, end)
        rows = bits != 0
        owner, block, bits = owner[rows], block[rows], bits[rows]
    return owner, block, bits


def pairs(maps: Bitmaps, own: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First and second word and number of all pairs that begin before `own`."""
    bits = first_of(maps.block, maps.bits, own)
    keep = bits != 0
    for first, second, _, _, _, counts in maps.extend(maps.word[keep], maps.block[keep], bits[keep]):
        yield first, second, counts


def longer(maps: Bitmaps, own: int, frequent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words (a row for each phrase) and numbers of the phrases of three words and more along frequent pairs, given as first << 32 | second."""
    frequent = np.sort(frequent)
    mask, kept = np.zeros((1 << 16) + 2, np.uint32), []
    for first, second, sizes, block, bits, _ in maps.extend(maps.word, maps.block, maps.bits):
        key = (first << 32) | second
        good = frequent[np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)] == key if len(frequent) else np.zeros(len(key), bool)
        rows = np.repeat(good, sizes)
        np.bitwise_or.at(mask, block[rows], bits[rows])
        kept.append((np.stack([first, second], 1), *_before(good, sizes, block, bits, own + 1)))

    def grow(words, owner, block, bits):
        length = words.shape[1] + 1
        for parent, last, sizes, block_, bits_, counts in maps.extend(owner, block, bits, mask):
            new = np.concatenate([words[parent], last[:, None]], 1)
            yield new, counts
            if length < LONGEST:
                yield from grow(new, np.repeat(np.arange(len(new)), sizes), block_, bits_)

    for words, owner, block, bits in kept:
        yield from grow(words, owner, block, bits)


SHARDS = "shard long, lang string, own int, sizes binary, blocks binary, codes binary, rest binary, slot int, word string, n long"
_SHARD_KINDS = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.string(), pa.int64())


def _record(names: list[str], kinds: tuple, length: int, /, **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[c], k) if c in columns else pa.nulls(length, k) for c, k in zip(names, kinds, strict=True)], names)


def shards(documents: DataFrame, shard: int = SHARD) -> DataFrame:
    """A row with the bitmaps of each shard, and one (slot, word, n) for each of its words."""
    names = [x.split()[0] for x in SHARDS.split(", ")]

    def fresh():
        memo = _Numbers()
        memo[b"\n"]
        return memo

    def run(batches):
        made, held = TaskContext.get().partitionId() << 32, {}

        def flush(lang, ids, memo, own):
            nonlocal made
            order = np.argsort(ids, kind="stable")
            order = order[np.count_nonzero(ids == 0) :]
            word, block, bits = ids[order].astype(np.int64) - 1, order >> 5, np.left_shift(np.uint32(1), (order & 31).astype(np.uint32))
            word, block, bits = merged(word, block, bits)
            n = np.bincount(ids[:own], minlength=len(memo))[1:]
            code, rest = pack(bits)
            made += 1
            payload = {"sizes": np.bincount(word, minlength=len(memo) - 1).astype(np.int32), "blocks": block.astype(np.uint16), "codes": code, "rest": rest}
            yield _record(names, _SHARD_KINDS, 1, shard=[made], lang=[lang], own=[own], **{k: [v.tobytes()] for k, v in payload.items()})
            every = pa.array(list(memo)[1:], pa.binary()).cast(pa.string())
            for a in range(0, len(every), 1 << 16):
                size = min(1 << 16, len(every) - a)
                yield _record(names, _SHARD_KINDS, size, shard=np.full(size, made), lang=[lang] * size, slot=np.arange(a, a + size, dtype=np.int32), word=every[a : a + size], n=n[a : a + size])

        def flush_held(lang):
            ids, memo, _ = held.pop(lang)
            ids = np.concatenate(ids)
            yield from flush(lang, ids, memo, len(ids))

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                for found, own in runs(text, shard):
                    if own < len(found) or len(found) >= shard:
                        memo = fresh()
                        ids = np.fromiter(map(memo.__getitem__, found), np.int32, len(found))
                        if len(memo) > 1:
                            yield from flush(lang, ids, memo, own)
                        continue
                    if lang in held and held[lang][2] + len(found) + 1 > shard:
                        yield from flush_held(lang)
                    ids, memo, n = held.get(lang) or ([], fresh(), 0)
                    ids.append(np.fromiter(map(memo.__getitem__, [*found, b"\n"]), np.int32, len(found) + 1))
                    held[lang] = (ids, memo, n + len(found) + 1)
                    if sum(x[2] for x in held.values()) > 2 * shard:
                        yield from flush_held(max(held, key=lambda k: held[k][2]))
        for lang in list(held):
            yield from flush_held(lang)

    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), as_bytes().alias("text")).mapInArrow(run, SHARDS)


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


KEPT = "shard long, own int, ids binary, sizes binary, blocks binary, codes binary, rest binary, a long, b long, n long"
_KEPT_KINDS = (pa.int64(), pa.int32(), *[pa.binary()] * 5, *[pa.int64()] * 3)


def _maps(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["sizes"], np.int32), np.frombuffer(row["blocks"], np.uint16), unpack(np.frombuffer(row["codes"], np.uint8), np.frombuffer(row["rest"], np.uint32))


def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    for k in range(b.num_rows):
        yield {c: b.column(c)[k].as_py() if b.column(c).type != pa.list_(pa.int64()) else b.column(c)[k].values.to_numpy(zero_copy_only=False) for c in b.schema.names}


def _pairs(batches):
    """The bitmaps of frequent words only, whose ids come with the shard; and the pairs of these words."""
    names = [x.split()[0] for x in KEPT.split(", ")]
    for b in batches:
        for row in _rows(b):
            sizes, block, bits = _maps(row)
            order = np.argsort(row["slots"])
            slots, ids = row["slots"][order], row["ids"][order]
            good = np.zeros(len(sizes), bool)
            good[slots] = True
            rows = np.repeat(good, sizes)
            sizes, block, bits = sizes[good], block[rows], bits[rows]
            code, rest = pack(bits)
            payload = {"ids": ids, "sizes": sizes, "blocks": block, "codes": code, "rest": rest}
            yield _record(names, _KEPT_KINDS, 1, shard=[row["shard"]], own=[row["own"]], **{k: [v.tobytes()] for k, v in payload.items()})
            for first, second, n in pairs(Bitmaps(sizes, block, bits), row["own"]):
                yield _record(names, _KEPT_KINDS, len(n), shard=np.full(len(n), row["shard"]), a=ids[first], b=ids[second], n=n)


LONGER = "a long, b long, c long, d long, n long"


def _longer(batches):
    names = [x.split()[0] for x in LONGER.split(", ")]
    for b in batches:
        for row in _rows(b):
            ids = np.frombuffer(row["ids"], np.int64)
            back = np.argsort(ids)
            first, second = (back[np.searchsorted(ids[back], row[x])] for x in ("firsts", "seconds"))
            for words, n in longer(Bitmaps(*_maps(row)), row["own"], (first << 32) | second):
                columns = [ids[words[:, k]] if k < words.shape[1] else np.full(len(n), -1) for k in range(LONGEST)]
                yield pa.record_batch([*(pa.array(x, pa.int64()) for x in columns), pa.array(n, pa.int64())], names)


def phrases(work: Scratch, documents: DataFrame, least: int = LEAST, shard: int = SHARD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (id, lang, word, n), all frequent phrases as ids (a, b, c, d, -1 where there is none; n), and each language's words."""
    made = work.table(shards(documents, shard), "shards", compression="zstd")
    words = made.where("slot is not null").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = work.table(words, "counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    common = work.table(words.where(F.col("n") >= least).select(F.monotonically_increasing_id().alias("id"), "lang", "word", "n"), "common")
    named = made.where("slot is not null").select("shard", "slot", "lang", "word").join(common.select("lang", "word", "id"), ["lang", "word"])
    named = named.groupBy("shard").agg(F.collect_list(F.struct("slot", "id")).alias("x")).select("shard", F.col("x.slot").cast("array<bigint>").alias("slots"), F.col("x.id").alias("ids"))
    bitmaps = made.where("slot is null").select("shard", "own", "sizes", "blocks", "codes", "rest")
    kept = work.table(bitmaps.join(named, "shard").mapInArrow(_pairs, KEPT), "pairs", compression="zstd")
    work.drop(made)
    seen = kept.where("n is not null").select("shard", "a", "b", "n")
    # A pair has one row for each shard that holds it at most, and its sum stands beside each, so rows need not meet their sums again.
    whole = seen.withColumn("n", F.sum("n").over(Window.partitionBy("a", "b"))).where(F.col("n") >= least)
    whole = work.table(whole, "frequent", compression="zstd")
    two = whole.groupBy("a", "b").agg(F.first("n").alias("n"))
    again = whole.groupBy("shard").agg(F.collect_list(F.struct("a", "b")).alias("x")).select("shard", F.col("x.a").alias("firsts"), F.col("x.b").alias("seconds"))
    bitmaps = kept.where("n is null").select("shard", "own", "ids", "sizes", "blocks", "codes", "rest")
    more = bitmaps.join(again, "shard").mapInArrow(_longer, LONGER).groupBy("a", "b", "c", "d").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    none = lambda c: F.lit(-1).cast("long").alias(c)
    one = common.select(F.col("id").alias("a"), none("b"), none("c"), none("d"), "n")
    out = work.table(one.union(two.select("a", "b", none("c"), none("d"), "n")).union(more), "phrases")
    work.drop(kept, whole)
    return common, out, totals


def _part(k: Column, n: Column) -> Column:
    """The ids of n words from the k-th (from 0) on, filled up with -1."""
    ids = F.array("a", "b", "c", "d")
    return F.struct(*[F.when(F.lit(i) < n, F.get(ids, k + i)).otherwise(F.lit(-1).cast("long")).alias(f"{x}_") for i, x in enumerate("abcd")])


def collocations(documents: DataFrame, least: int = LEAST, top: int | None = TOP, shard: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first `top` collocations."""
    work = Scratch(documents.sparkSession, "phrases")
    common, every, totals = phrases(work, documents, least, shard)
    size = sum((F.col(x) >= 0).cast("int") for x in "abcd")
    found = every.withColumn("size", size).where("size > 1")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    key = [F.col(x) == F.col(f"{x}_") for x in "abcd"]
    # Every phrase under the parts that lie in it, with the largest count.
    spans = F.expr("filter(flatten(transform(sequence(2, size - 1), n -> transform(sequence(0, size - n), k -> struct(k, n)))), x -> size > 2)")
    inner = found.where("size > 2").withColumn("at", F.explode(spans)).select(_part(F.col("at.k"), F.col("at.n")).alias("p"), "n").select("p.*", "n")
    inner = inner.groupBy("a_", "b_", "c_", "d_").agg(F.max("n").alias("most"))
    found = found.join(inner, key[0] & key[1] & key[2] & key[3], "left").where(F.col("most").isNull() | (exact("most") * 100 < exact("n") * 80)).drop("a_", "b_", "c_", "d_", "most")
    found = work.table(found, "found")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("*", _part(F.lit(0), F.col("k")).alias("x"), _part(F.col("k"), F.col("size") - F.col("k")).alias("y"))
    for side, name in (("x", "l"), ("y", "r")):
        part = every.select(*[F.col(x).alias(f"{x}_") for x in "abcd"], F.col("n").alias(name))
        cuts = cuts.select("*", f"{side}.*").drop(side).join(part, ["a_", "b_", "c_", "d_"]).drop("a_", "b_", "c_", "d_")
    score = F.expr("cast(n AS decimal(20,0)) * 2000000 div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("a", "b", "c", "d", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("a", "b", "c", "d", "n", "s.*")
    best = best.join(common.select(F.col("id").alias("a"), "lang"), "a")
    order = [F.col("score").desc(), F.col("n").desc()]
    if top is not None:  # all that tie with the last are kept until their words are known
        best = best.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top)
    best = work.table(best.select("lang", "a", "b", "c", "d", F.col("n").alias("f"), "l", "r", "score"), "best")
    words = best.select("a", "b", "c", "d", F.posexplode(F.array("a", "b", "c", "d")).alias("i", "id")).where("id >= 0").join(common.select("id", "word"), "id")
    words = words.groupBy("a", "b", "c", "d").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    out = best.join(words, ["a", "b", "c", "d"]).join(totals, "lang")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("f").desc(), "phrase")))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, unnest(flatten([[w[i:i + k] for i in range(1, len(w) - k + 1)] for k in range(0, {LONGEST})])) AS p FROM w),
f AS (SELECT lang, p, count(*) AS f FROM g GROUP BY lang, p),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE len(p) > 1 AND f >= {LEAST}),
i AS (SELECT lang, p, max(f) AS most FROM (SELECT lang, f, unnest(flatten([[p[i:i + k - 1] for i in range(1, len(p) - k + 2)] for k in range(2, len(p))])) AS p
        FROM c WHERE len(p) > 2) GROUP BY lang, p),
t AS (SELECT c.* FROM c LEFT JOIN i USING (lang, p) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * c.f),
k AS (SELECT *, unnest(range(1, len(p))) AS k FROM t),
s AS (SELECT k.lang, k.p, k.f AS a, k.k, x.f AS l, y.f AS r, 2000000::HUGEINT * k.f // (x.f + y.f) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.p = k.p[1:k.k] JOIN f y ON y.lang = k.lang AND y.p = k.p[k.k + 1:len(k.p)]),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS best FROM s),
r AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM b WHERE best = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM r)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o JOIN n USING (lang) WHERE rank <= {TOP}"""
