"""Spelling variants: words one error apart, found by forward and backward minimal acyclic automata.

One error leaves the first or the last half of a word as it is. A word is looked up in a forward automaton by its exact first half, then
with one error in what is left, and in a backward automaton (of reversed words) by its exact last half, then with one error. Automata
are minimal and number their words (the words before a transition are counted on it), so a match is a number, and its word and
count stand at that place of an array.

Words meet by halves: a bucket holds the words that agree with a length's first or last half, and the words of that length look their
neighbours up in it. A task reads buckets side by side and builds both automata for some thousand words at a time. A bucket of over MOST
words is cut in two, by the half of the rest in which the error lies, as often as needed: what is left is exact on either side of one
place, which no more than some thousand words can be. No bucket, pair or word is left out.

The error of a pair stands at the end of its common beginning; a match counts in the one bucket that holds this place, so nothing is counted twice,
and a task sends counts and its best form only, no pairs.

Null texts have no words, a null doc_id is an empty text in the hash. Repeated rows count as often as they stand. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, prepare, whole_groups

SHORTEST, LEAST, TYPOS = 5, 3, 97
#: Words of a bucket, and of the automata that are built at once.
MOST, CHUNK = 20_000, 30_000
_RUN = re.compile(rb"[a-z\xc0-\xff]+")
#: Distinct words that a task counts before it sends them.
HELD = 500_000


def counted(documents: DataFrame) -> DataFrame:
    """word and n, in parts, of the words of all texts, some of which are written with one letter less."""
    names, kinds = ["word", "n"], [pa.string(), pa.int64()]

    def sent(seen):
        return pa.record_batch([pa.array([w.decode("latin-1") for w in seen], kinds[0]), pa.array(seen.values(), kinds[1])], names)

    def run(batches):
        seen = Counter()
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                # One byte a code point: all that is no letter here becomes a question mark, which ends a word as well.
                own, start = Counter(_RUN.findall(text.encode("latin-1", "replace").lower())), zlib.crc32(f"{doc}:".encode())
                for w, n in own.items():
                    h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                    if not h % TYPOS:
                        w = w[: h % len(w)] + w[h % len(w) + 1 :]
                    if len(w) >= SHORTEST:
                        seen[w] += n
                if len(seen) >= HELD:
                    yield sent(seen)
                    seen = Counter()
        yield sent(seen)

    d = documents.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return d.mapInArrow(run, "word string, n long")


class Automaton:
    """The minimal acyclic automaton of sorted, distinct words; a word's number is its place among them."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[False, {}]]  # the states of the last word: whether it ends there, and settled transitions
        last = ""

        def settle(down: int) -> None:
            while len(path) > down + 1:
                final, out = path.pop()
                state = self._state(known, final, out)
                path[-1][1][last[len(path) - 1]] = state

        for w in words:
            same = 0
            for a, b in zip(w, last, strict=False):
                if a != b:
                    break
                same += 1
            settle(same)
            path += [[False, {}] for _ in range(len(w) - same)]
            path[-1][0], last = True, w
        settle(0)
        self.root = self._state(known, *path[0])

    def _state(self, known: dict[tuple, int], final: bool, out: dict[str, int]) -> int:
        key = (final, *out.items())
        state = known.get(key)
        if state is None:
            state = known[key] = len(self.edges)
            edges, n = {}, int(final)
            for c, to in out.items():
                edges[c] = (to, n)
                n += self.size[to]
            self.edges.append(edges)
            self.final.append(final)
            self.size.append(n)
        return state

    def follow(self, state: int, number: int, word: str, start: int, stop: int) -> tuple[int, int] | None:
        """State and number after an exact part of a word."""
        edges = self.edges
        for k in range(start, stop):
            e = edges[state].get(word[k])
            if e is None:
                return None
            state, number = e[0], number + e[1]
        return state, number

    def number(self, word: str) -> int | None:
        at = self.follow(self.root, 0, word, 0, len(word))
        return at[1] if at and self.final[at[0]] else None

    def near(self, word: str, exact: int, stop: int) -> Iterator[int]:
        """Numbers of the words that agree with `word` in the first `exact` code points or more and then have one error, which stands
        before place `stop` or at the word's end if that is `stop`. An error stands at the end of the common beginning, so each word comes once."""
        at, size, final, follow = self.follow(self.root, 0, word, 0, exact), len(word), self.final, self.follow
        if at is None:
            return
        state, number = at
        for c in range(exact, stop + (stop == size)):
            own = word[c] if c < size else ""
            for x, (to, skip) in self.edges[state].items():
                if x != own:
                    if own and (end := follow(to, number + skip, word, c + 1, size)) and final[end[0]]:
                        yield end[1]
                    if (end := follow(to, number + skip, word, c, size)) and final[end[0]]:
                        yield end[1]
            if not own:
                return
            if word[c + 1 : c + 2] != own and (end := follow(state, number, word, c + 1, size)) and final[end[0]]:
                yield end[1]
            e = self.edges[state].get(own)
            if e is None:
                return
            state, number = e[0], number + e[1]


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def lookup(rows: list[tuple[str, int, int, int, int]]) -> Iterator[tuple[str, int, str, int]]:
    """word, neighbours and best neighbour with its count, of whole buckets of (word, n, size, i, j).

    A row's bucket is for words of length `size` whose error is at i to j - 1, or also at j if this is the end.
    """
    fore = sorted({(w, n) for w, n, size, i, _ in rows if i >= size // 2})
    back = sorted({(w[::-1], n) for w, n, size, i, _ in rows if i < size // 2})
    forward, backward = Automaton([w for w, _ in fore]), Automaton([w for w, _ in back])
    for word, _, size, i, j in rows:
        if len(word) != size:
            continue
        if i >= size // 2:
            found = [fore[k] for k in forward.near(word, i, j)]
        else:
            found = [(back[k][0][::-1], back[k][1]) for k in backward.near(word[::-1], size - j, size)]
            found = [x for x in found if i <= _common(word, x[0]) < j]
        if found:
            form, n = min(found, key=lambda x: (-x[1], x[0]))
            yield word, len(found), form, n


_BUCKET = ["size", "i", "j"]


def _bucket() -> Column:
    """The key of words that agree in all before i and after j of a word of this size."""
    return F.expr("xxhash64(size, i, j, left(word, i), right(word, size - j))")


def buckets(work: Scratch, words: DataFrame, most: int = MOST) -> DataFrame:
    """bucket, word, n, size, i, j: each word in both buckets of its own length and of those it may be one error from; none of over `most` words."""
    sizes = F.explode(F.expr(f"filter(sequence(length(word) - 1, length(word) + 1), x -> x >= {SHORTEST})"))
    rows = words.select("word", "n", sizes.alias("size"))
    ends = F.array(*[F.struct(F.expr(a).cast("int").alias("i"), F.expr(z).cast("int").alias("j")) for a, z in (("0", "size div 2"), ("size div 2", "size"))])
    rows = rows.select("word", "n", "size", F.explode(ends).alias("e")).select("word", "n", "size", "e.i", "e.j")
    done = None
    while True:
        rows = work.table(rows.select(_bucket().alias("bucket"), "word", "n", *_BUCKET), "buckets")
        large = work.table(rows.where("j - i > 1").groupBy("bucket").agg(F.count("*").alias("members")).where(F.col("members") > most).select("bucket"), "large")
        if large.isEmpty():
            return rows if done is None else done.union(rows)
        fits = rows.join(large, "bucket", "left_anti")
        done = fits if done is None else done.union(fits)
        middle = F.expr("(i + j) div 2").cast("int")
        halves = F.array(F.struct(F.col("i").alias("a"), middle.alias("z")), F.struct(middle.alias("a"), F.col("j").alias("z")))
        rows = rows.join(large, "bucket").select("word", "n", "size", F.explode(halves).alias("e")).select("word", "n", "size", F.col("e.a").alias("i"), F.col("e.z").alias("j"))


NEAR = "word string, n_near long, form string, form_n long"


def neighbours(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """word, n_near, form and form_n, in parts, from buckets()."""
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())

    def run(batches):
        for t in whole_groups(batches, "bucket", chunk):
            found = list(lookup(list(zip(*(t.column(c).to_pylist() for c in ("word", "n", *_BUCKET)), strict=True))))
            if found:
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)], [x.split()[0] for x in NEAR.split(", ")])

    prepare(rows.sparkSession)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, NEAR)


def roots(work: Scratch, forms: DataFrame) -> DataFrame:
    """word and root for (word, form): every round, what a word points to is replaced by what that points to, so paths halve."""
    far = work.table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        to = far.select(F.col("word").alias("word_"), F.col("root").alias("root_"))
        new = work.table(far.join(to, F.col("root") == F.col("word_"), "left").select("word", F.coalesce("root_", "root").alias("root"), F.col("root_").isNotNull().alias("moved")), "roots")
        work.drop(far)
        far = new
        if far.where("moved").isEmpty():
            return far.select("word", "root")


def variants(documents: DataFrame, most: int = MOST, chunk: int = CHUNK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of at least SHORTEST code points and LEAST occurrences."""
    work = Scratch(documents.sparkSession, "spelling")
    prepare(documents.sparkSession)
    words = work.table(counted(documents).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST), "words")
    parts = neighbours(buckets(work, words, most), chunk)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    near = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    near = words.join(near, "word", "left")
    own = F.col("form_n") >= 2 * F.col("n")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(own, F.col("form")).alias("form"), F.when(own, F.col("form_n")).alias("form_n"))
    near = work.table(near, "forms")
    out = near.join(roots(work, near.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
