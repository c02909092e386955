"""Language identification by interpolated Kneser-Ney character models, one for each language.

Counts of the longest character runs are gathered over all learning rows in Spark; shorter runs are counted by the
distinct runs that they continue, as Kneser-Ney does. The models are sorted hash arrays: for each run that any
language has, the log-probability in every language with its back-off folded in. A text gets the language of least
cross-entropy per character, and a score from a scale that is fitted on learning rows. `rejected` marks texts
whose cross-entropy is beyond what that language's rows show. Scale and limits come from learning rows that are not counted:
a sixteenth of them, CALIBRATION_ROWS at most.

No run is left out. All that is needed for a character is found by the character before it: its runs and contexts of two
characters or more end there. So the arrays are cut into shards by that character, each of CELLS cells at most (or
one character's). The counts stay a written table from which a shard is built when it is needed, so the driver and a task
hold one shard at a time, whatever the corpus. A model of several shards scores a text in as many readings, and the parts are
added up in Spark.

Null texts and texts without a letter are `und` with score 0. Repeated rows count as often as they stand; null languages
teach nothing; other columns are not read. Without learning rows every text is `und`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, group_starts, mix

ORDER = 5
#: Bits of a character in a run, and the code points that keep their own number; the others are folded.
BITS, LETTERS, FOLD = np.uint64(12), 2048, 2039
DISCOUNT = 0.75
#: Runs of the longest order x languages that a shard holds.
CELLS = 1 << 23
#: Learning rows that the score's scale and the rejection limits are fitted on: of one in FOLDS, those of least key.
CALIBRATION_ROWS, FOLDS = 4000, 16
#: Cross-entropy beyond this quantile of a language's calibration rows, with slack in nats, is rejected.
REJECT_QUANTILE, REJECT_SLACK = 0.999, 0.5
#: Characters that are handled at once.
AT_ONCE = 500_000


def segments(texts: list[str], order: int = ORDER):
    """(index of the text, letters of the context and body) in lists of AT_ONCE characters or so; long texts are cut, with context."""
    held, size = [], 0
    for k, t in enumerate(texts):
        t = t.lower()
        for s in range(0, len(t), AT_ONCE):
            held.append((k, (t[s - order + 1 : s] if s else "\0" * (order - 1)) + t[s : s + AT_ONCE]))
            size += len(held[-1][1])
            if size >= AT_ONCE:
                yield held
                held, size = [], 0
    if held:
        yield held


def runs(parts: list[tuple[int, str]], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The run of `order` characters that ends at each character, and the parts' numbers of characters."""
    every = np.frombuffer("".join(p for _, p in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    small = every.astype(np.uint64)
    if every.max(initial=0) >= LETTERS:
        small = np.where(small < LETTERS, small, LETTERS + small % FOLD)
    key = small
    for n in range(1, order):
        key = key.copy()
        key[n:] |= small[:-n] << np.uint64(int(BITS) * n)
    whole = np.fromiter((len(p) for _, p in parts), np.int64, len(parts))
    lengths = whole - (order - 1)
    keep = np.ones(len(key), bool)
    starts = np.cumsum(whole) - whole
    for n in range(order - 1):
        keep[starts + n] = False
    return key[keep], lengths


def gather(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, run and count of the longest runs of rows (lang, text)."""

    def count(batches):
        for b in batches:
            langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
            for lang in sorted(set(langs)):
                for parts in segments([t for x, t in zip(langs, texts, strict=True) if x == lang], order):
                    key, n = np.unique(runs(parts, order)[0], return_counts=True)
                    yield pa.record_batch({"lang": pa.array([lang] * len(key), pa.string()), "run": pa.array(key.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    return rows.mapInArrow(count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))


class Table:
    """A sorted array of hashes with a row of values for each; a small index makes a lookup one or two probes."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        h = mix(keys)
        order = np.argsort(h)
        self.hashes, self.values = h[order], [v[order] for v in values]
        bits = max(int(len(keys)).bit_length() + 1, 4)
        self.shift = np.uint64(64 - bits)
        self.index = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        n = len(self.hashes)
        if not n:
            return np.full(len(keys), -1)
        h = mix(keys)
        at = self.index[(h >> self.shift).astype(np.int64)]
        at = np.minimum(at, n - 1)
        got = self.hashes[at]
        open_ = np.flatnonzero(got < h)
        while len(open_):
            at[open_] += 1
            open_ = open_[at[open_] < n]
            open_ = open_[self.hashes[at[open_]] < h[open_]]
        at = np.minimum(at, n - 1)
        return np.where(self.hashes[at] == h, at, -1)


def _kneser_ney(run: np.ndarray, n: np.ndarray, order: int, single: tuple[np.ndarray, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 1: runs, their log-probabilities, contexts and the contexts' log back-off weights.

    `single`: all characters and how many different ones each follows, which a shard does not know.
    """
    counts = [(run, n)]
    for k in range(order - 1, 1, -1):
        counts.append(np.unique(counts[-1][0] & np.uint64((1 << (int(BITS) * k)) - 1), return_counts=True))
    if order > 1:
        counts.append(single)
    out = []
    lower_runs, lower_p = None, None
    for k, (r, c) in enumerate(reversed(counts), 1):
        context, where, types = np.unique(r >> BITS, return_inverse=True, return_counts=True)
        total = np.bincount(where, c)
        weight = DISCOUNT * types / total
        lower = 1 / (LETTERS + FOLD) if k == 1 else lower_p[np.searchsorted(lower_runs, r & np.uint64((1 << (int(BITS) * (k - 1))) - 1))]
        p = np.maximum(c - DISCOUNT, 0) / total[where] + weight[where] * lower
        out.append((r, np.log(p), context, np.log(weight)))
        lower_runs, lower_p = r, p
    return out


@dataclass
class Shard:
    """tables[k]: runs of k + 1 characters with rows (log-probabilities, log back-off weights as a context) by language."""

    languages: list[str]
    tables: list[Table]
    unseen: np.ndarray

    def log_probabilities(self, key: np.ndarray, order: int) -> np.ndarray:
        """A row for each run: its last character's log-probability in every language."""
        if not order:
            return np.tile(self.unseen, (len(key), 1))
        t = self.tables[order - 1]
        at = t.find(key)
        out = t.values[0][at]
        lost = np.flatnonzero(at < 0)
        if len(lost):
            low = self.log_probabilities(key[lost] & np.uint64((1 << (int(BITS) * (order - 1))) - 1), order - 1)
            if order > 1:
                u = self.tables[order - 2]
                c = u.find(key[lost] >> BITS)
                low = low + np.where(c[:, None] >= 0, u.values[1][c], np.float32(0))
            out[lost] = low
        return out

    def totals(self, texts: list[str], number: int, shard_of: np.ndarray) -> np.ndarray:
        """The log-probabilities of each text's characters in this shard, summed, in every language."""
        order, one = len(self.tables), not shard_of.any()
        total = np.zeros((len(texts), len(self.languages)))
        for parts in segments(texts, order):
            key, lengths = runs(parts, order)
            owner = np.repeat([k for k, _ in parts], lengths)
            if not one:
                own = shard_of[before(key)] == number
                key, owner = key[own], owner[own]
            if len(key):
                p, first = self.log_probabilities(key, order), group_starts(owner)
                np.add.at(total, owner[first], np.add.reduceat(p, first, axis=0, dtype=np.float64))
        return total


@dataclass
class Model:
    """Shards by the last but one character of a run; `make` builds one of them, and the last one built is kept."""

    languages: list[str]
    make: Callable[[int], Shard]
    count: int
    shard_of: np.ndarray
    scale: float = 1.0
    limits: np.ndarray | None = None
    last: tuple[int, Shard] | None = None

    def shard(self, number: int) -> Shard:
        if self.last is None or self.last[0] != number:
            self.last = None
            self.last = number, self.make(number)
        return self.last[1]


def before(key: np.ndarray) -> np.ndarray:
    """The last but one character of runs."""
    return ((key >> BITS) & np.uint64((1 << int(BITS)) - 1)).astype(np.int64)


def build(languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]], single: list[tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> Shard:
    """The folded tables of all languages from a shard's longest runs (sorted) and counts, and from all characters."""
    every = [_kneser_ney(r, n, order, one) for (r, n), one in zip(counts, single, strict=True)]
    tables: list[Table] = []
    unseen = np.array([float(e[0][3][0]) - np.log(LETTERS + FOLD) for e in every], np.float32)
    model = Shard(languages, tables, unseen)
    for k in range(1, order + 1):
        # Contexts that are no runs themselves (a text's beginning) have their back-off weight here too.
        union = np.unique(np.concatenate([e[k - 1][0] for e in every] + [e[k][2] for e in every if k < order]))
        p = np.empty((len(union), len(languages)), np.float32)
        g = np.zeros_like(p)
        backed = model.log_probabilities(union & np.uint64((1 << (int(BITS) * (k - 1))) - 1), k - 1)
        if k > 1:
            c = tables[k - 2].find(union >> BITS)
            backed = backed + np.where(c[:, None] >= 0, tables[k - 2].values[1][c], np.float32(0))
        for j, e in enumerate(every):
            p[:, j] = backed[:, j]
            p[np.searchsorted(union, e[k - 1][0]), j] = e[k - 1][1]
            if k < order:
                context, weight = e[k][2], e[k][3]
                at = np.minimum(np.searchsorted(union, context), len(union) - 1)
                has = union[at] == context
                g[at[has], j] = weight[has]
        tables.append(Table(union, p, g))
    return model


def _by_language(got: pa.Table, languages: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted runs and counts of each language."""
    lang, run, n = (np.asarray(got.column(c).to_numpy(zero_copy_only=False)) for c in ("lang", "run", "n"))
    out = []
    for x in languages:
        own = np.flatnonzero(lang == x)
        r = run[own].astype(np.int64).view(np.uint64)
        o = np.argsort(r)
        out.append((r[o], n[own][o].astype(np.float64)))
    return out


def shards_for(sizes: dict[int, int], most: int) -> np.ndarray:
    """The shard of each character: characters of `most` runs in all, or one that has more."""
    out, held, number = np.zeros(LETTERS + FOLD, np.int32), 0, 0
    for char in sorted(sizes, key=lambda c: (-sizes[c], c)):
        if held and held + sizes[char] > most:
            held, number = 0, number + 1
        out[char] = number
        held += sizes[char]
    return out


def calibration_rows(rows: DataFrame, most: int) -> DataFrame:
    """key_ and lang_ of the rows that scale and limits are fitted on, `most` at most: of each language an equal share of a fold of
    its keys. A language keeps a key at least that is counted, so none is lost."""
    keys = rows.select("lang", "key").distinct()
    fold = F.pmod("key", F.lit(FOLDS)) == 0
    known = keys.groupBy("lang").agg(F.count("*").alias("keys"))
    languages = max(known.count(), 1)
    first = keys.where(fold).withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("key"))).where(F.col("place") <= max(most // languages, 1))
    return first.join(known, "lang").where(F.col("place") < F.col("keys")).select(F.col("key").alias("key_"), F.col("lang").alias("lang_"))


def train(work: Scratch, rows: DataFrame, order: int = ORDER, cells: int = CELLS, calibration: int = CALIBRATION_ROWS) -> Model | None:
    """Learn from rows (key, lang, text): counts over all but the calibration rows, scale and limits on those."""
    held = work.table(calibration_rows(rows, calibration), "held")
    own = (F.col("key") == F.col("key_")) & (F.col("lang") == F.col("lang_"))
    counts = work.table(gather(rows.join(F.broadcast(held), own, "left_anti").select("lang", "text"), order), "runs")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    mask = (1 << int(BITS)) - 1
    last = F.shiftright("run", int(BITS)).bitwiseAND(F.lit(mask)).cast("int")
    by = counts.groupBy(last.alias("char")).agg(F.count("*").alias("runs")).collect()
    shard_of = shards_for({r["char"]: r["runs"] for r in by}, cells // len(languages))
    # Characters by the different ones that they follow: two small aggregates.
    pairs = counts.select("lang", F.col("run").bitwiseAND(F.lit((1 << 2 * int(BITS)) - 1)).alias("pair")).distinct()
    single = pairs.groupBy("lang", F.col("pair").bitwiseAND(F.lit(mask).cast("long")).alias("run")).agg(F.count("*").alias("n"))
    single = _by_language(single.toArrow(), languages)
    table = work.spark.createDataFrame([(c, int(shard_of[c])) for c in {r["char"] for r in by}], "char int, shard int")

    def make(number: int) -> Shard:
        own = counts if not shard_of.any() else counts.join(F.broadcast(table.where(F.col("shard") == number)), last == F.col("char"))
        return build(languages, _by_language(own.select("lang", "run", "n").toArrow(), languages), single, order)

    model = Model(languages, make, int(shard_of.max()) + 1, shard_of)
    sample = rows.join(F.broadcast(held), own).where(F.col("lang").isin(languages)).dropDuplicates(["key", "lang"])
    seen = totals(sample.select("lang", "text"), model, ["lang"]).select("lang", "n", "totals").collect()
    if not seen:
        model.limits = np.full(len(languages), np.inf)
        return model
    ce = -np.array([r["totals"] for r in seen]) / np.maximum([r["n"] for r in seen], 1)[:, None]
    truth = np.array([languages.index(r["lang"]) for r in seen])
    losses = []
    scales = 2.0 ** np.arange(-2, 7, 0.5)
    for s in scales:
        z = -s * ce
        z = z - z.max(1, keepdims=True)
        losses.append(float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), truth]).mean()))
    model.scale = float(scales[int(np.argmin(losses))])
    own = [ce[truth == k, k] for k in range(len(languages))]
    limits = np.array([np.quantile(x, REJECT_QUANTILE) + REJECT_SLACK if len(x) else -np.inf for x in own])
    model.limits = np.where(np.isfinite(limits), limits, limits.max())  # a language without rows here takes the loosest limit
    return model


def totals(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """`keep` columns with n (characters), lettered and totals (log-probabilities by language) of each row's text."""
    spark = rows.sparkSession
    part = "n long, lettered boolean, totals array<double>"
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)

    def read(number: int, columns: list[str], shard):
        shard_of = model.shard_of

        def run(batches):
            for b in batches:
                texts = [t or "" for t in b.column("text").to_pylist()]
                total = shard.value.totals(texts, number, shard_of)
                n = pa.array([len(t.lower()) for t in texts], pa.int64())
                new = [n, pa.array([any(map(str.isalpha, t)) for t in texts], pa.bool_()), pa.array(total.tolist(), pa.list_(pa.float64()))]
                yield pa.record_batch([*(b.column(c) for c in columns), *new], [*columns, "n", "lettered", "totals"])

        return run

    share = lambda number: spark.sparkContext.broadcast(model.shard(number))
    if model.count == 1:
        return rows.select(*keep, "text").mapInArrow(read(0, keep, share(0)), f"{kept}, {part}")
    # A reading for each shard, known by the text's hashes; copies of a text have equal parts, of which one counts.
    text = F.coalesce("text", F.lit(""))
    keyed = rows.select(*keep, F.xxhash64(text).alias("th__"), F.xxhash64(F.lit(7), text).alias("tk__"), "text")
    parts, work = None, Scratch(spark, "language-parts")
    for k in range(model.count):
        shard = share(k)
        one = keyed.select("th__", "tk__", "text").mapInArrow(read(k, ["th__", "tk__"], shard), f"th__ long, tk__ long, {part}").withColumn("shard__", F.lit(k))
        one = work.table(one, "part")
        shard.destroy()
        parts = one if parts is None else parts.union(one)
    once = parts.groupBy("th__", "tk__", "shard__").agg(F.first("n").alias("n"), F.first("lettered").alias("lettered"), F.first("totals").alias("totals"))
    sums = [F.sum(F.col("totals")[k]) for k in range(len(model.languages))]
    whole = once.groupBy("th__", "tk__").agg(F.first("n").alias("n"), F.first("lettered").alias("lettered"), F.array(*sums).alias("totals"))
    return keyed.drop("text").join(whole, ["th__", "tk__"]).select(*keep, "n", "lettered", "totals")


def predict(documents: DataFrame, model: Model | None, keep: list[str], reject: bool = False) -> DataFrame:
    """`keep` columns with lang_pred, score, cross_entropy and rejected. With `reject`, rejected texts are `und`."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)
    if model is None:
        none = [F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("rejected")]
        return documents.select(*keep, *none)
    languages, scale, limits = model.languages, model.scale, model.limits

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            lettered = b.column("lettered").to_numpy(zero_copy_only=False)
            total = b.column("totals").flatten().to_numpy().reshape(b.num_rows, -1)
            ce = -total / np.maximum(b.column("n").to_numpy(), 1)[:, None]
            at = ce.argmin(1)
            z = np.exp(-scale * (ce - ce.min(1, keepdims=True)))
            best = ce[np.arange(len(ce)), at]
            far = lettered & (best > limits[at])
            ok = lettered & ~far if reject else lettered
            pred = [languages[a] if o else "und" for a, o in zip(at, ok, strict=True)]
            new = [pa.array(pred, pa.string()), pa.array(np.where(lettered, 1 / z.sum(1), 0.0)), pa.array(best), pa.array(far)]
            yield pa.record_batch([*(b.column(c) for c in keep), *new], [*keep, "lang_pred", "score", "cross_entropy", "rejected"])

    return totals(documents, model, keep).mapInArrow(run, kept + ", lang_pred string, score double, cross_entropy double, rejected boolean")


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    rows = documents.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.xxhash64("doc_id").alias("key"), "lang", "text")
    model = train(Scratch(spark, "language-id"), rows)
    d = documents.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text")
    return predict(d, model, ["doc_id", "held_out"]).drop("cross_entropy")
