"""Pieces shared by the training-data operators: scratch tables, row keys, word and shingle hashes,
complete groups from sorted partitions, global ranks and connected components."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words everywhere are runs of bytes other than ASCII space and \t\n\v\f\r, which is what bytes.split() cuts at.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
SIMILARITY = 0.8

_own: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small: a batch of very long texts must fit a worker's memory. Local workers find this package."""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, (root, env.get("PYTHONPATH"))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    # Rows that a join with a small written table will drop are dropped before their shuffle; the filters are at most 8 MB.
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1g")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset, a local one if all run on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not base:
        base = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))
        base = f"file://{base}"
    return base.rstrip("/")


class Scratch:
    """Tables written to the shared folder. They cut lineage and survive the loss of executors."""

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark, self.base = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.base}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_hash(text: Column | str = "text") -> Column:
    """With doc_id, the key of a row. Rows that agree in both are copies, for which any assignment is as good."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def with_texts(documents: DataFrame, places: DataFrame, schema: str, run) -> DataFrame:
    """Bring lists of places (doc_, th_, places) to their texts."""
    d = documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), as_bytes().alias("text"))
    # Texts are shuffled at every size alike: a table of places that may be broadcast today will not fit tomorrow.
    joined = d.join(places.hint("merge"), (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("doc_")))
    return joined.select("doc_id", "th", "text", "places").mapInArrow(run, schema)


def as_bytes(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


class Memo(dict):
    """Word to value, forgotten as a whole when it gets large, so that memory stays bounded."""

    def __init__(self, make, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.make(word)
        return value


def word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, over uint64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_words(lists: list[list[bytes]], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all lists, and each list's count."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((memo[w] for ws in lists for w in ws), np.uint64, int(counts.sum())), counts


def shingles_of(h: np.ndarray, counts: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words of each list, one after the other, and each list's count.

    A list with fewer words has one shingle of all its words; an empty list has none.
    """
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.cumsum(counts) - counts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    last = np.repeat(starts + counts, n)
    s = np.zeros(len(at), np.uint64)
    for k in range(width if len(h) else 0):
        i = at + k
        s = np.where(i < last, s * np.uint64(0x9E3779B97F4A7C15) + h[np.minimum(i, len(h) - 1)], s)
    return mix(s), n


def shingles(lists: list[list[bytes]], memo: Memo, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    return shingles_of(*hash_words(lists, memo), width)


def permutations(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(s: np.ndarray, n: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """One row of minima (uint32) for each list of shingles; rows of empty lists hold the largest value."""
    out = np.full((len(n), len(odd)), 0xFFFFFFFF, np.uint32)
    full = n > 0
    starts = (np.cumsum(n) - n)[full]
    if len(starts):
        for k, a in enumerate(odd):
            v = s * a
            v ^= v >> np.uint64(29)
            out[full, k] = (np.minimum.reduceat(v * a, starts) >> np.uint64(32)).astype(np.uint32)
    return out


def fixed(rows: np.ndarray) -> pa.Array:
    """A binary column with the bytes of each row of a two-dimensional array."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(rows)])


def matrix(column: pa.Array, dtype) -> np.ndarray:
    """The reverse of fixed()."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), -1) if values else np.zeros((0, 0), dtype)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int = 4096) -> Iterator[pa.Table]:
    """Tables that hold whole groups, from batches sorted by `key`; groups must be bounded by the caller."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < least or held[0].column(key)[0] == b.column(key)[-1]:
            continue
        t = pa.Table.from_batches(held)
        k = t.column(key).combine_chunks()
        last, cut = k[-1], len(k) - 1
        while cut and k[cut - 1] == last:
            cut -= 1
        yield t.slice(0, cut)
        held, rows = t.slice(cut).to_batches(), len(k) - cut
    if held:
        yield pa.Table.from_batches(held)


def group_starts(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in an array whose equal values stand together."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each node's component, for edges a-b among n nodes."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def in_blocks(df: DataFrame, group: str, member: str, count: str, size: int) -> DataFrame:
    """Split groups of over `size` members into blocks and deal every pair of blocks to a group of its own.

    Adds `unit` (the key of a pair of blocks), `side` (0: first block, 1: second) and `same` (both are one block).
    A row goes to as many units as its group has blocks, so no task gets a whole large group, and
    pairs are compared inside tasks without ever being rows.
    """
    blocks = F.ceil(F.col(count) / size).cast("int")
    own = F.pmod(F.xxhash64(F.col(member), F.lit(17)), blocks.cast("long")).cast("int")
    df = df.withColumn("own_", own).withColumn("other_", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("own_", "other_"), F.greatest("own_", "other_")
    return (
        df.withColumn("unit", F.xxhash64(F.col(group), low, high))
        .withColumn("side", (F.col("own_") != low).cast("int"))
        .withColumn("same", low == high)
        .drop("own_", "other_")
    )


def by_unit(df: DataFrame, *then: str) -> DataFrame:
    """Units side by side in sorted partitions."""
    return df.repartition("unit").sortWithinPartitions("unit", *then)


def components(work: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b); a component is named by one of its nodes. Nodes are hashes, of any ordered type.

    In each round every node hooks onto its least neighbour and edges are drawn between the hooks, so that edges vanish;
    as nodes are in random order, the rounds grow with the logarithm of the component. Every round is a written table; the
    driver only learns whether edges are left.
    """
    left = work.table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    hooks = []
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = work.table(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias(f"n{len(hooks)}"), F.least("a", "m").alias(f"to{len(hooks)}")), "hooks")
        n, to = hook.columns
        hooks.append(hook)
        once = left.join(hook, F.col("a") == F.col(n)).select(F.col(to).alias("a"), "b")
        moved = once.join(hook, F.col("b") == F.col(n)).select(F.least("a", to).alias("a"), F.greatest("a", to).alias("b"))
        new = work.table(moved.where("a <> b").distinct(), "edges")
        work.drop(left)
        left = new
        if left.isEmpty():
            break
    out = hooks[0].select(F.col("n0").alias("node"), F.col("to0").alias("component"))
    for hook in hooks[1:]:
        n, to = hook.columns
        out = out.join(hook, F.col("component") == F.col(n), "left").select("node", F.coalesce(to, "component").alias("component"))
    return out


def ranked(work: Scratch, df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add a global 0-based position in `order` without a task that sees all rows.

    Range partitions are written sorted, with the place inside the partition; the driver gets one count
    for each partition. Ties get places in any order, so order by all that tells rows apart.
    """
    tagged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = tagged.select("*", F.spark_partition_id().alias("part_"), (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("place_"))
    tagged = work.table(tagged, "ranked")
    total, starts = 0, {}
    for r in sorted(tagged.groupBy("part_").agg(F.count("*").alias("n")).collect()):
        starts[r["part_"]] = total
        total += r["n"]
    if not starts:
        return tagged.select(*df.columns, F.lit(0).cast("long").alias(name))
    first = work.spark.createDataFrame(list(starts.items()), "part_ int, start_ long")
    return tagged.join(F.broadcast(first), "part_").select(*df.columns, (F.col("start_") + F.col("place_")).alias(name))


def row_once(key: list[str]) -> Column:
    """1 for one of the rows that agree in `key`."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))
