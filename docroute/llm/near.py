"""Near-duplicate classes from MinHash buckets, verified exactly.

Items that share a bucket and whose signatures agree in enough places are candidates. Candidates' components are
small sets inside which every pair of texts is compared exactly, so a text travels once, not once for each bucket.
Pairs live inside tasks only: they leave as counts of links and as edges of spanning trees. Large buckets and components
are dealt out in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import SIMILARITY, Scratch, by_unit, components, fixed, group_starts, in_blocks, matrix, shingles, spanning, whole_groups, word_hashes

#: Members of a block when signatures and when texts are compared.
SIGNATURE_BLOCK, TEXT_BLOCK = 512, 128


def class_keys(s: np.ndarray, n: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """A key of each set of shingles (equal sets, equal keys), and the sets' sizes."""
    keys, sizes, at = [], np.zeros(len(n), np.int64), 0
    for k, m in enumerate(n.tolist()):
        own = np.unique(s[at : at + m])
        keys.append(xxhash.xxh3_128_digest(own.tobytes()))
        sizes[k] = len(own)
        at += m
    return keys, sizes


def _pairs(start: int, stop: int, side: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that a unit compares."""
    if same:
        a, b = np.triu_indices(stop - start, 1)
        return a + start, b + start
    left, right = start + np.flatnonzero(side[start:stop] == 0), start + np.flatnonzero(side[start:stop] == 1)
    return np.repeat(left, len(right)), np.tile(right, len(left))


def _candidates(least: int, words: int):
    def run(batches):
        for t in whole_groups(batches, "unit"):
            unit, side = t.column("unit").to_numpy(), t.column("side").to_numpy()
            same, keys = t.column("same").to_numpy(zero_copy_only=False), t.column("key").to_pylist()
            sig = matrix(t.column("sig"), np.uint32)
            starts = group_starts(unit)
            stops = np.append(starts[1:], len(unit))
            a, b = [], []
            two = (stops - starts == 2) & same[starts]
            i = starts[two]
            ok = (sig[i] == sig[i + 1]).sum(1) >= least
            a.append(i[ok])
            b.append(i[ok] + 1)
            for start, stop in zip(starts[~two].tolist(), stops[~two].tolist(), strict=True):
                i, j = _pairs(start, stop, side, bool(same[start]))
                for s in range(0, len(i), 1 << 16):
                    x, y = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                    ok = (sig[x] == sig[y]).sum(1) >= least
                    a.append(x[ok])
                    b.append(y[ok])
            label = spanning(len(unit), np.concatenate(a), np.concatenate(b))
            at = np.flatnonzero(label != np.arange(len(label)))
            yield pa.record_batch({"a": pa.array([keys[k] for k in at], pa.binary()), "b": pa.array([keys[k] for k in label[at]], pa.binary())})

    return run


def _similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of sorted sets have at least this Jaccard similarity."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    ok = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
    at = np.flatnonzero(ok)
    if not len(at):
        return ok
    i, j = i[at], j[at]
    if len(sets) <= 8:
        both = np.fromiter((len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist(), strict=True)), np.int64, len(i))
    else:
        # Common shingles of all pairs at once: products of a 0/1 matrix, some thousand shingles at a time.
        every, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), n)
        more = times[inverse] > 1
        place = np.cumsum(times > 1) - 1
        column, owner = place[inverse[more]], owner[more]
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for s in range(0, int((times > 1).sum()), 4096):
            lo, hi = np.searchsorted(column, [s, s + 4096])
            m = np.zeros((len(sets), 4096), np.float32)
            m[owner[lo:hi], column[lo:hi] - s] = 1
            common += m @ m.T
        both = common[i, j].astype(np.int64)
    ok[at] = both >= similarity * (n[i] + n[j] - both) - 1e-9
    return ok


def _verify(similarity: float):
    def run(batches):
        memo = word_hashes()
        for t in whole_groups(batches, "unit", 256):
            unit, side = t.column("unit").to_numpy(), t.column("side").to_numpy()
            same, keys, weight = t.column("same").to_numpy(zero_copy_only=False), t.column("key").to_pylist(), t.column("copies").to_numpy()
            texts = t.column("text").to_pylist()
            starts = group_starts(unit)
            out_a, out_b, out_n = [], [], []
            for start, stop in zip(starts.tolist(), np.append(starts[1:], len(unit)).tolist(), strict=True):
                first = {}
                for k in range(start, stop):  # the text of a row that stands twice comes twice
                    first.setdefault((keys[k], side[k]), k)
                at = np.array(sorted(first.values()))
                s, n = shingles([texts[k].split() for k in at], memo)
                ends = np.cumsum(n)
                sets = [np.unique(s[e - m : e]) for e, m in zip(ends.tolist(), n.tolist(), strict=True)]
                i, j = _pairs(0, len(at), side[at], bool(same[start]))
                ok = _similar(sets, i, j, similarity)
                i, j = i[ok], j[ok]
                links = np.bincount(i, weight[at[j]], len(at)) + np.bincount(j, weight[at[i]], len(at))
                label = spanning(len(at), i, j)
                for k in np.flatnonzero(links):
                    out_a.append(keys[at[k]])
                    out_b.append(keys[at[label[k]]])
                    out_n.append(int(links[k]))
            yield pa.record_batch({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary()), "links": pa.array(out_n, pa.int64())})

    return run


def in_buckets(items: DataFrame, buckets: list[Column]) -> DataFrame:
    """bucket and key, for each of an item's buckets, which are longs from its signature."""
    return items.select("key", F.explode(F.array(*buckets)).alias("bucket"))


def near_classes(
    work: Scratch, items: DataFrame, spread: DataFrame, words: int, fetch: Callable[[DataFrame], DataFrame], similarity: float = SIMILARITY, slack: float = 5.0
) -> DataFrame:
    """(key, component, links) of the items that are linked to another.

    items: key (binary), copies, sig (`words` minima of 32 bits) and what `fetch` needs. spread: bucket (long) and key, see in_buckets().
    fetch adds `text` (binary) to some items. Signatures must agree in the share `similarity` less `slack` standard
    deviations; a pair beyond that is lost with a probability far below that of missing all buckets.
    """
    least = int(np.ceil(words * similarity - slack * (words * similarity * (1 - similarity)) ** 0.5))
    shared = work.table(spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    held = spread.join(shared.where("members > 1"), "bucket").select("bucket", "members", F.col("key").alias("key_"))
    signed = held.join(items.select("key", "sig"), F.col("key_") == F.col("key")).drop("key_")
    units = in_blocks(signed, "bucket", "key", "members", SIGNATURE_BLOCK).select("unit", "side", "same", "key", "sig")
    edges = work.table(by_unit(units).mapInArrow(_candidates(least, words), "a binary, b binary").distinct(), "candidates")
    # Sizes are written before they are joined: a join of two plain tables is one whose hot keys Spark can split.
    near = work.table(components(work, edges).withColumnRenamed("node", "key"), "near")
    sizes = work.table(near.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    members = work.table(near.join(sizes, "component").join(items.drop("sig"), "key"), "members")
    texts = fetch(members.where("size > 1"))
    units = in_blocks(texts, "component", "key", "size", TEXT_BLOCK).select("unit", "side", "same", "key", "copies", "text")
    found = work.table(by_unit(units).mapInArrow(_verify(similarity), "a binary, b binary, links long"), "links")
    work.drop(shared, edges, near, sizes, members)
    linked = components(work, found)
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    return linked.join(links, F.col("node") == F.col("a")).select(F.col("node").alias("key"), "component", "links")
