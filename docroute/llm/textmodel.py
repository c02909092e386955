"""Sparse linear models on hashed text: rows of features, gradients, and a bounded sample of labelled documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashed weights of a model: its size, whatever the input.
DIM = 1 << 18
#: Rows of each class (least hashes of doc_id) that a model is fitted on; weights put back the classes' shares.
CLASS_ROWS = 4096


def slot(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) & (DIM - 1)


@dataclass
class Rows:
    """Rows of hashed features with values."""

    n: int
    row: np.ndarray
    ids: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, ids: list[bytes], values: list[bytes]) -> Rows:
        n = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        return cls(len(ids), np.repeat(np.arange(len(ids)), n), np.frombuffer(b"".join(ids), np.int32), np.frombuffer(b"".join(values), np.float32).astype(np.float64))

    def seen_by(self, least: int) -> Rows:
        """Without the features of fewer than `least` rows."""
        keep = np.bincount(self.ids, minlength=DIM)[self.ids] >= least
        return Rows(self.n, self.row[keep], self.ids[keep], self.values[keep])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.ids], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.ids, self.values * g[self.row], minlength=DIM)


class Steps:
    """AdaGrad with soft thresholds (L1), so that features without evidence stay at zero."""

    def __init__(self, rate: float, l1: float):
        self.rate, self.l1, self.seen = rate, l1, 1e-10

    def __call__(self, w: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.seen = self.seen + g * g
        step = self.rate / np.sqrt(self.seen)
        w = w - step * g
        return np.sign(w) * np.maximum(np.abs(w) - step * self.l1, 0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def held_out(doc_id: Column) -> Column:
    """True for a fifth of the documents, which no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, label: Column, classes: int, rows: int = CLASS_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """(text, label) of at most `rows` labelled documents of each class, and the classes' full counts.

    The ids are chosen from the labels first, so that documents meet a table of bounded size.
    """
    known = labels.select("doc_id", label.alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for k in range(classes):
        part = known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = part if picked is None else picked.union(part)
    return documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", F.col("label").cast("int")), counts
