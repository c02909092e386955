"""Toxicity by a counterfactually regularised classifier.

A logistic model on hashed words and word beginnings. For each labelled text with a term for a group of people,
copies with the term swapped for others of its kind should score the same: squared differences of their logits
are added to the loss, so that naming a group is no evidence by itself.

Scoring reads whole texts and sums weights over the distinct words. Null and empty texts have no words and get the score of
the intercept. Repeated rows get equal scores; labels of one document that disagree count as toxic; null labels are left
out; without labels every score is 0. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import Memo, prepare
from docroute.llm.textmodel import CLASS_ROWS, DIM, Rows, Steps, held_out, sample, sigmoid, slot

#: Terms that may be swapped for each other, by kind and language.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"), ("frauen", "männer"), ("ausländer", "flüchtlinge", "einheimische"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"), ("femmes", "hommes"), ("immigrés", "réfugiés", "étrangers"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"), ("mujeres", "hombres"), ("inmigrantes", "refugiados", "extranjeros"),
)
BEGINNINGS = (4, 5, 6)
PENALTY, L1, RATE, ROUNDS, LEAST_ROWS = 1.0, 5e-4, 0.5, 200, 3
_EDGES = "".join(map(chr, range(33, 127))).translate({c: None for c in [*range(48, 58), *range(65, 91), *range(97, 123)]}) + "«»„“”‘’…¡¿–—"
_SWAPS = {t: [x for x in kind if x != t] for kind in reversed(IDENTITY_TERMS) for t in kind}


def slots(word: str) -> list[int]:
    """The hashed features of a word."""
    bare = word.strip(_EDGES)
    return [slot("=" + bare)] + [slot("^" + bare[:n]) for n in BEGINNINGS if len(bare) > n] if bare else []


def words(text: str | None) -> set[str]:
    return set((text or "").lower().split())


def _features(found: set[str], memo: Memo) -> tuple[bytes, bytes]:
    ids = [i for w in found for i in memo[w]]
    ids, n = np.unique(np.array(ids, np.int32), return_counts=True)
    return ids.tobytes(), n.astype(np.float32).tobytes()


def swapped(found: set[str]) -> list[set[str]]:
    """Copies of a set of words with the terms of one kind swapped for each other term of that kind."""
    out = []
    for w in sorted(found):
        bare = w.strip(_EDGES)
        out += [(found - {w}) | {w.replace(bare, other)} for other in _SWAPS.get(bare, ())]
    return out


def fit(texts: Rows, label: np.ndarray, weight: np.ndarray, before: Rows, after: Rows, penalty: float = PENALTY, l1: float = L1, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and intercept. `before` and `after` are a text and its swapped copy, row by row."""
    w, step, at = np.zeros(DIM), Steps(RATE, l1), Steps(RATE, 0)
    share = weight / weight.sum()
    mean = float((share * label).sum())
    b = np.array([np.log((mean + 1e-6) / (1 - mean + 1e-6))])
    for _ in range(rounds):
        error = share * (sigmoid(texts.dot(w) + b[0]) - label)
        g = texts.back(error)
        if before.n:
            d = 2 * penalty / before.n * (before.dot(w) - after.dot(w))
            g += before.back(d) - after.back(d)
        w, b = step(w, g), at(b, np.array([error.sum()]))
    return w, float(b[0])


def train(documents: DataFrame, labels: DataFrame, label: Column | None = None, rows: int = CLASS_ROWS, penalty: float = PENALTY) -> tuple[np.ndarray, float] | None:
    """Weights and intercept from at most `rows` labelled documents of either class."""
    prepare(documents.sparkSession)
    picked, counts = sample(documents, labels, F.col("toxic") if label is None else label, 2, rows)

    def features(batches):
        memo = Memo(slots, 200_000)
        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True):
                found = words(text)
                sets = [found, *swapped(found)]
                ids, values = zip(*(_features(s, memo) for s in sets), strict=True)
                yield pa.record_batch({"label": pa.array([y] + [None] * (len(sets) - 1), pa.int32()), "ids": pa.array(ids, pa.binary()), "n": pa.array(values, pa.binary())})

    got = picked.mapInArrow(features, "label int, ids binary, n binary").collect()
    y = np.array([r["label"] for r in got if r["label"] is not None])
    if not len(y):
        return None
    own, pairs = [], []
    for r in got:
        if r["label"] is None:
            pairs.append((own[-1], r))
        else:
            own.append(r)
    make = lambda rs: Rows.of([r["ids"] for r in rs], [r["n"] for r in rs])
    weight = np.array([counts[int(v)] / max((y == v).sum(), 1) for v in y], float)
    return fit(make(own).seen_by(LEAST_ROWS), y.astype(float), weight, make([a for a, _ in pairs]), make([b for _, b in pairs]), penalty)


def score(documents: DataFrame, model: tuple[np.ndarray, float] | None, keep: list[str]) -> DataFrame:
    """`keep` columns and the score of every whole text."""
    prepare(documents.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema) + ", score double"
    packed = None
    if model:
        at = np.flatnonzero(model[0])
        packed = documents.sparkSession.sparkContext.broadcast((dict(zip(at.tolist(), model[0][at].tolist(), strict=True)), model[1]))

    def run(batches):
        weights, intercept = packed.value if packed else ({}, -50.0)
        memo = Memo(lambda w: sum(weights.get(i, 0.0) for i in slots(w)))
        for b in batches:
            logits = np.array([intercept + sum(sorted(map(memo.__getitem__, words(t)))) for t in b.column("text").to_pylist()])
            yield pa.record_batch([*(b.column(c) for c in keep), pa.array(sigmoid(logits) if packed else np.zeros(len(logits)), pa.float64())], [*keep, "score"])

    return documents.select(*keep, "text").mapInArrow(run, schema)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = train(documents, labels)
    d = documents.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return score(d, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
