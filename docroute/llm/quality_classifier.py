"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector on hashed text and ordered thresholds: P(grade >= k) = sigmoid(f - threshold_k). It gives the
expected grade and the tail probability of a grade, by which documents are selected. Features are words, shapes of
words (case, digits and marks) and repeats of the word before, each by the root of its share of the text.

The labels' grades: 0 poor, 1 good but toxic, 2 good. Null and empty texts are grade 0 and never selected. Repeated rows
get equal results; of ratings that disagree the highest counts; null ratings are left out; without ratings every text with a
word is selected. Other columns are not read by the classifier.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import Memo, prepare
from docroute.llm.textmodel import CLASS_ROWS, DIM, Rows, Steps, held_out, sample, sigmoid, slot

GRADES = 3
L1, RATE, ROUNDS, LEAST_ROWS = 2e-5, 0.5, 200, 3
#: A document is selected if its grade is SELECT_GRADE or more with at least this probability.
SELECT_GRADE, SELECT_PROBABILITY = 1, 0.5
_RUNS = re.compile(r"(.)\1+")
_CLASSES = str.maketrans({**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in "0123456789"}})


def graded() -> Column:
    """The grade of a row of labels (quality 0/1, toxic 0/1)."""
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, 2 - F.coalesce(F.col("toxic"), F.lit(0))).cast("int")


def shape(word: str) -> str:
    s = word.translate(_CLASSES)
    if not s.isascii():
        s = "".join("A" if c.isupper() else "a" if c.isalpha() else c for c in s)
    return _RUNS.sub(r"\1", s)[:8]


def features(text: str | None, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and their values."""
    found = (text or "").split()
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    ids: Counter = Counter()
    for w, n in Counter(found).items():
        a, b = memo[w]
        ids[a] += n
        ids[b] += n
    again = sum(map(str.__eq__, found, found[1:]))
    if again:
        ids[_AGAIN] += again
    at = np.fromiter(ids, np.int32, len(ids))
    n = np.fromiter(ids.values(), np.float64, len(ids))
    return at, np.sqrt(n / len(found)).astype(np.float32)


_AGAIN = slot("again")


def pair(word: str) -> tuple[int, int]:
    return slot("=" + word), slot("~" + shape(word))


def fit(texts: Rows, grade: np.ndarray, weight: np.ndarray, grades: int = GRADES, l1: float = L1, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the grades - 1 ordered thresholds."""
    w, step, at = np.zeros(DIM), Steps(RATE, l1), Steps(RATE, 0)
    share = weight / weight.sum()
    above = np.array([float(share[grade >= k].sum()) for k in range(1, grades)]).clip(1e-4, 1 - 1e-4)
    cut = np.maximum.accumulate(-np.log(above / (1 - above)) + 1e-3 * np.arange(grades - 1))
    for _ in range(rounds):
        f = texts.dot(w)
        over = np.column_stack([np.ones(len(f)), *(sigmoid(f - c) for c in cut), np.zeros(len(f))])
        a, b = over[np.arange(len(f)), grade], over[np.arange(len(f)), grade + 1]
        p = np.maximum(a - b, 1e-12)
        g = np.zeros(grades + 1)
        np.add.at(g, grade, share * a * (1 - a) / p)
        np.add.at(g, grade + 1, -share * b * (1 - b) / p)
        w = step(w, texts.back(share * (a + b - 1)))
        cut = at(cut, g[1:-1])
        cut = np.maximum.accumulate(cut + 1e-3 * np.arange(len(cut))) if (np.diff(cut) <= 0).any() else cut
    return w, cut


def train(documents: DataFrame, labels: DataFrame, grade: Column | None = None, grades: int = GRADES, rows: int = CLASS_ROWS) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and thresholds from at most `rows` rated documents of each grade."""
    prepare(documents.sparkSession)
    picked, counts = sample(documents, labels, graded() if grade is None else grade, grades, rows)

    def run(batches):
        memo = Memo(pair, 200_000)
        for b in batches:
            got = [features(t, memo) for t in b.column("text").to_pylist()]
            yield pa.record_batch({"label": b.column("label"), "ids": pa.array([x.tobytes() for x, _ in got], pa.binary()), "v": pa.array([v.tobytes() for _, v in got], pa.binary())})

    def learn(batches):
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("label", "ids", "v")), strict=True)]
        if not rows:
            return
        label, ids, v = zip(*rows, strict=True)
        y = np.array(label)
        weight = np.array([counts[int(g)] / max((y == g).sum(), 1) for g in y], float)
        w, cut = fit(Rows.of(ids, v).seen_by(LEAST_ROWS), y, weight, grades)
        at = np.flatnonzero(w)
        yield pa.record_batch({"at": [at.tobytes()], "w": [w[at].tobytes()], "cut": [cut.tobytes()]})

    # The sample is bounded, so one task can fit on it, in one order at every run; only the weights reach the driver.
    got = picked.mapInArrow(run, "label int, ids binary, v binary").repartition(1).sortWithinPartitions("label", "ids", "v").mapInArrow(learn, "at binary, w binary, cut binary").collect()
    if not got:
        return None
    w = np.zeros(DIM)
    w[np.frombuffer(got[0]["at"], np.int64)] = np.frombuffer(got[0]["w"])
    return w, np.frombuffer(got[0]["cut"])


def score(documents: DataFrame, model: tuple[np.ndarray, np.ndarray] | None, keep: list[str]) -> DataFrame:
    """`keep` columns with expected_grade, tail_probability (of SELECT_GRADE or more) and selected."""
    prepare(documents.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema) + ", expected_grade double, tail_probability double, selected boolean"
    packed = None
    if model:
        at = np.flatnonzero(model[0])
        packed = documents.sparkSession.sparkContext.broadcast((dict(zip(at.tolist(), model[0][at].tolist(), strict=True)), model[1]))

    def run(batches):
        weights, cut = packed.value if packed else ({}, np.array([-50.0]))
        weigh = weights.get

        def make(word):
            a, b = pair(word)
            return weigh(a, 0.0), b if b in weights else -1

        memo = Memo(make)
        for b in batches:
            texts = b.column("text").to_pylist()
            f, full = np.zeros(len(texts)), np.zeros(len(texts), bool)
            for k, t in enumerate(texts):
                found = (t or "").split()
                if not found:
                    continue
                full[k], total, shapes = True, 0.0, {}
                for w, n in Counter(found).items():
                    v, s = memo[w]
                    if v:
                        total += v * n**0.5
                    if s >= 0:
                        shapes[s] = shapes.get(s, 0) + n
                shapes[_AGAIN] = shapes.get(_AGAIN, 0) + sum(map(str.__eq__, found, found[1:]))
                f[k] = (total + sum(weigh(s, 0.0) * n**0.5 for s, n in shapes.items())) / len(found) ** 0.5
            over = np.where(full[:, None], sigmoid(f[:, None] - cut[None, :]), 0.0)
            tail = over[:, min(SELECT_GRADE, over.shape[1]) - 1]
            new = [pa.array(over.sum(1), pa.float64()), pa.array(tail, pa.float64()), pa.array(tail >= SELECT_PROBABILITY, pa.bool_())]
            yield pa.record_batch([*(b.column(c) for c in keep), *new], [*keep, "expected_grade", "tail_probability", "selected"])

    read = keep if "text" in keep else [*keep, "text"]
    return documents.select(*read).mapInArrow(run, schema)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = train(documents, labels)
    d = documents.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return score(d, model, ["doc_id", "held_out"])
