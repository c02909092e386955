"""Mix sources to target weights by pivotal dependent rounding.

A document of a source with target t and size s is taken t / s times in the mean. Whole copies are sure; the
fractions are rounded by exchanging mass (words) at random until a document is taken or left, with each document's mean
kept. The largest document is settled first: its partner is all smaller ones together, which have room for what it gains
or loses, and each of them bears a part in proportion to its room (with one partner this is the plain pair). So what stays open of a group is one small document; these residuals meet again in ever fewer groups, up to
one for each source. Mass is words, so a source's words miss its target by less than the last residual's size; only
where the smaller documents of a source have too little room for its largest one does that one stay open.

Groups are hash buckets of bounded size, a source has as many as it needs, and the draws depend on doc_id, text
and seed alone, so reruns agree and a hot source spreads over all tasks.

Null texts have size 0 and are taken 0 words (1 copy at most, by the mean); a null source is a source, last in order.
Repeated rows are rounded one by one. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, ranked, text_hash

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Documents of a bucket, and residuals that meet in one task, on average.
BUCKET, FAN = 2048, 256
SEED = 20


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, text's hash, source and words of every row."""
    text = F.coalesce("text", F.lit(""))
    n = F.size(F.array_remove(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " ", -1), ""))
    return documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), "source", n.cast("long").alias("size"))


def targets(work: Scratch, rows: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, docs and target, for every source.

    Sources past `most` times their size stop there and what they leave is shared again by weight, until none is above;
    each round is an aggregate over the sources, and a few sums come to the driver.
    """
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    s = ranked(work, s, [F.col("source").asc_nulls_last()], "place")
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = work.table(s.select("source", "source_size", "docs", F.get(w, (F.col("place") % len(weights)).cast("int")).alias("weight")), "sources")
    (total,) = s.agg(F.sum("source_size")).first()
    share = 0.0
    while total:
        capped = F.col("weight") * F.lit(share) >= most * F.col("source_size")
        held, free = s.agg(F.sum(F.when(capped, most * F.col("source_size"))), F.sum(F.when(~capped, F.col("weight")))).first()
        new = (total - (held or 0)) / free if free else share
        if new <= share or not free:
            break
        share = new
    return s.select("source", "source_size", "docs", F.least(F.col("weight") * F.lit(share), (most * F.col("source_size")).cast("double")).alias("target"))


def _settle(mass: np.ndarray, size: np.ndarray, k: int, open_: np.ndarray, u: float) -> bool:
    """Exchange mass between document k and open smaller ones (places, in order); true if k is settled.

    Up, k gains what it lacks and the others lose it; down, it loses what it has. A partner's room is the part of that which it can
    bear either way; the chances of up and down keep all means. Where all have too little room, k and the next one are
    a plain pair, and one of the two is settled.
    """
    gain, loss = size[k] - mass[k], mass[k]
    at = open_
    room = np.minimum(mass[at] / gain, (size[at] - mass[at]) / loss)
    if room.sum() >= 1:
        move = gain if u * (gain + loss) < loss else -loss
        mass[at] -= room / room.sum() * move
        mass[k] = size[k] if move > 0 else 0.0
    else:
        at = open_[:1]
        up, down = min(gain, mass[at[0]]), min(loss, size[at[0]] - mass[at[0]])
        move = up if u * (up + down) < down else -down
        mass[at] -= move
        mass[k] += move
    at = np.append(at, k)
    near = 1e-9 * size[at]
    mass[at] = np.where(mass[at] <= near, 0.0, np.where(mass[at] >= size[at] - near, size[at], mass[at]))
    return not 0 < mass[k] < size[k]


def _round(pdf: pd.DataFrame, level: int, seed: int) -> pd.DataFrame:
    """Settle fractions, large documents first, until one row at most is left between 0 and 1; it stays open."""
    pdf = pdf.sort_values(["size", "draw", "doc_id", "th"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    size, part = pdf["size"].to_numpy(float), pdf["part"].to_numpy(float).copy()
    first = pdf["draw"].to_numpy(np.int64)
    key = int(np.bitwise_xor.reduce(first)) & ((1 << 63) - 1) if len(first) else 0
    rng = np.random.default_rng([seed, level, key])
    empty = (size == 0) & (part > 0) & (part < 1)
    part[empty] = rng.random(int(empty.sum())) < part[empty]
    mass = np.where(part < 1e-9, 0.0, np.where(part > 1 - 1e-9, size, part * size))
    for k in range(len(pdf)):
        after = k + 1
        while 0 < mass[k] < size[k]:
            open_ = after + np.flatnonzero((mass[after:] > 0) & (mass[after:] < size[after:]))
            if not len(open_) or _settle(mass, size, k, open_, rng.random()):
                break
    full = size > 0
    part[full] = mass[full] / size[full]
    return pdf.assign(part=part)


SCHEMA = "doc_id long, th long, source string, size long, source_size long, target double, whole long, part double, draw long, bucket long"


def mix(documents: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """doc_id, th, source, size, source_size, target and copies for every row."""
    spark = documents.sparkSession
    work = Scratch(spark, "mixing")
    rows = work.table(sizes(documents), "sizes")
    t = targets(work, rows, weights, most).withColumnRenamed("source", "source_")
    rows = rows.join(t, rows.source.eqNullSafe(t.source_)).drop("source_")
    rate = F.least(F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)), F.lit(float(most)))
    near = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    buckets = F.ceil(F.col("docs") / bucket)
    rows = rows.withColumn("draw", F.xxhash64("doc_id", "th", F.lit(seed))).select(
        "doc_id", "th", F.col("source").cast("string"), "size", "source_size", "target", F.floor(near).alias("whole"),
        (near - F.floor(near)).alias("part"), "draw", F.pmod("draw", buckets).alias("bucket"), buckets.alias("buckets"),
    )
    rounder = lambda n: lambda pdf: _round(pdf, n, seed)
    level, done = 0, []
    (left,) = rows.agg(F.max("buckets")).first()
    state = rows.drop("buckets")
    while True:
        step = work.table(state.groupBy("source", "bucket").applyInPandas(rounder(level), SCHEMA), f"level{level}")
        open_ = (F.col("part") > 0) & (F.col("part") < 1)
        done.append(step.where(~open_))
        level += 1
        if not left or left <= 1:
            break
        left = -(-left // FAN)
        state = step.where(open_).withColumn("bucket", F.floor(F.col("bucket") / FAN))
    # One open row at most for each source: taken with its own probability.
    u = F.pmod(F.xxhash64("doc_id", "th", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30)
    done.append(step.where(open_).withColumn("part", (u < F.col("part")).cast("double")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "th", "source", "size", "source_size", "target", (F.col("whole") + F.col("part").cast("long")).alias("copies"))


def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
