"""Arrivals: thinned events, keys as of an arrival, the log of what is known to exist, and checks that are cut off and taken up again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BUDGET = 90.0


def thinned(events: DataFrame, path: str, at: str, gap: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """path and at (a long) of the events that come `gap` or more after the last accepted one of their path.

    Each event points to the first one that could be accepted after it; what the first event of a path reaches is accepted.
    Pointers double every round, so a path of n accepted events takes log n joins, whatever its share of the rows.
    keep(df, name) writes a table and reads it again.
    """
    e = events.select(F.col(path).alias("path"), F.col(at).cast("long").alias("at")).where("path is not null and at is not null").distinct()
    # Events and their earliest successors' times, latest first: the least event so far is the one a time points to.
    both = e.select("path", "at", F.col("at").alias("event"), F.lit(None).cast("long").alias("of"))
    both = both.union(e.select("path", F.col("at") + gap, F.lit(None).cast("long"), F.col("at")))
    w = Window.partitionBy("path").orderBy(F.desc("at"), F.col("event").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    jump = both.withColumn("next", F.min("event").over(w)).where("of is not null and next is not null").select("path", F.col("of").alias("at"), "next")
    jump = keep(jump, "jumps")
    taken = keep(e.groupBy("path").agg(F.min("at").alias("at")), "taken")
    while True:
        reached = taken.join(jump, ["path", "at"]).select("path", F.col("next").alias("at")).join(taken, ["path", "at"], "left_anti")
        new = keep(reached, "reached")
        if new.isEmpty():
            return taken
        taken = keep(taken.union(new), "taken")
        to = jump.select("path", F.col("at").alias("next"), F.col("next").alias("next_"))
        jump = keep(jump.join(to, ["path", "next"]).select("path", "at", F.col("next_").alias("next")), "jumps")


def as_of(files: DataFrame, versions: DataFrame, key: str, at: str) -> DataFrame:
    """Files with the values of the last version of their key that was valid on arrival; null before the first.

    Both are laid in one order of time, and the last version so far is carried along, so no pairs of files and versions are made.
    """
    values = [c for c in versions.columns if c not in (key, at)]
    own = [c for c in files.columns if c not in (key, at)]
    none = lambda df, cs: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in cs]
    v = versions.select(key, at, *none(files, own), F.struct(*values).alias("version_"), F.lit(0).alias("side_"))
    f = files.select(key, at, *own, F.lit(None).cast(v.schema["version_"].dataType).alias("version_"), F.lit(1).alias("side_"))
    w = Window.partitionBy(key).orderBy(at, "side_").rowsBetween(Window.unboundedPreceding, 0)
    out = v.union(f).withColumn("version_", F.last("version_", True).over(w)).where("side_ = 1")
    return out.select(key, at, *own, *[F.col("version_")[c].alias(c) for c in values])


def compacted(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last entry of each key by `order`, tombstones (no `exists`) included, so that an older entry that comes late changes nothing.

    Compacting what is compacted, with the same or older entries, gives the same rows.
    """
    last = F.max_by(F.struct(*log.columns), F.struct(*order)).alias("r")
    return log.groupBy(key).agg(last).select("r.*")


def existing(compact: DataFrame) -> DataFrame:
    """What the log says today: no evicted keys."""
    return compact.where("exists is not null")


def cut_off(stages: DataFrame, file: str, stage: str, seconds: str, decided: str, budget: float = BUDGET) -> DataFrame:
    """file, passes, kept_stages, resumed_at, decided_at and seconds of checks that stop when their time is up and are taken up again.

    Stages run in order until one decides. The stage that passes the budget is left undone; what the earlier ones found is kept, and a second
    pass without limit goes on from there, so no stage that was done runs again.
    """
    w = Window.partitionBy(file).orderBy(stage)
    s = stages.withColumn("spent", F.sum(seconds).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("before", F.coalesce(F.max(F.col(decided).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("before = 0")
    late = F.col("spent") > budget
    g = s.groupBy(file).agg(
        F.min(F.when(late, F.col(stage))).alias("resumed_at"), F.count_if(~late).alias("kept_stages"),
        F.min(F.when(F.col(decided), F.col(stage))).alias("decided_at"), F.round(F.max("spent"), 6).alias("seconds"),
    )
    return g.select(file, F.when(F.col("resumed_at").isNull(), 1).otherwise(2).alias("passes"), "kept_stages", "resumed_at", "decided_at", "seconds")


def cut_off_stream(stages: DataFrame, budget: float = BUDGET) -> DataFrame:
    """cut_off() over a stream of (file, stage, seconds, decided, last): the captured state lives in Spark's state store between passes.

    A row for a file leaves when a stage decides or its last one is in; stages of a file may come in any order within a micro-batch.
    """
    state_of = "spent double, kept long, resumed long, done boolean"
    out = "file long, passes int, kept_stages long, resumed_at long, decided_at long, seconds double"

    def go(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spent, kept, resumed, done = state.get if state.exists else (0.0, 0, None, False)
        rows = []
        for r in pd.concat(list(batches)).sort_values("stage").itertuples(index=False):
            if done:
                break
            spent += r.seconds
            if spent > budget:
                resumed = int(r.stage) if resumed is None else resumed
            else:
                kept += 1
            if r.decided or r.last:
                done = True
                rows.append((key[0], 1 if resumed is None else 2, kept, resumed, int(r.stage) if r.decided else None, round(spent, 6)))
        state.update((float(spent), int(kept), resumed, done))
        names = [c.split()[0] for c in out.split(", ")]
        yield pd.DataFrame(rows, columns=names).astype({"resumed_at": "Int64", "decided_at": "Int64"})

    return stages.groupBy("file").applyInPandasWithState(go, out, state_of, "append", GroupStateTimeout.NoTimeout)


def held_back(candidates: DataFrame, doc: str, stage: str, name: Column) -> DataFrame:
    """Candidates without the plain ones of noisy stages that found many; they count when a stage that is not noisy finds them again."""
    from docroute.operators.evidence import noisy

    plain = F.col("tier") == "Standard"
    many = F.count_if(plain).over(Window.partitionBy(doc, stage))
    return candidates.withColumn("many_", many).where(~(plain & noisy(name, F.col("many_")))).drop("many_")
