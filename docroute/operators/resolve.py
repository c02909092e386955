"""Resolution of candidates to keys: exact tiers, bounded Hamming distance with ties, stages, persistence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.functions import extract as X

HIGH_DISTANCE, STANDARD_DISTANCE = 2, 1
HIGH_HITS_NEAR, HIGH_HITS_FAR, STANDARD_HITS = 1, 2, 2


def tiered_candidates(texts: DataFrame, keys: DataFrame, *ids: str) -> DataFrame:
    """ids, candidate, tier (High, Standard) and known (is a key) for rows with `text`.

    High: behind a label or next to a keyword. Windows of longer digit runs count only if they are keys.
    """
    t = texts.select(
        *ids, "text",
        X.aci_candidates("text").alias("aci"), X.label_candidates("text").alias("label"), X.carrier_candidates("text").alias("carrier"), X.windows_of_12("text").alias("windows"),
    )
    t = t.select(*ids, "text", "windows", F.array_distinct(F.concat("label", "aci", "carrier")).alias("labelled"), X.text_candidates("text", F.col("aci")).alias("plain"))
    t = t.withColumn("promoted", X.keyword_adjacent("text", F.array_union("plain", "windows")))
    c = t.select(*ids, "labelled", "plain", "promoted", F.explode(F.array_distinct(F.concat("labelled", "plain", "windows"))).alias("candidate"))
    has = lambda a: F.array_contains(a, F.col("candidate"))
    c = c.select(*ids, "candidate", has("labelled").alias("labelled"), has("plain").alias("plain"), has("promoted").alias("promoted"))
    # Keys grow with the texts, and Spark takes a table of made strings for a small one.
    c = c.where(~X.disqualified(F.col("candidate"))).join(keys.select(F.col("awb").alias("candidate"), F.lit(True).alias("known")).distinct().hint("merge"), "candidate", "left")
    c = c.withColumn("known", F.coalesce("known", F.lit(False))).where(F.col("labelled") | F.col("plain") | F.col("known"))
    c = c.withColumn("tier", F.when(F.col("labelled") | F.col("promoted"), "High").otherwise("Standard"))
    return c.where((F.col("tier") == "High") | ~X.date_like(F.col("candidate"))).select(*ids, "candidate", "tier", "known")


def _unequal_bytes(bits: Column) -> Column:
    """How many of six bytes are not 0: the bits of a byte are gathered in its lowest one."""
    for n in (4, 2, 1):
        bits = bits.bitwiseOR(F.shiftright(bits, n))
    return F.bit_count(bits.bitwiseAND(F.lit(0x010101010101)))


#: Keys that may share six digits before two more tell them apart.
HEAVY = 50_000


def close_keys(candidates: DataFrame, keys: DataFrame, most: int = HIGH_DISTANCE, heavy: int = HEAVY) -> DataFrame:
    """candidate, awb, distance of keys within `most` (2 at most) of each candidate.

    The pool is the keys that share the first or last four digits; only a candidate without any such key is compared
    to all. Of four blocks of three digits, two errors leave two unhurt: pairs meet by six of the twelve digits, at the
    first two blocks that they share, in an equi-join of a million values and more. Where over `heavy` keys share these six digits,
    the other six are three parts of two, of which two errors leave one unhurt, and pairs meet by that part as well, the first that
    they share. Pairs grow with keys and candidates, so they are two numbers a side, each six characters of one byte: what differs is told by
    their bits, and texts are made of the few that are close. The ends that keys have are 20,000 at most.
    """
    if most > 2:
        raise ValueError("four blocks find two errors at most")
    two = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    block = lambda c, i: F.substring(c, 3 * i + 1, 3)
    halves = lambda c: [F.concat(block(c, i), block(c, j)) for i, j in two]
    half = lambda c, at: F.conv(F.hex(F.substring(c, at, 6)), 16, 10).cast("long")
    cut = lambda df, c: df.select(c).distinct().select(F.posexplode(F.array(*halves(c))).alias("b", "block"), half(c, 1).alias(f"{c}_1"), half(c, 7).alias(f"{c}_2"))
    text = lambda c: F.concat(*[F.unhex(F.lpad(F.hex(f"{c}_{k}"), 12, "0")).cast("string") for k in (1, 2)])
    left, right = cut(candidates, "candidate"), cut(keys, "awb")
    numbers = [f"{c}_{k}" for c in ("candidate", "awb") for k in (1, 2)]
    crowded = right.groupBy("b", "block").agg(F.count("*").alias("members")).where(F.col("members") > heavy).select("b", "block")
    rest = lambda c: F.element_at(F.array(*[F.concat(*[block(text(c), k) for k in range(4) if k not in p]) for p in two]), F.col("b") + 1)
    parts = lambda c: F.array(*[F.substring(rest(c), 2 * k + 1, 2) for k in range(3)])
    spread = lambda df, c: df.join(crowded, ["b", "block"]).select("b", "block", f"{c}_1", f"{c}_2", F.posexplode(parts(c)).alias("part", "digits"))
    same = F.array_position(F.zip_with(parts("candidate"), parts("awb"), lambda x, y: x == y), F.lit(True)) - 1
    dense = spread(left, "candidate").join(spread(right, "awb").hint("merge"), ["b", "block", "part", "digits"]).where(F.col("part") == same).select("b", *numbers)
    if keys.limit(heavy + 1).count() <= heavy or crowded.isEmpty():  # no block is crowded: the plain join gives the same pairs
        pairs = left.join(right.hint("merge"), ["b", "block"])
    else:
        pairs = left.join(right.join(crowded, ["b", "block"], "left_anti").hint("merge"), ["b", "block"]).select("b", *numbers).union(dense)
    apart = [F.col(f"candidate_{k}").bitwiseXOR(F.col(f"awb_{k}")) for k in (1, 2)]
    blocks = [x for a in apart for x in (F.shiftright(a, 24), a.bitwiseAND(F.lit(0xFFFFFF)))]  # 0: the same three characters
    first = F.lit(None).cast("int")
    for k, (i, j) in reversed(list(enumerate(two))):
        first = F.when((blocks[i] == 0) & (blocks[j] == 0), F.lit(k)).otherwise(first)
    pairs = pairs.where(F.col("b") == first).withColumn("distance", _unequal_bytes(apart[0]) + _unequal_bytes(apart[1])).where(F.col("distance") <= most)
    pairs = pairs.select(text("candidate").alias("candidate"), text("awb").alias("awb"), "distance")
    ends = lambda c: F.array(F.concat(F.lit("a"), F.substring(c, 1, 4)), F.concat(F.lit("z"), F.substring(c, 9, 4)))
    known = F.broadcast(keys.select(F.explode(ends("awb")).alias("end")).distinct())
    pooled = candidates.select("candidate").distinct().select("candidate", F.explode(ends("candidate")).alias("end")).join(known, "end", "left_semi").select("candidate").distinct()
    pairs = pairs.join(pooled.withColumn("pooled", F.lit(True)), "candidate", "left")
    return pairs.where(F.col("pooled").isNull() | F.arrays_overlap(ends("candidate"), ends("awb"))).select("candidate", "awb", "distance")


def tolerance(candidates: DataFrame, close: DataFrame, most: int, *ids: str) -> DataFrame:
    """ids with distance, keys (sorted) at the least distance, and hits: most stages of the candidates behind them.

    candidates: ids, candidate, hits.
    """
    c = candidates.join(close.where(F.col("distance") <= most), "candidate")
    best = c.withColumn("least", F.min("distance").over(Window.partitionBy(*ids))).where("distance = least")
    return best.groupBy(*ids).agg(F.min("distance").alias("distance"), F.array_sort(F.collect_set("awb")).alias("keys"), F.max("hits").alias("hits"))


def prioritize(candidates: DataFrame, keys: DataFrame, *ids: str, include_tolerance: bool = True) -> DataFrame:
    """ids, status (matched, tie, none), awb, method, distance, hits, ties. candidates: ids, candidate, tier, known, hits.

    Candidates are read several times and cost far more than they weigh: pass a table that is written or persisted
    (and is released by whoever did so). Close keys are only looked for where no exact match decides.
    """
    found = lambda tier: F.array_sort(F.collect_set(F.when(F.col("known") & (F.col("tier") == tier), F.col("candidate"))))
    per = candidates.groupBy(*ids).agg(found("High").alias("high"), found("Standard").alias("std"), F.countDistinct(F.when(F.col("tier") == "Standard", F.col("candidate"))).alias("n_std"))
    verdict = lambda ks, method, ok=None, d=None, h=None: [
        (F.size(ks) > 1, F.struct(F.lit("tie").alias("status"), F.lit(None).cast("string").alias("awb"), F.lit(method).alias("method"), F.lit(None).cast("int").alias("distance"), F.lit(None).cast("long").alias("hits"), ks.alias("ties"))),
        ((F.size(ks) == 1) & (F.lit(True) if ok is None else ok), F.struct(F.lit("matched").alias("status"), F.get(ks, 0).alias("awb"), F.lit(method).alias("method"), (F.lit(None) if d is None else d).cast("int").alias("distance"), (F.lit(None) if h is None else h).cast("long").alias("hits"), F.lit(None).cast("array<string>").alias("ties"))),
    ]
    cases = [*verdict(F.col("high"), "Exact-High"), *verdict(F.col("std"), "Exact-Standard")]
    if include_tolerance:
        undecided = candidates.join(per.where((F.size("high") == 0) & (F.size("std") == 0)).select(*ids), list(ids), "left_semi")
        close = close_keys(undecided, keys)
        h = tolerance(undecided.where("tier = 'High'"), close, HIGH_DISTANCE, *ids).select(*ids, F.struct("distance", "keys", "hits").alias("th"))
        s = tolerance(undecided.where("tier = 'Standard'"), close, STANDARD_DISTANCE, *ids).select(*ids, F.struct("distance", "keys", "hits").alias("ts"))
        per = per.join(h, list(ids), "left").join(s, list(ids), "left")
        enough = F.col("th.hits") >= F.when(F.col("th.distance") <= 1, HIGH_HITS_NEAR).otherwise(HIGH_HITS_FAR)
        cases += verdict(F.col("th.keys"), "Tolerance2-High", enough, F.col("th.distance"), F.col("th.hits"))
        cases += verdict(F.col("ts.keys"), "Tolerance2-Standard", (F.col("ts.hits") >= STANDARD_HITS) & (F.col("n_std") == 1), F.col("ts.distance"), F.col("ts.hits"))
    none = F.struct(F.lit("none").alias("status"), F.lit(None).cast("string").alias("awb"), F.lit(None).cast("string").alias("method"), F.lit(None).cast("int").alias("distance"), F.lit(None).cast("long").alias("hits"), F.lit(None).cast("array<string>").alias("ties"))
    out = F.coalesce(*[F.when(c, v) for c, v in cases], none)
    return per.select(*ids, out.alias("v")).select(*ids, "v.*")


def accumulate(candidates: DataFrame, doc: str, stage: str) -> DataFrame:
    """Pools after each stage: doc, stage, candidate, tier, known, hits.

    A candidate stays once seen, High once High, and hits counts the stages that saw it so far. candidates: doc, stage,
    candidate, tier, known.
    """
    stages = candidates.groupBy(doc).agg(F.array_sort(F.collect_set(stage)).alias("all_stages"))
    seen = candidates.groupBy(doc, "candidate").agg(
        F.max("known").alias("known"), F.collect_set(stage).alias("seen"), F.min(F.when(F.col("tier") == "High", F.col(stage))).alias("high_from"), F.min(stage).alias("since")
    )
    rows = seen.join(stages, doc).withColumn(stage, F.explode("all_stages")).where(F.col(stage) >= F.col("since"))
    return rows.select(
        doc, stage, "candidate", F.when(F.col("high_from") <= F.col(stage), "High").otherwise("Standard").alias("tier"), "known",
        F.size(F.filter("seen", lambda x: x <= F.col(stage))).cast("long").alias("hits"),
    )


def first_decisive(verdicts: DataFrame, doc: str, stage: str) -> DataFrame:
    """The verdict of the first stage that matched or tied; none otherwise."""
    v = F.struct(F.col(stage).alias("stage"), "status", "awb", "method", "distance", "hits", "ties")
    best = verdicts.groupBy(doc).agg(F.min_by(v, F.when(F.col("status") != "none", F.col(stage))).alias("v"))
    return best.select(doc, F.coalesce("v.status", F.lit("none")).alias("status"), "v.awb", "v.method", "v.stage", "v.distance", "v.hits", "v.ties")
