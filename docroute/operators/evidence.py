"""Evidence around candidates: boxes and reading order, rotation probes, quality of a source, persistence, snapshots, cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.functions.extract import CONFUSED, MEANT

ROTATION_MARGIN, CERTAIN, LIKELY = 80, 300, 120
NOISY_STAGES, TRUSTED_STAGES, NOISY_CANDIDATES = "Invert|AngFallback|Rotation-180|Rotation-270", "AirwayLabel|ROI", 3
ROW_HEIGHT = 10


def reading_order(words: DataFrame, doc: str) -> DataFrame:
    """doc, text: words (token, x, y) by rows of ROW_HEIGHT and then from left to right."""
    at = F.struct((F.bround(F.col("y") / ROW_HEIGHT) * ROW_HEIGHT).alias("row"), "x", "token")
    return words.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(at)), lambda w: w["token"]), " ").alias("text"))


def box_neighbours(words: DataFrame, doc: str, is_label: Column, width: int = 1400, height: int = 40, below: int = 120) -> DataFrame:
    """doc, label_x, label_y, token: tokens on a label's row or just below it, within reach to the sides."""
    label = words.where(is_label).select(doc, F.col("x").alias("label_x"), F.col("y").alias("label_y"))
    dy = F.col("y") - F.col("label_y")
    near = ((F.abs(dy) <= height) | dy.between(0, below)) & (F.abs(F.col("x") - F.col("label_x")) <= width)
    return words.join(label, doc).where(near).select(doc, "label_x", "label_y", "token", "x", "y")


def turned_hint(words: DataFrame, doc: str) -> DataFrame:
    """doc, turned: the words spread more than 1.5 times as far down as across."""
    g = words.groupBy(doc).agg((F.max("y") - F.min("y")).alias("dy"), (F.max("x") - F.min("x")).alias("dx"))
    return g.select(doc, (F.col("dy") > 1.5 * F.col("dx")).alias("turned"))


def probe_score(digits: Column, keywords: Column, words: Column) -> Column:
    return digits + 120 * keywords + 2 * words


def rotation_probe(angles: DataFrame, doc: str) -> DataFrame:
    """doc, angle, margin, certainty, order from rows (doc, angle, score); an angle that was not probed scores 0.

    Upright stays unless another angle leads by ROTATION_MARGIN. Order: the chosen angle, then the others by score.
    """
    score = lambda a: F.coalesce(F.max(F.when(F.col("angle") == a, F.col("score"))), F.lit(0))
    g = angles.groupBy(doc).agg(*[score(a).alias(f"s{a}") for a in (0, 90, 180, 270)])
    best = F.array_sort(F.array(*[F.struct((-F.col(f"s{a}")).alias("low"), F.lit(a).alias("angle")) for a in (0, 90, 180, 270)]))
    g = g.withColumn("by", best)
    lead = F.get("by", 0)
    angle = F.when(-lead["low"] - F.col("s0") >= ROTATION_MARGIN, lead["angle"]).otherwise(F.lit(0))
    margin = F.get("by", 1)["low"] - lead["low"]
    g = g.select(doc, angle.alias("angle"), margin.alias("margin"), "by")
    rest = F.filter(F.transform("by", lambda x: x["angle"]), lambda a: a != F.col("angle"))
    return g.select(doc, "angle", "margin", F.when(F.col("margin") >= CERTAIN, "CERTAIN").when(F.col("margin") >= LIKELY, "LIKELY").otherwise("UNCERTAIN").alias("certainty"), F.concat(F.array("angle"), rest).alias("order"))


def noisy(stage: Column, standard: Column) -> Column:
    """Whether a stage's plain candidates are held back: a desperate stage with many of them."""
    return stage.rlike(NOISY_STAGES) & ~stage.rlike(TRUSTED_STAGES) & (standard > NOISY_CANDIDATES)


def persistent(pools: DataFrame, existing: DataFrame, doc: str) -> DataFrame:
    """doc, status, awb, ties: High candidates of two stages or more that the archive knows. existing: awb."""
    c = pools.where((F.col("tier") == "High") & (F.col("hits") >= 2)).join(existing.select(F.col("awb").alias("candidate")).distinct(), "candidate", "left_semi")
    g = c.groupBy(doc).agg(F.array_sort(F.collect_set("candidate")).alias("found"))
    one = F.size("found") == 1
    return g.select(doc, F.when(one, "matched").otherwise("tie").alias("status"), F.when(one, F.get("found", 0)).alias("awb"), F.when(~one, F.array_join("found", ",")).alias("ties"))


def snapshots(candidates: DataFrame, *ids: str, most: int = 20) -> DataFrame:
    """ids, n, sample: how many candidates a stage saw and the first ones in order."""
    g = candidates.groupBy(*ids).agg(F.array_sort(F.collect_set("candidate")).alias("c"))
    return g.select(*ids, F.size("c").cast("long").alias("n"), F.array_join(F.slice("c", 1, most), ",").alias("sample"))


def cache_hits(files: DataFrame, by: list[str], key: str, cacheable: Column) -> DataFrame:
    """Add hit: the file before, in order of `by` after the first, had the same key and its snapshot could be kept."""
    first, *order = by
    w = Window.partitionBy(first).orderBy(*order)
    return files.withColumn("hit", F.coalesce((F.lag(key).over(w) == F.col(key)) & F.lag(cacheable).over(w), F.lit(False)))


def may_delete(copies: DataFrame, by: str) -> DataFrame:
    """by, copied, expected, ok: sources go only when nothing failed and all expected copies are there."""
    g = copies.groupBy(by).agg(F.count_if("done").alias("copied"), F.count("*").alias("expected"))
    return g.withColumn("ok", F.col("copied") == F.col("expected"))


def confuse(key: Column, start: Column) -> Column:
    """The key with one digit, the first confusable one from a place (0-based) on, written as a letter that means it."""
    swaps = {d: c for c, d in reversed(list(zip(CONFUSED, MEANT, strict=True)))}
    letters = F.create_map(*[F.lit(x) for kv in swaps.items() for x in kv])
    places = F.filter(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: (i + start) % 12 + 1), lambda p: letters[F.substring(key, p, F.lit(1))].isNotNull())
    p = F.get(places, 0)
    return F.when(p.isNull(), key).otherwise(F.concat(F.substring(key, F.lit(1), p - 1), letters[F.substring(key, p, F.lit(1))], F.substring(key, p + 1, F.lit(12))))


def grouped(token: Column, mark: Column) -> Column:
    return F.concat_ws("", F.substring(token, 1, 4), mark, F.substring(token, 5, 4), mark, F.substring(token, 9, 4))


def diagnose(cases: DataFrame, candidates: DataFrame) -> DataFrame:
    """file_id, n_high, n_std, in_high, in_std, known_high, known_std: where a case's expected key was seen, and how many candidates there were.

    cases: file_id, expected; candidates: file_id, candidate, tier, known.
    """
    c = cases.join(candidates, "file_id", "left")
    high, hit = F.col("tier") == "High", F.col("candidate") == F.col("expected")
    some = lambda x: F.coalesce(F.bool_or(x), F.lit(False))
    return c.groupBy("file_id").agg(
        F.count_if(high).alias("n_high"), F.count_if(F.col("tier") == "Standard").alias("n_std"), some(hit & high).alias("in_high"), some(hit & ~high).alias("in_std"),
        some(hit & high & F.col("known")).alias("known_high"), some(hit & ~high & F.col("known")).alias("known_std"),
    )


def synthetic_cases(keys: DataFrame, positives: int, negatives: int, seed: int) -> DataFrame:
    """kind (forced, positive, negative), expected, text: cases for a key reader, the same for the same keys and seed.

    Keys are picked by a seeded hash. Forced cases show each confusable digit once, in the first picked key that has it; positive
    ones have one letter for a digit; negative ones are numbers that are no keys.
    """
    salt = F.lit(f"|{seed}")
    order = F.md5(F.concat("awb", salt).cast("binary"))
    picked = keys.select("awb", order.alias("o")).orderBy("o", "awb").limit(positives)
    letter = {d: c for c, d in reversed(list(zip(CONFUSED, MEANT, strict=True)))}
    digits = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(c).alias("c")) for d, c in sorted(letter.items())]))
    each = picked.select("o", "awb", digits.alias("x")).where(F.contains("awb", F.col("x.d")))
    forced = each.groupBy("x").agg(F.min(F.struct("o", "awb")).alias("k")).select(F.lit("forced").alias("kind"), F.col("k.awb").alias("expected"), "x")
    at = F.instr(F.col("expected"), F.col("x.d"))
    forced = forced.select("kind", "expected", F.concat(F.substring("expected", F.lit(1), at - 1), F.col("x.c"), F.substring("expected", at + 1, F.lit(12))).alias("token"))
    changed = picked.select(F.lit("positive").alias("kind"), F.col("awb").alias("expected"), confuse(F.col("awb"), F.substring("awb", 11, 2).cast("int") % 12).alias("token"))
    wrong = keys.sparkSession.range(negatives).select(F.substring(F.translate(F.md5(F.concat(F.lit("n"), F.col("id").cast("string"), salt).cast("binary")), "abcdef", "012345"), 1, 12).alias("token"))
    wrong = wrong.join(keys.select(F.col("awb").alias("token")), "token", "left_anti").select(F.lit("negative").alias("kind"), F.lit(None).cast("string").alias("expected"), "token")
    head = F.when(F.col("kind") == "negative", "Customer id ").otherwise("AWB NUMBER: ")
    return forced.union(changed).union(wrong).select("kind", "expected", F.concat(head, "token").alias("text"))
