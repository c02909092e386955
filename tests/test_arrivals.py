"""Arrivals on small inputs: thinning, versions, compaction, cut-off checks as a batch and as a stream, noisy stages."""

import random

from pyspark.sql import functions as F

from docroute.operators import arrivals as A


def keeper(spark, tmp_path):
    count = iter(range(1000))

    def keep(df, name):
        path = f"{tmp_path}/{name}-{next(count)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


def test_thinning_of_one_hot_path(spark, tmp_path):
    rnd = random.Random(1)
    rows = [("hot", rnd.randrange(40_000)) for _ in range(700)] + [("b", 5), ("b", 5), (None, 3), ("c", None)]
    got = A.thinned(spark.createDataFrame(rows, "file string, us long"), "file", "us", 800, keeper(spark, tmp_path))
    want, last = [("b", 5)], None
    for at in sorted(x for p, x in rows if p == "hot"):
        if last is None or at - last >= 800:
            want.append(("hot", at))
            last = at
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_versions_as_of_arrival(spark):
    files = spark.createDataFrame([("a", 5, 1), ("a", 9, 2), ("a", 1, 3), ("b", 4, 4)], "k string, at long, file long")
    versions = spark.createDataFrame([("a", 5, "x", 1), ("a", 7, None, 2), ("c", 1, "z", 3)], "k string, at long, awb string, n int")
    got = {r["file"]: (r["awb"], r["n"]) for r in A.as_of(files, versions, "k", "at").collect()}
    assert got == {1: ("x", 1), 2: (None, 2), 3: (None, None), 4: (None, None)}


def test_compaction_is_idempotent(spark):
    log = spark.createDataFrame([("a", True, 1), ("a", None, 3), ("b", False, 2), ("b", True, 5), ("c", None, 1)], "awb string, exists boolean, at int")
    once = A.compacted(log, "awb", ["at"])
    again = A.compacted(once.unionByName(log.where("at < 4")), "awb", ["at"])
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(once) == rows(again) == [("a", None, 3), ("b", True, 5), ("c", None, 1)]
    assert rows(A.existing(once)) == [("b", True, 5)]


def test_cut_off_stream_equals_batch(spark, tmp_path):
    rnd = random.Random(2)
    rows = []
    for file in range(40):
        n = rnd.randrange(1, 9)
        rows += [(file, k, float(rnd.randrange(1, 50)), rnd.random() < 0.15, k == n - 1) for k in range(n)]
    df = spark.createDataFrame(rows, "file long, stage long, seconds double, decided boolean, last boolean")
    # Stages reach the stream in their order, some files' passes split over several micro-batches.
    for part in range(3):
        df.where((F.col("stage") >= 3 * part) & (F.col("stage") < 3 * part + 3)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = A.cut_off_stream(s).writeStream.format("memory").queryName("cut_off").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(200)
    got = sorted(map(tuple, spark.table("cut_off").collect()))
    want = A.cut_off(df, "file", "stage", "seconds", "decided")
    assert got == sorted(map(tuple, want.select("file", "passes", "kept_stages", "resumed_at", "decided_at", "seconds").collect()))
    assert {r[1] for r in got} == {1, 2}


def test_noisy_stages_are_held_back(spark):
    c = [(1, 0, str(k), "Standard") for k in range(5)] + [(1, 0, "h", "High"), (1, 1, "2", "Standard"), (1, 2, "9", "Standard")] + [(2, 0, str(k), "Standard") for k in range(3)]
    df = spark.createDataFrame(c, "doc int, stage int, candidate string, tier string")
    kept = lambda name: {(r["doc"], r["stage"], r["candidate"]) for r in A.held_back(df, "doc", "stage", F.when(F.col("stage") == 0, name).otherwise("OCR")).collect()}
    rest = {(1, 0, "h"), (1, 1, "2"), (1, 2, "9"), (2, 0, "0"), (2, 0, "1"), (2, 0, "2")}
    assert kept("Rotation-180") == rest
    assert kept("AirwayLabel-Rotation-180") == {r[:3] for r in c} == kept("OCR-Main")


def test_close_keys_under_one_prefix(spark):
    """All keys share six digits and more: the same pairs as from all pairs, however few make a crowd."""
    from docroute.operators.resolve import close_keys

    rnd = random.Random(5)
    keys = [f"123456{rnd.randrange(10**6):06d}" for _ in range(3000)]
    asked = [k[:6] + "".join(c if rnd.random() < 0.8 else str(rnd.randrange(10)) for c in k[6:]) for k in rnd.sample(keys, 60)] + ["123456000000", "923456000000", "124456111111"]
    df = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    want = {(a, b, far(a, b)) for a in asked for b in set(keys) if far(a, b) <= 2 and (a[:4] == b[:4] or a[8:] == b[8:] or not any(a[:4] == k[:4] or a[8:] == k[8:] for k in keys))}
    for heavy in (50_000, 100):
        got = list(map(tuple, close_keys(df(asked, "candidate"), df(keys, "awb"), heavy=heavy).collect()))
        assert len(got) == len(set(got)) and set(got) == want
