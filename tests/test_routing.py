"""Perceptual hashes meet without a table that grows with them on the driver."""

import random

from pyspark.sql import functions as F

from docroute.operators import routing as R


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_near_hashes_are_not_broadcast(spark, tmp_path):
    """A side of 68 rows a hash looks as small to Spark as the hashes are, and was broadcast through the driver."""
    r = random.Random(1)
    some = [r.getrandbits(63) for _ in range(60)]
    rows = [(i, h ^ sum(1 << b for b in r.sample(range(63), r.choice([0, 2, 9, 10, 11])))) for i, h in enumerate(some * 3)]
    spark.createDataFrame(rows, "id long, h long").write.parquet(f"file://{tmp_path}/h")
    df = spark.read.parquet(f"file://{tmp_path}/h")
    pairs = R.phash_pairs(df, df)
    assert "Broadcast" not in _plan(pairs)
    assert "Broadcast" not in _plan(R.near_hashes(df.select("h", F.lit(1).alias("key")), df.select("h", F.lit(1).alias("key")), "key"))
    want = {(a, b, (x ^ y).bit_count()) for a, x in rows for b, y in rows if (x ^ y).bit_count() <= 10}
    assert {tuple(x) for x in pairs.collect()} == want and pairs.count() == len(want)
