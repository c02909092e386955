"""Next fit over blocks against a plain loop, with one run that holds nearly all rows."""

import random

import pytest
from pyspark.sql import functions as F

from docroute.operators import batching


def plain(rows, capacity):
    out, last = [], None
    for tier, k, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        if last is None or last[0] != tier:
            last = (tier,)
            seq, batch, used = 0, 1, 0
        if used > 0 and used + (n or 0) > capacity:
            batch, used = batch + 1, 0
        seq += 1
        out.append((tier, k, n, seq, batch, used + 1))
        used += n or 0
    return out


@pytest.mark.parametrize("capacity", [1, 7, 48])
def test_next_fit_of_a_hot_run(spark, capacity):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one block
    try:
        hot_run(spark, capacity)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def hot_run(spark, capacity):
    rnd = random.Random(capacity)
    rows = [(rnd.choice(["a"] * 30 + ["b", None, "c"]), k, rnd.choice([None, 0, 0, *range(1, 14), 60])) for k in range(6000)]
    df = spark.createDataFrame(rows, "tier string, k int, pages int")
    got = batching.next_fit(df, ["tier"], ["k"], "pages", capacity)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows, capacity), key=str)
    # The hot run is dealt over tasks: none has much more than its share.
    parts = got.where("tier = 'a'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 5000


def test_next_fit_of_few_rows(spark):
    df = spark.createDataFrame([(1, 5)], "k int, pages int")
    assert list(map(tuple, batching.next_fit(df, [], ["k"], "pages").collect())) == [(1, 5, 1, 1, 1)]
    assert batching.next_fit(df.limit(0), [], ["k"], "pages").count() == 0
