"""Close keys against a plain distance, and key tables that stay off the driver."""

import random

from docroute.operators import resolve


def _far(a, b):
    return sum(x != y for x, y in zip(a, b, strict=True))


def test_distances_and_merged_keys(spark, tmp_path):
    r = random.Random(4)
    keys = sorted({"".join(r.choice("0123456789") for _ in range(12)) for _ in range(60)})
    change = lambda k, n: "".join(r.choice("0123456789") if i in at else c for at in [r.sample(range(12), n)] for i, c in enumerate(k))
    cands = sorted({change(k, n) for k in keys for n in (0, 1, 2, 2, 3)} | {"O" + keys[0][1:]})
    spark.createDataFrame([(k,) for k in keys], "awb string").write.parquet(f"file://{tmp_path}/keys")
    table, c = spark.read.parquet(f"file://{tmp_path}/keys"), spark.createDataFrame([(x,) for x in cands], "candidate string")
    ends = {k[:4] for k in keys}, {k[8:] for k in keys}
    pooled = lambda x: x[:4] in ends[0] or x[8:] in ends[1]
    want = {(x, k, _far(x, k)) for x in cands for k in keys if _far(x, k) <= 2 and (not pooled(x) or x[:4] == k[:4] or x[8:] == k[8:])}
    for heavy in (resolve.HEAVY, 0):
        close = resolve.close_keys(c, table, heavy=heavy)
        assert {tuple(x) for x in close.collect()} == want and close.count() == len(want)
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    # Keys were broadcast through the driver, and a distance was counted character by character.
    texts = spark.createDataFrame([(1, "AWB 123456789012")], "file_id long, text string")
    assert "Broadcast" not in plan(resolve.tiered_candidates(texts, table, "file_id"))
    assert "aggregate(" not in plan(resolve.close_keys(c, table)) and plan(resolve.close_keys(c, table)).count("BroadcastHashJoin") == 1  # the ends
