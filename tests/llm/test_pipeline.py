"""The pipeline's stages, one after the other, on the smallest tables."""

from collections import Counter, defaultdict

import corpus_pipeline as P
from docroute.llm.common import Scratch
from docroute.llm.registry import ORACLES, QUERIES


def test_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries() and set(ORACLES) <= set(entry.oracle_sql())


def test_stages(spark, sf_dir):
    docs, work, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "t"), {}
    seen["documents"] = docs.toPandas()
    for name, stage in P.STAGES:
        docs = work.table(stage(spark, docs, sf_dir), name)
        seen[name] = docs.toPandas()
    names = [n for n, _ in P.STAGES]
    for n in names[:-1]:
        assert list(seen[n].columns) == P.COLUMNS
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    left = set(seen[names[0]]["doc_id"])
    good = [d in left for d, q in zip(labels["doc_id"], labels["quality"], strict=True) if q == 1]
    bad = [d in left for d, q in zip(labels["doc_id"], labels["quality"], strict=True) if q == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.2 * max(len(bad), 1)
    texts = seen[names[1]]["text"].tolist()
    assert len(texts) == len(set(texts)) and set(seen[names[1]]["doc_id"]) <= left
    before = dict(zip(seen[names[1]]["doc_id"], seen[names[1]]["text"], strict=True))
    for d, t, n in zip(seen[names[2]]["doc_id"], seen[names[2]]["text"], seen[names[2]]["n_chars"], strict=True):
        assert len(t) <= len(before[d]) and (t == before[d] or n == len(t))
    lines = Counter(x for t in seen[names[2]]["text"] for x in t.split("\n") if len(x.split()) >= 20)
    assert max(lines.values(), default=1) == 1
    taken = Counter(seen[names[3]]["doc_id"])
    assert max(taken.values()) <= 3
    packed = seen[names[4]]
    pieces = defaultdict(int)
    for d, k in zip(packed["doc_id"], packed["piece"], strict=True):
        pieces[d] += k == 0
    assert dict(pieces) == dict(taken)
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_joins_are_shuffled(spark, sf_dir):
    """A small table of the kind that grows is not broadcast by Spark itself, as each of these takes a thread of the driver."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    P.STAGES[0][1](spark, docs, sf_dir)
    plan = docs.join(docs.limit(3).select("doc_id"), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
