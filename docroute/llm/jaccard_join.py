"""N-gram Jaccard join of documents by a MinHash LSH forest and exact verification.

A signature has TREES labels of DEPTH minima; a tree is the trie of its labels, whose nodes are the groups of labels with
one prefix. A document starts at the whole labels, where few others are, and goes up to shorter prefixes, one tree at a time and
the one first that adds the fewest documents, until a document of the wanted similarity is met in some tree with the
target recall. So where much is alike most prefixes stay long, and where a document is alone they are shortened at no cost.
The nodes asked for are buckets; candidates are verified on whole texts (near.py).

Texts with equal sets of shingles are one class and enter once, with their number of copies. A text of fewer than
five words has one shingle of all of them; null and empty texts have none, are linked to nothing and stand alone.
Rows that agree in doc_id and text are copies like others; `keep` is true for one row of each class. A null doc_id
is ordered first. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import SHINGLE, SIMILARITY, Scratch, as_bytes, fixed, minhashes, permutations, row_once, shingles, text_hash, word_hashes
from docroute.llm.near import class_keys, near_classes

TREES, DEPTH = 16, 5
RECALL = 0.999
SEED = 4


def depth_for(recall: float, similarity: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair of this similarity meets in some tree with at least this probability."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def chosen_depths(sizes: np.ndarray, recall: float, similarity: float, depth: int = DEPTH) -> np.ndarray:
    """The length of the prefix that each document (row) asks for in each tree (column).

    sizes[:, :, k] are the documents below the node of a prefix of depth - k minima. All rows are shortened alike, step by step,
    each in the tree where it meets the fewest more, as long as its recall is below the target.
    """
    miss = np.log(1 - similarity ** np.arange(depth + 1, dtype=float).clip(1))
    rows, trees, levels = sizes.shape
    up = np.zeros((rows, trees), np.int64)
    more = np.diff(sizes.astype(np.float64), axis=2, append=np.inf)
    while True:
        open_ = np.flatnonzero((miss[depth - up].sum(1) > np.log(1 - recall)) & (up < levels - 1).any(1))
        if not len(open_):
            return depth - up
        cost = np.take_along_axis(more[open_], up[open_][:, :, None], 2)[:, :, 0]
        up[open_, cost.argmin(1)] += 1


def forest(work: Scratch, classes: DataFrame, recall: float = RECALL, similarity: float = SIMILARITY) -> DataFrame:
    """bucket and key: the nodes of the tries that documents ask for, and all documents below them."""
    least = depth_for(recall, similarity)
    node = lambda t, d: F.xxhash64(F.lit(t), F.lit(d), F.substring("sig", 4 * DEPTH * t + 1, 4 * d))
    # From the shortest prefixes that may be needed, only those labels go on that share them with others.
    label = [F.struct(F.lit(t).alias("tree"), *[node(t, d).alias(f"n{d}") for d in range(least, DEPTH + 1)]) for t in range(TREES)]
    rows = classes.select("key", F.explode(F.array(*label)).alias("l")).select("key", "l.*")
    size = lambda d, rows: rows.groupBy(f"n{d}").agg(F.count("*").alias(f"s{d}"))
    shared = work.table(size(least, rows).where(f"s{least} > 1"), "nodes")
    held = work.table(rows.join(shared, f"n{least}"), "held")
    work.drop(shared)
    for d in range(least + 1, DEPTH + 1):
        one = work.table(size(d, held).where(f"s{d} > 1"), "nodes")
        new = work.table(held.join(one, f"n{d}", "left").withColumn(f"s{d}", F.coalesce(f"s{d}", F.lit(1).cast("long"))), "held")
        work.drop(one, held)
        held = new
    sizes = F.array(*[F.col(f"s{d}") for d in range(DEPTH, least - 1, -1)])
    names = F.array(*[F.col(f"n{d}") for d in range(DEPTH, least - 1, -1)])
    of = held.groupBy("key").agg(F.collect_list(F.struct("tree", sizes.alias("sizes"), names.alias("nodes"))).alias("trees"))  # TREES at most

    def ask(batches):
        for b in batches:
            keys, trees = b.column("key").to_pylist(), b.column("trees").to_pylist()
            all_ = np.ones((len(keys), TREES, DEPTH - least + 1), np.int64)
            for k, row in enumerate(trees):
                for x in row:
                    all_[k, x["tree"]] = x["sizes"]
            depths = chosen_depths(all_, recall, similarity)
            out = [x["nodes"][DEPTH - depths[k, x["tree"]]] for k, row in enumerate(trees) for x in row if all_[k, x["tree"], DEPTH - depths[k, x["tree"]]] > 1]
            yield pa.record_batch({"bucket": pa.array(out, pa.int64())})

    asked = work.table(of.mapInArrow(ask, "bucket long").distinct(), "asked")
    every = held.select("key", F.explode(names).alias("bucket"))
    out = work.table(every.join(asked, "bucket"), "forest")
    work.drop(held, asked)
    return out


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, th, key (of the set of shingles), n (shingles) and sig of every row."""

    def run(batches):
        memo, odd = word_hashes(), permutations(TREES * DEPTH, SEED)
        for b in batches:
            s, n = shingles([t.split() for t in b.column("text").to_pylist()], memo, SHINGLE)
            keys, sizes = class_keys(s, n)
            yield pa.record_batch({"doc_id": b.column("doc_id"), "th": b.column("th"), "key": pa.array(keys, pa.binary()), "n": pa.array(sizes), "sig": fixed(minhashes(s, n, odd))})

    rows = documents.select(F.col("doc_id").cast("long"), text_hash().alias("th"), as_bytes().alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, key binary, n long, sig binary")


def jaccard_join(documents: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, th, class_id, n_links and keep for every row.

    class_id: the least doc_id of the documents connected by links. n_links: the other rows whose similarity is
    `similarity` or more. keep: true for the row of least (doc_id, th) of a class.
    """
    work = Scratch(documents.sparkSession, "jaccard")
    rows = work.table(sketches(documents), "sketches")
    classes = rows.where("n > 0").groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
    classes = work.table(classes, "classes")
    nodes = forest(work, classes, recall, similarity)

    def fetch(members: DataFrame) -> DataFrame:
        d = documents.select(F.col("doc_id").cast("long").alias("doc_"), text_hash().alias("th_"), as_bytes().alias("text"))
        m = members.withColumns({"rep_doc": F.col("rep.doc_id"), "rep_th": F.col("rep.th")})
        return d.join(m.hint("merge"), (F.col("th_") == F.col("rep_th")) & F.col("doc_").eqNullSafe(F.col("rep_doc")))

    near = work.table(near_classes(work, classes, nodes, TREES * DEPTH, fetch, similarity), "near")
    named = work.table(classes.drop("sig").join(near, "key", "left").withColumn("component", F.coalesce("component", "key")), "members")
    first = work.table(named.groupBy("component").agg(F.min("rep").alias("first")), "first")
    named = work.table(named.join(first, "component").select("key", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    out = rows.drop("sig", "n").join(named, "key", "left")
    alone = F.col("first").isNull()
    keep = alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))
    out = out.select("doc_id", "th", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), keep.alias("keep"))
    return out


def distinct_documents(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns. Empty texts are no copies of each other and all stay."""
    kept = jaccard_join(documents, similarity).where("keep").select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).distinct()
    # The row travels as one struct, so that no column of it can clash with another.
    d = documents.select(F.struct(*documents.columns).alias("__row"), text_hash().alias("__own"), F.col("doc_id").cast("long").alias("__id"))
    out = d.join(kept.hint("merge"), (F.col("__own") == F.col("__th")) & F.col("__id").eqNullSafe(F.col("__doc")))
    empty = F.lit(text_hash(F.lit("")))
    out = out.withColumn("__once", row_once(["__th", "__doc"]))
    return out.where((F.col("__once") == 1) | (F.col("__own") == empty)).select("__row.*")


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    out = jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "class_id", "n_links")


ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) >= {SHINGLE} THEN list_transform(range(1, len(words) - {SHINGLE - 2}), lambda i: array_to_string(words[i:i + {SHINGLE - 1}], ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= {SIMILARITY} * (x.n + y.n - c) - 1e-9),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
k AS (SELECT a, min(b) AS b FROM r GROUP BY a),
l AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(k.b, doc_id)) AS class_id, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN k ON doc_id = k.a LEFT JOIN l ON doc_id = l.a"""
