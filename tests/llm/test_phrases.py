"""Phrase collocations: bitmaps against plain counts, in one shard and in many, and awkward rows."""

import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from docroute.llm import phrases as ph


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    most = Counter()
    for (lang, p), v in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i : i + k]] = max(most[lang, p[i : i + k]], v)
    out = {}
    for (lang, p), a in cand.items():
        if (lang, p) in most and 100 * most[lang, p] >= 80 * a:
            continue
        cuts = [(Fraction(2_000_000 * a, f[lang, p[:k]] + f[lang, p[k:]]).__floor__(), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
        for lang, found in out.items() for i, x in enumerate(sorted(found)[:top])
    }


def text(rnd, words, many):
    return "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"]) for _ in range(many))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    words = ["The", "the", "of", "new", "York", "Ä", "ä", "x y", "😀", "a\\", "[b]", "'", "%", "é"]
    out = [(rnd.choice(["en", "fr", None]), text(rnd, words, rnd.randrange(1, 120))) for _ in range(150)]
    out += [("en", None), ("en", ""), ("fr", " .;\n"), ("de", "alone"), ("en", "go " * 3000), ("en", text(rnd, words, 4000))]
    out += [("en", "same row twice, the same row twice")] * 40
    return out


@pytest.mark.parametrize(("shard", "least", "top"), [(ph.SHARD, 3, 2000), (64, 3, 50), (500, 30, None)])
def test_against_plain_counts(spark, rows, shard, least, top):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6).selectExpr("*", "'clash' AS n", "'clash' AS word", "'clash' AS shard", "'clash' AS a")
    got = {tuple(r) for r in ph.collocations(df, least, top, shard).collect()}
    assert got == plain(rows, least, top)


def test_no_rows(spark):
    assert ph.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert ph.collocations(spark.createDataFrame([("en", None), (None, "few words")], "lang string, text string")).count() == 0


def test_query_and_sql(spark, rows, tmp_path):
    spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in ph.op12_phrase_collocations(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = set(con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({ph.ORACLE})").fetchall())
    assert got == want and len(got) > 20


def test_bitmaps_pack_and_shift():
    rnd = np.random.default_rng(1)
    ids = rnd.integers(0, 5, 3000)
    word, block, bits = ph.merged(ids, np.arange(3000) >> 5, np.left_shift(np.uint32(1), (np.arange(3000) & 31).astype(np.uint32)))
    code, rest = ph.pack(bits)
    assert (ph.unpack(code, rest) == bits).all() and len(rest) < len(bits)
    maps = ph.Bitmaps(np.bincount(word), block, bits)
    got = Counter()
    for a, b, n in ph.pairs(maps, 2000):
        got.update(dict(zip(zip(a.tolist(), b.tolist()), n.tolist())))
    assert got == Counter(zip(ids[:2000].tolist(), ids[1:2001].tolist()))


def test_long_texts_come_in_runs():
    words = [b"w%d" % i for i in range(1000)]
    parts = list(ph.runs(b" ".join(words), 100))
    assert b" ".join(w for found, own in parts for w in found[:own]) == b" ".join(words)
    assert all(found[own : own + 3] == nxt[:3] for (found, own), (nxt, _) in zip(parts, parts[1:]))
