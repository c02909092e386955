"""Prefilter against a plain form, added batches call by call, and texts of finished audits."""

import datetime as dt
import json
import random
from collections import Counter

from docroute.operators import audit as A
from docroute.operators import closing as C
from docroute.operators import prefilter as P

_INC = "awb string, file_id long, page_no int, exempt boolean, page_hash string, phash long, text string"
_ARC = "awb string, doc long, doc_page int, page_hash string, phash long, text string"


def _top_numbers(pages):
    """pages: texts in page order; words are numbers already."""
    seen = Counter(w for t in pages for w in (t or "").split() if w.isdigit() and 6 <= len(w) <= 16)
    return {w for w, _ in seen.most_common(12)}


def _plain(inc, arc):
    out = set()
    docs = {}
    for awb, doc, page, h, p, t in sorted(arc, key=lambda r: (r[1], r[2])):
        docs.setdefault((awb, doc), []).append((h, p, t))
    files = {}
    for awb, file, page, exempt, h, p, t in sorted(inc, key=lambda r: (r[1], r[2])):
        files.setdefault((awb, file), []).append((exempt, h, p, t))
    for (awb, file), pages in files.items():
        use = [x for x in pages if not x[0]]
        own, scored = _top_numbers([x[3] for x in use]), []
        mine = sorted(d for a, d in docs if a == awb)
        for d in mine:
            there = docs[awb, d]
            hashes = len({x[1] for x in use} & {x[0] for x in there} - {None})
            near = sum(x[2] is not None and any(y[1] is not None and ((x[2] ^ y[1]) & (1 << 64) - 1).bit_count() <= 10 for y in there) for x in use)
            tokens = len(own & _top_numbers([y[2] for y in there]))
            share = tokens / max(1, len(own))
            gap = 1 - min(1.0, abs(len(there) - len(pages)) / max(1, len(pages)))
            scored.append((-round(2.5 * hashes + 1.5 * near + 2.0 * share + 0.5 * gap, 9), d, hashes, near, tokens, share))
        for rank, (score, d, hashes, near, tokens, share) in enumerate(sorted(scored)):
            if len(mine) <= 3 or rank < 3 or hashes or near or share >= 0.2:
                out.add((file, d, hashes, near, tokens, -score, rank < 3))
    return out


def test_prefilter_against_plain(spark):
    r = random.Random(5)
    inc, arc = [], []
    text = lambda: r.choice([None, "", " ".join(r.choice(["x", "12345", *(str(100000 + r.randrange(60)) for _ in range(2))]) for _ in range(r.randrange(8)))])
    near = [r.getrandbits(63) for _ in range(40)]
    phash = lambda: r.choice([None, r.choice(near) ^ sum(1 << b for b in r.sample(range(63), r.choice([0, 9, 10, 11])))])
    page_hash = lambda: r.choice([None, f"h{r.randrange(90)}"])
    for file in range(60):  # keys 4 and 5 have no documents, one key has a third of all files
        awb = r.choice(["k0", "k0", *(f"k{i}" for i in range(6))])
        inc += [(awb, file, p, r.random() < 0.2, page_hash(), phash(), text()) for p in range(r.choice([1, 2, 5, 9]))]
    for doc in range(70):
        awb = r.choice(["k0", "k0", "k0", "k1", "k2"]) if doc > 1 else "k3"
        arc += [(awb, doc, p, page_hash(), phash(), text()) for p in range(r.choice([1, 1, 3, 4, 30]))]
    arc += arc[:3]  # repeated pages
    got = P.kept_documents(spark.createDataFrame(inc, _INC), spark.createDataFrame(arc, _ARC)).collect()
    want = _plain(inc, arc)
    assert len(got) == len(want) and {tuple(x) for x in got} == want
    assert {x[6] for x in want} == {True, False}
    few = [(a, f) for a, f, *_ in inc if a == "k3"]
    assert {x[0] for x in want if x[1] < 2} == {f for _, f in few}


def _some_pages(seed):
    r = random.Random(seed)
    near = [r.getrandbits(63) for _ in range(20)]
    text = lambda: r.choice([None, " ".join(r.choice(["x", "012345", str(100000 + r.randrange(40))]) for _ in range(r.randrange(9)))])
    signs = lambda: (r.choice([None, f"h{r.randrange(50)}"]), r.choice([None, r.choice(near) ^ sum(1 << b for b in r.sample(range(63), r.choice([0, 10, 11])))]), text())
    key = lambda i: f"k{i % 4 * (i % 3 > 0)}"  # half of them have k0
    inc = [(key(f), f, p, r.random() < 0.2, *signs()) for f in range(30) for p in range(r.choice([1, 2, 5]))]
    return inc, [(key(d), d, p, *signs()) for d in range(40) for p in range(r.choice([1, 3, 12]))]


def test_prefilter_of_small_keys_spreads_no_hashes(spark, monkeypatch):
    """Sixty-eight rows for each perceptual hash took the disk; pages of a key with few of them meet directly."""
    inc, arc = _some_pages(7)
    monkeypatch.setattr(P, "near_hashes", None)
    got = P.kept_documents(spark.createDataFrame(inc, _INC), spark.createDataFrame(arc, _ARC)).collect()
    assert len(got) == len(_plain(inc, arc)) and {tuple(x) for x in got} == _plain(inc, arc)


def test_prefilter_of_crowded_keys(spark):
    inc, arc = _some_pages(8)
    for crowded in (0, 20):  # all keys, and k0 alone
        got = P.kept_documents(spark.createDataFrame(inc, _INC), spark.createDataFrame(arc, _ARC), crowded=crowded).collect()
        assert len(got) == len(_plain(inc, arc)) and {tuple(x) for x in got} == _plain(inc, arc)


def test_prefilter_empty(spark):
    inc, arc = spark.createDataFrame([], _INC), spark.createDataFrame([], _ARC)
    one = spark.createDataFrame([("k", 1, 1, None, None, None, None)], _INC)
    doc = spark.createDataFrame([("k", 7, 1, None, None, None)], _ARC)
    assert P.kept_documents(inc, doc).count() == P.kept_documents(one, arc).count() == 0
    assert [tuple(x) for x in P.kept_documents(one, doc).collect()] == [(1, 7, 0, 0, 0, 0.5, True)]


def test_batches_one_call_after_the_other(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", "c", "", None]), f"f{i}", r.choice(["IN-PROGRESS", None, "COMPLETE", "REJECTED"]), r.choice([None, 5, 4000]), r.choice([None, 7])) for i in range(80)]
    calls = [(i, r.choice(["a", "a", "b", "d", "", None]), i % 9, dt.date(2024, 1, 1)) for i in range(70)]
    want = {x[0]: [x[0], x[1], x[3], None, None] for x in rows}
    parts = {x[0]: (x[4] or 0) + (x[5] or 0) for x in rows}
    added = []
    for call, awb, batch, _ in calls:
        hit = max((n for n, x in want.items() if awb and x[1] == awb and x[2] in ("IN-PROGRESS", None)), default=None)
        if hit is None:
            added.append((None, awb, "COMPLETE", batch, None))
        else:
            want[hit][2:] = ["COMPLETE", batch, parts[hit]]
    got = C.batch_added(
        spark.createDataFrame(rows, "row_no long, awb string, processed_name string, status string, hot_secs long, edm_secs long"),
        spark.createDataFrame(calls, "call_no long, awb string, batch long, added_at date"),
    ).collect()
    assert Counter((x.row_no, x.awb, x.status, x.batch, x.total_secs) for x in got) == Counter(map(tuple, want.values())) + Counter(added)
    assert {x.processed_name for x in got if x.row_no is None and x.awb == "d"} == {"d.pdf"}
    assert {x.total_hms for x in got if x.total_secs == 4007} <= {"01:06:47"}


def test_last_row_wins(spark):
    cache = spark.createDataFrame([(1, "a", "Filename"), (2, " a ", " ocr-exact "), (3, "", "Filename"), (4, None, "Filename"), (5, "b", None), (6, "c", "x-OCR-EXACT"), (7, "d", "text-layer")], "row_no long, awb string, method string")
    files = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",), (None,), ("a",)], "awb string")
    got = Counter(tuple(x) for x in C.with_tier(files, cache).select("awb", "tier").collect())
    assert got == Counter({("a", "Medium"): 2, ("b", "Low"): 1, ("c", "Low"): 1, ("d", "High"): 1, ("e", "Low"): 1, (None, "Low"): 1})


def test_match_statistics(spark):
    texts = {"1/16 pages": (1, 16, 0.062), "3/16": (3, 16, 0.188), " 4 / 0 ": (4, 0, 0.0), "N/A": (None, None, None), "5/x": (5, None, None), "5/": (5, None, None), "7": (None, None, None), None: (None, None, None), "2/5/9": (2, 5, 0.4)}
    at = dt.datetime(2024, 1, 1)
    rows = [(at, None, t, at, at + dt.timedelta(microseconds=1234567)) for t in texts]
    c = spark.createDataFrame(rows, "ts timestamp, awb string, match_stats string, started_at timestamp, ended_at timestamp")
    none = {n: None for n in ("file", "status", "route", "reason", "cache")}
    for n in none:
        c = c.selectExpr("*", f"cast(null as string) as {n}")
    c = c.selectExpr("*", *[f"cast(null as double) as {s}_ms" for s in C.STEPS])
    for x in C.finished(c).collect():
        event = json.loads(x.event)
        said = event["match_stats"]
        assert (x.dup_pages, x.total_pages, x.ratio) == texts[None if said == "N/A" else said]
        assert x.secs == 1.23 and event["timings_ms"] == {"total_active": 1234.6} and event["cache"] == x.method == "MISS" and "awb" not in event


def test_a_key_is_written_once(spark, tmp_path):
    log = lambda *keys: spark.createDataFrame([(k,) for k in keys], "k string")
    path = f"file://{tmp_path}/log"
    A.append_rows(log("a", "a", "b"), path, "k")
    A.append_rows(log("b", "c", "c"), path, "k")
    assert sorted(x.k for x in A.read_log(spark, path).collect()) == ["a", "b", "c"]
