"""The duplicate check: bounds are never below the similarity, and each tier and gate by hand."""

from hypothesis import given, settings
from hypothesis import strategies as st

from docroute.functions.similarity import similarity
from docroute.operators import duplicates as D
from docroute.operators.matching import TEXT_SIMILARITY

TEXTS = st.text(st.sampled_from("aab bc\n\tdé  "), max_size=25)


def plain_bound(a, b):
    """What may_reach() computes, in plain Python."""
    (n, c, m, d, x), (n2, c2, m2, d2, y) = D.signature_of(a), D.signature_of(b)
    top = lambda k, k2, u, v: (lambda s: 200 * s / (min(k, k2) + s) if s else 0)(sum(map(min, u, v)))
    return 100.0 if set(x) & set(y) else max(top(n, n2, c, c2), top(m, m2, d, d2))


@settings(max_examples=1500, deadline=None)
@given(TEXTS, TEXTS)
def test_no_similarity_is_above_its_bound(a, b):
    assert similarity(a, b) <= plain_bound(a, b) + 1e-9


def test_bounds_in_spark(spark):
    rows = [("abc def", "xyz"), ("aaaa", "aabb"), ("", "a"), (None, None), ("one word", "word one two"), ("kkkkkkkkkk", "kkkzzzzzzz"), ("kkkkkkkkkk", "kkkkzzzzzz")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", D.may_reach(D.signature("a"), D.signature("b")).alias("may")).collect()
    assert [r["may"] for r in got] == [plain_bound(a, b) >= TEXT_SIMILARITY for a, b in rows]
    df = df.withColumns({"sig_a": D.signature("a"), "sig_b": D.signature("b")})
    assert {(r["a"], r["b"]) for r in D.alike(df, "a", "b").collect()} == {(a, b) for a, b in rows if similarity(a, b) >= TEXT_SIMILARITY}


def test_tiers_focus_and_gates(spark, tmp_path):
    long = "the quick brown fox jumps over the lazy dog " * 3
    page = lambda file, no, h, p, text, ocr="", exempt=False: ("k", file, no, exempt, h, p, text, ocr)
    inc = [
        page(1, 1, "h1", 0, ""), page(1, 2, "h2", 0, ""), page(1, 3, "h3", 0, ""), page(1, 4, "h9", 0, long), page(1, 5, "h1", 0, "", exempt=True),
        page(2, 1, "n", -1, long), page(2, 2, "n", -1, "99999"), page(3, 1, "n", -1, "", "scan " + long), page(3, 2, "n", -1, "", "6666"), page(4, 1, "n", -1, "55555"),
    ]
    arc = [("k", 7, 1, "h1", 1 << 40, "", ""), ("k", 7, 2, "h2", 1 << 40, "", ""), ("k", 7, 3, "h3", 1 << 40, "", ""), ("k", 8, 1, "x", 1 << 41, long, ""), ("k", 9, 1, "y", 1 << 42, "", "44444")]
    inc = spark.createDataFrame(inc, "awb string, file_id long, page_no int, exempt boolean, page_hash string, phash long, text string, ocr string")
    arc = spark.createDataFrame(arc, "awb string, doc long, doc_page int, page_hash string, phash long, text string, ocr string")
    files = spark.createDataFrame([(k, False) for k in (1, 2, 3, 4)], "file_id long, token_signal boolean")
    count = iter(range(100))

    def keep(df, name):
        path = f"{tmp_path}/{name}{next(count)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    got = {(r["file_id"], r["page_no"]): (r["method"], r["doc"]) for r in D.check(inc, arc, files, keep).collect()}
    # Three pages by hash put document 7 into focus; the fourth is near to all of them by its perceptual hash. File 3's scan is near document 8.
    assert got == {(1, 1): ("HASH", 7), (1, 2): ("HASH", 7), (1, 3): ("HASH", 7), (1, 4): ("PHASH", 7), (2, 1): ("TEXT", 8), (3, 1): ("OCR", 8)}


def test_repeated_texts_are_compared_once(monkeypatch):
    import pandas as pd

    from docroute.functions import similarity as S

    done = []
    monkeypatch.setattr(S, "similarity", lambda a, b: done.append((a, b)) or 50.0)
    assert list(S.text_similarity.func(pd.Series(["a", "a", None, "a"]), pd.Series(["b", "b", "b", "c"]))) == [50.0] * 4
    monkeypatch.setattr(D, "signature_of", lambda x: done.append(x) or (0, [], 0, [], []))
    assert len(next(D.signature.func(iter([pd.Series(["t", None, "t"])])))) == 3
    assert len(done) == 5
