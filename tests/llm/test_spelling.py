"""Spelling variants: automata and buckets against all pairs of words, and awkward rows."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docroute.llm import spelling as sp

ALPHABET = "abé"


def one_error(w, alphabet):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
    return out - {w}


def plain(rows):
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    n = {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}
    alphabet, form, out = set("".join(n)), {}, set()
    near = {w: [v for v in one_error(w, alphabet) if v in n] for w in n}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(ALPHABET, min_size=1, max_size=7), max_size=40))
def test_automaton_numbers_words_and_finds_errors(words):
    words = sorted(words)
    a = sp.Automaton(words)
    assert [a.number(w) for w in words] == list(range(len(words))) and a.number("zzz") is None
    for w in words:
        got = list(a.near(w, 0, len(w)))
        assert len(got) == len(set(got)) and {words[k] for k in got} == one_error(w, ALPHABET) & set(words)


def test_automaton_is_minimal():
    words = sorted(a + b for a in ("aa", "ab", "ba") for b in ("", "xs", "ys"))
    assert len(sp.Automaton(words).edges) == 6  # root, two after a first letter, end of the stems, after x or y, end


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    stems = ["".join(rnd.choice("abcé") for _ in range(rnd.randrange(4, 9))) for _ in range(60)] + ["common" + "".join(rnd.choice("abc") for _ in range(6)) for _ in range(300)]
    stems += ["aaaaa", "aaaaaa", "aaaab", "abaaa", "ÀÉÿ×÷xx", "Straße", "straße"]
    weight = [1 / (k % 40 + 1) for k in range(len(stems))]

    def word():
        w = rnd.choices(stems, weight)[0]
        if rnd.random() < 0.3:
            w = rnd.choice(sorted(one_error(w, "abcé")))
        return w.upper() if rnd.random() < 0.1 else w

    out = [(i, " ".join(word() for _ in range(80))) for i in range(250)]
    return out + [(None, None), (None, "commonaaaaaa aaaaa"), (7, ""), (8, "😀 12 – ,"), (9, "same same2same"), (10, "q" * 5000 + " " + "q" * 4999 + "z")] + [(11, "repeated " + "q" * 5000 + " repeatd " + "q" * 4999)] * 4


@pytest.mark.parametrize(("most", "chunk"), [(sp.MOST, sp.CHUNK), (20, 100), (5, 1)])
def test_against_all_pairs(spark, rows, most, chunk):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "'clash' AS word", "'clash' AS n", "'clash' AS form", "'clash' AS bucket", "'clash' AS i")
    got = [tuple(r) for r in sp.variants(df, most, chunk).collect()]
    want = plain(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] and r[2] != r[1] for r in want) and max(r[4] for r in want) > 5


def test_no_words(spark):
    assert sp.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert sp.variants(spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")).count() == 0


def test_query(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sp.op13_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and {tuple(r) for r in got.collect()} == plain(rows)
