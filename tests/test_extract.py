"""Extractors on texts worked out by hand."""

import pytest
from pyspark.sql import functions as F

from docroute.functions import extract as X
from docroute.operators import batching, resolve, routing


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("399617498819", "399617498819"), ("3996-1749 8819", "399617498819"), ("39961749881B", "399617498818"), ("OQDILZ123456", None), ("39961749881X", None), ("12345678901", None), (None, None), ("", None), ("3O0617498819", "300617498819")],
)
def test_norm_digits(spark, raw, want):
    assert one(spark, X.norm_digits("t"), t=raw) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("400-399617498819", "399617498819"), ("400 3996 1749 8819", "399617498819"), ("400399617498819", "399617498819"), ("400-099617498819", None), ("1400-399617498819", None), ("400-3996174988190", None), (None, None)],
)
def test_tight_400(spark, text, want):
    assert one(spark, X.tight_400("t"), t=text) == want


def test_line_blocks(spark):
    text = "top 111122223333\nFedEx row\nnext 4444 5555 6666\nlast 777788889999\nfar 123412341234"
    assert sorted(one(spark, X.carrier_candidates("t"), t=text)) == ["111122223333", "444455556666", "777788889999"]
    assert sorted(one(spark, X.airway_candidates("t"), t="x\nAirway Bill\n123456789012")) == ["123456789012"]


def test_keyword_neighbours(spark):
    assert one(spark, X.keyword_adjacent("t", F.array(F.lit("123456789012"))), t="waybill " + "x" * 20 + " 123456789012") == ["123456789012"]
    assert one(spark, X.keyword_adjacent("t", F.array(F.lit("123456789012"))), t="waybill " + "x" * 60 + " 123456789012") == ["123456789012"]  # same line
    assert one(spark, X.keyword_adjacent("t", F.array(F.lit("123456789012"))), t="waybill\n" + "x" * 60 + "\n" + "y" * 60 + " 123456789012") == []


def test_windows(spark):
    assert "399617498819" in one(spark, X.windows_of_12("t"), t="no 7739961749881942")
    assert one(spark, X.windows_of_12("t"), t="no 12345") == []


def test_close_keys_need_no_cross_join(spark):
    keys = spark.createDataFrame([("111122223333",), ("999922228888",)], "awb string")
    cands = spark.createDataFrame([("111122223344",), ("899922228887",), ("555566667777",)], "candidate string")
    got = {tuple(r) for r in resolve.close_keys(cands, keys).collect()}
    assert got == {("111122223344", "111122223333", 2), ("899922228887", "999922228888", 2)}


def test_phash_bands_are_complete(spark):
    import random

    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(40)]
    hs = base + [b ^ sum(1 << i for i in rnd.sample(range(64), rnd.randint(0, 12))) for b in base]
    signed = [h - (1 << 64) if h >> 63 else h for h in hs]
    df = spark.createDataFrame(list(enumerate(signed)), "id long, h long")
    got = {(r["a"], r["b"]) for r in routing.phash_pairs(df, df).where("a < b").collect()}
    assert got == {(i, j) for i in range(80) for j in range(i + 1, 80) if bin(hs[i] ^ hs[j]).count("1") <= 10}


def test_next_fit(spark):
    df = spark.createDataFrame([("a", k, s) for k, s in enumerate([20, 20, 20, 60, 1, 47, 1])], "g string, k int, size int")
    got = [(r["k"], r["batch_no"], r["start_page"]) for r in batching.next_fit(df, ["g"], ["k"], "size").orderBy("k").collect()]
    assert got == [(0, 1, 1), (1, 1, 21), (2, 2, 1), (3, 3, 1), (4, 4, 1), (5, 4, 2), (6, 5, 1)]


def test_cargo_page(spark):
    assert one(spark, routing.cargo_control_page(F.col("t")), t="Cargo control document 400-1234567890")
    assert not one(spark, routing.cargo_control_page(F.col("t")), t="Cargo control document")


def test_reach_before_and_behind(spark):
    """Forty characters on either side count, whatever they are; no pattern looks back over a stretch, which took most of keyword_reach's time."""
    near = X.keyword_adjacent("text", X.clean_candidates("text"))
    assert "(?<=" not in near._jc.toString()
    n = "123456789012"
    gaps = (0, 33, 34, 35, 60)  # behind three line ends, so only the reach counts, and the keyword takes three characters of it
    texts = [(t, gap <= 34) for gap in gaps for fill in ("\U0001f600" * gap,) for t in (f"awb\n\n\n{fill}{n}", f"{n}{fill}\n\n\nawb")]
    rows = spark.createDataFrame(texts, "text string, near boolean").withColumn("found", near).collect()
    assert [bool(x.found) for x in rows] == [x.near for x in rows]


def test_gates_turn_nothing_away(spark):
    """Patterns are only tried where a cheap test lets them; spread letters and small ones must pass it."""
    n = "123456789012"
    texts = {"carrier": [f"F e d e\tx\n{n}", f"fed-ex {n}", f"fEdEx {n}"], "airway": [f"air-way bil {n}", f"a i r w a y b i l l\n{n}"], "aci": [f"a c 1 {n}", f"A6I no: {n}"], "label": [f"hawb {n}", f"trk# {n}", f"Track {n}", f"400 no {n}"]}
    for name, some in texts.items():
        got = spark.createDataFrame([(t,) for t in some], "text string").select(getattr(X, f"{name}_candidates")("text").alias("c")).collect()
        assert [x.c for x in got] == [[n]] * len(some), name
