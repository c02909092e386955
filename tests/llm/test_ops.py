"""Each operator against a plain version of itself, and on awkward rows."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docroute.llm import jaccard_join, language_id, media, mixing, packing, quality_classifier, quality_rules, substring_dedup, suffix_dedup, toxicity
from docroute.llm.common import Scratch, components, ranked

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def held(doc, n):
    return zlib.crc32(str(doc).encode()) % n


# ---- shared pieces


def test_components(spark):
    rnd = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rnd.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    label = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r["component"]].add(r["node"])
    want = defaultdict(set)
    for x, c in label.items():
        want[c].add(x)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in want.values() if len(g) > 1}


def test_ranked(spark):
    df = spark.range(1000).select(F.pmod(F.hash("id"), F.lit(97)).alias("x"), "id").repartition(7)
    got = ranked(Scratch(spark, "t"), df, [F.col("x"), F.col("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1000))
    assert [(r["x"], r["id"]) for r in got] == sorted((r["x"], r["id"]) for r in got)


# ---- 1 media


def test_container_round_trip():
    for n in (1, 2, 63, 64, 65, 200):
        payload = bytes((i * 7) % 256 for i in range(n * media.FRAME))
        data = media.write_container(payload, key_every=3)
        (t,) = media.read_container(data)
        assert b"".join(data[o : o + s] for o, s in zip(t.offsets, t.sizes, strict=True)) == payload
        assert (t.codec, t.handler, t.timescale, t.duration, len(t.sizes), int(t.key.sum())) == ("raw ", "vide", 25, n, n, -(-n // 3))
        first = media.key_ranges(t)[0]
        assert data[first[0] : first[0] + first[1]] == payload[: media.FRAME]


def test_fragments_and_bad_containers():
    import struct

    box = lambda k, *p: struct.pack(">I4s", 8 + len(b"".join(p)), k) + b"".join(p)
    head = media.write_container(bytes(media.FRAME))
    # A fragment of two samples of 5 and 7 bytes, of which the first is a key frame.
    trun = lambda off: box(b"trun", struct.pack(">IIiIIIII", 0x000605 - 0x000004, 2, off, 5, 0, 7, 0x10000, 0)[:28])
    moof = lambda off: box(b"moof", box(b"traf", box(b"tfhd", struct.pack(">II", 0x8, 1), struct.pack(">I", 3)), trun(off)))
    data = head + moof(len(moof(0)) + 8) + box(b"mdat", b"aaaaabbbbbbb")
    (t,) = media.read_container(data)
    assert [data[o : o + s] for o, s in zip(t.offsets[1:], t.sizes[1:], strict=True)] == [b"aaaaa", b"bbbbbbb"]
    assert t.key.tolist() == [True, True, False] and t.duration == 1 + 2 * 3
    for bad in (head[:100], b"junk" * 9, head[:-1], struct.pack(">I4s", 4, b"moov")):
        with pytest.raises(media.BadContainer):
            media.read_container(bad)


def test_fragments_of_several_runs_and_tracks():
    """Two runs in each of two tracks, all offsets from the moof, whose size takes 64 bits."""
    import struct

    box = lambda k, *p: struct.pack(">I4s", 8 + len(b"".join(p)), k) + b"".join(p)
    wide = lambda k, *p: struct.pack(">I4sQ", 1, k, 16 + len(b"".join(p))) + b"".join(p)
    head = media.write_container(bytes(media.FRAME))
    moov = head[head.index(b"moov") - 4 :]
    moov = moov[: struct.unpack(">I", moov[:4])[0]]
    second = bytearray(moov[moov.index(b"trak") - 4 :])
    second = second[: struct.unpack(">I", second[:4])[0]]
    struct.pack_into(">I", second, second.index(b"tkhd") + 4 + 12, 2)
    both = head.replace(moov, box(b"moov", moov[8:], bytes(second)))
    shift = len(both) - len(head)
    if both.index(b"moov") < both.index(b"mdat"):
        both = bytearray(both)
        for at in [i for i in range(len(both)) if both[i : i + 4] == b"stco"]:
            struct.pack_into(">I", both, at + 12, struct.unpack_from(">I", both, at + 12)[0] + shift)
        both = bytes(both)
    run = lambda off, first, *sizes: box(b"trun", struct.pack(">II", 0x205 if off is not None else 0x204, len(sizes)), b"" if off is None else struct.pack(">i", off), struct.pack(">I", first), *(struct.pack(">I", x) for x in sizes))
    tfhd = lambda number: box(b"tfhd", struct.pack(">III", 0x20020, number, 0x10000))

    def moof(at):
        one = box(b"traf", tfhd(1), run(at, 0, 3, 4), run(at + 20, 0x10000, 2))
        return wide(b"moof", one, box(b"traf", tfhd(2), run(at + 7, 0, 5), run(None, 0, 1, 2)))

    data = both + moof(len(moof(0)) + 8) + box(b"mdat", b"aaabbbbCCCCCdEE_____ff")
    one, two = media.read_container(data)
    got = lambda t: [data[o : o + s] for o, s in zip(t.offsets[1:], t.sizes[1:], strict=True)]
    assert got(one) == [b"aaa", b"bbbb", b"ff"] and one.key[1:].tolist() == [True, False, False]
    assert got(two) == [b"CCCCC", b"d", b"EE"] and two.key[1:].tolist() == [True, True, False]


def test_codecs_and_compact_sizes():
    import struct

    box = lambda k, *p: struct.pack(">I4s", 8 + len(b"".join(p)), k) + b"".join(p)
    entry = lambda kind, inner, width=78: struct.pack(">II", 0, 1) + box(kind, bytes(width), inner)
    name = lambda x, handler="vide": media._codec(x, 0, len(x), handler)
    # The letters avcC inside another box are no configuration.
    assert name(entry(b"avc1", box(b"free", b"..avcC\1\2\3") + box(b"avcC", b"\1\x64\0\x1f"))) == "avc1.64001f"
    assert name(entry(b"hvc1", box(b"hvcC", bytes([1, 1, 0x60, 0, 0, 0, 0xB0, 0, 0, 0, 0, 0, 93])))) == "hvc1.1.6.L93.B0"
    assert name(entry(b"av01", box(b"av1C", bytes([0x81, 0x08, 0x0C, 0])))) == "av01.0.08M.08"
    esds = box(b"esds", bytes(4), b"\3\x19\0\1\0\4\x11\x40" + bytes(12) + b"\5\2\x12\x10")
    assert name(entry(b"mp4a", esds, 28), "soun") == "mp4a.40.2"
    assert name(entry(b"raw ", b"")) == "raw "
    table = lambda bits, n, raw: struct.pack(">I3xBI", 0, bits, n) + raw
    for bits, raw in ((4, b"\x12\x30"), (8, b"\1\2\3"), (16, b"\0\1\0\2\0\3")):
        x = table(bits, 3, raw)
        assert media._compact(x, 0, len(x)).tolist() == [1, 2, 3]


def test_media_of_an_empty_table(empty):
    assert media.read_texts(media.store_texts(empty)).count() == 0


def test_media_columns(spark):
    good = media.write_container(bytes(media.FRAME))
    df = spark.createDataFrame([(1, good, "x"), (2, None, "x"), (3, b"", "x"), (4, good[:50], "x"), (1, good, "x")], "id int, media binary, codec string")
    got = media.media_columns(df).collect()
    assert [r["tracks"][0]["status"].split(":")[0] for r in got] == ["ok", "empty", "empty", "bad", "ok"]
    assert got[0]["tracks"] == got[4]["tracks"] and got[0]["tracks"][0]["key_ranges"][0]["length"] == media.FRAME


def test_media_query(edge, edge_rows):
    got = media.read_texts(media.store_texts(edge)).collect()
    want = Counter()
    for doc, text, *_ in edge_rows:
        b = (text or "").encode()
        p = b + b" " * (max(-(-len(b) // 192), 1) * 192 - len(b))
        want[doc, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
    assert len({r["payload_sha256"] for r in got}) == len({(r["media_sha256"], r["feature"], r["media_bytes"]) for r in got})


# ---- 2 toxicity, 5 quality


def labelled(spark, rnd, n=1500):
    rows, labels = [], []
    for i in range(n):
        bad, junk = rnd.random() < 0.3, rnd.random() < 0.3
        w = [f"w{rnd.integers(300)}" for _ in range(60)]
        group = rnd.choice(["muslim", "christian", "women", "none"]) if not bad or rnd.random() < 0.9 else "jewish"
        if bad:
            w[5] = ["vile", "nasty", "vilest"][rnd.integers(3)]
        if bad and rnd.random() < 0.8:
            group = "jewish"
        w[9] = str(group)
        if junk:
            w = [x + "!!" for x in w]
        rows.append((i, " ".join(w), None, None, 0))
        labels.append((i, 0 if junk else 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity(spark, edge, empty):
    docs, labels, truth = labelled(spark, np.random.default_rng(2))
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    out = [(got[i] >= 0.5) == bool(t) for i, _, t in truth if held(i, 5) == 0]
    assert np.mean(out) > 0.93
    # Naming a group is no evidence: swapped copies score alike, and better than without the penalty.
    plain = toxicity.train(docs, labels, penalty=0.0)
    texts = spark.createDataFrame([(0, "w1 w2 jewish w3"), (1, "w1 w2 muslim w3")], "doc_id long, text string")
    gap = lambda m: abs(np.subtract(*[np.log(r["score"] / (1 - r["score"])) for r in toxicity.score(texts, m, ["doc_id"]).orderBy("doc_id").collect()]))
    assert gap(model) < 0.5 * gap(plain)
    e = toxicity.score(edge.select("doc_id", "text"), model, ["doc_id"]).collect()
    assert len(e) == 18 and all(0 <= r["score"] <= 1 for r in e)
    assert toxicity.score(empty, model, ["doc_id"]).count() == 0
    assert toxicity.train(docs, labels.limit(0)) is None


def test_quality_classifier(spark, edge, empty):
    docs, labels, truth = labelled(spark, np.random.default_rng(3))
    model = quality_classifier.train(docs, labels)
    assert (np.diff(model[1]) > 0).all()
    got = {r["doc_id"]: r for r in quality_classifier.score(docs, model, ["doc_id"]).collect()}
    out = [got[i]["selected"] == bool(q) for i, q, _ in truth if held(i, 5) == 0]
    assert np.mean(out) > 0.97
    mean = lambda q, t: np.mean([got[i]["expected_grade"] for i, a, b in truth if (a, b) == (q, t)])
    assert mean(0, 0) < mean(1, 1) < mean(1, 0)
    e = {r["doc_id"]: r["selected"] for r in quality_classifier.score(edge.select("doc_id", "text"), model, ["doc_id"]).collect()}
    assert not e[0] and not e[1] and not e[2] and e[5]
    assert quality_classifier.score(empty, model, ["doc_id"]).count() == 0
    assert all(r["selected"] == bool(words(r["text"])) for r in quality_classifier.score(edge.select("text"), None, ["text"]).collect())


def test_quality_classifier_is_fitted_in_a_task(spark, monkeypatch):
    """The driver gets the weights, not the sample, and they are the same however the documents are dealt out."""
    docs, labels, _ = labelled(spark, np.random.default_rng(3))
    driver, real = os.getpid(), quality_classifier.fit

    def elsewhere(*a):
        assert os.getpid() != driver
        return real(*a)

    monkeypatch.setattr(quality_classifier, "fit", elsewhere)
    (w, cut), (w_, cut_) = (quality_classifier.train(docs.repartition(n), labels) for n in (1, 5))
    assert (w == w_).all() and (cut == cut_).all() and np.count_nonzero(w)
    assert quality_classifier.train(docs, labels.limit(0)) is None


def _rows(x):
    from docroute.llm.textmodel import Rows

    row, ids = np.nonzero(x)
    return Rows(len(x), row, ids.astype(np.int32), x[row, ids])


def _slope(loss, at, h=1e-4):
    """The largest finite difference of a plain loss around a point."""
    return max(abs(loss(at + h * e) - loss(at - h * e)) / (2 * h) for e in np.eye(len(at)))


@pytest.fixture
def few_weights(monkeypatch):
    from docroute.llm import textmodel

    for module in (textmodel, toxicity, quality_classifier):
        monkeypatch.setattr(module, "DIM", 8)


def test_toxicity_fit_ends_where_a_plain_loss_is_flat(few_weights):
    rnd = np.random.default_rng(51)
    x = rnd.integers(0, 2, (80, 6)).astype(float)
    y = (rnd.random(80) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1])))).astype(float)
    weight = rnd.random(80) + 0.5
    a, z = x[:30], x[:30][:, [0, 1, 3, 2, 4, 5]]
    w, b = toxicity.fit(_rows(x), y, weight, _rows(a), _rows(z), penalty=0.3, l1=0.0, rounds=4000)

    def loss(v):
        f, share = x @ v[:6] + v[6], weight / weight.sum()
        return (share * (np.log1p(np.exp(f)) - y * f)).sum() + 0.3 * ((a @ v[:6] - z @ v[:6]) ** 2).mean()

    assert _slope(loss, np.append(w[:6], b)) < 1e-3 and not w[6:].any()
    assert _slope(loss, np.zeros(7)) > 1e-2


def test_quality_fit_ends_where_a_plain_loss_is_flat(few_weights):
    rnd = np.random.default_rng(52)
    x = rnd.random((120, 5))
    y = np.digitize(3 * x[:, 0] - 2 * x[:, 1] + rnd.logistic(size=120), [0.0, 1.0])
    weight = rnd.random(120) + 0.5
    w, cut = quality_classifier.fit(_rows(x), y, weight, grades=3, l1=0.0, rounds=6000)

    def loss(v):
        over = 1 / (1 + np.exp(-(x @ v[:5])[:, None] + v[5:]))
        over = np.column_stack([np.ones(len(x)), over, np.zeros(len(x))])
        p = over[np.arange(len(x)), y] - over[np.arange(len(x)), y + 1]
        return -(weight / weight.sum() * np.log(p)).sum()

    assert _slope(loss, np.append(w[:5], cut)) < 1e-3 and cut[0] < cut[1]


# ---- 3 mixing


def test_mixing(spark, edge, edge_rows, empty):
    rnd = np.random.default_rng(4)
    rows = [(i, "w " * int(rnd.integers(1, 60)), None, ["s0", "s0", "s0", "s1", "s2", None][i % 6], 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    first, second = (sorted(map(tuple, mixing.mix(df.repartition(n), bucket=100).collect()), key=str) for n in (3, 5))
    assert first == second
    size, taken, target = Counter(), Counter(), {}
    for _, _, s, n, _, t, copies in first:
        size[s] += n
        taken[s] += copies * n
        target[s] = t
        assert copies <= 3
    total = sum(size.values())
    weight = dict(zip(sorted(size, key=lambda s: (s is None, s)), (1, 2, 3, 1), strict=True))
    capped = set()
    while True:
        share = (total - sum(3 * size[s] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        more = {s for s, w in weight.items() if s not in capped and w * share > 3 * size[s]}
        if not more:
            break
        capped |= more
    for s in size:
        assert target[s] == pytest.approx(3 * size[s] if s in capped else share * weight[s])
        assert abs(taken[s] - target[s]) <= 60
    e = mixing.mix(edge).collect()
    assert len(e) == len(edge_rows) and Counter(r["size"] for r in e) == Counter(len(words(r[1])) for r in edge_rows)
    assert mixing.mix(empty).count() == 0


def test_rounding_keeps_means():
    import pandas as pd

    hits = np.zeros(6)
    for seed in range(1500):
        pdf = pd.DataFrame({"doc_id": range(6), "th": 0, "size": [5, 9, 2, 7, 4, 8], "part": [0.3, 0.5, 0.9, 0.2, 0.6, 0.1], "draw": range(6)})
        out = mixing._round(pdf, 0, seed).sort_values("doc_id")
        assert ((out["part"] > 0) & (out["part"] < 1)).sum() <= 1
        assert (out["part"] * out["size"]).sum() == pytest.approx((pdf["part"] * pdf["size"]).sum())
        hits += out["part"].to_numpy()
    assert np.abs(hits / 1500 - [0.3, 0.5, 0.9, 0.2, 0.6, 0.1]).max() < 0.05


def test_rounding_ends_small():
    """Fifty documents and a giant: what is left open is less than the median document, and means are kept."""
    import pandas as pd

    rnd = np.random.default_rng(14)
    size = np.append(rnd.integers(20, 200, 50), 2000)
    part = np.append(rnd.random(50), 0.37)
    hits = np.zeros(51)
    for seed in range(600):
        pdf = pd.DataFrame({"doc_id": range(51), "th": 0, "size": size, "part": part, "draw": range(51)})
        out = mixing._round(pdf, 0, seed).sort_values("doc_id")
        got = out["part"].to_numpy()
        assert (got * size).sum() == pytest.approx((part * size).sum())
        left = (got > 0) & (got < 1)
        assert left.sum() <= 1 and size[left].max(initial=0) <= np.median(size)
        hits += got
    assert np.abs(hits / 600 - part).max() < 0.09


def test_mixing_targets_with_a_giant(spark):
    rnd = np.random.default_rng(15)
    rows = [(i, "w " * int(rnd.integers(20, 200)), None, f"s{i % 6}", 0) for i in range(300)] + [(1000 + k, "w " * 2000, None, f"s{k}", 0) for k in range(6)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).toPandas()
    for _, g in got.groupby("source"):
        assert abs((g["copies"] * g["size"]).sum() - g["target"].iloc[0]) <= g["size"].median()


# ---- 4 join


def brute_links(rows):
    def grams(text):
        w = words(text)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    g = [grams(t) for _, t, *_ in rows]
    link = [[j for j in range(len(g)) if j != i and g[i] and len(g[i] & g[j]) >= 0.8 * len(g[i] | g[j])] for i in range(len(g))]
    label = list(range(len(g)))
    for _ in g:
        for i, js in enumerate(link):
            for j in js:
                label[i] = label[j] = min(label[i], label[j])
    return link, label


def test_jaccard_join(spark, edge, edge_rows, empty):
    link, label = brute_links(edge_rows)
    got = jaccard_join.jaccard_join(edge).collect()
    key = lambda d: (d is not None, d)
    want = Counter()
    for i, (doc, *_) in enumerate(edge_rows):
        same = [edge_rows[j][0] for j in range(len(label)) if label[j] == label[i]]
        want[doc, min(same, key=key), len(link[i])] += 1
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want
    kept = jaccard_join.distinct_documents(edge)
    assert kept.columns == edge.columns and kept.count() == len(set(label))
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_large_groups_are_dealt_in_blocks(spark, monkeypatch):
    from docroute.llm import near

    monkeypatch.setattr(near, "SIGNATURE_BLOCK", 8)
    monkeypatch.setattr(near, "TEXT_BLOCK", 5)
    rnd = np.random.default_rng(6)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in rnd.integers(0, 150, 2):
            w[k] = f"x{rnd.integers(10**6)}"
        rows.append((i, " ".join(w)))
    link, label = brute_links(rows)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (label[i], len(link[i])) for i in range(60)}


def test_depth_follows_recall():
    assert jaccard_join.depth_for(0.999, 0.8) == 4
    assert jaccard_join.depth_for(0.5, 0.8) == 5
    assert jaccard_join.depth_for(0.9999999, 0.5) == 1


def test_prefixes_are_shortened_as_far_as_needed():
    trees, depth = jaccard_join.TREES, jaccard_join.DEPTH
    reached = lambda d: 1 - np.prod(1 - 0.8**d)
    sizes = np.ones((3, trees, 3), np.int64)
    sizes[1] = [2, 50, 900]  # crowded everywhere: no more is shortened than the recall asks for
    sizes[2, :4] = [1, 7, 7]  # four trees with others, the rest alone
    got = jaccard_join.chosen_depths(sizes, 0.999, 0.8)
    assert all(reached(d) >= 0.999 for d in got)
    assert reached(np.where(np.arange(trees) == got[1].argmin(), got[1] + 1, got[1])) < 0.999 and got[1].max() == depth
    assert (got[2, :4] == depth).all()


def test_recall_of_the_join(spark):
    """Pairs about the threshold, against brute force."""
    rnd = np.random.default_rng(41)
    rows = []
    for k in range(150):
        base = [f"w{x}" for x in rnd.integers(0, 10**6, 120)]
        other = list(base)
        for i in rnd.choice(120, 1 + k % 4, replace=False):
            other[i] = f"y{k}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    link, _ = brute_links(rows)
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] <= len(link[i]) for i in range(len(rows)))
    assert sum(got.values()) >= 0.99 * sum(map(len, link)) > 150


# ---- 6 language


def test_language_id(spark, edge, empty):
    rnd = np.random.default_rng(7)
    parts = {"aa": ["the", "ing", "tion", "er", "and"], "bb": ["que", "los", "ción", "ar", "es"], "cc": ["sch", "ung", "ein", "über", "ß"]}
    rows = [(i, " ".join("".join(rnd.choice(parts[g], 3)) for _ in range(12)), g) for i, g in enumerate(list(parts) * 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(Scratch(spark, "t"), df.where(F.col("doc_id") % 7 != 1).select(F.xxhash64("doc_id").alias("key"), "lang", "text"))
    got = language_id.predict(df.drop("lang"), model, ["doc_id"]).collect()
    assert np.mean([r["lang_pred"] == rows[r["doc_id"]][2] for r in got]) > 0.99
    # The probabilities of the characters that may follow a context add up to one, for each language.
    t = model.shard(0).tables[2]
    for context in ("th", "qu"):
        every = np.array([(ord(context[0]) << 24) | (ord(context[1]) << 12) | c for c in range(language_id.LETTERS + language_id.FOLD)], np.uint64)
        assert np.exp(model.shard(0).log_probabilities(every, 3).astype(float)).sum(0) == pytest.approx([1, 1, 1], abs=1e-3)
    assert (np.diff(t.hashes.astype(object)) > 0).all()
    e = {r["doc_id"]: r for r in language_id.predict(edge, model, ["doc_id"]).collect()}
    assert {d for d, r in e.items() if r["lang_pred"] == "und"} == {0, 1, 2, 15}
    far = spark.createDataFrame([(1, "xq zk vj wq xx qz jx " * 9)], "doc_id long, text string")
    assert language_id.predict(far, model, ["doc_id"], reject=True).first()["lang_pred"] == "und"
    assert language_id.predict(empty, model, ["doc_id"]).count() == 0
    nothing = language_id.train(Scratch(spark, "t"), df.where("false").select(F.xxhash64("doc_id").alias("key"), "lang", "text"))
    assert nothing is None and language_id.predict(edge, None, ["doc_id"]).where("lang_pred <> 'und'").count() == 0


def test_no_language_is_lost_to_the_calibration(spark, tmp_path):
    """Rare languages whose few rows all are, or of which none is, in the calibration's fold."""
    inside = [k for k in range(4000) if _key(spark, k) % language_id.FOLDS == 0]
    outside = [k for k in range(400) if _key(spark, k) % language_id.FOLDS]
    rows = [(k, "en", "the house and the garden of the king") for k in outside[:300]] + [(k, "fi", "hyvää päivää kaikille täällä") for k in inside[:2]]
    rows += [(k, "sv", "och det är så här på ön") for k in outside[300:302]] + [(inside[5], "pl", "cześć wszystkim")]
    df = spark.createDataFrame([(k, *r[1:]) for k, r in ((_key(spark, x[0]), x) for x in rows)], "key long, lang string, text string")
    model = language_id.train(Scratch(spark, "t"), df)
    assert model.languages == ["en", "fi", "pl", "sv"]
    assert np.isfinite(model.limits).all()
    got = language_id.predict(spark.createDataFrame([(1, "päivää täällä"), (2, "det är på ön"), (3, "the king and the house")], "doc_id long, text string"), model, ["doc_id"]).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "fi", 2: "sv", 3: "en"}


_keys = {}


def _key(spark, k):
    if not _keys:
        _keys.update({r[0]: r[1] for r in spark.range(4000).selectExpr("id", "xxhash64(id)").collect()})
    return _keys[k]


def plain_kneser_ney(texts, order, discount):
    """log p(character | context) by dicts, from the definition."""
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        t = "\0" * (order - 1) + t.lower()
        counts[order].update(t[i - order + 1 : i + 1] for i in range(order - 1, len(t)))
    for n in range(order - 1, 0, -1):
        counts[n].update(r[1:] for r in counts[n + 1])
    total, types = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
    for n in range(1, order + 1):
        for r, c in counts[n].items():
            total[n][r[:-1]] += c
            types[n][r[:-1]] += 1

    def p(run):
        n = len(run)
        if not n:
            return 1 / (language_id.LETTERS + language_id.FOLD)
        context = run[:-1]
        if not total[n][context]:
            return p(run[1:])
        return max(counts[n][run] - discount, 0) / total[n][context] + discount * types[n][context] / total[n][context] * p(run[1:])

    return lambda t: sum(np.log(p(("\0" * (order - 1) + t.lower())[i : i + order])) for i in range(len(t)))


def test_against_plain_kneser_ney_in_one_shard_and_in_many(spark):
    rnd = np.random.default_rng(17)
    parts = {"aa": "abcde fgh", "bb": "hgf xyz abü"}
    rows = [(i, "".join(rnd.choice(list(parts[g]), 90)), g) for i, g in enumerate(["aa", "bb"] * 40)]
    df = spark.createDataFrame(rows, "key long, text string, lang string")
    held = {i for i, *_ in rows if i % language_id.FOLDS == 0}
    plain = {g: plain_kneser_ney([t for i, t, x in rows if x == g and i not in held], language_id.ORDER, language_id.DISCOUNT) for g in parts}
    asked = spark.createDataFrame([(k, t) for k, t in enumerate([rows[3][1], rows[4][1], "Qux 字 abc", "", None, rows[3][1]])], "id int, text string")
    for cells, many in ((1 << 23, 1), (900, 2)):
        model = language_id.train(Scratch(spark, "t"), df, cells=cells)
        assert model.count >= many and (many == 1) == (model.count == 1)
        got = {r["id"]: r["totals"] for r in language_id.totals(asked, model, ["id"]).collect()}
        for k, t in asked.collect():
            assert got[k] == pytest.approx([plain[g](t or "") for g in ("aa", "bb")], rel=1e-4, abs=1e-3)


def test_long_texts_are_cut_with_context(monkeypatch):
    text = "".join(chr(97 + i % 23) for i in range(1000))
    whole = language_id.runs([(0, "\0" * 4 + text)])[0]
    monkeypatch.setattr(language_id, "AT_ONCE", 70)
    parts = np.concatenate([language_id.runs(p)[0] for p in language_id.segments([text])])
    assert (whole == parts).all()


# ---- 7 substrings


def test_substring_dedup(spark, edge, edge_rows, empty):
    got = {r["doc_id"]: r for r in substring_dedup.substring_dedup(edge).collect()}
    # The copies' first is the row without doc_id; a longer document loses the paragraph, the passage in two others goes from the second.
    assert set(got) == {5, 6, 7, 9, 11}
    assert got[5]["kept"] == "" and got[9]["paragraphs_removed"] == 1 and got[11]["passages_removed"] == 1
    text = dict((r[0], r[1]) for r in edge_rows)
    assert got[9]["kept"] == "\n".join(text[9].split("\n")[:2])
    inside = " ".join(text[10].split()[40:70])
    assert inside in text[11] and inside not in got[11]["kept"]
    kept = substring_dedup.without_repeats(edge)
    assert kept.columns == edge.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in edge_rows if r[0] not in (5, 6, 7))
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_cut():
    assert substring_dedup.cut(b"x\ny\nz", {1}) == (b"x\nz", 1, 0)
    words_ = [b"w%d" % k for k in range(90)]
    line = b" ".join(words_)
    assert substring_dedup.cut(line, set(), ((20, 50), (21, 50))) == (b" ".join(words_[:20] + words_[71:]), 0, 1)
    assert substring_dedup.cut(line, set(), ((0, 1), (2, 1)))[0] == b" ".join([words_[1], *words_[3:]])
    assert substring_dedup.cut(b"", set()) == (b"", 0, 0)
    assert substring_dedup.bands_for(0.99, 0.8, 2) == 5


def plain_passages(rows, n=50):
    """What is left of each text, by comparing all windows: a word goes if a window of n words with it stands in an earlier document."""
    left, seen = {}, {}
    for doc, text in sorted(rows):
        w = text.split()
        own = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        gone = [False] * len(w)
        for i, g in enumerate(own):
            if seen.get(g, doc) != doc:
                gone[i : i + n] = [True] * n
        for g in own:
            seen.setdefault(g, doc)
        left[doc] = [x for x, y in zip(w, gone, strict=True) if not y]
    return left


def test_passages_against_all_windows(spark):
    """Short lines only, so that windows alone decide: passages, chains of overlapping ones, copies and a passage in very many documents."""
    rnd = np.random.default_rng(23)
    some = lambda n: [f"t{x}" for x in rnd.integers(0, 10**6, n)]
    pool = [some(int(n)) for n in rnd.integers(45, 140, 12)]
    common = some(57)
    rows = []
    for k in range(150):
        w = []
        for _ in range(int(rnd.integers(1, 4))):
            p = pool[rnd.integers(12)]
            cut = int(rnd.integers(0, 12))
            w += some(int(rnd.integers(0, 40))) + p[cut : len(p) - int(rnd.integers(0, 12))]
        rows.append((k, w + (common if k % 3 == 0 else []) + some(int(rnd.integers(0, 30)))))
    rows = [(k, "\n".join(" ".join(w[i : i + 13]) for i in range(0, len(w), 13))) for k, w in rows]
    rows += [(500 + k, rows[k][1]) for k in range(20)]
    got = {r["doc_id"]: r["kept"] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_passages(rows)
    assert {k: got.get(k, t).split() for k, t in rows} == want


def test_repeats_within_a_document_against_all_windows(spark):
    """A passage that stands twice in a document, with the same words around it, and once in an earlier document with others."""
    rnd = np.random.default_rng(29)
    some = lambda n: [f"r{x}" for x in rnd.integers(0, 10**6, n)]
    rows = []
    for k in range(12):
        passage, before, behind = some(80), some(int(rnd.integers(3, 60))), some(int(rnd.integers(3, 60)))
        again = before + passage + behind
        rows += [(10 * k, some(60) + passage + some(60)), (10 * k + 1, again * (2 + k % 3)), (10 * k + 2, some(9) + again + some(9)), (10 * k + 3, again * 2)]
    rows = [(k, "\n".join(" ".join(w[i : i + 13]) for i in range(0, len(w), 13))) for k, w in rows]  # no line is a paragraph
    got = {r["doc_id"]: r["kept"] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got.get(k, t).split() for k, t in rows} == plain_passages(rows)


def test_long_stretches_against_all_windows(spark):
    """Texts of few words, whose stretches hold more windows than a piece does, and shared parts that are not in a row."""
    rnd = np.random.default_rng(24)
    some = lambda n: [f"u{x}" for x in rnd.integers(0, 10**6, n)]
    round_ = some(9)
    left, right = some(30), some(30)
    core = some(22)
    rows = [(k, some(5) + (round_ * 60)[int(rnd.integers(0, 9)) : int(rnd.integers(60, 500))] + some(int(rnd.integers(0, 9)))) for k in range(12)]
    rows += [(20, some(8) + left + core + some(8)), (21, some(8) + core + right + some(8)), (22, some(3) + left + core + right + some(3))]
    rows += [(30 + k, some(6) + left[int(rnd.integers(0, 30)) :] + core + right[: int(rnd.integers(0, 30))] + some(6)) for k in range(30)]
    rows = [(k, "\n".join(" ".join(w[i : i + 11]) for i in range(0, len(w), 11))) for k, w in rows]
    got = {r["doc_id"]: r["kept"] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got.get(k, t).split() for k, t in rows} == plain_passages(rows)


def test_wrapped_passages_are_cut_in_full(spark):
    """Passages in lines of under 20 words, and ones that enter or leave a line in the middle."""
    rnd = np.random.default_rng(21)
    some = lambda n: [f"q{x}" for x in rnd.integers(0, 10**6, n)]
    wrap = lambda ws, n: "\n".join(" ".join(ws[i : i + n]) for i in range(0, len(ws), n))
    verse, across = some(60), some(64)
    own = [some(30) for _ in range(4)]
    rows = [
        (1, " ".join(own[0]) + "\n" + wrap(verse, 15) + "\nlast line"), (2, " ".join(own[1]) + "\n" + wrap(verse, 12) + "\nend here"),
        (3, wrap(own[2] + across, 16)), (4, wrap(across + own[3], 17)),
    ]
    got = {r["doc_id"]: r["kept"] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {2, 4}
    assert got[2].split() == own[1] + ["end", "here"] and got[4].split() == own[3]


def test_short_passages_go_to_their_exact_ends(spark):
    """Passages of just over 50 words inside long lines: every one is found, and no word of it is left in the second copy."""
    rnd = np.random.default_rng(22)
    some = lambda n: [f"r{x}" for x in rnd.integers(0, 10**6, n)]
    rows, rest = [], {}
    for k in range(30):
        passage, a, z = some(51), some(90), some(90)
        rows += [(k, " ".join(some(90) + passage + some(90))), (100 + k, " ".join(a + passage + z))]
        rest[100 + k] = " ".join(a + z)
    got = {r["doc_id"]: r["kept"] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == rest


# ---- 8 packing


@pytest.mark.parametrize("special", [True, False])
def test_tokens_equal_the_tokenizers(edge_rows, special):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    if not special:  # else the tokenizer's default holds, by which packing works
        t.encode_special_tokens = True
    encode = packing.encoder(packing.VOCABULARY, special) if not special else packing.encoder(path("byte_bpe_50k.json"))
    odd = ["a  b", " a", "a ", "a\n b", "a \n\n  b\t c", "it's we'll 12ab ,,x", "\u00a0x y\u00a0 z", "<|endoftext|> a", "\x1c a b", "a\u2003b c"]
    odd += ["<|endoftext|>", "one text<|endoftext|>next text", "a <|endoftext|><|endoftext|> b", "<|endoftext", "x <|endoftext|>\n y"]
    for text in odd + [r[1] or "" for r in edge_rows]:
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def brute_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return sorted(gaps)


def test_sweeps_are_best_fit_decreasing():
    rnd = np.random.default_rng(8)
    for capacity in (10, 64, 1024):
        lengths = rnd.integers(1, capacity + 1, 700).tolist()
        used = Counter()
        for length, a, b, first, offset, each in packing.sweeps(Counter(lengths), capacity):
            for k in range(b - a):
                assert used[first + k // each] == offset + k % each * length
                used[first + k // each] += length
        assert sorted(capacity - u for u in used.values()) == brute_best_fit(lengths, capacity)


def test_packing(spark, edge, edge_rows, empty):
    pieces = packing.tokenize(edge, keep_ids=True)
    got = packing.pack(pieces).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 0) == 1
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by) == len(brute_best_fit([r["length"] for r in got], 1024))
    full = packing.sequences(packing.pack(pieces)).collect()
    assert sum(len(r["ids"]) for r in full) == sum(r["length"] for r in got)
    assert packing.cut(1024) == [(0, 1024)] and packing.cut(1500) == [(0, 476), (476, 1024)] and packing.cut(3) == [(0, 3)]
    assert packing.pack(Scratch(spark, "t").table(packing.tokenize(empty), "p")).count() == 0


# ---- 9 suffixes


def brute_cut(texts, length, mode):
    seen = defaultdict(list)
    for k, b in enumerate(texts):
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]].append((k, i))
    out = []
    for k, b in enumerate(texts):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            at = seen[b[i : i + length]]
            if len(at) > 1 and (mode == "all" or at[0] != (k, i)):
                gone[i : i + length] = True
        out.append(bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b)
    return out


@pytest.mark.parametrize("mode", ["all", "later"])
def test_suffix_dedup(spark, mode):
    rnd = np.random.default_rng(9)
    piece = lambda n: bytes(rnd.integers(97, 123, n, dtype=np.uint8)).decode()
    shared = [piece(n) for n in (30, 39, 40, 41, 90, 200)]
    texts = ["", piece(20), "ab" * 100, "é" * 60]
    for _ in range(60):
        texts.append("".join(piece(int(rnd.integers(0, 80))) + shared[rnd.integers(6)] for _ in range(rnd.integers(1, 4))))
    texts += texts[-5:]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_cut([t.encode() for t in texts], 40, mode)
    got = {r["doc_id"]: r["kept"] for r in suffix_dedup.cut_repeats(df, length=40, kmer=12, mode=mode).collect()}
    assert {k: got.get(k, texts[k].encode()) for k in range(len(texts))} == dict(enumerate(want))


def test_crowded_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    rnd = np.random.default_rng(10)
    piece = lambda n: bytes(rnd.integers(97, 123, n, dtype=np.uint8)).decode()
    shared = piece(55)
    texts = [piece(int(rnd.integers(0, 30))) + shared + piece(int(rnd.integers(0, 30))) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for mode in ("all", "later"):
        want = brute_cut([t.encode() for t in texts], 40, mode)
        got = {r["doc_id"]: r["kept"] for r in suffix_dedup.cut_repeats(df, length=40, kmer=12, mode=mode).collect()}
        assert [got.get(k, texts[k].encode()) for k in range(len(texts))] == want


def test_crowded_windows_look_up_their_ends(spark, monkeypatch):
    """A range for each stretch and the windows before its first probe or after its last, not one for each window."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    rnd = np.random.default_rng(11)
    piece = lambda n: bytes(rnd.integers(97, 123, n, dtype=np.uint8)).decode()
    shared = piece(160)
    texts = [piece(20) + shared + piece(20) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for mode, many in (("all", 30), ("later", 29)):
        ranges = suffix_dedup.repeats(Scratch(spark, "t"), df, 40, 12, mode).collect()
        assert {(r["doc_id"], b) for r in ranges for b in range(r["start"], r["stop"])} >= {(d, b) for d in range(30 - many, 30) for b in range(20, 180)}
        assert len(ranges) < many * (160 - 40 + 1) / 3


def test_two_lengths_from_one_order(spark, monkeypatch):
    rnd = np.random.default_rng(12)
    piece = lambda n: bytes(rnd.integers(97, 99, n, dtype=np.uint8)).decode()
    shared = [piece(n) for n in (24, 25, 30, 39, 40, 41, 90)]
    texts = [piece(int(rnd.integers(0, 30))) + shared[rnd.integers(7)] + piece(int(rnd.integers(0, 30))) + shared[rnd.integers(7)] for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw = [t.encode() for t in texts]
    cut, short = brute_cut(raw, 40, "all"), brute_cut(raw, 25, "all")
    for crowd in (2000, 2):
        monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
        got = {r["doc_id"]: r for r in suffix_dedup.cut_repeats(df, length=40, kmer=12, short=25).collect()}
        for k, t in enumerate(raw):
            assert (got[k]["kept"], got[k]["n_short"]) == (cut[k], len(t) - len(short[k])) if k in got else (cut[k], short[k]) == (t, t)


def test_heads_are_the_suffix_order():
    rnd = np.random.default_rng(13)
    texts = [bytes(rnd.integers(0, 3, int(n), dtype=np.uint8)) for n in rnd.integers(0, 60, 30)]
    suffixes = [t[i:] for t in texts for i in range(len(t))]
    for n, rank in zip((7, 10, 28, 40), suffix_dedup.heads(texts, (7, 10, 28, 40)), strict=True):
        order = {h: k for k, h in enumerate(sorted({x[:n] for x in suffixes}), 1)}
        assert rank.tolist() == [order[x[:n]] for x in suffixes]
    some = rnd.permutation(len(suffixes))[:90]
    for n, rank in zip((7, 10, 28, 40), suffix_dedup.heads(texts, (7, 10, 28, 40), some), strict=True):
        order = {h: k for k, h in enumerate(sorted({suffixes[x][:n] for x in some}), 1)}
        assert rank.tolist() == [order[suffixes[x][:n]] for x in some]


def test_suffix_edge_rows(edge, edge_rows, empty):
    got = suffix_dedup.cut_repeats(edge)
    gone = {r["doc_id"]: r["n_removed"] for r in got.collect()}
    text = {r[0]: (r[1] or "").encode() for r in edge_rows}
    assert gone[6] == len(text[6]) and gone[None] == len(text[None]) and gone[13] == len(text[13]) and 0 not in gone and 14 not in gone
    assert suffix_dedup.cut_repeats(empty).count() == 0


# ---- 10 rules


def test_quality_rules(spark, edge, edge_rows, empty):
    got = quality_rules.quality_rules(edge)
    want = duckdb.connect()
    import pandas as pd

    documents = pd.DataFrame(edge_rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    want.register("documents", documents)
    rows = want.execute(quality_rules.ORACLE).fetchall()
    assert Counter(tuple(r) for r in got.collect()) == Counter(rows)
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[13]["n_repeat_words"] == 700 and by[13]["base_failed"] and by[0]["n_words"] == 0 and not by[0]["kept"]
    assert quality_rules.quality_rules(empty).count() == 0


def test_repeats_of_very_long_texts(spark):
    """Over 2^20 words, whole windows against a plain count; and bins of large metrics."""
    rnd = np.random.default_rng(31)
    own = [f"v{x}" for x in rnd.integers(0, 10**7, 700_000)]
    passage = [f"p{k}" for k in range(420_000)]
    long_ = passage + own + passage
    rows = [(1, " ".join(long_)), (2, "字" * 3000 + " " + "語" * 2000), (3, "a b c " * 40)]
    got = {r["doc_id"]: r for r in quality_rules.features(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS lang", "'y' AS source")).collect()}
    seen = Counter(zip(long_, long_[1:], long_[2:]))
    covered = np.zeros(len(long_), bool)
    for i in range(len(long_) - 2):
        if seen[tuple(long_[i : i + 3])] > 1:
            covered[i : i + 3] = True
    assert got[1]["n_words"] == len(long_) and got[1]["n_repeat_words"] == int(covered.sum())
    assert got[3]["n_repeat_words"] == 120
    bins = spark.createDataFrame([(0, 0, 0, 0, 2, 25 * k, 1) for k in (20, 204, 1000, 2500)], "n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long, n_words long, word_chars long, x int")
    assert [r[0] for r in bins.select(quality_rules._metrics()["word_length"]).collect()] == [2500 - 2500 % 4, 25500 - 25500 % 32, 125000 - 125000 % 128, 312500 - 312500 % 512]


def test_windows_whose_hashes_meet(spark, monkeypatch):
    """All windows share one hash: only the words tell them apart."""
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    text = "a b c d a b c x a b c d y z w y z w"
    row = spark.createDataFrame([(1, text, "x", "y")], "doc_id long, text string, lang string, source string")
    assert quality_rules.features(row).first()["n_repeat_words"] == 4 + 3 + 4 + 6
