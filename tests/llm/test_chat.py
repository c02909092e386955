"""Chat formatting: grammar round trips, awkward rows, and the query's SQL."""

import hashlib
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docroute.llm import chat_format as cf

PARTS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/OUT]", "[OUT]", "[ROLE]", "[TEXT]", "[/TEXT]", "\\", " ", "a", "\n", "[", "]", "é😀"]), max_size=8).map("".join)
SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "system", "assistant"]), PARTS), PARTS), max_size=5))
def test_every_conversation_reads_back(turns):
    pieces = [cf.written(role, text) for role, text in turns]
    text = "".join(p[0] for p in pieces)
    got = list(cf.parse(text))
    assert [g[:2] for g in got] == turns
    assert [cf.unescape(text[a:z]) for _, _, a, z in got] == [t for _, t in turns]


def test_plain_texts_are_not_escaped():
    assert cf.written("user", "a \\ b [inst]")[0] == "[INST] a \\ b [inst] [/INST]"
    assert cf.written("user", "a \\[INST]")[0] == "[INST] a \\\\[INST] [/INST]"


@pytest.mark.parametrize("bad", ["[INST] a", "[INST]a [/INST]", "a [INST] b [/INST]", "[INST] [/INST]", "[OUT] a [/INST]", "[ROLE] a [/TEXT]", "[INST] a [/INST] ", "</s>", "[INST] a [SYS] b [/INST]"])
def test_bad_texts_have_no_parse(bad):
    with pytest.raises(cf.BadFormat):
        list(cf.parse(bad))


def awkward(rnd):
    rows = [(-3, None, None, None), (-3, 1, "user", ""), (None, 0, "tool", "x </s>"), (None, 1, "assistant", "y"), (5, 0, "user", "same"), (5, 0, "user", "same")]
    rows += [(6, t, "assistant" if t % 2 else "user", "\\" * t + "[/OUT]" * t) for t in range(9)]
    rows += [(7, 0, "user", "long " * 200_000), (7, 1, "assistant", cf.PROBE * 30_000)]
    rows += [(8, t, rnd.choice(["user", "assistant"]), f"turn {t} <s>") for t in range(5000)]
    return rows


def plain(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    for conv, turns in out.items():
        learnt = "".join(t for r, t in turns if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        yield conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt)


def test_awkward_conversations(spark):
    rows = awkward(random.Random(1))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS place", "'clash' AS formatted", "1 AS start")
    pieces = cf.format_turns(df.repartition(5))
    got = {tuple(r)[:5]: r["formatted_chars"] for r in cf.read_back(pieces).collect()}
    assert set(got) == set(plain(rows))
    whole = {}
    for r in pieces.collect():
        whole.setdefault(r["conv_id"], []).append(r["formatted"])
    assert {k[0]: v for k, v in got.items()} == {c: len("".join(p)) for c, p in whole.items()}
    text = "".join(whole[6])
    assert text.startswith("<s>") and text.endswith("</s>") and len(list(cf.parse(text[:-4], 3))) == 9
    assert cf.read_back(cf.format_turns(df.limit(0))).count() == 0


def test_query_and_sql(spark, tmp_path):
    rows = [r for r in awkward(random.Random(2)) if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {tuple(r) for r in cf.op11_chat_formatting(spark, str(tmp_path)).collect()}
    assert set(plain([*rows, (-7, 0, "user", cf.PROBE), (-7, 1, "assistant", cf.PROBE)])) == {r[:5] for r in got}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    names = [x.split()[0] for x in cf.DIGESTS.split(", ")]
    assert set(con.execute(f"SELECT {', '.join(names)} FROM ({cf.ORACLE})").fetchall()) == got
