"""Readers, fuzzy matching and streams on small inputs."""

import datetime
import io
import zipfile

from pyspark.sql import functions as F

from docroute.conf import PipelineConf
from docroute.functions import similarity as S
from docroute.operators import matching, resolve
from docroute.sources import readers
from docroute.streaming import intake


def test_similarity_ratios():
    assert S.ratio("this is a test", "this is a test!") == 200 * 14 / 29
    assert S.partial_ratio("this is a test", "this is a test!") == 100
    assert S.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert S.similarity("wuzzy fuzzy was a bear", "bear a was fuzzy wuzzy") == 100
    assert S.similarity(None, "x") == 0 and S.similarity(" ", "x") == 0
    assert S.common_length("abcbdab", "bdcaba") == 4


def test_tiers_and_focus(spark):
    inc = [("k", 1, n, h, p, t, None) for n, h, p, t in [(1, "h1", 0, ""), (2, "h2", 0, ""), (3, "h3", 0, ""), (4, "zz", 7, ""), (5, "yy", 0x0F0F0F0F0F0F0F0F, "alpha beta gamma delta"), (6, "c", 0, "cargo control document 400-1234567890")]]
    arc = [("k", d, n, h, p, t, None) for d, n, h, p, t in [(10, 1, "h1", -2, ""), (10, 2, "h2", -2, ""), (10, 3, "h3", -2, ""), (11, 1, "q", 5, ""), (10, 4, "r", 0x5555555555555555, "gamma beta alpha delta"), (11, 9, "c", 0, "")]]
    names = "page_hash string, phash long, text string, ocr string"
    p = matching.page_pairs(spark.createDataFrame(inc, f"awb string, file_id long, page_no int, {names}"), spark.createDataFrame(arc, f"awb string, doc long, doc_page int, {names}"))
    got = {r["page_no"]: (r["method"], r["doc"]) for r in matching.claim(p).collect()}
    assert got == {1: ("HASH", 10), 2: ("HASH", 10), 3: ("HASH", 10), 5: ("TEXT", 10)}  # document 10 is in focus when page 4 meets 11


def test_workbook_keys(spark, tmp_path):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c t="s"><v>0</v></c><c><v>399617498819</v></c><c t="inlineStr"><is><t>x 1111-2222-3333</t></is></c></row></sheetData></worksheet>'
    texts = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>key 123456789012</t></si></sst>'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", texts)
    assert sorted(r["awb"] for r in readers.keys_of_workbooks(spark, str(tmp_path)).collect()) == ["111122223333", "123456789012", "399617498819"]


def test_zip_and_json(spark):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a.PDF", b"1")
        z.writestr("b.txt", b"2")
    f = spark.createDataFrame([("p", data.getvalue()), ("q", b"no zip"), ("r", None)], "path string, content binary")
    assert [tuple(r) for r in readers.zip_members(f).collect()] == [("p", "a.PDF", bytearray(b"1"))]
    r = spark.createDataFrame([("k", '{"groups":[{"documents":[{"documentId":"1"},{"id":"2"}]},{"documents":[{"x":1}]}]}'), ("l", "{bad"), ("m", None)], "awb string, body string")
    assert sorted((x["awb"], x["document_id"]) for x in readers.archive_documents(r).collect()) == [("k", "1"), ("k", "2")]
    c = spark.createDataFrame([('{"1": {"exists": true, "checked_at": "t"}, "2": false, "3": "junk"}',)], "body string")
    assert sorted(map(tuple, readers.existence_cache(c).collect())) == [("1", True, "t"), ("2", False, None)]


def test_last_wins_and_upsert(spark):
    d = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y")], "k string, n int, v string")
    assert sorted(map(tuple, readers.last_wins(d, "k", "n").collect())) == [("a", 3, "z"), ("b", 2, "y")]
    new = spark.createDataFrame([("a", 9, "w", True)], "k string, n int, v string, extra boolean")
    assert sorted(map(tuple, readers.upsert(readers.last_wins(d, "k", "n"), new, "k").collect())) == [("a", 9, "w", True), ("b", 2, "y", None)]


def test_stability(spark):
    o = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 1), ("b", 2, 2), ("c", 1, 0), ("c", 2, 0)], "path string, ts int, size int")
    assert dict(map(tuple, intake.stable_files(o).collect())) == {"a": True, "b": False, "c": False}


def test_rate_limit(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    rows = [("a", t + datetime.timedelta(milliseconds=m)) for m in (0, 300, 700, 900, 1600, 1750)] + [("b", t)]
    spark.createDataFrame(rows, "path string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("path string, ts timestamp").parquet(str(tmp_path / "in"))
    q = intake.rate_limited(s).writeStream.format("memory").queryName("limited").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r["path"], (r["ts"] - t).total_seconds()) for r in spark.table("limited").collect())
    assert got == [("a", 0.0), ("a", 0.9), ("a", 1.75), ("b", 0.0)]


def test_stream_equals_batch(spark, tmp_path):
    keys = spark.createDataFrame([("399617498819",), ("123456789012",)], "awb string")
    rows = [(1, "AWB NO: 399617498819"), (2, "Ref. 123456789012"), (3, "nothing"), (4, "Ref. 399617498818")]
    spark.createDataFrame(rows, "file_id int, text string").repartition(3).write.parquet(str(tmp_path / "in"))
    build = lambda df: resolve.prioritize(resolve.tiered_candidates(df, keys, "file_id").withColumn("hits", F.lit(1)), keys, "file_id").drop("ties")
    stream = spark.readStream.schema("file_id int, text string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    intake.run_batches(stream, build, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(200)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, build(spark.read.parquet(str(tmp_path / "in"))).collect()))


def test_conf(monkeypatch):
    monkeypatch.setenv("DOCROUTE_BATCH_PAGES", "20")
    monkeypatch.setenv("DOCROUTE_REJECT_RATIO", "junk")
    assert PipelineConf.from_env() == PipelineConf(batch_pages=20)


def test_case_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text("\ufefftext,expected_awb\nAWB 1,399617498819\nnone,\n ,123456789012\n", encoding="utf-8")
    assert sorted(map(tuple, readers.confusion_case_file(spark, str(tmp_path / "c.csv")).collect()), key=str) == [("AWB 1", "399617498819"), ("none", None)]


def test_fresh_keys(spark, tmp_path):
    spark.createDataFrame([("1",)], "awb string").write.parquet(str(tmp_path / "k"))
    build = readers.with_fresh_keys(lambda b, k: b.join(k, "awb", "left_semi"), str(tmp_path / "k"))
    rows = spark.createDataFrame([("1",), ("2",)], "awb string")
    assert build(rows).count() == 1
    spark.createDataFrame([("2",)], "awb string").write.mode("append").parquet(str(tmp_path / "k"))
    assert build(rows).count() == 2


def test_logs_grow_and_are_not_written_twice(spark, tmp_path):
    from docroute.operators import audit

    log = str(tmp_path / "log")
    audit.append_rows(spark.createDataFrame([(1, "a")], "k int, x string"), log, "k")
    audit.append_rows(spark.createDataFrame([(1, "again", 5), (2, "b", 6)], "k int, x string, n int"), log, "k")
    assert sorted(map(tuple, audit.read_log(spark, log).select("k", "x", "n").collect())) == [(1, "a", None), (2, "b", 6)]
    audit.append_json(spark.createDataFrame([("BATCH", "OK"), ("BATCH", None)], "stage string, status string"), str(tmp_path / "events"))
    lines = sorted(x["value"] for x in spark.read.text(str(tmp_path / "events")).collect())
    assert lines == ['{"stage":"BATCH","status":"OK"}', '{"stage":"BATCH"}']
