"""Readers: workbooks of keys, archive responses, existence and stage caches, zip members, page folders."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions.extract import any_text_keys

_NAME = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def workbook_cells(content: bytes) -> list[str]:
    """The texts of all cells of all sheets of an xlsx file."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_NAME}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NAME}si")]
        out = []
        for name in sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)):
            for c in ElementTree.fromstring(z.read(name)).iter(f"{_NAME}c"):
                v, inline = c.find(f"{_NAME}v"), c.find(f"{_NAME}is")
                if c.get("t") == "s" and v is not None:
                    out.append(shared[int(v.text)])
                elif inline is not None:
                    out.append("".join(t.text or "" for t in inline.iter(f"{_NAME}t")))
                elif v is not None and v.text:
                    out.append(v.text)
        return out


def keys_of_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """awb: the distinct 12-digit keys of any cell of the workbooks at a path."""

    def cells(batches):
        for b in batches:
            yield pa.record_batch({"cell": pa.array([c for content in b.column("content").to_pylist() for c in workbook_cells(content)], pa.string())})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("content")
    return files.mapInArrow(cells, "cell string").select(F.explode(any_text_keys("cell")).alias("awb")).distinct()


def zip_members(files: DataFrame) -> DataFrame:
    """path, member, content of the pages (pdf, tif, tiff) in zip files (path, content); what is no zip is skipped."""

    def run(batches):
        for b in batches:
            rows = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        rows += [(path, n, z.read(n)) for n in z.namelist() if n.lower().endswith((".pdf", ".tif", ".tiff"))]
                except zipfile.BadZipFile:
                    continue
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary()), strict=True)], ["path", "member", "content"])

    return files.select("path", "content").mapInArrow(run, "path string, member string, content binary")


def archive_documents(responses: DataFrame) -> DataFrame:
    """awb, document_id, place from metadata answers (awb, body): ids under either name, in order; bad JSON has none."""
    schema = "groups array<struct<documents:array<struct<documentId:string,id:string>>>>"
    g = responses.select("awb", F.posexplode_outer(F.from_json("body", schema)["groups"]).alias("group_no", "group"))
    d = g.select("awb", "group_no", F.posexplode(F.col("group.documents")).alias("no", "d"))
    d = d.select("awb", "group_no", "no", F.coalesce("d.documentId", "d.id").alias("document_id")).where("document_id is not null")
    return d.select("awb", "document_id", F.struct("group_no", "no").alias("place"))


def existence_cache(texts: DataFrame, *keep: str) -> DataFrame:
    """awb, exists, checked_at (and columns to keep) from JSON maps (body); values are objects or bare booleans."""
    entries = texts.select(*keep, F.explode(F.from_json("body", "map<string,string>")).alias("awb", "value"))
    o = F.from_json("value", "exists boolean, checked_at string")
    bare = F.col("value").isin("true", "false")
    return entries.select("awb", F.when(bare, F.col("value") == "true").otherwise(o["exists"]).alias("exists"), F.when(~bare, o["checked_at"]).alias("checked_at"), *keep).where("exists is not null")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: the last in `order`."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of `new` in place of those of `old` with the same key; columns may be added."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def confusion_case_file(spark: SparkSession, path: str) -> DataFrame:
    """text, expected from a CSV of cases; blank texts go, a blank key is a negative case, any other than 12 digits an error."""
    c = spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8").csv(path)
    c = c.withColumnsRenamed({n: n.lstrip("\ufeff").strip() for n in c.columns})
    expected = F.nullif(F.trim(F.coalesce("expected_awb" if "expected_awb" in c.columns else F.lit(""), F.lit(""))), F.lit(""))
    bad = F.raise_error(F.concat(F.lit("not a 12-digit key: "), expected)).cast("string")
    return c.where(F.trim("text") != "").select("text", F.when(expected.isNull() | expected.rlike(r"^\d{12}$"), expected).otherwise(bad).alias("expected"))


def with_fresh_keys(build, keys_path: str):
    """A micro-batch builder that reads the keys anew for each batch, so that a running stream sees new ones."""
    return lambda batch: build(batch, batch.sparkSession.read.parquet(keys_path))
