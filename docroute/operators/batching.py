"""Capacity-limited batches: sequence numbers, next-fit packing and names."""

from __future__ import annotations

import pickle
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroute.sources.scratch import shared_dir

CAPACITY, COVER = 48, 1


def _step(used: int, n: int, capacity: int) -> tuple[bool, int]:
    """Whether a group of n pages opens a batch, and the pages used then; all that is over the capacity is one state."""
    opens = used > 0 and used + n > capacity
    return opens, min(n if opens else used + n, capacity + 1)


def _keys(b: pa.RecordBatch, by: list[str]) -> list[tuple]:
    return list(zip(*(b.column(c).to_pylist() for c in by), strict=True)) if by else [()] * b.num_rows


def _summaries(by: list[str], size: str, capacity: int):
    """Of each block: what its first run's groups make of every state it may begin in, and where its last run ends."""

    def run(batches):
        out, block = [], None
        for b in batches:
            for part, key, n in zip(b.column("part_").to_pylist(), _keys(b, by), b.column(size).to_pylist(), strict=True):
                n = n or 0
                if block is None or block["part"] != part:
                    block = {"part": part, "head": key, "rows": 0, "exits": list(range(capacity + 2)), "opened": [0] * (capacity + 2), "last": None, "seq": 0, "batch": 1, "used": 0}
                    out.append(block)
                if block["last"] is None and key == block["head"]:
                    block["rows"] += 1
                    met: dict[int, tuple[bool, int]] = {}  # states soon fall together
                    for k, used in enumerate(block["exits"]):
                        if used not in met:
                            met[used] = _step(used, n, capacity)
                        block["opened"][k] += met[used][0]
                        block["exits"][k] = met[used][1]
                    continue
                if key != block["last"]:
                    block |= {"last": key, "seq": 0, "batch": 1, "used": 0}
                opens, used = _step(block["used"], n, capacity)
                block |= {"seq": block["seq"] + 1, "batch": block["batch"] + opens, "used": used}
        yield pa.record_batch([pa.array([pickle.dumps(x) for x in out], pa.binary())], ["block"])

    return run


def next_fit(groups: DataFrame, by: list[str], order: list[str], size: str, capacity: int = CAPACITY) -> DataFrame:
    """Add seq, batch_no and start_page: in order, a new batch opens when the next group does not fit.

    Rows are range-sorted into blocks, so a run of one `by` (a tier and a month) may span many. The state that a block begins in is one of capacity + 2
    (pages used); a first reading gives, for each block, what each of them becomes, the driver chains these tables (one for a block), and a
    second reading places the rows of every block from its own state. No run needs one task, and no task holds a run. `order` tells rows apart.
    A group larger than a batch gets one of its own.
    """
    spark, names = groups.sparkSession, [*by, *order, size]
    rows = groups.select(*by, *order, F.col(size).cast("long").alias(size))
    sort = [F.col(c) for c in (*by, *order)]
    tagged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else rows.coalesce(1)
    path = f"{shared_dir(spark)}/next-fit-{uuid.uuid4().hex}"
    tagged.select("*", F.spark_partition_id().alias("part_"), F.monotonically_increasing_id().alias("place_")).write.parquet(path)
    blocks = spark.read.parquet(path).repartition("part_").sortWithinPartitions("part_", "place_")
    found = sorted((pickle.loads(r["block"]) for r in blocks.select("part_", *by, size).mapInArrow(_summaries(by, size, capacity), "block binary").collect()), key=lambda x: x["part"])

    begin, key, seq, batch, used = {}, None, 0, 1, 0
    for x in found:
        if not begin or x["head"] != key:
            seq, batch, used = 0, 1, 0
        begin[x["part"]] = (seq, batch, used)
        if x["last"] is None:
            key, seq, batch, used = x["head"], seq + x["rows"], batch + x["opened"][used], x["exits"][used]
        else:
            key, seq, batch, used = x["last"], x["seq"], x["batch"], x["used"]
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in ("seq", "batch_no", "start_page"))])

    def place(batches):
        part, last, seq, batch, used = None, None, 0, 1, 0
        for b in batches:
            out = []
            for at, key, n in zip(b.column("part_").to_pylist(), _keys(b, by), b.column(size).to_pylist(), strict=True):
                if at != part:
                    part, last, (seq, batch, used) = at, key, begin[at]
                elif key != last:
                    last, seq, batch, used = key, 0, 1, 0
                opens, after = _step(used, n or 0, capacity)
                seq, batch = seq + 1, batch + opens
                out.append((seq, batch, 1 if opens else used + 1))
                used = after
            columns = [pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 3
            yield pa.record_batch([*(b.column(c) for c in names), *columns], [*names, "seq", "batch_no", "start_page"])

    return blocks.mapInArrow(place, schema)


def collision_name(df: DataFrame, stem: str, order: list[str], mark: str = "_") -> DataFrame:
    """Add name: the stem for its first row, then stem_2, stem_3 ..."""
    n = F.row_number().over(Window.partitionBy(stem).orderBy(*order))
    return df.withColumn("name", F.concat(F.col(stem), F.when(n > 1, F.concat(F.lit(mark), n.cast("string"))).otherwise(F.lit("")), F.lit(".pdf")))


def batch_name(base: str, tier: Column, number: Column) -> Column:
    return F.format_string("%s_T%s_%03d.pdf", F.lit(base), F.substring(tier, 1, 1), number)
