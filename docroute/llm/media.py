"""Media columns: ISO base media containers (MP4, MOV, fragmented MP4) as rows of plain facts.

The reader walks nested boxes, decodes the sample tables and keeps codec, duration and the byte ranges of key
frames; payloads are never decoded. The writer stores bytes as a track of uncompressed 8x8 RGB frames.

A null or empty container, or one whose boxes or tables do not fit its bytes, gets nulls and a status that says why.
Repeated rows give repeated results; columns of any name are kept by media_columns().
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import as_bytes, prepare

HOLDERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"mvex", b"moof", b"traf", b"edts", b"dinf"}
FRAME, SIDE, TIMESCALE, CHUNK = 192, 8, 25, 64


class BadContainer(ValueError):
    """The boxes or tables contradict each other or the container's length."""


def boxes(data: bytes, start: int, end: int, path: tuple[bytes, ...] = ()):
    """(path, first byte, first byte of the body, end) of every box, outer before inner."""
    while start < end:
        if end - start < 8:
            raise BadContainer("cut box header")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if end - start < 16:
                raise BadContainer("cut box header")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop > end or stop < body:
            raise BadContainer(f"box {kind.decode('latin-1')} leaves its parent")
        yield (*path, kind), start, body, stop
        if kind in HOLDERS:
            yield from boxes(data, body, stop, (*path, kind))
        start = stop


@dataclass
class Track:
    number: int = 0
    handler: str = ""
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    fragments: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    key: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))


def _table(data: bytes, at: int, end: int, kind: str, width: int = 1) -> np.ndarray:
    """The entries of a counted table as rows of whole numbers."""
    (n,) = struct.unpack_from(">I", data, at + 4)
    dtype = np.dtype(kind)
    if at + 8 + n * width * dtype.itemsize > end:
        raise BadContainer("a table leaves its box")
    return np.frombuffer(data, dtype, n * width, at + 8).astype(np.int64).reshape(n, width)


def _compact(data: bytes, at: int, end: int) -> np.ndarray:
    """Sample sizes of 4, 8 or 16 bits."""
    bits, (n,) = data[at + 7], struct.unpack_from(">I", data, at + 8)
    if bits not in (4, 8, 16) or at + 12 + (n * bits + 7) // 8 > end:
        raise BadContainer("a table leaves its box")
    if bits == 4:
        two = np.frombuffer(data, np.uint8, (n + 1) // 2, at + 12)
        return np.stack([two >> 4, two & 15], 1).ravel()[:n].astype(np.int64)
    return np.frombuffer(data, f">u{bits // 8}", n, at + 12).astype(np.int64)


def _codec(data: bytes, at: int, end: int, handler: str) -> str:
    """The codec of the first sample entry, with what its configuration box says of profile and level."""
    if end - at < 16:
        raise BadContainer("no sample entry")
    entry, size = at + 8, struct.unpack_from(">I", data, at + 8)[0]
    name, stop = data[entry + 4 : entry + 8].decode("latin-1"), min(end, entry + size)
    inner = entry + {"vide": 86, "soun": 36}.get(handler, 1 << 62)
    if inner >= stop:
        return name
    try:
        own = {path[-1]: data[body:z] for path, _, body, z in boxes(data, inner, stop)}
    except BadContainer:  # entries of other layouts hold no boxes there
        return name
    if c := own.get(b"avcC", b"")[1:4]:
        return f"{name}.{c.hex()}"
    if len(c := own.get(b"hvcC", b"")) >= 13:
        space, profile, tier = c[1] >> 6, c[1] & 31, "LH"[c[1] >> 5 & 1]
        flags = int(f"{int.from_bytes(c[2:6]):032b}"[::-1], 2)
        more = c[6:12].rstrip(b"\0")
        return ".".join([name, f"{('', 'A', 'B', 'C')[space]}{profile}", f"{flags:X}", f"{tier}{c[12]}", *(f"{x:X}" for x in more)])
    if len(c := own.get(b"av1C", b"")) >= 3:
        depth = 8 + 2 * (c[2] >> 6 & 1) * (1 + (c[2] >> 5 & 1) * (c[1] >> 5 == 2))
        return f"{name}.{c[1] >> 5}.{c[1] & 31:02d}{'MH'[c[2] >> 7]}.{depth:02d}"
    return _audio_object(name, own[b"esds"]) if b"esds" in own else name


def _audio_object(name: str, data: bytes) -> str:
    """mp4a.40.2 and the like, from the descriptors of an esds box."""
    at, out = 4, [name]
    while at + 2 <= len(data):
        tag, at = data[at], at + 1
        while at < len(data) and data[at] & 128:  # a length of up to four bytes of seven bits
            at += 1
        at += 1
        if tag == 3:
            flags = data[at + 2] if at + 2 < len(data) else 0
            at += 3 + 2 * (flags >> 7) + (1 + data[at + 3] if flags & 64 and at + 3 < len(data) else 0) + 2 * (flags >> 5 & 1)
        elif tag == 4 and at < len(data):
            out.append(f"{data[at]:x}")
            at += 13
        elif tag == 5 and at + 1 < len(data):
            kind = data[at] >> 3
            out.append(str(kind if kind < 31 else 32 + ((data[at] & 7) << 3 | data[at + 1] >> 5)))
            break
        else:
            break
    return ".".join(out)


def _samples(t: Track, tables: dict[bytes, np.ndarray], fixed: tuple[int, int] | None, length: int) -> None:
    """Offsets and sizes from the chunk and size tables."""
    if fixed:
        if fixed[0] * fixed[1] > length:
            raise BadContainer("samples leave the container")
        t.sizes = np.full(fixed[1], fixed[0], np.int64)
    chunks, runs = tables.get(b"stco", tables.get(b"co64", np.zeros((0, 1), np.int64)))[:, 0], tables.get(b"stsc", np.zeros((0, 3), np.int64))
    n = len(t.sizes)
    if n and (not len(chunks) or not len(runs) or runs[0, 0] != 1 or (np.diff(runs[:, 0]) <= 0).any()):
        raise BadContainer("no chunks for the samples")
    if n:
        of_chunk = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(chunks) + 1)).clip(0))[: len(chunks)]
        if of_chunk.sum() != n:
            raise BadContainer("chunk and size tables disagree")
        first = np.cumsum(of_chunk) - of_chunk
        before = np.cumsum(t.sizes) - t.sizes
        base = chunks - before[np.minimum(first, n - 1)]
        t.offsets = np.repeat(base, of_chunk) + before
    t.key = np.ones(n, bool)
    if b"stss" in tables:
        at = tables[b"stss"][:, 0] - 1
        if len(at) and (at.min() < 0 or at.max() >= n):
            raise BadContainer("a key frame that is no sample")
        t.key = np.zeros(n, bool)
        t.key[at] = True


def _fragment(data: bytes, items: list, tracks: dict[int, Track], defaults: dict[int, tuple], moof: int) -> None:
    """Samples of one movie fragment."""
    t, size, flags, duration = None, 0, 0, 0
    base = after = stop = moof  # the base of offsets, where the next run begins, and where the last track's data ended
    for k, (kind, at, end) in enumerate(items):
        if kind == b"tfhd":
            (have, number) = struct.unpack_from(">II", data, at)
            t, at = tracks.get(number), at + 8
            if t is None:
                raise BadContainer("a fragment of no track")
            duration, size, flags = defaults.get(number, (0, 0, 0))
            base = moof if have & 0x20000 or all(x[0] != b"tfhd" for x in items[:k]) else stop
            if have & 1:
                (base,), at = struct.unpack_from(">Q", data, at), at + 8
            at += 4 * bool(have & 2)
            for bit in (8, 16, 32):
                if have & bit:
                    (v,), at = struct.unpack_from(">I", data, at), at + 4
                    duration, size, flags = (v if bit == 8 else duration), (v if bit == 16 else size), (v if bit == 32 else flags)
            after = base
        elif kind == b"trun" and t is not None:
            have, n = struct.unpack_from(">II", data, at)
            at, offset, first = at + 8, after, flags
            if have & 1:
                offset, at = base + struct.unpack_from(">i", data, at)[0], at + 4
            if have & 4:
                (first,), at = struct.unpack_from(">I", data, at), at + 4
            names = [b for b in (256, 512, 1024, 2048) if have & b]
            if at + 4 * n * len(names) > end or (not names and n > len(data)):
                raise BadContainer("a fragment's table leaves its box")
            table = np.frombuffer(data, ">u4", n * len(names), at).astype(np.int64).reshape(n, len(names))
            column = lambda b, other: table[:, names.index(b)] if b in names else np.full(n, other, np.int64)  # noqa: E731, B023
            sizes, marks = column(512, size), column(1024, flags)
            if n and have & 4 and not have & 1024:
                marks[0] = first
            t.offsets = np.append(t.offsets, offset + np.cumsum(sizes) - sizes)
            t.sizes, t.key = np.append(t.sizes, sizes), np.append(t.key, (marks & 0x10000) == 0)
            t.duration += int(column(256, duration).sum())
            t.fragments += 1
            after = stop = offset + int(sizes.sum())


def read_container(data: bytes) -> list[Track]:
    """The tracks of a container."""
    tracks: dict[int, Track] = {}
    defaults: dict[int, tuple] = {}
    fragments: dict[int, list] = {}
    t, tables, fixed, done = Track(), {}, None, []
    moof = 0
    try:
        for path, whole, at, end in boxes(data, 0, len(data)):
            kind = path[-1]
            if kind == b"moof":
                moof = whole
            elif path[:1] == (b"moof",):
                fragments.setdefault(moof, []).append((kind, at, end))
            elif kind == b"trak":
                t, tables, fixed = Track(), {}, None
                done.append((t, tables, len(done)))
            elif kind == b"tkhd":
                (t.number,) = struct.unpack_from(">I", data, at + (20 if data[at] else 12))
                tracks[t.number] = t
            elif kind == b"mdhd":
                t.timescale, t.duration = struct.unpack_from(">IQ", data, at + 20) if data[at] else struct.unpack_from(">II", data, at + 12)
            elif kind == b"hdlr" and b"mdia" in path:
                t.handler = data[at + 8 : at + 12].decode("latin-1")
            elif kind == b"stsd":
                t.codec = _codec(data, at, end, t.handler)
            elif kind == b"stsz":
                size, n = struct.unpack_from(">II", data, at + 4)
                if size:
                    tables[b"fixed"] = (size, n)
                else:
                    t.sizes = _table(data, at + 4, end, ">u4")[:, 0]
            elif kind == b"stz2":
                t.sizes = _compact(data, at, end)
            elif kind in (b"stco", b"stss"):
                tables[kind] = _table(data, at, end, ">u4")
            elif kind == b"co64":
                tables[kind] = _table(data, at, end, ">u8")
            elif kind == b"stsc":
                tables[kind] = _table(data, at, end, ">u4", 3)
            elif kind == b"stts":
                tables[kind] = _table(data, at, end, ">u4", 2)
            elif kind == b"trex":
                number, _, duration, size, flags = struct.unpack_from(">5I", data, at + 4)
                defaults[number] = (duration, size, flags)
        for t, tables, _ in done:
            _samples(t, tables, tables.pop(b"fixed", None), len(data))
            if b"stts" in tables and len(tables[b"stts"]):
                t.duration = int((tables[b"stts"][:, 0] * tables[b"stts"][:, 1]).sum())
        for start, items in sorted(fragments.items()):
            _fragment(data, items, tracks, defaults, start)
    except (struct.error, IndexError, OverflowError) as e:
        raise BadContainer(str(e)) from e
    out = [t for t, _, _ in done]
    if not out:
        raise BadContainer("no track")
    for t in out:
        if len(t.offsets) and (t.offsets.min() < 0 or (t.offsets + t.sizes).max() > len(data)):
            raise BadContainer("samples leave the container")
    return out


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def write_container(payload: bytes, key_every: int = 1) -> bytes:
    """A container whose one track has the payload as uncompressed 8x8 RGB frames; a frame is 192 bytes."""
    n, rest = divmod(len(payload), FRAME)
    if rest or not n:
        raise ValueError("the payload must be whole frames")
    unit = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 24, -1))
    starts = range(0, n, CHUNK)
    runs = [(1, CHUNK, 1)] * (n >= CHUNK) + [(n // CHUNK + 1, n % CHUNK, 1)] * (n % CHUNK > 0)
    full = lambda kind, *parts: _box(kind, bytes(4), *parts)

    def head(offset: int) -> bytes:
        far = offset + len(payload) >= 1 << 32
        tables = [
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, n, 1)),
            full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            full(b"stsz", struct.pack(">II", FRAME, n)),
            full(b"co64" if far else b"stco", struct.pack(">I", len(starts)), np.array([offset + s * FRAME for s in starts], ">u8" if far else ">u4").tobytes()),
        ]
        if key_every > 1:
            keys = np.arange(1, n + 1, key_every, dtype=">u4")
            tables.append(full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()))
        media = _box(
            b"mdia",
            full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, n, 0x55C4, 0)),
            full(b"hdlr", bytes(4), b"vide", bytes(13)),
            _box(b"minf", _box(b"vmhd", struct.pack(">IHHHH", 1, 0, 0, 0, 0)), _box(b"dinf", full(b"dref", struct.pack(">I", 1), _box(b"url ", struct.pack(">I", 1)))), _box(b"stbl", *tables)),
        )
        track = _box(b"trak", _box(b"tkhd", struct.pack(">IIIIII", 7, 0, 0, 1, 0, n), bytes(8), struct.pack(">HHHH", 0, 0, 0, 0), unit, struct.pack(">II", SIDE << 16, SIDE << 16)), media)
        movie = _box(b"moov", full(b"mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, n, 0x10000, 0x100), bytes(10), unit, bytes(24), struct.pack(">I", 2)), track)
        return _box(b"ftyp", b"qt  ", bytes(4), b"qt  ", b"isom") + movie

    offset = len(head(0)) + 8
    if len(payload) + 8 >= 1 << 32:
        offset += 8
        return head(offset) + struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) + payload
    return head(offset) + struct.pack(">I4s", len(payload) + 8, b"mdat") + payload


def key_ranges(t: Track) -> list[tuple[int, int]]:
    """(start, length) of runs of key frames that stand together in the container."""
    at, size = t.offsets[t.key], t.sizes[t.key]
    if not len(at):
        return []
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1] + size[:-1]))
    total = np.add.reduceat(size, first)
    return list(zip(at[first].tolist(), total.tolist(), strict=True))


INFO = pa.struct(
    [
        ("status", pa.string()), ("handler", pa.string()), ("codec", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("seconds", pa.float64()),
        ("samples", pa.int64()), ("key_frames", pa.int64()), ("key_ranges", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
    ]
)
INFO_DDL = "array<struct<status:string,handler:string,codec:string,timescale:bigint,duration:bigint,seconds:double,samples:bigint,key_frames:bigint,key_ranges:array<struct<start:bigint,length:bigint>>>>"


def _facts(data: bytes | None) -> list[dict]:
    if not data:
        return [{"status": "empty"}]
    try:
        tracks = read_container(data)
    except BadContainer as e:
        return [{"status": f"bad: {e}"}]
    return [
        {
            "status": "ok", "handler": t.handler, "codec": t.codec, "timescale": t.timescale, "duration": t.duration, "seconds": t.duration / t.timescale if t.timescale else None,
            "samples": len(t.sizes), "key_frames": int(t.key.sum()), "key_ranges": [{"start": s, "length": n} for s, n in key_ranges(t)],
        }
        for t in tracks
    ]


def media_columns(df: DataFrame, media: str = "media", into: str = "tracks") -> DataFrame:
    """Add the column `into`: a struct of facts for each track of the containers in the binary column `media`."""
    prepare(df.sparkSession)

    @F.arrow_udf(INFO_DDL)
    def facts(column: pa.Array) -> pa.Array:
        return pa.array([_facts(x.as_py()) for x in column], pa.list_(INFO))

    return df.withColumn(into, facts(F.col(media)))


def store_texts(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes and `media`: the text's bytes, filled up with spaces to whole frames, as a container."""

    def write(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            stored = [write_container(x + b" " * (max(-(-len(x) // FRAME), 1) * FRAME - len(x))) for x in texts]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_bytes": pa.array(map(len, texts), pa.int64()), "media": pa.array(stored, pa.binary())})

    prepare(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), as_bytes().alias("text")).mapInArrow(write, "doc_id long, n_bytes long, media binary")


def read_texts(stored: DataFrame) -> DataFrame:
    """Read each container's payload by its sample tables and describe it."""

    def read(batches):
        for b in batches:
            out = []
            for data in b.column("media").to_pylist():
                (t,) = read_container(data)
                first = np.flatnonzero(np.append(True, t.offsets[1:] != t.offsets[:-1] + t.sizes[:-1]))
                total = np.add.reduceat(t.sizes, first)
                payload = b"".join(data[s : s + n] for s, n in zip(t.offsets[first].tolist(), total.tolist(), strict=True))
                rgb = np.frombuffer(payload, np.uint8).reshape(-1, 3).sum(0, dtype=np.int64)
                feature = f"{t.codec.strip()};frames={len(t.sizes)};seconds={t.duration}/{t.timescale};key={key_ranges(t)};rgb={','.join(map(str, rgb))}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature, t.codec, t.duration, t.timescale, int(t.key.sum())))
            names = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "codec", "duration", "timescale", "key_frames")
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.record_batch([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "n_bytes", *names])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration long, timescale long, key_frames long"
    return stored.mapInArrow(read, schema)


def op1_media_columns(spark, sf_dir: str) -> DataFrame:
    return read_texts(store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
