"""ISO media containers: a writer of one-track files and a reader of sample tables.

The reader walks nested boxes and decodes the sample tables (stsd, stts, stss, stsz, stsc, stco, co64)
into codec, duration and the byte ranges of keyframes. It does not decode sample payloads.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spindrift.llm.common import strings

#: Bytes of payload in one media sample: a frame of so many 8-bit values.
FRAME = 64
#: Each so-many-th sample is a keyframe.
KEY_EVERY = 16
#: Samples in a chunk of the file.
CHUNK_SAMPLES = 64
RATE = 8000
#: Fixed values of the format: boxes that hold boxes.
CONTAINERS = (b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta")
MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)

KEYFRAMES = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration double, keyframes array<struct<start:long,length:long>>"


def box(kind: bytes, *body: bytes) -> bytes:
    size = 8 + sum(map(len, body))
    head = struct.pack(">I4s", size, kind) if size < 1 << 32 else struct.pack(">I4sQ", 1, kind, size + 8)
    return b"".join((head, *body))


def full(kind: bytes, version: int, *body: bytes) -> bytes:
    return box(kind, struct.pack(">I", version << 24), *body)


def padded(text: bytes) -> bytes:
    """text with zero bytes up to a positive multiple of FRAME."""
    return text + bytes(-len(text) % FRAME or (0 if text else FRAME))


def write_container(payload: bytes) -> bytes:
    """A file of one track of 8-bit values; payload is a multiple of FRAME. Equal payloads give equal files."""
    frames = len(payload) // FRAME
    chunks = -(-frames // CHUNK_SAMPLES)
    wide = len(payload) + 65536 + 16 * frames >= 1 << 32
    v, moment = (1, ">QQIQ") if wide else (0, ">IIII")
    ftyp = box(b"ftyp", b"qt  ", struct.pack(">I", 512), b"qt  ")
    runs = [(1, CHUNK_SAMPLES)] if frames >= CHUNK_SAMPLES else []
    if frames % CHUNK_SAMPLES:
        runs.append((chunks, frames % CHUNK_SAMPLES))
    sound = box(b"raw ", bytes(6), struct.pack(">HHHIHHHHI", 1, 0, 0, 0, 1, 8, 0, 0, RATE << 16))
    keys = np.arange(1, frames + 1, KEY_EVERY, dtype=">u4")
    stsd = full(b"stsd", 0, struct.pack(">I", 1), sound)
    stts = full(b"stts", 0, struct.pack(">III", 1, frames, FRAME))
    stss = full(b"stss", 0, struct.pack(">I", len(keys)), keys.tobytes())
    stsc = full(b"stsc", 0, struct.pack(">I", len(runs)), *(struct.pack(">III", first, n, 1) for first, n in runs))
    stsz = full(b"stsz", 0, struct.pack(">II", FRAME, frames))

    def moov(base: int) -> bytes:
        offsets = base + np.arange(chunks, dtype=np.int64) * (CHUNK_SAMPLES * FRAME)
        stco = full(b"co64" if wide else b"stco", 0, struct.pack(">I", chunks), offsets.astype(">u8" if wide else ">u4").tobytes())
        dinf = box(b"dinf", full(b"dref", 0, struct.pack(">I", 1), box(b"url ", struct.pack(">I", 1))))
        minf = box(b"minf", full(b"smhd", 0, bytes(4)), dinf, box(b"stbl", stsd, stts, stss, stsc, stsz, stco))
        hdlr = full(b"hdlr", 0, bytes(4), b"soun", bytes(12), b"\0")
        mdhd = full(b"mdhd", v, struct.pack(moment, 0, 0, RATE, len(payload)), struct.pack(">HH", 0x55C4, 0))
        size = ">QQIIQ" if wide else ">IIIII"
        tkhd = full(b"tkhd", v, struct.pack(size, 0, 0, 1, 0, len(payload)), bytes(8), struct.pack(">hhhh", 0, 0, 256, 0), MATRIX, bytes(8))
        mvhd = full(b"mvhd", v, struct.pack(moment, 0, 0, RATE, len(payload)), struct.pack(">ih", 0x10000, 256), bytes(10), MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, minf)))

    head = len(ftyp) + len(moov(0)) + (16 if 8 + len(payload) >= 1 << 32 else 8)
    return b"".join((ftyp, moov(head), box(b"mdat", payload)))


@dataclass
class Track:
    codec: str = ""
    timescale: int = 1
    duration: float = 0.0
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))


def boxes(data: memoryview, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Kind and content range of each box in a range; sizes of 0 (to the end) and 1 (64 bits) included."""
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            if at + 16 > end:
                raise ValueError("box cut off")
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise ValueError("box cut off")
        yield kind, at + head, at + size
        at += size


def _table(data: memoryview, at: int, kind: str, width: int = 1, skip: int = 4) -> np.ndarray:
    count = struct.unpack_from(">I", data, at + skip)[0]
    found = np.frombuffer(data, dtype=kind, count=count * width, offset=at + skip + 4).astype(np.int64)
    return found.reshape(count, width) if width > 1 else found


def read_tracks(content: bytes) -> list[Track]:
    """The tracks of a file; raises ValueError or struct.error if its boxes are broken."""
    data = memoryview(content)
    tracks: list[dict] = []

    todo = [boxes(data, 0, len(data))]
    while todo:  # as deep as the file nests its boxes
        found = next(todo[-1], None)
        if found is None:
            todo.pop()
            continue
        kind, a, b = found
        if kind == b"trak":
            tracks.append({})
        if kind in CONTAINERS:
            todo.append(boxes(data, a, b))
        elif tracks:
            tracks[-1][kind] = (a, b)
    return [_resolve(data, t) for t in tracks]


def _resolve(data: memoryview, at: dict[bytes, tuple[int, int]]) -> Track:
    out = Track()
    if b"mdhd" in at:
        a = at[b"mdhd"][0]
        out.timescale, ticks = struct.unpack_from(">IQ", data, a + 20) if data[a] == 1 else struct.unpack_from(">II", data, a + 12)
        out.duration = ticks / max(1, out.timescale)
    if b"stsd" in at:
        out.codec = bytes(data[at[b"stsd"][0] + 12 : at[b"stsd"][0] + 16]).decode("latin-1")
    if b"stsz" not in at:
        return out
    a = at[b"stsz"][0]
    fixed, count = struct.unpack_from(">II", data, a + 4)
    if fixed * count > len(data):
        raise ValueError("samples beyond the file")
    out.sizes = np.full(count, fixed, dtype=np.int64) if fixed else _table(data, a, ">u4", skip=8)
    if b"stts" in at and not out.duration:
        runs = _table(data, at[b"stts"][0], ">u4", 2)
        out.duration = float((runs[:, 0].astype(np.float64) * runs[:, 1]).sum()) / max(1, out.timescale)
    offsets = _table(data, at[b"co64"][0], ">u8") if b"co64" in at else _table(data, at[b"stco"][0], ">u4")
    runs = _table(data, at[b"stsc"][0], ">u4", 3)
    if len(runs) and len(offsets):
        spans = np.diff(np.r_[runs[:, 0], len(offsets) + 1])
        per_chunk = np.repeat(runs[:, 1], spans)
        if per_chunk.astype(np.float64).sum() != len(out.sizes):
            raise ValueError("chunks and samples differ")
        chunk_of = np.repeat(np.arange(len(offsets)), per_chunk)
        before = np.cumsum(out.sizes) - out.sizes
        first = np.r_[0, np.cumsum(per_chunk)][:-1]
        out.starts = offsets[chunk_of] + before - before[np.minimum(first, len(before) - 1)][chunk_of]
        if len(out.starts) and (out.starts.min() < 0 or (out.starts + out.sizes).max() > len(data)):
            raise ValueError("samples beyond the file")
    out.keys = _table(data, at[b"stss"][0], ">u4") - 1 if b"stss" in at else np.arange(len(out.sizes))
    if len(out.keys) and (out.keys.min() < 0 or out.keys.max() >= len(out.sizes)):
        raise ValueError("keyframes beyond the samples")
    return out


def read_payload(content: bytes, track: Track) -> bytes:
    """All samples of a track in order; samples that touch are read as one piece."""
    if not len(track.starts):
        return b""
    ends = track.starts + track.sizes
    cut = np.flatnonzero(track.starts[1:] != ends[:-1]) + 1
    view = memoryview(content)
    return b"".join(view[a:b] for a, b in zip(track.starts[np.r_[0, cut]].tolist(), ends[np.r_[cut - 1, len(ends) - 1]].tolist(), strict=True))


def describe(track: Track) -> str:
    keys = np.stack([track.starts[track.keys], track.sizes[track.keys]], axis=1).astype("<i8") if len(track.starts) else np.zeros((0, 2), "<i8")
    return f"codec={track.codec.strip()};timescale={track.timescale};duration={track.duration:.6f};samples={len(track.sizes)};keyframes={len(keys)};ranges={zlib.crc32(keys.tobytes()):08x}"


def media_features(media: DataFrame, column: str, id_column: str) -> DataFrame:
    """Codec, duration in seconds and keyframe byte ranges of the first track of each file in a binary column.

    Null, empty or broken files give nulls, as do those whose tables point beyond the file; a track without
    a sync table has keyframes only. Compact sample sizes (stz2) and movie fragments are not read: such a
    track has no samples. Null ids stay null, repeated rows give repeated rows, files of any size and depth
    of boxes are walked, an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            codec, duration, keys = [], [], []
            for content in t.column(1).to_pylist():
                try:
                    found = (read_tracks(content or b"") or [None])[0]
                    ranges = None if found is None else [{"start": s, "length": n} for s, n in zip(found.starts[found.keys].tolist(), found.sizes[found.keys].tolist(), strict=True)]
                except (ValueError, struct.error, IndexError, KeyError):
                    found = ranges = None
                codec.append(found and found.codec)
                duration.append(found and found.duration)
                keys.append(ranges)
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(codec, pa.string()), pa.array(duration, pa.float64()), pa.array(keys, KEYFRAMES)], names=[id_column, "codec", "duration", "keyframes"])

    kind = media.schema[id_column].dataType.simpleString()
    return media.select(id_column, column).mapInArrow(run, f"`{id_column}` {kind}, codec string, duration double, keyframes array<struct<start:long,length:long>>")


def store_texts(docs: DataFrame) -> DataFrame:
    """Stores each text in a container, reads the container back and describes it; one row per document.

    A null text is empty: a payload of FRAME zero bytes. Equal texts give equal values. A text of any
    length is one payload. A null id stays null; repeated rows give repeated rows; an empty table gives no
    rows; other columns are not read, so they may have any names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *[x.split()[0] for x in SCHEMA.split(", ")[1:]]]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64()]
        for t in batches:
            rows, keys, counts = [], [], []
            for doc_id, text in zip(t.column(0).to_pylist(), strings(t.column(1)), strict=True):
                raw = text.encode()
                media = write_container(padded(raw))
                track = read_tracks(media)[0]
                back = read_payload(media, track)
                rows.append((doc_id, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-FRAME:]), len(media), hashlib.sha256(media).hexdigest(), describe(track), track.codec.strip(), track.duration))
                keys.append(np.stack([track.starts[track.keys], track.sizes[track.keys]]))
                counts.append(keys[-1].shape[1])
            if not rows:
                continue
            both = np.concatenate(keys, axis=1)
            ranges = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.StructArray.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["start", "length"]))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)), ranges], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
