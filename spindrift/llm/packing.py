"""Best-fit packing of documents into token sequences, in rounds up a tree.

Each partition packs its own pieces by best fit, longest first, and emits its nearly full bins. After
best fit all bins of a node but one are over half full, and of two bins that can be joined one is at most
half full. So at a node of the tree as many bins as it has children can be put into others. That one
climbs with as many of the node's emptiest bins, which take whatever a fuller bin could; the others are
final, since more receivers would join no more bins. The bins that arrive at a node are items of another
best-fit round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.bpe import CHUNK_BYTES, Bpe, parts
from spindrift.llm.common import cut, regroup, strings

#: Pieces that are packed together at most.
PACK_PIECES = 200_000
#: A bin with at most so much room is emitted.
NEARLY_FULL = 8
#: Nodes that meet at their parent.
FAN = 16

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long, node long"
MEMBERS = pa.list_(pa.struct([("bin", pa.int64()), ("base", pa.int64())]))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: items by falling size, each into the fullest bin that has room for it."""
    bins: list[list[int]] = []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: a bin with room r is open
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        if room > size:
            with_room.setdefault(room - size, []).append(b)
            rooms |= 1 << (room - size)
    return bins


def climbing(fills: list[int], capacity: int) -> list[int]:
    """The bins that go on to the next round: those at most half full, and one receiver for each child that may send such a bin."""
    open_bins = sorted((b for b in range(len(fills)) if capacity - fills[b] > NEARLY_FULL), key=lambda b: fills[b])
    small = sum(2 * fills[b] <= capacity for b in open_bins)
    return open_bins[: small + FAN]


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens: full ones from the end, so the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((a, capacity) for a in range(first, n, capacity))]


def _pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        node = TaskContext.get().partitionId()
        next_bin = node << 32
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal next_bin
            bins = best_fit([row[3] for row in held], capacity)
            fills = [sum(held[i][3] for i in b) for b in bins]
            up = set(climbing(fills, capacity))
            rows = []
            for b, items in enumerate(bins):
                offset = 0
                for i in items:
                    rows.append((*held[i], next_bin + b, offset, fills[b], node if b in up else None))
                    offset += held[i][3]
            next_bin += len(bins)
            held.clear()
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 7]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in PIECE_SCHEMA.split(", ")])

        for t in regroup(batches, "text", CHUNK_BYTES):
            doc_ids, texts = t.column("doc_id").to_pylist(), strings(t.column("text"))
            for a, b in parts(texts, CHUNK_BYTES):
                ids, bounds = bpe.encode_batch(texts[a:b])
                for doc_id, i, j in zip(doc_ids[a:b], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    raw = np.append(ids[i:j], end_id).astype("<u4")
                    for k, (start, length) in enumerate(cut_pieces(len(raw), capacity)):
                        held.append((doc_id, k, start, length, zlib.crc32(raw[start : start + length].tobytes())))
                    if len(held) >= PACK_PIECES:
                        yield flush()
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


def _round(bins: DataFrame, capacity: int) -> DataFrame:
    """One round: the bins (node, fill, members) that meet at each parent node, packed as items. node is null once a bin is final."""
    listed = bins.withColumn("node", F.expr(f"node div {FAN}")).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("fill", "members"))).alias("bins"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for node, own in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True):
                packed = best_fit([x["fill"] for x in own], capacity)
                fills = [sum(own[i]["fill"] for i in b) for b in packed]
                up = set(climbing(fills, capacity))
                members = []
                for items in packed:
                    base, into = 0, []
                    for i in items:
                        into += [{"bin": m["bin"], "base": m["base"] + base} for m in own[i]["members"]]
                        base += own[i]["fill"]
                    members.append(into)
                yield pa.RecordBatch.from_arrays([pa.array([node if b in up else None for b in range(len(packed))], pa.int64()), pa.array(fills, pa.int64()), pa.array(members, MEMBERS)], names=["node", "fill", "members"])

    return listed.mapInArrow(run, "node long, fill long, members array<struct<bin:long,base:long>>")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece of a document: where it begins, its length and checksum, its sequence and its place there.

    A document is the ids of its text and end_id. Only documents over the capacity are cut, into full
    pieces but for the first. A null or empty text is end_id alone; a very long one is many full pieces;
    pieces of equal length go in the order of their rows; null ids and repeated rows are packed like others;
    an empty table gives no rows. Only columns doc_id and text are read, so others may have any names.
    """
    pieces = cut(_pieces(docs, vocabulary, end_id, capacity))
    bins = pieces.where("node IS NOT NULL").groupBy("bin").agg(F.first("node").alias("node"), F.first("fill").alias("fill"))
    level = bins.select("node", "fill", F.array(F.struct("bin", F.lit(0).cast("long").alias("base"))).alias("members"))
    top = level.agg(F.max("node")).first()[0]
    settled = []
    while top is not None:
        packed = cut(_round(level, capacity))
        settled.append(packed.where("node IS NULL"))
        level, top = packed.where("node IS NOT NULL"), top // FAN if top else None
    settled.append(level)
    placed = settled[0]
    for x in settled[1:]:
        placed = placed.unionByName(x)
    moves = placed.select(F.expr("members[0].bin").alias("sequence_id"), F.explode("members").alias("m")).select("sequence_id", F.col("m.bin").alias("bin"), F.col("m.base").alias("base"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    final = pieces.where("node IS NULL").select(*columns, F.col("bin").alias("sequence_id"), "offset")
    moved = pieces.where("node IS NOT NULL").join(moves, "bin").select(*columns, "sequence_id", (F.col("offset") + F.col("base")).alias("offset"))
    return final.unionByName(moved)
