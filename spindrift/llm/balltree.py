"""Exact top-k by inner product with a ball tree per shard.

Vectors are dealt into shards by space: a tree of splits, fitted on a bounded sample, sends each to a leaf,
and large leaves are cut into parts. Each part gets a ball tree, each leaf a ball around its parts. Blocks of
queries from one leaf meet shards in rounds: first one part of their own leaf, then the leaves of highest
upper bound, then all leaves whose bound reaches the kth score that some query has by then. So a pair of a
block and a shard that cannot add an answer is dropped before anything is moved. Within a shard, nodes are
visited by descending upper bound q.c + |q| r and are left out for all queries whose kth score is higher;
equal bounds are visited, since ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.llm.common import cut

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF_ROWS = 128
#: Vectors on which splits are fitted at most, those of the smallest hashes; leaves of one length, and numbers in all their centres, at most.
FIT_ROWS, MOST_LEAVES, MOST_NUMBERS = 20_000, 1024, 1 << 20
#: Lengths of vectors that are split, the most frequent ones; the leaves of others are cut by rows only.
LENGTHS = 8
#: Leaves of highest bound that a block meets before all others.
NEAR = 4
#: Query blocks that stream past one copy of a shard.
BLOCKS_A_COPY = 64
#: Below every score of two int64 vectors that is kept as a double.
NOTHING = np.iinfo(np.int64).min
#: Sums of products up to this size are exact in doubles.
EXACT = 2.0**53

ROUTED = "vec_id long, dim int, leaf int, v binary"
SHARD_SCHEMA = "dim int, leaf int, part int, ids binary, data binary, centre binary, radius double, largest double"
BLOCK_SCHEMA = "block string, dim int, leaf int, ids binary, data binary"
HIT_SCHEMA = "query_id long, vec_id long, score long"
Splits = dict[int, tuple[np.ndarray, np.ndarray]]


class BallTree:
    """Nodes over rows of `data`, which it reorders: each has a centre, a radius and either a row range or two children."""

    def __init__(self, ids: np.ndarray, data: np.ndarray):
        order = np.arange(len(ids))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            own = data[order[a:b]]
            me = len(self.spans)
            if parent >= 0:
                pair = list(self.children[parent] or (0, 0))
                pair[side] = me
                self.children[parent] = tuple(pair)
            self.spans.append((a, b))
            centre = own.mean(axis=0)
            centres.append(centre)
            radii.append(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
            self.children.append(None)
            if b - a > LEAF_ROWS and radii[-1] > 0 and own.shape[1]:
                axis = int(own.var(axis=0).argmax())
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)]
                self.children[me] = (0, 0)
                todo += [(a, a + mid, me, 0), (a + mid, b, me, 1)]
        self.ids, self.data = ids[order], data[order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.largest = float(np.abs(data).max(initial=0))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best rows of each query, of those whose score is at least floor; NOTHING where there are fewer."""
        n, dim = queries.shape
        safe = self.largest * float(np.abs(queries).max(initial=0)) * max(1, dim) < EXACT
        bound = bounds(queries, self.centres, self.radii, np.full(len(self.radii), self.largest))
        best, best_ids = np.full((n, k), NOTHING), np.full((n, k), np.iinfo(np.int64).max)
        kth = floor.copy()
        heap = [(-np.inf, 0, np.arange(n))]
        while heap:
            _, node, active = heapq.heappop(heap)
            active = active[bound[active, node] >= kth[active]]
            if not len(active):
                continue
            if self.children[node]:
                for child in self.children[node]:
                    own = active[bound[active, child] >= kth[active]]
                    if len(own):
                        heapq.heappush(heap, (-float(bound[own, child].max()), child, own))
                continue
            a, b = self.spans[node]
            for i in range(a, b, 4 * LEAF_ROWS):
                ids = self.ids[i : min(b, i + 4 * LEAF_ROWS)]
                scores = inner(queries[active], self.data[i : i + len(ids)], safe)
                scores[ids[None, :] == query_ids[active][:, None]] = NOTHING
                scores[scores < floor[active][:, None]] = NOTHING
                all_scores = np.concatenate([best[active], scores], axis=1)
                all_ids = np.concatenate([best_ids[active], np.broadcast_to(ids, scores.shape)], axis=1)
                top = np.lexsort((all_ids, -np.maximum(all_scores, NOTHING + 1)), axis=1)[:, :k]
                best[active], best_ids[active] = np.take_along_axis(all_scores, top, 1), np.take_along_axis(all_ids, top, 1)
                kth[active] = np.maximum(kth[active], best[active][:, -1])
        return best, best_ids


def inner(queries: np.ndarray, rows: np.ndarray, safe: bool) -> np.ndarray:
    """Integer inner products: by doubles while they are exact, else by whole numbers of any size, cut to 64 bits."""
    if safe:
        return (queries @ rows.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in queries], dtype=object).reshape(queries.shape) @ np.array([[int(x) for x in r] for r in rows], dtype=object).reshape(rows.shape).T
    return np.clip(whole, NOTHING + 1, np.iinfo(np.int64).max).astype(np.int64)


def fitted(sample: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and threshold of each split of a balanced tree with `leaves` (a power of two) leaves, level by level."""
    axes, thresholds = np.zeros(leaves - 1, dtype=np.int64), np.zeros(leaves - 1)
    own = {0: sample}
    for node in range(leaves - 1):
        rows = own.pop(node)
        if len(rows):
            axes[node] = int(rows.var(axis=0).argmax())
            thresholds[node] = np.median(rows[:, axes[node]])
        right = rows[:, axes[node]] > thresholds[node]
        own[2 * node + 1], own[2 * node + 2] = rows[~right], rows[right]
    return axes, thresholds


def leaf_of(splits: tuple[np.ndarray, np.ndarray] | None, vectors: np.ndarray) -> np.ndarray:
    at = np.zeros(len(vectors), dtype=np.int64)
    if splits is None:
        return at
    axes, thresholds = splits
    while len(at) and at[0] < len(axes):  # all are on one level
        at = 2 * at + 1 + (vectors[np.arange(len(at)), axes[at]] > thresholds[at])
    return at - len(axes)


def whole_numbers(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the rows that have it and their components as floor(64 x)."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = np.floor(64.0 * lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() :].astype(np.float64))
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == dim)
        yield dim, own, flat[starts[own][:, None] + np.arange(dim)].reshape(len(own), dim)


def _splits(rows: DataFrame) -> Splits:
    """The splits of each frequent length; the sample is bounded, so are the leaves."""
    counts = rows.groupBy(F.size("v").alias("dim")).count().where(F.col("count") > SHARD_ROWS).orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()
    out: Splits = {}
    for r in counts:
        dim, n = r["dim"], r["count"]
        sample = rows.where(F.size("v") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("v").toArrow()
        if not dim or not sample.num_rows:
            continue
        (_, _, x), *_ = whole_numbers(sample.column(0).combine_chunks())
        most = min(MOST_LEAVES, MOST_NUMBERS // dim, len(x) // 16, -(-n // SHARD_ROWS))
        leaves = 1 << max(0, int(most).bit_length() - 1)
        if leaves > 1:
            out[dim] = fitted(x, leaves)
    return out


def _routed(rows: DataFrame, splits: Splits) -> DataFrame:
    """vec_id, dim, leaf and v, the components as doubles, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ids = t.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for dim, own, x in whole_numbers(t.column(1)):
                leaf = leaf_of(splits.get(dim), x)
                raw = pa.array([v.tobytes() for v in x], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(np.full(len(own), dim), pa.int32()), pa.array(leaf, pa.int32()), raw], names=["vec_id", "dim", "leaf", "v"])

    return rows.select("vec_id", "v").mapInArrow(run, ROUTED)


def _runs(batches: Iterator[pa.RecordBatch], keys: int, limit: int) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """For consecutive rows with equal first columns, `limit` at most: the key, their ids and their vectors."""
    key, ids, raw = None, [], []
    for t in batches:
        columns = [c.to_pylist() for c in t.columns]
        for row in zip(*columns, strict=True):
            if key != row[:keys] or len(ids) >= limit:
                if ids:
                    yield key, np.array(ids, dtype=np.int64), np.frombuffer(b"".join(raw)).reshape(len(ids), -1)
                key, ids, raw = row[:keys], [], []
            ids.append(row[keys])
            raw.append(row[keys + 1])
    if ids:
        yield key, np.array(ids, dtype=np.int64), np.frombuffer(b"".join(raw)).reshape(len(ids), -1)


def _shards(routed: DataFrame, n: int) -> DataFrame:
    """The parts of all leaves with their balls. Rows of a leaf are dealt to its parts by place, so equal rows part too."""
    sizes = routed.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n"))
    counted = routed.join(F.broadcast(sizes.where(F.col("n") > SHARD_ROWS)), ["dim", "leaf"], "left")  # n / SHARD_ROWS leaves at most
    parts = F.coalesce(F.ceil(F.col("n") / SHARD_ROWS), F.lit(1))
    dealt = counted.withColumn("part", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), parts).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, leaf, part), ids, x in _runs(batches, 3, 4 * SHARD_ROWS):
            centre = x.mean(axis=0)
            radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([leaf], pa.int32()), pa.array([part], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([centre.tobytes()], pa.binary()), pa.array([radius]), pa.array([float(np.abs(x).max(initial=0))])],
                names=[c.split()[0] for c in SHARD_SCHEMA.split(", ")],
            )

    placed = dealt.select("dim", "leaf", "part", "vec_id", "v").repartition(max(1, -(-n // SHARD_ROWS)), "dim", "leaf", "part").sortWithinPartitions("dim", "leaf", "part")
    return placed.mapInArrow(run, SHARD_SCHEMA).withColumn("number", F.xxhash64("ids"))


def _blocks(routed: DataFrame, m: int) -> DataFrame:
    """Blocks of queries of one leaf each; large leaves are dealt to several tasks."""
    sizes = routed.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n"))
    counted = routed.join(F.broadcast(sizes.where(F.col("n") > BLOCK_ROWS)), ["dim", "leaf"], "left")  # m / BLOCK_ROWS leaves at most
    dealt = counted.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.coalesce(F.ceil(F.col("n") / BLOCK_ROWS), F.lit(1))).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, leaf, part), ids, x in _runs(batches, 3, BLOCK_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([f"{dim}/{leaf}/{part}/{ids[0]}"]), pa.array([dim], pa.int32()), pa.array([leaf], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

    placed = dealt.select("dim", "leaf", "part", "vec_id", "v").repartition(max(1, -(-m // BLOCK_ROWS)), "dim", "leaf", "part").sortWithinPartitions("dim", "leaf", "part", "vec_id")
    return placed.mapInArrow(run, BLOCK_SCHEMA)


def bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of each query (rows) in each ball (columns); infinite where doubles are not exact."""
    norms = np.sqrt((queries**2).sum(axis=1))
    out = queries @ centres.T + norms[:, None] * radii
    out += 0.5 + 1e-9 * norms[:, None] * (np.sqrt((centres**2).sum(axis=1)) + radii)
    out[:, largest * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) >= EXACT] = np.inf
    return out


def _balls(shards: DataFrame) -> dict[int, dict[str, np.ndarray]]:
    """For each length with several leaves the ball around each leaf: LENGTHS * MOST_LEAVES balls, and MOST_NUMBERS numbers a length, at most."""
    several = shards.groupBy("dim").agg(F.max("leaf").alias("last")).where(F.col("last") > 0).select("dim")
    middle = shards.join(F.broadcast(several), "dim", "left_semi").groupBy("dim", "leaf").agg(F.min("centre").alias("first"), F.max("largest").alias("largest"))
    known: dict[int, list] = {}
    rows = middle.collect()
    if not rows:
        return {}
    firsts = {(r["dim"], r["leaf"]): np.frombuffer(r["first"]) for r in rows}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            far = []
            for dim, leaf, centre, radius in zip(*(c.to_pylist() for c in t.columns), strict=True):
                own = firsts.get((dim, leaf))
                far.append(None if own is None else float(np.sqrt(((np.frombuffer(centre) - own) ** 2).sum())) + radius)
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(far, pa.float64())], names=["dim", "leaf", "reach"])

    reach = shards.select("dim", "leaf", "centre", "radius").mapInArrow(run, "dim int, leaf int, reach double").where("reach IS NOT NULL").groupBy("dim", "leaf").agg(F.max("reach").alias("reach"))
    radii = {(r["dim"], r["leaf"]): r["reach"] for r in reach.collect()}
    for r in sorted(rows, key=lambda r: (r["dim"], r["leaf"])):
        known.setdefault(r["dim"], []).append((r["leaf"], firsts[r["dim"], r["leaf"]], radii[r["dim"], r["leaf"]], r["largest"]))
    return {dim: {"leaf": np.array([x[0] for x in own]), "centre": np.stack([x[1] for x in own]), "radius": np.array([x[2] for x in own]), "largest": np.array([x[3] for x in own])} for dim, own in known.items()}


def _wanted(blocks: DataFrame, hits: DataFrame, balls: dict, k: int, nearest: bool) -> DataFrame:
    """Blocks with their floors for each leaf that they go on to meet: the NEAR leaves of highest bound, or all others that may add an answer."""
    kth = _ranked(hits, k).groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    of = _members(blocks).join(kth, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "low")).alias("known"))  # BLOCK_ROWS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            out = []
            for block, dim, home, ids, data, known in zip(*(c.to_pylist() for c in t.columns), strict=True):
                own = np.frombuffer(ids, dtype=np.int64)
                low = {q["query_id"]: q["low"] for q in known or []}
                floor = np.array([low.get(i, NOTHING + 1) for i in own.tolist()], dtype=np.int64)
                ball = balls.get(dim)
                if ball is None:
                    leaves = [] if nearest else [(home, True)]
                else:
                    x = np.frombuffer(data).reshape(len(own), -1)
                    upper = bounds(x, ball["centre"], ball["radius"], ball["largest"])
                    order = np.argsort(-upper.max(axis=0), kind="stable")[:NEAR]
                    near = set(ball["leaf"][order].tolist())
                    open_ = (upper >= floor[:, None]).any(axis=0)
                    leaves = [(leaf, leaf == home) for leaf, o in zip(ball["leaf"].tolist(), open_.tolist(), strict=True) if o and (leaf in near) == nearest]
                out += [(block, dim, leaf, at_home, ids, data, floor.tobytes()) for leaf, at_home in leaves]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            for i in range(0, len(out), 16):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out[i : i + 16], strict=True), kinds, strict=True)], names=["block", "dim", "leaf", "at_home", "ids", "data", "floor"])

    joined = blocks.join(of, "block", "left").select("block", "dim", "leaf", "ids", "data", "known")
    return joined.mapInArrow(run, "block string, dim int, leaf int, at_home boolean, ids binary, data binary, floor binary")


def _meet(shards: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The best rows of each shard for the blocks that want its leaf. A copy of the shard is sent for every BLOCKS_A_COPY blocks, which stream past it."""
    wanted = cut(wanted)
    copies = wanted.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCKS_A_COPY).cast("int").alias("copies"))
    none = F.lit(None).cast("binary")
    here = shards.join(copies, ["dim", "leaf"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    data = here.select("number", "copy", F.lit(0).alias("kind"), "dim", F.lit("").alias("block"), "ids", "data", none.alias("floor"))
    targets = shards.select("dim", "leaf", "number", "part").join(copies, ["dim", "leaf"])
    asked = wanted.join(targets, ["dim", "leaf"]).where("NOT (at_home AND part = 0)")  # a block has met the first part of its own leaf
    past = asked.select("number", F.pmod(F.xxhash64("block"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("kind"), "dim", "block", "ids", "data", "floor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree, held = None, None, None
        for t in batches:
            for number, copy, kind, dim, _, ids, data, floor in zip(*(c.to_pylist() for c in t.columns), strict=True):
                own = np.frombuffer(ids, dtype=np.int64)
                x = np.frombuffer(data).reshape(len(own), dim)
                if kind == 0:
                    at, held, tree = (number, copy), (own, x), None
                    continue
                if at != (number, copy):
                    raise ValueError("a block came without its shard")
                if tree is None:
                    tree = BallTree(*held)
                low = np.frombuffer(floor, dtype=np.int64) if floor else np.full(len(own), NOTHING + 1)
                scores, found = tree.search(own, x, k, low)
                hit = scores > NOTHING
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, hit.sum(axis=1))), pa.array(found[hit]), pa.array(scores[hit])], names=["query_id", "vec_id", "score"])

    met = data.unionByName(past).repartition("number", "copy").sortWithinPartitions("number", "copy", "kind")
    return cut(met.mapInArrow(run, HIT_SCHEMA))


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query with their rank; more are dropped before the shuffle."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of highest integer inner product for each query row.

    Components count as floor(64 x). Ties go to the smaller vec_id. A row never answers a query with its
    own id; repeated rows each answer. Vectors that are null or hold null or non-finite components, and
    null ids, take no part. Vectors meet only those of their own length. Fewer than k candidates give
    fewer rows; an empty table gives none; other columns are not read, so they may have any names.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    valid = vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull()).where(F.forall(vector_column, finite))
    own = [F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")]
    rows, queries = valid.select(own), valid.where(is_query).select(own).dropDuplicates(["vec_id"])
    splits = _splits(rows)
    n, m = rows.count(), queries.count()
    shards = cut(_shards(_routed(rows, splits), n))
    blocks = cut(_blocks(_routed(queries, splits), m))
    balls = _balls(shards)
    first = blocks.select("block", "dim", "leaf", F.lit(False).alias("at_home"), "ids", "data", F.lit(None).cast("binary").alias("floor"))
    hits = _meet(shards.where("part = 0"), first, k)
    for nearest in (True, False):
        hits = hits.unionByName(_meet(shards, _wanted(blocks, hits, balls, k, nearest), k))
    return _ranked(hits, k).select("query_id", "rank", "vec_id", "score")


def _members(blocks: DataFrame) -> DataFrame:
    """The block of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for block, ids in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True):
                own = np.frombuffer(ids, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(own)), pa.array(own)], names=["block", "query_id"])

    return blocks.select("block", "ids").mapInArrow(run, "block string, query_id long")
