"""Similarity join of texts on word shingles by MinHash with Bayesian pruning.

Equal texts (but for case and white space) form one class, of which one copy takes part. Bands of
MinHash values put classes into buckets. Within a bucket the values of each pair are compared step by
step, and a pair is dropped once the posterior probability that its similarity reaches the threshold is
below a tolerance. What is left links classes to groups; within each group all pairs are pruned again
and then verified by the exact Jaccard similarity of their shingle sets.

No list of pairs is ever made: buckets and groups are cut into blocks, blocks meet in twos, and each
meeting returns per member its links and the smallest member that it is connected with.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import bitmap, components, cut, discard, in_bitmap, join_counted, may_be_in, ranges, regroup, release, stored, strings

SHINGLE = 5
THRESHOLD = 0.8
#: Pairs whose probability of reaching the threshold is lower are dropped.
TOLERANCE = 1e-4
#: Values compared between two looks at the posterior.
STEP = 14
#: Members of a block; two blocks meet in memory, and no meeting is much larger than a task's usual share.
BUCKET_BLOCK = 1024
GROUP_BLOCK = 128
#: Shingles of a block.
GROUP_SHINGLES = 1_000_000
PAIRS_AT_ONCE = 1 << 17
CHUNK_BYTES = 2 << 20
KEEP_WORDS = 120_000

U = np.uint64


@dataclass(frozen=True)
class Bands:
    """bands * rows MinHash values. At similarity s a pair shares a bucket with probability 1 - (1 - s^rows)^bands."""

    bands: int = 28
    rows: int = 5

    def recall(self, s: float) -> float:
        return 1 - (1 - s**self.rows) ** self.bands


class Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


class Shingler:
    """Hashes of all runs of SHINGLE words; a shorter text is one run."""

    def __init__(self) -> None:
        self.known = Words()
        self.factors = np.random.default_rng(11).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * U(2) + U(1)

    def shingles(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """For lists of words: all shingles one after another, and how many each has (0 for no words)."""
        if len(self.known) > KEEP_WORDS:
            self.known.clear()
        sizes = np.array([len(w) for w in texts], dtype=np.int64)
        flat = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(texts)), dtype=np.uint64, count=int(sizes.sum()))
        if not len(flat):
            return flat, sizes
        padded = np.concatenate([flat, np.zeros(SHINGLE, dtype=np.uint64)])
        ends = np.repeat(np.cumsum(sizes), sizes)
        place = np.arange(len(flat))
        mixed = np.zeros(len(flat), dtype=np.uint64)
        for i in range(SHINGLE):
            mixed += np.where(place + i < ends, padded[i : i + len(flat)], U(0)) * self.factors[i]
        mixed ^= mixed >> U(29)
        mixed *= U(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> U(32)
        counts = np.where(sizes > 0, np.maximum(1, sizes - SHINGLE + 1), 0)
        return mixed[ranges(np.cumsum(sizes) - sizes, counts)], counts


def words_of(text: str) -> list[str]:
    return text.lower().split()


def key_of(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()


def key_numbers(keys: list[bytes]) -> np.ndarray:
    """The first seven bytes of keys as longs."""
    return np.array([int.from_bytes(k[:7], "big") for k in keys], dtype=np.int64)


def key_number() -> Column:
    """key_numbers for column key."""
    return F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long").alias("key_number")


def pair_number(id_column: str) -> Column:
    """A number for the pair of column key and an id."""
    id_ = F.col(id_column).cast("long")
    return key_number().bitwiseXOR(F.shiftleft(id_, 17)).bitwiseXOR(id_).alias("pair_number")


def pair_numbers(numbers: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """pair_number for arrays of key numbers and ids."""
    return numbers ^ (ids << 17) ^ ids


#: What permutations and least_matches have made. A plain dictionary, since it travels to the workers by value.
MADE: dict[tuple, np.ndarray] = {}


def permutations(n: int) -> np.ndarray:
    if ("permutations", n) not in MADE:
        MADE["permutations", n] = np.random.default_rng(5).integers(1, 1 << 63, n, dtype=np.uint64) * U(2) + U(1)
    return MADE["permutations", n]


def min_hashes(flat: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """n values of 32 bits for each text with shingles; texts without have zeros."""
    out = np.zeros((len(counts), n), dtype=np.uint32)
    has = np.flatnonzero(counts)
    if not len(has):
        return out
    starts = (np.cumsum(counts) - counts)[has]
    for j, factor in enumerate(permutations(n)):
        out[has, j] = np.minimum.reduceat(((flat ^ (factor >> U(7))) * factor) >> U(32), starts)
    return out


def band_hashes(values: np.ndarray, bands: Bands) -> np.ndarray:
    """One long per band, different for each band."""
    grouped = values.reshape(len(values), bands.bands, bands.rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands.bands + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15), grouped.shape[:2]).copy()
    for i in range(bands.rows):
        h = (h ^ grouped[:, :, i]) * U(0xD6E8FEB86659FD93)
        h ^= h >> U(32)
    return h.view(np.int64)


def least_matches(n: int, threshold: float, tolerance: float) -> np.ndarray:
    """For each number of compared values the fewest matches at which a pair is kept.

    Values are compared by their last 8 bits, so values of texts of similarity s match with probability
    s + (1 - s) / 256. The prior of s is uniform.
    """
    known = ("least matches", n, threshold, tolerance)
    if known in MADE:
        return MADE[known]
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = np.zeros(n + 1, dtype=np.int64)
    for seen in range(1, n + 1):
        low = 0
        for m in range(seen + 1):
            log = m * np.log(p) + (seen - m) * np.log1p(-p)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() / weight.sum() >= tolerance:
                low = m
                break
            low = m + 1
        out[seen] = low
    MADE[known] = out
    return out


def prepared(bands: Bands, threshold: float) -> None:
    """Makes on the driver what every task needs; MADE travels with the functions that read it."""
    permutations(bands.bands * bands.rows)
    least_matches(bands.bands * bands.rows, threshold, TOLERANCE)


def surviving(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of signatures (rows of a and b) stay when their values are compared step by step."""
    n = a.shape[1]
    least = least_matches(n, threshold, TOLERANCE)
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for at in range(0, n, STEP):
        stop = min(n, at + STEP)
        matches[alive] += (a[alive, at:stop] == b[alive, at:stop]).sum(axis=1)
        alive = alive[matches[alive] >= least[stop]]
        if not len(alive):
            break
    return alive


class Sets:
    """Union-find; the root of a set is its smallest member."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        p = self.parent
        while (y := p.setdefault(x, x)) != x:
            p[x] = x = p[y] if y in p else y
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def pair_indexes(left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within left, or all pairs of left and right."""
    if right is None:
        i, j = np.triu_indices(len(left), 1)
        return left[i], left[j]
    return np.repeat(left, len(right)), np.tile(right, len(left))


def meetings(rows: DataFrame, key: str, blocks: Column, item: str = "item") -> DataFrame:
    """Deals the members of each key into `blocks` blocks; each two blocks of a key meet under (key, low, high)."""
    dealt = rows.withColumn("_blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
    each = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return each.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other")).drop("_blocks", "_other")


def seated(met: DataFrame, key: str) -> DataFrame:
    """Deals meetings to tasks: those of one key to one task after another, so that the meetings of a large key do not land together."""
    n = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.expr("pmod(CAST(high AS BIGINT) * (high + 1) div 2 + low, {n})".format(n=n))
    slot = F.pmod(F.pmod(F.xxhash64(key), F.lit(n)) + place, F.lit(n)).cast("int")
    return met.withColumn("_slot", slot).repartitionById(n, "_slot").drop("_slot").sortWithinPartitions(key, "low", "high")


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal first `keys` columns."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        columns = [t.column(i).to_numpy() for i in range(keys)]
        changes = np.zeros(t.num_rows, dtype=bool)
        for c in columns:
            changes[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        cuts = np.flatnonzero(changes).tolist()
        if last is not None and first != last and held:
            yield pa.concat_tables(held)
            held = []
        for a, b in zip([0, *cuts], [*cuts, t.num_rows], strict=True):
            held.append(t.slice(a, b - a))
            if b < t.num_rows:
                yield pa.concat_tables(held)
                held = []
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.concat_tables(held)


def _bucket_links(members: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members of buckets that survive pruning: of each connected set of them a star."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal n
            a, b, sa, sb = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            n = 0
            kept = surviving(sa, sb, threshold)
            sets = Sets()
            for x, y in zip(a[kept].tolist(), b[kept].tolist(), strict=True):
                sets.join(x, y)
            star = [(x, sets.root(x)) for x in list(sets.parent)]
            star = [(x, y) for x, y in star if x != y]
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in star], pa.int64()), pa.array([y for _, y in star], pa.int64())], names=["a", "b"])

        for t in grouped(batches, 3):
            items, block = t.column(4).to_numpy(), t.column(3).to_numpy()
            if len(items) < 2:
                continue
            signatures = np.frombuffer(b"".join(t.column(5).to_pylist()), dtype=np.uint8).reshape(len(items), -1)
            low, high = t.column(1)[0].as_py(), t.column(2)[0].as_py()
            left = np.flatnonzero(block == low)
            i, j = pair_indexes(left, None if low == high else np.flatnonzero(block == high))
            for at in range(0, len(i), PAIRS_AT_ONCE):
                x, y = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
                held.append((items[x], items[y], signatures[x], signatures[y]))
                n += len(x)
                if n >= PAIRS_AT_ONCE // 4:
                    yield flush()
        if held:
            yield flush()
        release()

    met = meetings(members, "bucket", F.ceil(F.col("n") / BUCKET_BLOCK))
    met = seated(met.select("bucket", "low", "high", "block", "item", "signature"), "bucket")
    return met.mapInArrow(run, "a long, b long")


def exact_links(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) of sets (sorted, without repeats) reach the Jaccard threshold."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    fits = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
    i, j = i[fits], j[fits]
    if len(i) <= 256:
        common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist(), strict=True)], dtype=np.int64)
    else:
        used = np.unique(np.concatenate([i, j]))
        slot = np.zeros(len(sets), dtype=np.int64)
        slot[used] = np.arange(len(used))
        owner = np.repeat(np.arange(len(used)), sizes[used])
        _, column, seen = np.unique(np.concatenate([sets[x] for x in used]), return_inverse=True, return_counts=True)
        shared = seen[column] > 1
        owner, column = owner[shared], column[shared]
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        product = np.zeros((len(used), len(used)), dtype=np.float32)
        width = 8192
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [at, at + width])
            part = np.zeros((len(used), width), dtype=np.float32)
            part[owner[a:b], column[a:b] - at] = 1
            product += part @ part.T
        common = product[slot[i], slot[j]].astype(np.int64)
    ok = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
    return np.stack([i[ok], j[ok]])


def _group_links(groups: DataFrame, threshold: float) -> DataFrame:
    """item, root, links: of each member of a meeting the smallest member it is connected with there and the copies it is linked to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for t in grouped(batches, 3):
            ids = t.column(4).to_numpy()
            ids, first = np.unique(ids, return_index=True)  # repeated rows fetched the same text twice
            if len(ids) < 2:
                continue
            t = t.take(pa.array(first))
            block, copies = t.column(3).to_numpy(), t.column(6).to_numpy()
            signatures = np.frombuffer(b"".join(t.column(5).to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            flat, counts = shingler.shingles([words_of(x) for x in strings(t.column(7))])
            sets = [np.unique(x) for x in np.split(flat, np.cumsum(counts)[:-1])]
            low, high = t.column(1)[0].as_py(), t.column(2)[0].as_py()
            i, j = pair_indexes(np.flatnonzero(block == low), None if low == high else np.flatnonzero(block == high))
            kept = surviving(signatures[i], signatures[j], threshold)
            x, y = exact_links(sets, i[kept], j[kept], threshold)
            links = np.bincount(x, copies[y], len(ids)).astype(np.int64) + np.bincount(y, copies[x], len(ids)).astype(np.int64)
            union = Sets()
            for a, b in zip(ids[x].tolist(), ids[y].tolist(), strict=True):
                union.join(a, b)
            touched = np.flatnonzero(links)
            del t, flat, sets
            yield pa.RecordBatch.from_arrays([pa.array(ids[touched]), pa.array([union.root(a) for a in ids[touched].tolist()], pa.int64()), pa.array(links[touched])], names=["item", "root", "links"])
        del shingler
        release()

    return groups.mapInArrow(run, "item long, root long, links long")


def sketched(docs: DataFrame, bands: Bands, id_column: str = "doc_id") -> DataFrame:
    """doc_id, key, signature, bands and n (shingles) of every row; key is null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for t in regroup(batches, "text", CHUNK_BYTES):
            words = [words_of(x) for x in strings(t.column("text"))]
            flat, counts = shingler.shingles(words)
            values = min_hashes(flat, counts, bands.bands * bands.rows)
            hashes = band_hashes(values, bands)
            signatures = (values & 255).astype(np.uint8)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * bands.bands, pa.int32()), pa.array(hashes.ravel()))
            yield pa.RecordBatch.from_arrays([t.column(id_column).combine_chunks().cast(pa.int64()), pa.array([key_of(w) if w else None for w in words], pa.binary()), pa.array([s.tobytes() for s in signatures], pa.binary()), lists, pa.array(counts)], names=["doc_id", "key", "signature", "bands", "n"])

    return docs.select(id_column, "text").mapInArrow(run, "doc_id long, key binary, signature binary, bands array<long>, n long")


def classes_of(sketches: DataFrame) -> tuple[DataFrame, str]:
    """One row per class of equal texts: item, key, first (smallest doc_id), copies, signature, bands, n; and where they are stored."""
    one = sketches.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.first("n").alias("n"))
    return stored(one.withColumn("item", F.monotonically_increasing_id()))


def texts_of(docs: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A fetch for linked(): the texts (key, text) of classes from docs, of each class that of its first document."""

    def fetch(groups: DataFrame) -> DataFrame:
        wanted, wanted_docs = bitmap(groups.select(pair_number("first"))), bitmap(groups.select("first"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: set[bytes] = set()
            for t in batches:
                t = t.filter(pa.array(may_be_in(wanted_docs, t.column(0))))
                texts, ids = strings(t.column(1)), t.column(0).fill_null(0).to_numpy()
                keys = [key_of(words_of(x)) for x in texts]
                met = in_bitmap(wanted, pair_numbers(key_numbers(keys), ids)) | t.column(0).is_null().to_numpy(zero_copy_only=False)
                out = {}
                for i in np.flatnonzero(met).tolist():
                    if keys[i] not in done:
                        done.add(keys[i])
                        out[keys[i]] = texts[i]
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.string())], names=["key", "text"])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "key binary, text string")

    return fetch


def linked(classes: DataFrame, fetch: Callable[[DataFrame], DataFrame], threshold: float = THRESHOLD) -> DataFrame:
    """item, label, links for the classes that have a link: label is the smallest item of the connected component.

    fetch gives the text (key, text) of each class of a table with columns key and first, at most once from
    each of its tasks.
    """
    placed = classes.select("item", F.explode("bands").alias("bucket"))
    sizes = cut(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = classes.count()
    members = join_counted(placed, sizes, "bucket", "n", max(1, total), spread=F.xxhash64("item")).where(F.col("n").isNotNull())
    members = members.join(classes.select("item", "signature"), "item")
    candidates = cut(components(_bucket_links(members, threshold)))
    extent = classes.select(F.col("item").alias("node"), "first", "key", "copies", "signature", F.col("n").alias("n_shingles"))
    groups = cut(candidates.join(extent, "node").withColumnRenamed("node", "item"))
    fetched = fetch(groups)
    extents = groups.groupBy("label").agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("n_all"))
    whole = join_counted(groups, extents, "label", "members", max(1, total), spread=F.xxhash64("item"))
    met = meetings(whole.join(fetched, "key"), "label", F.greatest(F.ceil(F.col("members") / GROUP_BLOCK), F.ceil(F.col("n_all") / GROUP_SHINGLES)))
    met = seated(met.select("label", "low", "high", "block", "item", "signature", "copies", "text"), "label")
    found = cut(_group_links(met, threshold))
    final = components(found.select(F.col("item").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("item").agg(F.sum("links").alias("links"))
    return final.withColumnRenamed("node", "item").join(links, "item", "left").select("item", "label", F.coalesce("links", F.lit(0)).alias("links"))


def similarity_classes(docs: DataFrame, bands: Bands = Bands(), threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links of every row of docs.

    n_links counts the other rows whose word-shingle sets have a Jaccard similarity of at least the
    threshold, equal texts included. class_id is the smallest doc_id of all rows that links connect. Words
    are lower-case runs of non-space; a text of fewer than SHINGLE words is one shingle. A text that is
    null or has no words is linked to nothing and is a class of its own (class_id is its doc_id). Repeated
    rows count as copies of each other. Null ids are kept; a class of only null ids has a null class_id.
    """
    return _keyed_classes(docs, bands, threshold).drop("key")


def _keyed_classes(docs: DataFrame, bands: Bands, threshold: float) -> DataFrame:
    """similarity_classes with the key of each text, null if it has no words."""
    prepared(bands, threshold)
    sketches = cut(sketched(docs, bands))
    classes, path = classes_of(sketches)
    found = linked(classes, texts_of(docs), threshold)
    known = classes.select("item", "key", "first", "copies").join(found, "item", "left").withColumn("label", F.coalesce("label", "item"))
    known = cut(known)
    discard(docs.sparkSession, path)
    heads = known.groupBy("label").agg(F.min("first").alias("class_id"), F.count(F.lit(1)).alias("members"))
    rows = sketches.count()
    known = join_counted(known, heads, "label", "members", max(1, rows), spread=F.xxhash64("item"))
    per_key = known.select("key", "copies", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    joined = join_counted(sketches.select("doc_id", "key"), per_key, "key", "copies", max(1, rows), spread=F.unhex(F.hex(F.xxhash64("doc_id"))))
    return joined.select("doc_id", "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def first_of_each(docs: DataFrame, bands: Bands = Bands(), threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows of each class that do not have its smallest doc_id, and without repeated rows.

    Texts without words and rows with null ids stay. Of several texts with one id, each goes or stays by
    its own class; of rows with one id and text one stays. Texts of any length are compared whole, an empty
    table gives no rows, and other columns may have any names. Only rows of ids that are in question are
    shuffled.
    """
    found = _keyed_classes(docs, bands, threshold).where(F.col("doc_id").isNotNull())
    beaten = F.col("doc_id") != F.col("class_id")
    each = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set(F.when(beaten, F.col("key"))).alias("gone"), F.bool_and(beaten).alias("all_gone"), F.count(F.lit(1)).alias("n"))
    asked = cut(each.where((F.size("gone") > 0) | (F.col("n") > 1)))
    wanted = bitmap(asked.select("id"))
    total, split = asked.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max(~F.col("all_gone") & (F.size("gone") > 0)), F.lit(False))).first()
    columns, schema = docs.columns, docs.schema
    at = columns.index("doc_id")

    def part(hit: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                ids = t.column(at)
                mask = in_bitmap(wanted, ids.cast(pa.int64()).fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
                yield t.filter(pa.array(mask if hit else ~mask))
            release()

        return run

    rows = docs.mapInArrow(part(True), schema).select(F.col("doc_id").cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    left = join_counted(rows, asked, "id", "n", max(1, total), spread=F.xxhash64("row.text")).where("NOT coalesce(all_gone, false)")
    if split:  # of some ids one text goes and another stays

        def stays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                texts = strings(t.column(1).field("text"))
                mask = [not gone or key_of(words_of(x)) not in gone for x, gone in zip(texts, t.column(2).to_pylist(), strict=True)]
                yield t.filter(pa.array(mask, pa.bool_()))

        left = left.mapInArrow(stays, left.schema)
    once = left.where("n > 1").withColumn("text", F.col("row.text")).dropDuplicates(["id", "text"])
    own = [F.col(f"row.`{c}`").alias(c) for c in columns]
    return docs.mapInArrow(part(False), schema).union(left.where("coalesce(n, 1) = 1").select(own)).union(once.select(own))
