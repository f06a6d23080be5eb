"""Removal of passages that repeat across documents.

Paragraphs of at least LEAST_WORDS words are compared by MinHash bands that are tuned for recall;
colliding paragraphs are joined, verified by exact Jaccard similarity, and clustered into connected
components. Each cluster keeps the paragraphs of its smallest document.

A passage may also stand inside longer paragraphs, which then are not similar as wholes. So every run of
PASSAGE words is a sub-paragraph, whose shingles are runs of WINDOW words and whose band is one MinHash
value. Neighbouring sub-paragraphs mostly share that value, so it is kept once for the place where it
stands, the anchor. Equal sub-paragraphs collide wherever they stand, for their own words alone decide.
Runs that begin with a line are anchors too. Anchors of one value form a cluster. Those of a later
document that touch make a chain, whose ends are verified word by word against the smallest document and
extended over the words that are equal on both sides, so that a passage goes in its full length and no word beyond it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import bitmap, cut, discard, free_name, in_bitmap, join_counted, may_be_in, ranges, regroup, release, stored, strings
from spindrift.llm.jaccard import SHINGLE, THRESHOLD, Bands, U, band_hashes, classes_of, key_number, linked, min_hashes, pair_number, pair_numbers, prepared

#: Words of the shortest paragraph, or run inside one, that counts as a passage.
LEAST_WORDS = 24
WINDOW = 24
#: Words of a sub-paragraph: equal runs of so many words surely collide.
PASSAGE = 50
#: Shingles of a sub-paragraph, and words to each side of an anchor that are compared.
RUN = PASSAGE - WINDOW + 1
#: At similarity 0.8 two paragraphs collide with probability 0.997, at 0.9 with 0.99999.
BANDS = Bands(bands=8, rows=3)
CHUNK_BYTES = 1 << 20
#: Bytes of words that are hashed together.
SLICE = 1 << 18

SPACES = [*range(9, 14), *range(28, 33)]
WORD = re.compile("[^\\t-\\r\\x1c- ]+")
ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def packed(column: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes one after another, and where each text begins; one more entry than texts."""
    return np.frombuffer(b"".join(column), dtype=np.uint8), np.cumsum(np.r_[0, np.fromiter(map(len, column), dtype=np.int64, count=len(column))])


def words_in(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of every word: runs of bytes that are no ASCII white space, within one text."""
    solid = np.ones(256, dtype=bool)
    solid[SPACES] = False
    solid = solid[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    joint = np.zeros(len(data) + 1, dtype=bool)  # a word goes on from the byte before to this one
    joint[1:-1] = solid[1:] & solid[:-1] & ~edge[1:-1]
    return np.flatnonzero(solid & ~joint[:-1]), np.flatnonzero(solid & ~joint[1:]) + 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(29))
    h *= U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


class Hasher:
    """Hashes of words, and of runs of words from prefix sums over powers of an odd number."""

    def __init__(self) -> None:
        self.factors = np.random.default_rng(17).integers(1, 1 << 63, 1024, dtype=np.uint64) * U(2) + U(1)
        self.tables: dict[tuple[int, bool], np.ndarray] = {}

    def words(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(begin), dtype=np.uint64)
        sizes = end - begin
        upto = np.cumsum(sizes)
        at = 0
        while at < len(begin):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, "right")))
            own = sizes[at:stop]
            firsts = np.cumsum(own) - own
            place = np.arange(int(own.sum())) - np.repeat(firsts, own)
            bytes_ = data[place + np.repeat(begin[at:stop], own)].astype(np.uint64) + U(1)
            bytes_ *= self.factors[place & 1023]
            out[at:stop] = np.add.reduceat(bytes_, firsts) + own.astype(np.uint64)
            at = stop
        return mixed(out)

    def powers(self, base: int, n: int, inverse: bool = False) -> np.ndarray:
        table = self.tables.get((base, inverse))
        if table is None or len(table) < n:
            steps = np.full(max(n, 1 << 19), pow(base, -1, 1 << 64) if inverse else base, dtype=np.uint64)
            steps[0] = 1
            table = self.tables[base, inverse] = np.cumprod(steps, dtype=np.uint64)
        return table[:n]

    def sums(self, h: np.ndarray, base: int = ODD[0]) -> np.ndarray:
        return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * self.powers(base, len(h)), dtype=np.uint64)])

    def between(self, sums: np.ndarray, first: np.ndarray, last: np.ndarray, base: int = ODD[0]) -> np.ndarray:
        """Hashes of the words first .. last - 1."""
        return mixed((sums[last] - sums[first]) * self.powers(base, len(sums), True)[first])

    def runs(self, sums: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the n words from each word on."""
        return mixed((sums[n:] - sums[:-n]) * self.powers(ODD[0], len(sums) - n, True)) if len(sums) > n else sums[:0]


def least_of_runs(values: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whether a value is the least, and the first of equal ones, of RUN in a row; left counts the values to the end of the text."""
    out = np.zeros(len(values), dtype=bool)
    if len(values) < RUN:
        return out
    least, at, size = values, np.arange(len(values)), 1
    while size < RUN:
        step = min(size, RUN - size)
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
        size += step
    out[at[left[: len(at)] >= RUN]] = True
    return out


class Chunk:
    """The words of some texts: their places in bytes and code points, their hashes in lower case, their texts."""

    def __init__(self, texts: list[str], hasher: Hasher, hashed: bool = True):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data, self.bounds = packed(raw)
        self.marks = [zlib.crc32(x) for x in raw]
        self.begin, self.end = words_in(data, self.bounds)
        self.data, self.hasher = data, hasher
        wide = bool(len(data)) and int(data.max()) > 127
        self.points = np.cumsum(np.r_[False, (data & 0xC0) != 0x80], dtype=np.int32) if wide else None
        per = np.searchsorted(self.begin, self.bounds)
        self.first, self.sizes = per[:-1], np.diff(per)
        if hashed:
            lowered, low_bounds = packed([t.lower().encode("utf-8", "surrogatepass") for t in texts])
            begin, end = words_in(lowered, low_bounds) if wide else (self.begin, self.end)  # letters may change their length
            self.hashes = hasher.words(lowered, begin, end)
            self.sums = hasher.sums(self.hashes)
            self.line = self._line_of()

    def _line_of(self) -> np.ndarray:
        """The line of each word."""
        breaks = self.data == 10
        breaks[self.bounds[:-1][self.bounds[:-1] < len(breaks)]] = True
        return np.cumsum(breaks, dtype=np.int32)[self.begin] if len(self.begin) else self.begin

    def chars(self, byte: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Code points of a text before a byte of it."""
        start = self.bounds[owner]
        return byte - start if self.points is None else (self.points[byte] - self.points[start]).astype(np.int64)

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Text, first and last character and hash of each anchor."""
        one = self.hasher.runs(self.sums, WINDOW)
        upto = np.repeat(self.first + self.sizes, self.sizes)
        left = (upto - np.arange(len(upto)) - WINDOW + 1)[: len(one)]
        opens = np.r_[True, self.line[1:] != self.line[:-1]][: len(one)]
        place = np.flatnonzero((left > 0) & (opens | least_of_runs(one, left)))
        owner = np.searchsorted(self.bounds, self.begin[place], "right") - 1
        return owner, self.chars(self.begin[place], owner), self.chars(self.end[place + WINDOW - 1], owner), one[place].view(np.int64)

    def lines(self) -> tuple[np.ndarray, ...]:
        """Text, first and last character, first word and number of words of each line of LEAST_WORDS words and more."""
        line = self.line
        first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else line
        counts = np.diff(np.r_[first, len(line)])
        first, counts = first[counts >= LEAST_WORDS], counts[counts >= LEAST_WORDS]
        owner = np.searchsorted(self.bounds, self.begin[first], "right") - 1
        return owner, self.chars(self.begin[first], owner), self.chars(self.end[first + counts - 1], owner), first, counts

    def keys(self, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Two numbers for the words of each line; equal lines, but for case and white space, have equal ones."""
        other = self.hasher.sums(self.hashes, ODD[1])
        return np.stack([self.hasher.between(self.sums, first, first + counts), self.hasher.between(other, first, first + counts, ODD[1])], axis=1)

    def sketches(self, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        shingles = self.hasher.runs(self.sums, SHINGLE)
        own = counts - SHINGLE + 1
        return min_hashes(shingles[ranges(first, own)], own, BANDS.bands * BANDS.rows)


def binaries(rows: np.ndarray) -> pa.Array:
    """Each row of an array as one binary."""
    raw = np.ascontiguousarray(rows)
    width = raw.shape[1] * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer((np.arange(len(raw) + 1) * width).astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about CHUNK_BYTES of text each, in order; one longer text is a table of its own."""
    for t in regroup(batches, "text", CHUNK_BYTES):
        column = t.column("text")
        lengths = pc.binary_length(column).fill_null(0).to_numpy()
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // CHUNK_BYTES)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), t.num_rows], strict=True):
            yield t.slice(a, b - a)


UNITS = "hash long, doc_id long, mark long, start int, stop int, key binary, signature binary, bands array<long>, n long"


def _rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _units(docs: DataFrame) -> DataFrame:
    """Anchors (with hash) and paragraphs (with key and sketch) of all documents, from one pass; mark is a checksum of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for t in slices(batches):
            chunk = Chunk(strings(t.column(1)), hasher)
            ids, marks = t.column(0).to_numpy(), np.array(chunk.marks, dtype=np.int64)
            owner, a, b, one = chunk.anchors()
            line_owner, line_a, line_b, first, counts = chunk.lines()
            values = chunk.sketches(first, counts)
            bands = band_hashes(values, BANDS)
            n, m = len(one), len(first)
            both = np.concatenate([owner, line_owner])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * BANDS.bands, pa.int32()), pa.array(bands.ravel()))
            columns = [
                pa.concat_arrays([pa.array(one), pa.nulls(m, pa.int64())]),
                pa.array(ids[both]),
                pa.array(marks[both]),
                pa.array(np.concatenate([a, line_a]), pa.int32()),
                pa.array(np.concatenate([b, line_b]), pa.int32()),
                pa.concat_arrays([pa.nulls(n, pa.binary()), binaries(chunk.keys(first, counts).astype(">u8"))]),
                pa.concat_arrays([pa.nulls(n, pa.binary()), binaries((values & 255).astype(np.uint8))]),
                pa.concat_arrays([pa.nulls(n, lists.type), lists]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(counts - SHINGLE + 1)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in UNITS.split(", ")])

    return _rows(docs).mapInArrow(run, UNITS)


PLACE = "doc_id long, mark long, start int, stop int"
CONTEXT = "hash long, words string, before int"


def chains(anchors: list[dict]) -> Iterator[tuple[int, int, int | None]]:
    """First and last character and hash of both ends of each run of anchors that touch; what is between the ends, without hash."""
    own = sorted((x["start"], x["stop"], x["hash"]) for x in anchors)
    at = 0
    while at < len(own):
        last = at
        while last + 1 < len(own) and own[last + 1][0] - own[last][1] <= 2:  # no room for a word
            last += 1
        yield own[at]
        if last > at:
            yield own[last]
        if last > at + 1:
            yield own[at + 1][0], own[last - 1][1], None
        at = last + 1


def _repeated_runs(docs: DataFrame, anchors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """PLACE, words, before of the runs that an earlier document has too, and the bitmap of their documents.

    words, of the ends of chains, are those of the earlier document around the anchor, of which `before`
    stand before it. A document's anchors are gathered; their number is bounded by its length.
    """
    spark = docs.sparkSession
    groups = cut(anchors.groupBy("hash").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("home < last").drop("last"))
    total = max(1, groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    shared = bitmap(groups.select("hash"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            yield t.filter(pa.array(in_bitmap(shared, t.column(0).to_numpy())))
        release()

    again = anchors.mapInArrow(keep, anchors.schema)
    seen, path = stored(join_counted(again, groups, "hash", "n", total, spread=F.xxhash64("doc_id", "start")).where("home IS NOT NULL").drop("n"))

    def linked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            rows = [(doc_id, mark, *x) for doc_id, mark, own in zip(*(c.to_pylist() for c in t.columns), strict=True) for x in chains(own)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["doc_id", "mark", "start", "stop", "hash"])
        release()

    gathered = seen.where("doc_id > home").groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "stop", "hash")).alias("own"))
    parts = cut(gathered.mapInArrow(linked_up, f"{PLACE}, hash long"))
    ends = parts.where("hash IS NOT NULL")
    wanted = ends.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    firsts = seen.where("doc_id = home").groupBy("hash").agg(F.min(F.struct("doc_id", "mark", "start")).alias("at"))
    homes = cut(wanted.join(firsts, "hash"))
    discard(spark, path)
    places = cut(homes.groupBy(F.col("at.doc_id").alias("home")).agg(F.collect_list(F.struct("hash", "at.mark", "at.start")).alias("places")))
    at_home = bitmap(places.select("home"))

    def homes_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            yield t.filter(pa.array(in_bitmap(at_home, t.column(0).to_numpy())))
        release()

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for t in slices(batches):
            texts = strings(t.column(1))
            chunk = Chunk(texts, hasher, hashed=False)
            hashes, around, before = [], [], []
            for k, (text, places) in enumerate(zip(texts, t.column(2).to_pylist(), strict=True)):
                own = [(p["start"], p["hash"]) for p in places if p["mark"] == chunk.marks[k]]
                if not own:
                    continue
                words, begin, _ = chunk_words(chunk, k, text)
                for i, h in zip(np.searchsorted(begin, [s for s, _ in own]).tolist(), [h for _, h in own], strict=True):
                    low = max(0, i - RUN)
                    hashes.append(h)
                    around.append(" ".join(words[low : i + WINDOW + RUN]))
                    before.append(i - low)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(around, pa.string()), pa.array(before, pa.int32())], names=["hash", "words", "before"])

    rows = _rows(docs)
    found = rows.mapInArrow(homes_only, rows.schema).join(places, F.col("doc_id") == F.col("home")).select("doc_id", "text", "places").mapInArrow(contexts, CONTEXT)
    once = found.groupBy("hash").agg(F.min(F.struct("words", "before")).alias("c"))  # repeated rows give the same words
    counted = cut(homes.select("hash", "n").join(once, "hash").select("hash", "n", "c.words", "c.before"))
    known = join_counted(ends, counted, "hash", "n", max(1, ends.count()), spread=F.xxhash64("doc_id", "start")).where("words IS NOT NULL")
    return known.drop("hash", "n").unionByName(parts.where("hash IS NULL").drop("hash"), allowMissingColumns=True), bitmap(parts.select("doc_id"))


def chunk_words(chunk: Chunk, k: int, text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of one text of a chunk in lower case, and their first and last characters."""
    own = slice(chunk.first[k], chunk.first[k] + chunk.sizes[k])
    of = np.full(int(chunk.sizes[k]), k)
    return WORD.findall(text.lower()), chunk.chars(chunk.begin[own], of), chunk.chars(chunk.end[own], of)


def reach(words: list[str], i: int, theirs: list[str], before: int) -> tuple[int, int] | None:
    """The first and last word (exclusive) of the run around word i that theirs has around its word `before`; None if the anchor differs."""
    if words[i : i + WINDOW] != theirs[before : before + WINDOW]:
        return None
    a, x = i, before
    while a and x and words[a - 1] == theirs[x - 1]:
        a, x = a - 1, x - 1
    b, y = i + WINDOW, before + WINDOW
    while b < len(words) and y < len(theirs) and words[b] == theirs[y]:
        b, y = b + 1, y + 1
    return a, b


def _repeated_paragraphs(docs: DataFrame, lines: DataFrame, threshold: float) -> tuple[DataFrame, np.ndarray]:
    """PLACE of paragraphs that are copies or near copies of paragraphs of an earlier document, and the bitmap of their documents."""
    classes, path = classes_of(lines)

    def fetch(groups: DataFrame) -> DataFrame:
        wanted, wanted_docs = bitmap(groups.select(pair_number("first"))), bitmap(groups.select("first"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher, done = Hasher(), set()

            def some() -> Iterator[pa.RecordBatch]:
                for t in batches:
                    yield t.filter(pa.array(in_bitmap(wanted_docs, t.column(0).to_numpy())))

            for t in slices(some()):
                texts = strings(t.column(1))
                chunk = Chunk(texts, hasher)
                owner, a, b, first, counts = chunk.lines()
                keys = chunk.keys(first, counts)
                met = np.flatnonzero(in_bitmap(wanted, pair_numbers((keys[:, 0] >> U(8)).astype(np.int64), t.column(0).to_numpy()[owner])))
                raw = keys[met].astype(">u8")
                out = {}
                for k, x, y, key in zip(owner[met].tolist(), a[met].tolist(), b[met].tolist(), raw, strict=True):
                    name = key.tobytes()
                    if name not in done:
                        done.add(name)
                        out[name] = texts[k][x:y]
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.string())], names=["key", "text"])

        return _rows(docs).mapInArrow(run, "key binary, text string")

    links = linked(classes, fetch, threshold).select("item", "label")
    known = classes.select("item", "key", "first", "copies").join(links, "item", "left").where("label IS NOT NULL OR copies > 1")
    found = cut(known.withColumn("label", F.coalesce("label", "item")))
    heads = found.groupBy("label").agg(F.min("first").alias("home"), F.count(F.lit(1)).alias("n"))
    placed = cut(join_counted(found, heads, "label", "n", max(1, found.count()), spread=F.xxhash64("item")).select("key", "home", "copies"))
    wanted = bitmap(placed.select(key_number()))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            numbers = np.array([int.from_bytes(x[:7], "big") for x in t.column(0).to_pylist()], dtype=np.int64)
            yield t.filter(pa.array(in_bitmap(wanted, numbers)))
        release()

    names = [x.split()[0] for x in PLACE.split(", ")]
    own = lines.select("key", *names)
    total = max(1, placed.agg(F.coalesce(F.sum("copies"), F.lit(1))).first()[0])
    joined = join_counted(own.mapInArrow(keep, own.schema), placed, "key", "copies", total, spread=F.unhex(F.hex(F.xxhash64("doc_id", "start"))))
    later = cut(joined.where("doc_id > home").select(*names))
    discard(docs.sparkSession, path)
    return later, bitmap(later.select("doc_id"))


def merged(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch joined; nothing outside them goes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and not text[out[-1][1] : a].strip():
            out[-1] = (out[-1][0], max(out[-1][1], b))
        elif out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """text without spans; with a whole line goes its line end, and one of two spaces that meet."""
    out, at = [], 0
    for a, b in spans:
        before = text[a - 1 : a]
        if before in ("", "\n") and text[b : b + 1] == "\n" or before == " " and text[b : b + 1] == " ":
            b += 1
        out.append(text[at:a])
        at = max(at, b)
    out.append(text[at:])
    return "".join(out)


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD, report: bool = False) -> DataFrame:
    """docs without passages that a document with a smaller id has too; every row stays.

    Passages are paragraphs of LEAST_WORDS words and more (near copies by word shingles, or equal) and runs
    of as many words inside them, which are surely found if PASSAGE words are equal. Words are runs of
    anything but ASCII white space, compared in lower case. n_chars, if there, follows the text. A text that
    is wholly repeated becomes empty, one of any length is treated whole; null texts and rows with null ids
    stay as they are, an empty table gives no rows, rows with one id (equal ones too) keep each other's
    passages, and other columns may have any names. With report, columns doc_id, n_removed, removed
    (start:end, comma-joined, code points) and text are returned instead.
    """
    spark = docs.sparkSession
    prepared(BANDS, threshold)
    units, path = stored(_units(docs))
    names = [x.split()[0] for x in PLACE.split(", ")]
    runs, with_runs = _repeated_runs(docs, units.where("hash IS NOT NULL").select("hash", *names))
    copies, with_copies = _repeated_paragraphs(docs, units.where("key IS NOT NULL").select("key", "signature", "bands", "n", *names), threshold)
    discard(spark, path)
    every = runs.unionByName(copies, allowMissingColumns=True)
    columns, schema = docs.columns, docs.schema
    at, doc, spans = columns.index("doc_id"), free_name("_doc", columns), free_name("_spans", columns)
    listed = every.groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set(F.struct("mark", "start", "stop", "words", "before")).alias(spans))

    def part(hit: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                ids = t.column(at).cast(pa.int64())
                mask = may_be_in(with_runs, ids) | may_be_in(with_copies, ids)
                yield t.filter(pa.array(mask if hit else ~mask))
            release()

        return run

    touched = docs.mapInArrow(part(True), schema).join(listed, F.col("doc_id") == F.col(doc), "left").drop(doc)
    rest = docs.mapInArrow(part(False), schema)
    if report:
        rest = rest.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("removed"), "text")

    def removals(texts: list[str | None], found: pa.ChunkedArray, hasher: Hasher) -> Iterator[list[tuple[int, int]]]:
        chunk = Chunk([t or "" for t in texts], hasher, hashed=False)
        for k, (text, own) in enumerate(zip(texts, found.to_pylist(), strict=True)):
            own = [s for s in own or () if s["mark"] == chunk.marks[k]]
            cuts = [(s["start"], s["stop"]) for s in own if s["words"] is None]
            inside = [s for s in own if s["words"] is not None]
            if inside:
                words, begin, end = chunk_words(chunk, k, text)
                for s, i in zip(inside, np.searchsorted(begin, [s["start"] for s in inside]).tolist(), strict=True):
                    same = reach(words, i, s["words"].split(" "), s["before"])
                    if same:
                        cuts.append((int(begin[same[0]]), int(end[same[1] - 1])))
            yield merged(text, cuts) if cuts else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for t in slices(batches):
            own = {c: t.column(c).combine_chunks() for c in columns}
            texts, removed, gone = own["text"].to_pylist(), [], []
            for i, cuts in enumerate(removals(texts, t.column(spans), hasher)):
                n = len(texts[i] or "")
                if cuts:
                    texts[i] = without(texts[i], cuts)
                gone.append(n - len(texts[i] or ""))
                removed.append(",".join(f"{a}:{b}" for a, b in cuts))
            if report:
                yield pa.RecordBatch.from_arrays([own["doc_id"].cast(pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "n_removed", "removed", "text"])
                continue
            if "n_chars" in own:
                own["n_chars"] = pa.array([len(x) if g else n for x, g, n in zip(texts, gone, own["n_chars"].to_pylist(), strict=True)], own["n_chars"].type)
            own["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(own.values()), names=columns)

    return touched.mapInArrow(run, "doc_id long, n_removed long, removed string, text string" if report else schema).union(rest)
