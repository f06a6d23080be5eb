"""Byte-level BPE by a pair occurrence index.

The different words of a batch are laid end to end, with links between neighbouring symbols. The index maps
each pair, by its rank, to all places where it occurs. Ranks are applied in ascending order: the index is
walked from its lowest bucket of ranks to its highest, and within a bucket every word has its lowest rank
applied at all its places at once, since words do not touch each other. Only the entries beside a merge are
looked up again and filed under their new ranks, which are higher than that of the merge. So the work
follows the number of occurrences, whatever the length of the words.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from spindrift.llm.common import ranges, regroup, strings

#: The split of text before merges, as byte-level BPE vocabularies publish it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text that are encoded together.
CHUNK_BYTES = 4 << 20
#: Different space-separated chunks that are kept with their ids before the memory is emptied.
KEEP_CHUNKS = 200_000
#: Pairs that are looked up together.
SLICE = 1 << 16
#: Buckets of ranks in the index, at least; where a word has more than 64 times as many symbols, one per 64 of them.
BUCKETS = 32

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file: itself, or the next one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in printable else next(spare)) for b in range(256)}


class Known(dict):
    """Numbers chunks of text by first sight, from one count with others; new ones go to the list `new` with the lead that all have."""

    def __init__(self, lead: str, new: list[tuple[str, str]]):
        self.lead, self.new = lead, new
        self.first = 0

    def __missing__(self, chunk: str) -> int:
        i = self[chunk] = self.first + len(self.new)
        self.new.append((self.lead, chunk))
        return i


class Bpe:
    """Encoder and decoder of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        n = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * n
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int32)
        self.base = n
        self.rank_of: dict[int, int] = {}
        left, right, into = [], [], []
        for a, b in ((m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]):
            left.append(vocab[a])
            right.append(vocab[b])
            into.append(vocab[a + b])
            self.rank_of.setdefault(left[-1] * n + right[-1], len(left) - 1)
        self.into = into
        self.into_of = np.array(into, dtype=np.int32)
        self._hash(np.array(list(self.rank_of), dtype=np.int64), np.array(list(self.rank_of.values()), dtype=np.int32))
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.split = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.new: list[tuple[str, str]] = []
        #: Chunks as they are, and chunks after a space, which is left out.
        self.known, self.spaced = Known("", self.new), Known(" ", self.new)
        self._reset()

    def _reset(self) -> None:
        for known in (self.known, self.spaced):
            known.clear()
            known.first = 0
        self.tokens = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)

    def _hash(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """An open table from pairs to ranks, for whole arrays of pairs at once."""
        self.slots = np.full(1 << 20, -1, dtype=np.int64)
        self.slot_ranks = np.full(1 << 20, -1, dtype=np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[free]
            won = self.slots[at] == keys
            self.slot_ranks[at[won]] = ranks[won]
            keys, ranks, at = keys[~won], ranks[~won], (at[~won] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * 0x9E3779B97F4A7C1 >> 17) & (len(self.slots) - 1)).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        out = np.empty(len(a), dtype=np.int32)
        for i in range(0, len(a), SLICE):
            want = a[i : i + SLICE].astype(np.int64) * self.base + b[i : i + SLICE]
            at = self._slot(want)
            found = self.slots[at]
            own = np.where(found == want, self.slot_ranks[at], -1)
            open_ = np.flatnonzero((found != want) & (found >= 0))
            while len(open_):
                at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
                found = self.slots[at[open_]]
                hit = found == want[open_]
                own[open_[hit]] = self.slot_ranks[at[open_[hit]]]
                open_ = open_[~hit & (found >= 0)]
            out[i : i + SLICE] = own
        return out

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Applies all merges to words laid end to end; ends[i] is where word i stops. Returns tokens and their count per word."""
        n, none = len(symbols), len(self.into)
        sizes = np.diff(np.r_[0, ends])
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(len(sizes), dtype=np.int64)
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        ids = np.r_[symbols, 0].astype(np.int32)  # the last place stands for none
        nxt, prv = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        full = ends[sizes > 0]
        nxt[full - 1] = n
        prv[np.r_[0, full[:-1]]] = n
        pair = np.full(n + 1, none, dtype=np.int32)  # the rank of the pair that begins at each place
        at = np.flatnonzero(nxt[:n] < n).astype(np.int32)
        found = self._ranks(ids[at], ids[at + 1])
        pair[at] = np.where(found < 0, none, found)
        buckets = min(none, max(BUCKETS, int(sizes.max()) // 64))
        width = -(-none // max(1, buckets))
        index: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(buckets)]

        def file(places: np.ndarray, ranks: np.ndarray, least: int) -> None:
            """Puts places under their ranks' buckets, from bucket `least` on."""
            if not len(places):
                return
            bucket = np.maximum(ranks // width, least).astype(np.uint16 if buckets < 1 << 16 else np.int32)
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            bucket, places, ranks = bucket[order], places[order], ranks[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
                index[bucket[a]].append((places[a:b], ranks[a:b]))

        at = at[found >= 0]
        file(at, pair[at], 0)
        lowest = np.full(len(sizes), none, dtype=np.int32)
        chosen = np.zeros(n + 1, dtype=bool)
        for k in range(buckets):
            if not index[k]:
                continue
            places, ranks = (np.concatenate(x) for x in zip(*index[k], strict=True))
            index[k] = []
            later: list[tuple[np.ndarray, np.ndarray]] = []
            while True:
                live = pair[places] == ranks
                places, ranks = places[live], ranks[live]
                if not len(places):
                    break
                own = word[places]
                np.minimum.at(lowest, own, ranks)
                first = lowest[own] == ranks
                lowest[own] = none
                at, rank = places[first], ranks[first]
                twin = ids[at] == ids[nxt[at]]
                if twin.any():  # of a run of equal symbols every other place, from the left
                    order = np.argsort(at[twin], kind="stable")
                    run = at[twin][order]
                    i = np.arange(len(run))
                    begins = np.maximum.accumulate(np.where(np.r_[False, nxt[run[:-1]] == run[1:]], 0, i))
                    odd = (i - begins) % 2 == 1
                    at, rank = np.concatenate([at[~twin], run[~odd]]), np.concatenate([rank[~twin], rank[twin][order][~odd]])
                right = nxt[at]
                after, before = nxt[right], prv[at]
                ids[at] = self.into_of[rank]
                ids[right] = -1
                pair[right] = none
                nxt[at] = after
                prv[after] = at
                chosen[at] = True
                before = before[(before < n) & ~chosen[before]]
                chosen[at] = False
                pair[at] = none
                near = np.concatenate([at[after < n], before])
                found = self._ranks(ids[near], ids[nxt[near]])
                pair[near] = np.where(found < 0, none, found)
                near, found = near[found >= 0], found[found >= 0].astype(np.int32)
                here = found < (k + 1) * width
                later.append((near[~here], found[~here]))
                places, ranks = np.concatenate([places[~first], near[here]]), np.concatenate([ranks[~first], found[here]])
            if later:
                file(*(np.concatenate(x) for x in zip(*later, strict=True)), k + 1)
        alive = ids[:n] >= 0
        upto = np.r_[0, np.cumsum(alive)]
        return ids[:n][alive], np.diff(upto[np.r_[0, ends]])

    def _learn(self) -> None:
        """Encodes the chunks that are new and appends their ids."""
        pieces, per = [], np.empty(len(self.new), dtype=np.int64)
        for i, (lead, c) in enumerate(self.new):
            if c.isalpha():
                per[i] = 1
                pieces.append(lead + c)
            elif c[-1] in ".,;:!?" and c[:-1].isalpha():
                per[i] = 2
                pieces += (lead + c[:-1], c[-1])
            else:
                own = self.split.findall(lead + c)
                per[i] = len(own)
                pieces += own
        raw = [x.encode() for x in pieces]
        ends = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
        tokens, counts = self.merge(self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)], ends)
        upto = np.r_[0, np.cumsum(counts)][np.r_[0, np.cumsum(per)]]
        self.starts = np.concatenate([self.starts, upto[:-1] + len(self.tokens)])
        self.lengths = np.concatenate([self.lengths, np.diff(upto)])
        self.tokens = np.concatenate([self.tokens, tokens])
        self.new.clear()
        self.known.first = self.spaced.first = len(self.starts)

    def _chunks(self, text: str) -> list[str]:
        """Pieces at whose borders no token crosses: a border stands before each space that a non-space follows."""
        parts = text.split(" ")
        out = [parts[0]] if parts[0] else []
        for x in parts[1:]:
            if x and not x[0].isspace():
                out.append(" " + x)
            elif out:
                out[-1] += " " + x
            else:
                out.append(" " + x)
        return out

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids begin; one more entry than texts."""
        if len(self.starts) > KEEP_CHUNKS:
            self._reset()
        walk, counts = [], []
        specials: list[tuple[int, int]] = []
        for text in texts:
            before = len(walk)
            if self.specials is not None and self.specials.search(text):
                for part in self.specials.split(text):
                    if part in self.special:
                        specials.append((len(walk), self.special[part]))
                        walk.append(-1)
                    elif part:
                        self._walk(part, walk)
            elif text:
                self._walk(text, walk)
            counts.append(len(walk) - before)
        if self.new:
            self._learn()
        at = np.array(walk, dtype=np.int64)
        if specials:
            where = np.array([w for w, _ in specials])
            base = len(self.tokens)
            kinds = sorted({i for _, i in specials})
            starts = np.concatenate([self.starts, base + np.arange(len(kinds))])
            lengths = np.concatenate([self.lengths, np.ones(len(kinds), dtype=np.int64)])
            at[where] = len(self.starts) + np.searchsorted(kinds, [i for _, i in specials])
            tokens = np.concatenate([self.tokens, np.array(kinds, dtype=np.int32)])
        else:
            starts, lengths, tokens = self.starts, self.lengths, self.tokens
        sizes = lengths[at] if len(at) else np.zeros(0, dtype=np.int64)
        ids = tokens[ranges(starts[at], sizes)] if len(at) else np.zeros(0, dtype=np.int32)
        bounds = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(np.array(counts, dtype=np.int64))]]
        return ids, bounds

    def _walk(self, text: str, walk: list[int]) -> None:
        """Appends the numbers of a text's chunks."""
        if ODD_SPACE.search(text):
            walk += map(self.known.__getitem__, self._chunks(text))
            return
        words = text.split(" ")
        first = words.pop(0) if words else ""
        if first:
            walk.append(self.known[first])
        walk += map(self.spaced.__getitem__, words)

    def decode(self, ids: np.ndarray) -> str:
        table = self.token_bytes
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


#: A space that does not open a word.
ODD_SPACE = re.compile(r" (?:\s|$)")


def parts(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Slices of texts with about `limit` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_decode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the text decoded from them.

    A null text is empty: no ids, the digests of nothing. A null id stays null; repeated rows give
    repeated rows; other columns are not read. Texts that hold a special token's string get its id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for t in regroup(batches, text_column, CHUNK_BYTES):
            texts, counts, hashes, decoded = strings(t.column(text_column)), [], [], []
            for a, b in parts(texts, CHUNK_BYTES):
                ids, bounds = bpe.encode_batch(texts[a:b])
                for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    own = ids[i:j]
                    counts.append(j - i)
                    hashes.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([t.column(id_column).cast(pa.int64()).combine_chunks(), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_column, text_column).mapInArrow(run, SCHEMA)
