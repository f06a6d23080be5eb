"""Personal data by weak supervision.

Base patterns give spans that always stay. Wider patterns give more candidates. Six labelers (patterns,
checks, gazetteers, context and negative context) vote on every candidate. Expectation maximisation over
the counted vote patterns of the corpus estimates how reliable each labeler is, and a logistic
classifier of span features, trained on the resulting posteriors, decides which further spans are added.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import cut, regroup, strings

#: Kinds in the order of the digests; the base patterns give the first four.
KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = 6
#: Added spans need this probability.
CERTAIN = 0.9
#: Candidates on which the classifier is trained at most, those of the smallest hashes.
TRAINING_SPANS = 20_000
ROUNDS = 50
CHUNK_BYTES = 4 << 20
CONTEXT = 32

#: Base patterns.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Wider patterns.
WIDER = (
    ("email", re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\s?(?:\[at\]|\(at\))\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\[dot\]|\(dot\)|\.)\s?[A-Za-z0-9-]{2,63}){1,4}\b", re.I)),
    ("phone", re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")),
    ("secret", re.compile(r"\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|(?<![A-Za-z])(?:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{6,128}", re.I)),
)
#: Gazetteers.
TOP_DOMAINS = frozenset("com net org edu gov io info biz de fr es it uk us eu nl ch at co me dev".split())
ISSUERS = ("34", "35", "36", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "65")
BEFORE = {
    "email": ("mail", "contact", "write", "reach", "correo", "courriel"),
    "ip": ("ip", "addr", "host", "server", "from"),
    "card": ("card", "visa", "master", "credit", "karte", "carte", "tarjeta", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "ring", "téléphone"),
    "secret": ("password", "passwd", "pwd", "secret", "token", "key", "akia", "login"),
}
AGAINST = ("version", "ver.", "isbn", "order", "invoice", "serial", "build", "sku", "article", "ticket", " v", "#", "/", "=", "id")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the base pattern. The local part is all that reaches back from an @, so the work is linear."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        if m:
            start = at
            while start > done and LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                out.append((start, m.end()))
                done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the base spans, by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if ANY_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


ANY_DIGIT = re.compile(r"[0-9]")
HINT = re.compile(r"[0-9]|[\[(]at[\])]|AKIA|gh[pousr]_|password|passwd|pwd|secret|token|api[_-]?key", re.I)


def wider_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates that the base patterns miss; none overlaps a base span or another candidate."""
    if not HINT.search(text):
        return []
    found: list[tuple[str, int, int]] = []
    begins: list[int] = []  # of what is taken: parts that do not overlap, in order
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if begins and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    more = [(kind, *m.span()) for kind, pattern in WIDER for m in pattern.finditer(text)]
    more += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(re.sub("[ -]", "", m[0])) <= 19]
    for kind, a, b in more:
        at = bisect.bisect_right(begins, a)
        if (not at or ends[at - 1] <= a) and (at == len(begins) or b <= begins[at]):
            found.append((kind, a, b))
            begins.insert(at, a)
            ends.insert(at, b)
    return found


def entropy(s: str) -> float:
    counts = Counter(s)
    return -sum(c / len(s) * math.log2(c / len(s)) for c in counts.values()) if s else 0.0


def votes(text: str, kind: str, a: int, b: int, is_base: bool) -> tuple[int, ...]:
    """What each labeler says: 1 for personal data, -1 against, 0 nothing."""
    span, before = text[a:b], text[max(0, a - CONTEXT) : a].lower()
    digits = re.sub("[^0-9]", "", span)
    after, left = text[b : b + 1], text[a - 1 : a]
    pattern = 1 if is_base or kind == "secret" else -1 if kind == "card" else 0
    if kind == "card":
        check = 1 if luhn(digits) else -1
    elif kind == "ip":
        check = -1 if digits.startswith("0") or span.startswith(("127.", "0.")) else 1
    elif kind == "phone":
        check = 1 if 10 <= len(digits) <= 13 else -1
    elif kind == "email":
        check = 1 if len(span) <= 254 and ".." not in span else -1
    else:
        check = 1 if entropy(span[-24:]) >= 3.0 and any(c.isdigit() for c in span) else -1
    if kind == "email":
        gazetteer = 1 if re.split(r"[.\s\])]+", span.lower())[-1] in TOP_DOMAINS else -1
    elif kind == "card":
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
    elif kind == "phone":
        gazetteer = 1 if span.startswith("+") or digits[:3] not in ("000", "111", "123", "999") else -1
    elif kind == "secret":
        gazetteer = 1 if span.startswith(("AKIA", "gh")) else 0
    else:
        gazetteer = 0
    context = 1 if any(w in before for w in BEFORE[kind]) or kind == "secret" and any(w in span.lower() for w in BEFORE[kind]) else 0
    border = 1 if (not left or not left.isalnum()) and (not after or not after.isalnum()) else -1
    against = -1 if kind != "secret" and any(before.rstrip(" :").endswith(w.strip()) for w in AGAINST) else 0
    return pattern, check, gazetteer, context, border, against


def span_features(text: str, kind: str, a: int, b: int, v: tuple[int, ...]) -> list[float]:
    span = text[a:b]
    n = max(1, len(span))
    shares = [sum(map(f, span)) / n for f in (str.isdigit, str.isalpha, str.isupper, str.isspace)]
    around = text[max(0, a - 1) : a] + text[b : b + 1]
    return [1.0, *(float(kind == k) for k in KINDS), min(2.0, n / 32), *shares, entropy(span) / 5, sum(c.isalnum() for c in around) / 2, *(float(x > 0) for x in v), *(float(x < 0) for x in v)]


def expectation_maximisation(patterns: list[tuple[str, tuple[int, ...]]], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The posterior of each (kind, votes) pattern and each labeler's P(vote | class) as [labeler, class, vote + 1].

    The classes share no labels with the data: it starts from the majority of votes.
    """
    v = np.array([p for _, p in patterns]) + 1
    kinds = np.array([KINDS.index(k) for k, _ in patterns])
    majority = (v - 1).sum(axis=1)
    posterior = 1 / (1 + np.exp(-1.0 * majority))
    reliability = np.zeros((LABELERS, 2, 3))
    for _ in range(ROUNDS):
        weights = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = np.zeros((2, len(KINDS)))
        for c in (0, 1):
            prior[c] = np.bincount(kinds, weights[c], len(KINDS)) + 1
            for j in range(LABELERS):
                reliability[j, c] = np.bincount(v[:, j], weights[c], 3) + 1
        prior /= prior.sum(axis=0)
        reliability /= reliability.sum(axis=2, keepdims=True)
        logs = [np.log(prior[c][kinds]) + sum(np.log(reliability[j, c][v[:, j]]) for j in range(LABELERS)) for c in (0, 1)]
        fresh = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))
        if np.abs(fresh - posterior).max() < 1e-9:
            break
        posterior = fresh
    return posterior, reliability


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic classifier on soft labels."""
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (weight * (p - y)) + 1e-4 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


CANDIDATE = "struct<kind:string,start:long,end:long,base:boolean,votes:string,x:array<double>>"
CANDIDATE_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.string()), ("x", pa.list_(pa.float64()))])


def spans_of(text: str) -> list[dict]:
    base = base_spans(text)
    out = []
    for is_base, found in ((True, base), (False, wider_spans(text, base))):
        for kind, a, b in found:
            v = votes(text, kind, a, b, is_base)
            out.append({"kind": kind, "start": a, "end": b, "base": is_base, "votes": " ".join(map(str, v)), "x": span_features(text, kind, a, b, v)})
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and all candidate spans of each row with votes and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regroup(batches, "text", CHUNK_BYTES):
            found = [spans_of(x) for x in strings(t.column("text"))]
            yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), pa.array(found, pa.list_(CANDIDATE_TYPE))], names=["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, found array<{CANDIDATE}>")


def learn(found: DataFrame) -> dict | None:
    """The classifier from candidates; None if the corpus has none.

    The vote patterns are counted over all documents; their number is bounded by the labelers, not by
    the corpus. The classifier sees TRAINING_SPANS candidates at most.
    """
    each = found.select("doc_id", F.explode("found").alias("s"))
    tally = each.groupBy("s.kind", "s.votes").count().collect()
    if not tally:
        return None
    tally.sort(key=lambda r: (r["kind"], r["votes"]))
    patterns = [(r["kind"], tuple(map(int, r["votes"].split()))) for r in tally]
    posterior, reliability = expectation_maximisation(patterns, np.array([float(r["count"]) for r in tally]))
    soft = {(r["kind"], r["votes"]): float(p) for r, p in zip(tally, posterior, strict=True)}
    rows = each.orderBy(F.xxhash64("doc_id", "s.start", "s.kind"), "doc_id", "s.start").limit(TRAINING_SPANS).select("s.kind", "s.votes", "s.x").collect()
    weights = train(np.array([r["x"] for r in rows]), np.array([soft[r["kind"], r["votes"]] for r in rows]), np.ones(len(rows)))
    return {"weights": weights, "reliability": reliability.tolist(), "posterior": soft}


def decided(found: list[dict], weights: np.ndarray | None) -> list[tuple[str, int, int]]:
    """Base spans and those candidates of which the classifier is certain, by kind, then start."""
    kept = []
    for s in found:
        if s["base"] or weights is not None and float(np.dot(weights, s["x"])) >= math.log(CERTAIN / (1 - CERTAIN)):
            kept.append((s["kind"], s["start"], s["end"]))
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and all spans of every row; offsets in code points, ends exclusive.

    n_spans counts all spans. A null or empty text has no spans, hence counts 0, the digest of nothing and
    empty spans. Of candidates that overlap the first pattern's stays. A text of any length is read whole,
    in time in proportion to it. Null ids stay null, repeated rows give repeated rows, an empty table gives
    no rows; only columns doc_id and text are read, so others may have any names.
    """
    found = cut(candidates(docs))
    model = learn(found)
    weights = None if model is None else model["weights"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            rows = []
            for own in t.column(1).to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in own if s["base"]]
                counts = Counter(k for k, _, _ in base)
                kept = decided(own, weights)
                rows.append((*(counts[k] for k in KINDS[:4]), hashlib.sha256(joined(base).encode()).hexdigest(), joined(kept), len(kept)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([t.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])

    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span that find() gives replaced by its kind in brackets; n_chars, if there, follows the text.

    Overlapping spans are replaced as one, under the kind of the first. Null texts stay null, as do null
    ids; repeated rows stay, an empty table gives no rows, other columns may have any names.
    """
    model = learn(cut(candidates(docs)))
    weights = None if model is None else model["weights"]
    columns = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regroup(batches, "text", CHUNK_BYTES):
            texts = [None if x is None else replaced(x, decided(spans_of(x), weights)) for x in t.column("text").to_pylist()]
            own = {c: t.column(c).combine_chunks() for c in columns}
            if "n_chars" in own:
                own["n_chars"] = pa.array([n if x is None else len(x) for x, n in zip(texts, own["n_chars"].to_pylist(), strict=True)], own["n_chars"].type)
            own["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(own.values()), names=columns)

    return docs.mapInArrow(run, schema)


def replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += (text[at:a], f"[{kind.upper()}]")
        at = max(at, b)
    return "".join((*out, text[at:])) if out else text
