"""Each corpus operator against brute force, exact round trips or held-out accuracy, and its defined edge cases."""

import gzip
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spindrift.llm import balltree, bpe, common, html, jaccard, media, packing, paragraphs, pii, quality, queries, warc

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return common.table(spark, SMALL, "documents")


def docs_of(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(words))


ODD = [None, "", " ", "word", "x" * 40_000, "a b " * 9000, "tie tie tie", "tie tie tie", "é́ 日本語 😀 \x00 <|endoftext|>"]


# -- shared --------------------------------------------------------------------


def test_components(spark):
    pairs = [(1, 2), (2, 3), (3, 4), (10, 11), (11, 10), (5, 5)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 230)]
    got = {r.node: r.label for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 4), 1), 10: 10, 11: 10, **dict.fromkeys(range(100, 160), 100), **dict.fromkeys(range(200, 231), 200)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_join_of_hot_and_cold_keys(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(300)] + [("cold", -1), (None, -2), ("none", -3)], "k string, i int")
    groups = spark.createDataFrame([("hot", 300, 1), ("cold", 1, 2)], "k string, n long, v int")
    got = common.join_counted(rows, groups, "k", "n", 10**5, spread=F.xxhash64("i").cast("string")).collect()
    assert len(got) == 303 and {(r.k, r.v) for r in got} == {("hot", 1), ("cold", 2), (None, None), ("none", None)}


def test_bitmap_lets_its_values_through(spark):
    bits = common.bitmap(spark.createDataFrame([(5,), (-7,), (2**60 + 3,), (None,)], "x long"))
    assert common.in_bitmap(bits, np.array([5, -7, 2**60 + 3, 6])).tolist() == [True, True, True, False]


# -- 1 -------------------------------------------------------------------------


def test_quality_is_learnt_from_pairs(spark, documents):
    labels = common.table(spark, SMALL, "labels")
    got = {r.doc_id: r for r in quality.classify(documents, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(got[i].predicted, q) for i, q in truth.items() if i in got and got[i].held_out]
    assert len(held) > 10 and sum(p == q for p, q in held) / len(held) > 0.9
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in got.items())


def test_quality_edges(spark):
    docs = docs_of(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(9)] + [(None, 1, 0), (3, None, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs.unionByName(docs), labels).collect()
    assert len(got) == 2 * len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(docs.limit(0), labels).count() == 0


# -- 2 -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><a href=x>menu</a></nav><div class="cookie-notice">We use cookies</div>
<div class="layout-{n}"><div class="post-body c{n}"><h1>Head &amp; {n}</h1><p>First <b>bo</b>ld para&nbsp;x of {n}<p>Second  one
goes on and on for a while {n}<ul><li>one<li>two</ul><div class="ad">BUY</div></div><aside>side bar</aside>
<section id=comments><p>a reader says something that is long enough to count as a text of its own</section></div>
<form><p>form</p></form><footer>&copy; foot</footer>"""


def test_main_text(spark):
    want = "Head & {n}\nFirst bold para x of {n}\nSecond one goes on and on for a while {n}\none\ntwo"
    rows = [(i, f"http://u:p@Host.example:80/{i}", PAGE.format(n=i)) for i in range(6)] + [(6, None, None), (7, "x", ""), (8, "http://host.example/8", "<p>only &lt;this"), (None, "http://host.example", "plain")]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [text[i] for i in range(6)] == [want.format(n=i) for i in range(6)]
    assert (text[6], text[7], text[8], text[None]) == ("", "", "only <this", "plain")


def test_host_paths_win_over_a_page(spark):
    votes = spark.createDataFrame([(i, "http://a.example/", PAGE.format(n=i)) for i in range(3)], "page_id long, url string, html string")
    assert [(r.host, r.path) for r in html.consensus(votes).collect()] == [("a.example", "html>body>div.layout-#>div.c#.post-body")]


def test_headline_and_lead_beside_the_body_stay(spark):
    page = "<body><div class=top>Our paper, since 1900</div><div class=wrap><div class=post><h1>Title {n} of forty characters or so</h1>{lead}<div class=body><p>{long}</p></div></div><div class=more><a href=x>other story</a></div></div></body>"
    rows = [(i, f"http://{h}.example/{i}", page.format(n=i, lead=lead, long=prose(i, 400))) for i, (h, lead) in enumerate([("a", ""), ("a", ""), ("b", "<div class=lead>Lead</div>"), ("b", "<div class=lead>Lede</div>"), ("c", "")])]
    main = "<body><main><h1>Title {n}</h1><div><div><div class=body>{long}</div></div></div></main></body>"
    rows += [(i, "http://m.example/", main.format(n=i, long=prose(i, 400))) for i in (5, 6)]
    slogan = "<body><div class=top>Our paper, since 1900</div><div class=body>{long}</div></body>"
    rows += [(i, "http://s.example/", slogan.format(long=prose(i, 400))) for i in (7, 8)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert got[i] == "\n".join([f"Title {i} of forty characters or so", *(["Lead", "Lede"][i - 2 : i - 1] if i in (2, 3) else []), prose(i, 400)])
    for i in (5, 6):
        assert got[i] == f"Title {i}\n{prose(i, 400)}"
    for i in (7, 8):
        assert got[i] == prose(i, 400)


@pytest.mark.parametrize("broken", ["<", "<p", "</p>", "<div><div>", "<script>x", "<!-- x", "<a href='x>y</a> t", "<table><td>a<tr><td>b", "<div>" * 5000 + "x"])
def test_broken_pages(broken):
    assert isinstance(html.extract(broken, "html>body"), str)


def test_pages_of_the_table(spark):
    pages = common.table(spark, SMALL, "pages")
    got = {r.page_id: r.text for r in queries.op2_host_paths(spark, SMALL).collect()}
    for r in pages.collect():
        inside = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", inside)]
        assert got[r.page_id] == "\n".join(x for x in parts if x)


# -- 3 -------------------------------------------------------------------------


def brute_links(texts):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in texts]
    n = len(texts)
    linked = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(n)]
    return [(root[i], len(linked[i])) for i in range(n)]


def test_similarity_join_against_brute_force(spark):
    texts = list(ODD)
    for seed in range(12):
        base = prose(seed, 90).split()
        for copy in range(1 + seed % 4 * 3):
            w = list(base)
            for _ in range(copy % 3):
                w[random.Random(seed * 31 + copy).randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    texts += [prose(99, 60)] * 7 + ["Case  And\nSpace " + prose(98, 40), "case and space " + prose(98, 40)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.similarity_classes(docs_of(spark, texts)).collect()}
    assert got == dict(enumerate(brute_links(texts)))


def test_similarity_join_edges(spark):
    assert jaccard.similarity_classes(docs_of(spark, [])).count() == 0
    docs = docs_of(spark, ["a b c d e f", "a b c d e f", None, "g h"], [None, 4, None, 4])
    assert sorted((r.doc_id or -1, r.class_id or -1, r.n_links) for r in jaccard.similarity_classes(docs).collect()) == [(-1, -1, 0), (-1, 4, 1), (4, 4, 0), (4, 4, 1)]
    kept = jaccard.first_of_each(docs_of(spark, ["a b c d e f", "a b c d e f", "x y z", "x y z"], [1, 2, 3, 3]).withColumn("label", F.lit(1)))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and kept.columns[-1] == "label"


def test_one_id_of_several_texts_and_null_ids(spark):
    texts = ["a b c d e f", "a b c d e f", "clean other words of its own", "g h i j k l", "g h i j k l", "g h i j k l", None]
    kept = jaccard.first_of_each(docs_of(spark, texts, [1, 2, 2, None, None, 4, 2]).withColumn("label", F.lit(1)))
    want = [(1, "a b c d e f"), (2, "clean other words of its own"), (2, None), (4, "g h i j k l"), (None, "g h i j k l"), (None, "g h i j k l")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_pruning_keeps_what_reaches_the_threshold():
    assert jaccard.Bands().recall(0.8) > 0.9999
    r = np.random.default_rng(0)
    a = r.integers(0, 256, (4000, 140), dtype=np.uint8)
    b = np.where(r.random(a.shape) < 0.8, a, r.integers(0, 256, a.shape, dtype=np.uint8))
    assert len(jaccard.surviving(a, b, 0.8)) >= 3995
    assert len(jaccard.surviving(a, r.integers(0, 256, a.shape, dtype=np.uint8), 0.8)) == 0


# -- 4 -------------------------------------------------------------------------

EMAIL, IP4 = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute_spans(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP4.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 13 <= len(re.sub("[ -]", "", m[0])) <= 19 and pii.luhn(re.sub("[ -]", "", m[0])):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@pytest.mark.parametrize("letters", ["ab@.-1 é", "0123.4 -", "+1 ()-.5", "a@b.c@d", "1.2@"])
def test_base_spans(letters):
    r = random.Random(letters)
    for _ in range(3000):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 30)))
        assert pii.base_spans(t) == brute_spans(t)


def test_personal_data(spark):
    texts = [*ODD, "mail ann.b@mail.example.com or +1 (212) 555-0134 now", "card 4539 5787 6362 1486 at 10.0.0.1", "call +1 (212) 555-0134 10.20.30.40 soon", 'token = "bc0d31ba76f17e56642e8751295a3fd50cd8e61f"', "version 1.2.3.4"] * 3
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, t in enumerate(texts):
        base = brute_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(k == x for k, _, _ in base) for x in ("email", "ip", "card", "phone"))
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i].spans.split(","))
    clean = pii.redact(docs.withColumn("spans", F.lit(1))).orderBy("doc_id").collect()
    assert clean[9].text == "mail [EMAIL] or [PHONE] now" and clean[9].n_chars == len(clean[9].text) and clean[9].spans == 1
    assert clean[0].text is None and clean[6].text == "tie tie tie"
    assert pii.find(docs.limit(0)).count() == 0


def test_reliabilities_rise_with_agreement():
    patterns = [("phone", (1, 1, 1, 1, 1, 0)), ("phone", (0, 1, 1, 0, 1, 0)), ("card", (-1, -1, -1, 0, 1, -1)), ("card", (-1, -1, 1, 0, -1, 0))]
    posterior, reliability = pii.expectation_maximisation(patterns, np.array([50.0, 20.0, 40.0, 30.0]))
    assert posterior[0] > 0.99 and posterior[2] < 0.01 and reliability[1, 1, 2] > reliability[1, 0, 2]


# -- 5 -------------------------------------------------------------------------


def test_revisits(spark, tmp_path):
    rows = [(i, f"http://h/{i} x", "same \r\n\r\n page é") for i in (7, 3, 9)] + [(1, None, None), (4, "u", ""), (5, "u", "other"), (None, "u", "other"), (3, "u", "same \r\n\r\n page é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    got = sorted((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes) for r in warc.deduplicate(pages, str(tmp_path / "w")).collect())
    n = len("same \r\n\r\n page é".encode())
    assert got == [(-1, "revisit", 5, 5), (1, "response", None, 0), (3, "response", None, n), (3, "response", None, n), (4, "revisit", 1, 0), (5, "response", None, 5), (7, "revisit", 3, n), (9, "revisit", 3, n)]
    records = [x for p in sorted((tmp_path / "w").glob("*.gz")) for x in warc.parse(p.read_bytes())]
    assert len(records) == 8
    for fields, block in records:
        payload = block.partition(b"\r\n\r\n")[2]
        if fields["warc-type"] == "response":
            assert fields["warc-payload-digest"] == "sha1:" + warc.base32_digest(hashlib.sha1(payload).hexdigest())
        else:
            assert payload == b"" and "warc-refers-to" in fields
    assert gzip.decompress(next((tmp_path / "w").glob("*.gz")).read_bytes()).startswith(b"WARC/1.1")


def test_archives_of_few_or_no_pages(spark):
    schema = "page_id long, url string, html string, digest string, original string"
    assert warc.deduplicate(spark.createDataFrame([], schema)).count() == 0
    one = warc.deduplicate(spark.createDataFrame([(8, None, "x" * 3_000_000, "a", "b")], schema)).collect()
    assert [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in one] == [(8, 3_000_000, "response", None)]
    spread = spark.createDataFrame([(i, "u", f"page {i % 5}", "a", "b") for i in range(20)] + [(None, "u", "none", "a", "b")] * 2, schema).repartition(40)
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.deduplicate(spread).collect()}
    assert got == {(i, "response" if i < 5 else "revisit", None if i < 5 else i % 5) for i in range(20)} | {(None, "response", None)}


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    assert {r.page_id: r.record_type for r in warc.deduplicate(pages, least_bytes=3).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


# -- 6 -------------------------------------------------------------------------


def check_packing(rows, texts, capacity):
    t = Tokenizer.from_file(VOCABULARY)
    of, sequences = {}, {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(of) == set(texts)
    for i, pieces in of.items():
        ids = np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(ids)
        assert all(r.length == capacity for r in pieces[1:]) and (len(pieces) == 1 or len(ids) > capacity)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in pieces)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


def test_packing(spark):
    texts = dict(enumerate([*ODD, *(prose(i, 1 + i * 7 % 400) for i in range(150))]))
    docs = docs_of(spark, list(texts.values())).repartition(7)
    rows = packing.pack(docs, VOCABULARY, 256).collect()
    n = check_packing(rows, texts, 256)
    assert n <= -(-sum(r.length for r in rows) // 256) * 1.05 + 1
    assert packing.pack(docs.limit(0), VOCABULARY).count() == 0


def test_best_fit_is_best_fit():
    bins = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert sorted(map(sorted, bins)) == [[0, 2], [1, 3, 4]]
    assert packing.cut_pieces(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.cut_pieces(1024, 1024) == [(0, 1024)]


# -- 7 -------------------------------------------------------------------------


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(balltree, "SHARD_ROWS", 64)
    monkeypatch.setattr(balltree, "BLOCK_ROWS", 8)
    r = np.random.default_rng(2)
    vectors = [(i, r.normal(size=6).astype(np.float32).tolist()) for i in range(300)] + [(i, [0.5] * 6) for i in range(300, 380)]
    bad = [(400, None), (420, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (440, [float("nan")] * 6), (460, [float("inf")] * 6), (None, [1.0] * 6), (480, [1.0, 2.0]), (500, [3.0, 1.0])]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit(0))
    got = {}
    for x in balltree.top_k(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(x.query_id, {})[x.rank] = (x.score, x.vec_id)
    whole = {i: np.floor(64 * np.array(v, dtype=np.float64)).astype(np.int64) for i, v in vectors}
    for q in range(0, 380, 20):
        want = sorted(((int(whole[q] @ w), i) for i, w in whole.items() if i != q), key=lambda x: (-x[0], x[1]))[:20]
        assert [got[q][k] for k in range(1, 21)] == want
    assert got[480] == {1: (64 * 64 * 5, 500)} and got[500] == {1: (64 * 64 * 5, 480)} and set(got) == {*range(0, 380, 20), 480, 500}
    assert balltree.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_large_numbers(spark):
    df = spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e3, 3.0]), (2, [1e3, 2.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in balltree.top_k(df, F.col("vec_id") == 0, 2).orderBy("rank").collect()] == [(1, int(64e12) * 64000 + 64 * 192), (2, int(64e12) * 64000 + 64 * 128)]


# -- 8 -------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4095, 4096, 4097, 1_000_000])
def test_container_round_trip(n):
    raw = random.Random(n).randbytes(n)
    payload = media.padded(raw)
    assert len(payload) % 64 == 0 and len(payload) >= max(64, n)
    content = media.write_container(payload)
    (track,) = media.read_tracks(content)
    assert media.read_payload(content, track) == payload and track.codec == "raw " and track.duration == len(payload) / 8000
    assert [content[a : a + s] for a, s in zip(track.starts[track.keys], track.sizes[track.keys])] == [payload[i : i + 64] for i in range(0, len(payload), 64 * 16)]


def test_broken_containers(spark):
    good = media.write_container(media.padded(b"x" * 500))
    rows = [(0, None), (1, b""), (2, good[:200]), (3, b"\0" * 64), (4, good), (5, good[:-100])]
    got = {r.id: r for r in media.media_features(spark.createDataFrame(rows, "id int, content binary"), "content", "id").collect()}
    assert [got[i].codec for i in range(5)] == [None, None, None, None, "raw "] and len(got[4].keyframes) == 1


def test_stored_texts(spark):
    got = {r.doc_id: r for r in media.store_texts(docs_of(spark, ODD)).collect()}
    for i, t in enumerate(ODD):
        payload = media.padded((t or "").encode())
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        content = media.write_container(payload)
        assert (r.media_bytes, r.media_sha256) == (len(content), hashlib.sha256(content).hexdigest())
    assert got[6].feature == got[7].feature


# -- 9 -------------------------------------------------------------------------


def test_repeated_passages(spark):
    passage = ". ".join(prose(i, 12).capitalize() for i in range(100, 106)) + "."
    near = prose(7, 60).split()
    near_copy = [*near[:30], "changed", *near[31:]]
    texts = [
        f"{prose(1, 40)} {passage} {prose(2, 30)}",
        f"{prose(3, 25)}\n{passage}\n{prose(4, 25)}",
        f"{prose(5, 33)} {passage} {prose(6, 20)}",
        "Start\n" + " ".join(near),
        "Other\n" + " ".join(near_copy),
        prose(8, 200),
        None,
        "",
        prose(9, 80),
        prose(9, 80),
    ]
    got = {r.doc_id: r for r in paragraphs.deduplicate(docs_of(spark, texts), report=True).collect()}
    assert len(got) == len(texts)
    for i in (0, 3, 5, 6, 7, 8):
        assert got[i].n_removed == 0 and got[i].text == texts[i]
    for i in (1, 2):
        assert len(got[i].text) < len(texts[i]) - 0.85 * len(passage) and passage not in got[i].text
    assert got[1].text.startswith(prose(3, 25)) and prose(4, 25) in got[1].text and got[2].text.startswith(prose(5, 33))
    assert got[4].text.strip() == "Other" and got[9].text == ""
    whole = paragraphs.deduplicate(docs_of(spark, texts).withColumn("start", F.lit("mine"))).orderBy("doc_id").collect()
    assert whole[9].n_chars == 0 and whole[5].n_chars == len(texts[5]) and whole[0].start == "mine"


def test_passages_edges(spark):
    assert paragraphs.deduplicate(docs_of(spark, []), report=True).count() == 0
    t = prose(1, 60)
    got = paragraphs.deduplicate(docs_of(spark, [t, t, t, *ODD], [None, 5, 5, *range(10, 19)]), report=True).collect()
    assert sum(r.n_removed for r in got) == 0 and len(got) == 12


def test_words_after_a_shared_passage_stay(spark):
    shared = "The " + " ".join(f"w{i}" for i in range(23))
    own = " ".join(f"unique{i}" for i in range(15)) + "."
    texts = [f"{shared} {prose(1, 15)}.", f"{shared} {own}", f"{prose(2, 30)} {prose(3, 60)} {prose(4, 10)}.", f"{prose(5, 30)} {prose(3, 60)} {prose(6, 10)}."]
    got = {r.doc_id: r.text for r in paragraphs.deduplicate(docs_of(spark, texts), report=True).collect()}
    assert got[1].strip() == own and got[3] == f"{prose(5, 30)} {prose(6, 10)}."


def test_words_and_anchors_of_odd_white_space():
    hasher = paragraphs.Hasher()
    for gap in (" ", "  ", "\n", "\t \x1c", " é "):
        text = gap + gap.join(prose(3, 80).split()) + gap
        chunk = paragraphs.Chunk(["", text, "", "É" + text.upper(), ""], hasher)
        words, begin, end = paragraphs.chunk_words(chunk, 1, text)
        assert words == text.lower().split() and [text[a:b] for a, b in zip(begin, end)] == text.split()
        owner, a, b, one = chunk.anchors()
        assert len(a) and all(len(text[x:y].split()) == 24 for o, x, y in zip(owner, a, b) if o == 1)
        assert set(one[owner == 1]) & set(one[owner == 3])


@pytest.mark.parametrize("n", [50, 51, 80])
def test_passages_of_any_words_have_a_common_anchor(n):
    hasher = paragraphs.Hasher()
    for seed in range(300):
        passage = prose(seed, n) if seed % 3 else " ".join(["tie"] * n)
        texts = [f"{prose(1000 + seed, 40)} {passage} {prose(2000 + seed, 40)}", f"{prose(3000 + seed, 31)} Xy {passage} Yx {prose(4000 + seed, 33)}"]
        owner, a, b, one = paragraphs.Chunk(texts, hasher).anchors()
        inside = [{h for o, x, y, h in zip(owner, a, b, one) if o == k and texts[k].index(passage) <= x and y <= texts[k].index(passage) + len(passage)} for k in (0, 1)]
        assert inside[0] & inside[1]


def test_hashes_of_very_long_words_and_texts(monkeypatch):
    texts = ["x" * 5000 + " " + prose(1, 300), prose(2, 2000), "", prose(1, 300) + " " + "y" * 3000]
    whole = paragraphs.Chunk(texts, paragraphs.Hasher()).hashes
    monkeypatch.setattr(paragraphs, "SLICE", 100)
    assert (paragraphs.Chunk(texts, paragraphs.Hasher()).hashes == whole).all()
    seen = dict(zip(" ".join(texts).split(), whole))
    assert len(set(seen.values())) == len(seen)


def test_passages_against_brute_force(spark, documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    got = {r.doc_id: r for r in paragraphs.deduplicate(documents, report=True).collect()}

    def shingles(line):
        w = line.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    lines = [(i, k, s) for i, t in sorted(rows.items()) for k, x in enumerate(t.split("\n")) if len(x.split()) >= 24 and (s := shingles(x))]
    parent = {(i, k): (i, k) for i, k, _ in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, k, s) in enumerate(lines):
        for j, m, z in lines[:n]:
            if min(len(s), len(z)) >= 0.8 * max(len(s), len(z)) and len(s & z) >= 0.8 * len(s | z):
                x, y = root((i, k)), root((j, m))
                parent[max(x, y)] = min(x, y)
    near = {(i, k): root((i, k))[0] for i, k, _ in lines}
    words, runs, homes = {}, {}, {}
    for i, t in sorted(rows.items()):
        w = words[i] = t.lower().split()
        for n in (24, 50):
            for k in range(len(w) - n + 1):
                homes.setdefault((n, tuple(w[k : k + n])), i)
    for i, t in rows.items():
        cuts = [tuple(map(int, x.split(":"))) for x in got[i].removed.split(",") if x]
        gone, at = set(), 0
        for m in re.finditer(r"\S+", t):
            if any(a <= m.start() and m.end() <= b for a, b in cuts):
                gone.add(at)
            at += 1
        must, may, at = set(), set(), 0
        for k, x in enumerate(t.split("\n")):
            n = len(x.split())
            if near.get((i, k), i) < i:
                must |= set(range(at, at + n))
            at += n
        may |= must
        for k in range(len(words[i]) - 23):
            if homes[24, tuple(words[i][k : k + 24])] < i:
                may |= set(range(k, k + 24))
            if k < len(words[i]) - 49 and homes[50, tuple(words[i][k : k + 50])] < i and homes[50, tuple(words[i][k : k + 50])] == homes[24, tuple(words[i][k : k + 24])]:
                runs.setdefault(i, set()).update(range(k, k + 50))
        assert must <= gone <= may, i
        assert len(runs.get(i, set()) - gone) <= 0.02 * len(words[i]), i


def test_passages_in_mid_sentence_go_whole(spark):
    passages = [prose(i, 51) for i in range(40)]
    texts = [f"{prose(100 + i, 30)} {p} {prose(200 + i, 30)}" for i, p in enumerate(passages)] + [f"{prose(300 + i, 33)} {p} {prose(400 + i, 29)}" for i, p in enumerate(passages)]
    got = {r.doc_id: r for r in paragraphs.deduplicate(docs_of(spark, texts), report=True).collect()}
    for i, p in enumerate(passages):
        a = texts[40 + i].index(p)
        assert got[i].n_removed == 0
        assert any(x <= a and a + len(p) <= y for x, y in (map(int, s.split(":")) for s in got[40 + i].removed.split(",") if s))


# -- 10 ------------------------------------------------------------------------


def test_bpe_like_the_library():
    own, lib = bpe.Bpe(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    r = random.Random(1)
    texts = [t or "" for t in ODD] + ["a" * 5000, "=-" * 3000, "it's we'll I'D", "½²Ⅷ x²", " \t a\n\n b ", "a\x1cb \x1c c\x85d"]
    texts += ["".join(r.choice(" \n\tabcé's1²,.!#日 \x1c\x85​😀́") for _ in range(r.randint(0, 40))) for _ in range(1500)]
    ids, bounds = own.encode_batch(texts)
    for i, e in enumerate(lib.encode_batch(texts, add_special_tokens=False)):
        mine = ids[bounds[i] : bounds[i + 1]]
        assert mine.tolist() == e.ids and own.decode(mine) == lib.decode(e.ids, skip_special_tokens=False)


def test_merges_do_not_depend_on_the_buckets(monkeypatch):
    own = bpe.Bpe(VOCABULARY)
    words = [w for i in range(40) for w in prose(i, 20).split()] + ["aaaa", "aaaaa", prose(3, 900).replace(" ", ""), "", "=" * 3000]
    raw = [w.encode() for w in words]
    symbols, ends = own.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)], np.cumsum([len(x) for x in raw])
    a = own.merge(symbols, ends)
    for n in (1, 1000, 10**6):
        monkeypatch.setattr(bpe, "BUCKETS", n)
        b = own.merge(symbols, ends)
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()
    assert a[1][-2] == 0


def test_bpe_of_a_very_long_word():
    own, lib = bpe.Bpe(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    r = random.Random(4)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    assert own.encode_batch([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


def test_bpe_query_digests(spark):
    lib = Tokenizer.from_file(VOCABULARY)
    got = {r.doc_id: r for r in bpe.encode_decode(docs_of(spark, ODD), VOCABULARY).collect()}
    for i, t in enumerate(ODD):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


# -- queries -------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLES[name])
    assert [c[0] for c in want.description] == df.columns
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want.fetchall()))


def test_queries_cover_their_tables(spark):
    counts = {t: common.table(spark, SMALL, t).count() for t in ("documents", "pages")}
    for name, t in (("op4_weak_supervision_pii", "documents"), ("op8_iso_media", "documents"), ("op10_pair_index_bpe", "documents"), ("op5_warc_revisits", "pages")):
        assert queries.QUERIES[name](spark, SMALL).count() == counts[t]
