"""Hostile and odd inputs of the corpus operators, their work in proportion to the input, and workers without the package."""

import os
import random
import struct
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrift.llm import balltree, bpe, common, html, jaccard, media, packing, paragraphs, pii, quality, queries

REPO = Path(__file__).resolve().parent.parent.parent
SMALL = "/root/testdata/sf0.001"
#: docs whose other columns have the names that operators use inside.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, _doc string, _spans string, _quality string, key string, item string, label string, start string, spans string, hash string, _alone string, _gone string, score string"


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(words))


TEXTS = [None, "", " \n ", "one", prose(1, 30_000), prose(2, 200), prose(2, 200), "x" * 300_000, f"{prose(3, 40)}\n{prose(4, 60)}", f"{prose(5, 30)}\n{prose(4, 60)}"]


def clashing(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *["mine"] * 12) for i, t in zip(ids, texts)], CLASHING)


# -- all -----------------------------------------------------------------------


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Every query and stage in a driver that starts elsewhere, so that workers cannot import the package."""
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {("file://" + str(tmp_path / "shared"))!r}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from pyspark.sql import functions as F
found = spark.range(1).select(F.udf(lambda i: __import__("importlib").util.find_spec("spindrift") is None, "boolean")("id")).first()[0]
assert found, "workers see the package, so this test tests nothing"
import __spark_entry__ as e
for name, q in e.queries().items():
    if name.startswith("op") or name == "pipeline":
        q(spark, {SMALL!r}).write.format("noop").mode("overwrite").save()
        print("done", name)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert ran.stdout.count("done") == 11


def test_empty_tables_and_clashing_names(spark):
    docs = clashing(spark, TEXTS)
    none = docs.limit(0)
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    n = len(TEXTS)
    for run in (lambda d: quality.classify(d, labels), jaccard.similarity_classes, pii.find, paragraphs.deduplicate, lambda d: paragraphs.deduplicate(d, report=True), lambda d: bpe.encode_decode(d, queries.VOCABULARY), media.store_texts, pii.redact):
        assert run(docs).count() == n and run(none).count() == 0
    assert {r.doc_id for r in packing.pack(docs, queries.VOCABULARY).collect()} == set(range(n)) and packing.pack(none, queries.VOCABULARY).count() == 0
    kept = jaccard.first_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(n)) - {6}
    clean = {r.doc_id: r for r in paragraphs.deduplicate(docs).collect()}
    assert all(clean[i]._doc == clean[i]._spans == clean[i].hash == "mine" for i in range(n))
    assert clean[6].text == "" and clean[9].text == prose(5, 30) + "\n" and clean[4].text == TEXTS[4] and clean[0].text is None


# -- 1 -------------------------------------------------------------------------


def test_weights_and_threshold_against_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 5))
    good = x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=120) > 0.3
    monkeypatch.setattr(quality, "PAIRS", 3000)
    model = quality.fit(x, good, 0.5)
    z = np.clip((x - model["centre"]) / model["scale"], -8, 8)
    draw = np.random.default_rng(7)
    d = z[draw.choice(np.flatnonzero(good), 3000)] - z[draw.choice(np.flatnonzero(~good), 3000)]

    def loss(w):
        return sum(np.log1p(np.exp(-float(v @ w))) for v in d) / len(d) + quality.RIDGE / 2 * float(w @ w)

    best = loss(model["weights"])
    for _ in range(60):
        assert loss(model["weights"] + rng.normal(size=5) * rng.choice([1e-3, 1e-2, 0.3])) > best
    u = z @ model["weights"]

    def balanced(t):
        return ((u > t) & good).sum() / good.sum() + ((u <= t) & ~good).sum() / (~good).sum()

    tries = np.sort(u)
    assert balanced(model["threshold"]) >= max(balanced((a + b) / 2) for a, b in zip(tries, tries[1:])) - 1e-9


# -- 2 -------------------------------------------------------------------------


def extracted(body):
    return html.extract(f"<html><body>{body}</body></html>", None)


ARTICLE = "<h1>Head</h1><p>" + prose(1, 60) + "</p><p>" + prose(2, 60) + "</p>"
WANT = f"Head\n{prose(1, 60)}\n{prose(2, 60)}"


@pytest.mark.parametrize("theme", ["content with-sidebar", "post related-posts-enabled", "search-results-paragraph", "share-price", "single has-comments no-header", "entry comments-enabled", "post-content", "sidebar"])
@pytest.mark.parametrize("noise", ["cookie-notice", "sidebar-left", "ad-slot", "related-posts", "post-comments", "site-footer", "advert", "share-buttons"])
def test_theme_classes(theme, noise):
    page = f'<div class="{theme}">{ARTICLE}</div><div class="{noise}"><p>{prose(9, 25)}</p></div>'
    assert extracted(page) == WANT


def test_longer_comments_are_no_article():
    assert extracted(f'<div class=post>{ARTICLE}</div><section id=comments><h1>Readers</h1><p>{prose(9, 900)}</p></section>') == WANT


def test_inline_noise_is_nested():
    assert extracted(f'<div><p>{prose(1, 30)} a <span class="ad">BUY <span>now</span> CHEAP</span> b</p></div>') == f"{prose(1, 30)} a b"
    assert extracted(f'<div><p>{prose(1, 30)} <span class="ad">never shut</p><p>{prose(2, 30)}</p></div>') == f"{prose(1, 30)}\n{prose(2, 30)}"


def test_several_articles_stay():
    assert extracted(f"<div><article class=a><p>{prose(1, 40)}</p></article><article class=b><p>{prose(2, 30)}</p></article></div>") == f"{prose(1, 40)}\n{prose(2, 30)}"


def test_quoted_ends_of_tags():
    assert extracted(f"<p title='a > b' data-x=\"<p>\">{prose(1, 30)}</p><p title=\"open>{prose(2, 30)}</p>") == f"{prose(1, 30)}\n{prose(2, 30)}"


@pytest.mark.parametrize("part", ["<div ", '<span class="ad">x', '<a "> "', "<form>", "<ul><li>", "<!--", "<script>", "</p>", "<a '", "<", "<p>x</p>", "<div class=a><p>text of a part</p></div>", "<table><tr><td>x"])
def test_work_follows_the_length_of_a_page(part):
    took = []
    for size in (150_000, 600_000):
        page = part * (size // len(part))
        began = time.process_time()
        html.extract(page, "html>body>div")
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0] + 0.5


# -- 3 -------------------------------------------------------------------------


def test_groups_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", 4)
    monkeypatch.setattr(jaccard, "BUCKET_BLOCK", 3)
    base = prose(1, 80).split()
    texts = [" ".join([*base[: 2 * i], f"w{i}", *base[2 * i + 1 :]]) for i in range(14)] + [prose(50 + i, 50) for i in range(6)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    links = [[j for j in range(len(texts)) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(texts))]
    got = {r.doc_id: r for r in jaccard.similarity_classes(clashing(spark, texts)).collect()}
    assert [got[i].n_links for i in range(len(texts))] == [len(x) for x in links]
    assert all(got[i].class_id == (0 if i < 14 else i) for i in range(len(texts)))


# -- 4 -------------------------------------------------------------------------


def test_spans_of_a_very_long_text():
    text = " ".join(f"(212) 555-{i % 10000:04d} and mail{i}@example.com, password = abc{i}def9" for i in range(20_000))
    began = time.process_time()
    base = pii.base_spans(text)
    found = pii.wider_spans(text, base)
    assert time.process_time() - began < 20
    assert len(base) == 20_000 and len(found) == 40_000
    every = sorted((a, b) for _, a, b in base + found)
    assert all(x[1] <= y[0] for x, y in zip(every, every[1:]))


# -- 6 -------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_receivers_suffice(seed):
    """As many bins as if all bins climbed the tree."""

    def packed(level, receivers, capacity=100):
        """level: bins of each node."""
        done = 0
        while True:
            nodes = []
            for own in level:
                fills = [sum(own[i] for i in b) for b in packing.best_fit(own, capacity)]
                up = [fills[i] for i in packing.climbing(fills, capacity)] if receivers else fills
                done += len(fills) - len(up)
                nodes.append(up)
            if len(nodes) == 1:
                return done + len(nodes[0])
            level = [sum(nodes[i : i + packing.FAN], []) for i in range(0, len(nodes), packing.FAN)]

    r = random.Random(seed)
    sizes = [[r.randint(1, [100, 60, 40, 12][seed % 4]) for _ in range(r.randint(0, 80))] for _ in range(150)]
    assert packed([list(x) for x in sizes], True) == packed([list(x) for x in sizes], False)


# -- 7 -------------------------------------------------------------------------


def test_vectors_of_odd_kinds(spark):
    schema = "vec_id long, embedding array<float>, score string, rank string"
    rows = [(0, [1.0, 2.0], "a", "b"), (20, [1.0, 2.0], "a", "b"), (3, [1.0, 2.0], "a", "b"), (4, None, "a", "b"), (5, [float("nan"), 1.0], "a", "b"), (6, [None, 1.0], "a", "b"), (None, [9.0, 9.0], "a", "b"), (7, [float("inf"), 1.0], "a", "b"), (8, [1.0], "a", "b"), (40, [], "a", "b"), (3, [1.0, 2.0], "a", "b")]
    vectors = spark.createDataFrame(rows, schema)
    got = [tuple(r) for r in balltree.top_k(vectors, F.col("vec_id") % 20 == 0, 3).orderBy("query_id", "rank").collect()]
    score = 64 * 64 + 128 * 128
    assert got == [(0, 1, 3, score), (0, 2, 3, score), (0, 3, 20, score), (20, 1, 0, score), (20, 2, 3, score), (20, 3, 3, score)]
    assert balltree.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_many_shards_and_hot_vectors(spark, monkeypatch):
    """Clustered vectors, a third of them equal, in many leaves and parts; blocks drop the leaves that cannot answer."""
    for name, n in (("SHARD_ROWS", 64), ("BLOCK_ROWS", 8), ("BLOCKS_A_COPY", 2), ("LEAF_ROWS", 16)):
        monkeypatch.setattr(balltree, name, n)
    r = np.random.default_rng(8)
    centres = r.normal(size=(12, 5)) * 6
    x = np.concatenate([centres[np.arange(1000) % 12] + r.normal(size=(1000, 5)) * 0.2, np.tile([1.0, 2.0, 3.0, 4.0, 5.0], (500, 1))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    e = np.floor(64 * x.astype(np.float64)).astype(np.int64)
    got = {}
    for row in balltree.top_k(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(row.query_id, {})[row["rank"]] = (row.score, row.vec_id)
    for q in range(0, 1500, 20):
        s = e @ e[q]
        want = sorted(((int(v), i) for i, v in enumerate(s) if i != q), key=lambda t: (-t[0], t[1]))[:20]
        assert [got[q][k] for k in range(1, 21)] == want


# -- 8 -------------------------------------------------------------------------


def test_hostile_containers(spark):
    deep = b""
    for _ in range(3000):
        deep = struct.pack(">I4s", len(deep) + 8, b"moov") + deep
    good = media.write_container(media.padded(b"y" * 300))
    at = good.index(b"stsz") + 4
    huge = good[: at + 4] + struct.pack(">II", 64, 0xFFFFFFFF) + good[at + 12 :]
    at = good.index(b"stsc") + 4
    chunks = good[: at + 12] + struct.pack(">I", 0xFFFFFFF0) + good[at + 16 :]
    at = good.index(b"stss") + 4
    keys = good[: at + 8] + struct.pack(">I", 0) + good[at + 12 :]
    rows = [(i, x) for i, x in enumerate([deep, huge, chunks, keys, good])]
    got = {r.id: r for r in media.media_features(spark.createDataFrame(rows, "id int, content binary"), "content", "id").collect()}
    assert [got[i].codec for i in range(5)] == [None, None, None, None, "raw "]


def test_features_of_stored_texts_are_those_of_a_media_column(spark):
    texts = ["", "a" * 5000, prose(1, 3000)]
    stored = {r.doc_id: r for r in media.store_texts(clashing(spark, texts)).collect()}
    column = spark.createDataFrame([(i, media.write_container(media.padded(t.encode()))) for i, t in enumerate(texts)], "doc_id long, content binary")
    got = {r.doc_id: r for r in media.media_features(column, "content", "doc_id").collect()}
    for i in range(len(texts)):
        assert got[i].keyframes == stored[i].keyframes and got[i].duration == stored[i].duration and got[i].codec.strip() == stored[i].codec


# -- shared --------------------------------------------------------------------


def test_bitmaps_follow_the_number_of_values(spark):
    few, many = (common.bitmap(spark.range(n).select((F.col("id") * 977).alias("x"))) for n in (10, 300_000))
    assert len(few) < len(many) and common.in_bitmap(many, np.arange(300_000) * 977).all()
    assert common.in_bitmap(many, np.arange(300_000) * 977 + 1).mean() < 0.2


def test_free_names():
    assert common.free_name("_a", ["b"]) == "_a" and common.free_name("_a", ["_A"], ["__a"]) == "___a"
