"""The stages of the corpus pipeline on the smallest tables."""

import random
import re

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, seen[-1], SMALL).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
        assert k == len(pipeline.STAGES) - 1 or seen[-1].columns == columns, name
    n = [x.count() for x in seen[:5]]
    assert n[0] > n[1] >= n[2] == n[3] == n[4] > 0
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in seen[1].select("doc_id").collect()}
    assert all(i in kept for i, q in labels.items() if q == 1)
    texts = [r.text for r in seen[4].collect()]
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) for t in texts)
    assert {r.doc_id for r in seen[5].select("doc_id").distinct().collect()} == {r.doc_id for r in seen[4].collect()}


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _quality string, _doc string, _spans string, key string, label string, start string, spans string"
WORDS = "the of and a to in is was that it he for on are with as his they at be this from or had by not but some what there we can out other were all your when up use word how said each she which do their time if will way about many then them would write like so these her long make thing see him two has look more day could go come did my sound no most number who over know water than call first people may down side been now find".split()


def prose(seed, n):
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(["", "", "ing", "ed", "s"]) for _ in range(n)]
    return " ".join(w.capitalize() + ("." if i % 11 == 10 else "") if i % 11 == 0 else w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))


def test_odd_documents_in_every_stage(spark):
    """Nulls, empty and very long texts, copies, equal rows, clashing names and an empty table, stage by stage."""
    passage = prose(7, 60)
    texts = {0: None, 1: "", 2: prose(1, 20_000), 3: prose(2, 90), 4: prose(2, 90), 5: f"{prose(3, 40)} {passage} {prose(4, 40)}", 6: f"{prose(5, 50)} {passage} {prose(6, 50)}", 7: f"{prose(8, 60)} write to ann.b@mail.example.com now"}
    rows = [(i, t, "en", "s", None if t is None else len(t), *["mine"] * 7) for i, t in [*texts.items(), (7, texts[7]), (None, texts[3])]]
    docs = spark.createDataFrame(rows, COLUMNS)
    for k, (name, stage) in enumerate(pipeline.STAGES):
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
        done = stage(spark, docs, SMALL)
        if k == len(pipeline.STAGES) - 1:
            assert {r.doc_id for r in done.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
            break
        assert done.columns == docs.columns and done.dtypes == docs.dtypes, name
        got = done.collect()
        assert all(r._quality == r._doc == r._spans == r.key == "mine" for r in got), name
        if k == 0:  # labels of the small table belong to other texts, so what is kept is the classifier's choice
            assert len(got) <= len(rows)
            continue
        by = {r.doc_id: r for r in got}
        if k == 1:
            assert sorted(str(r.doc_id) for r in got) == sorted(["0", "1", "2", "3", "5", "6", "7", "None"])
        if k == 2:
            assert by[5].text == texts[5] and by[6].text == f"{prose(5, 50)} {prose(6, 50)}" and by[6].n_chars == len(by[6].text) and by[2].text == texts[2] and by[0].text is None
        if k == 3:
            assert "[EMAIL]" in by[7].text and "@" not in by[7].text and by[0].text is None and by[1].text == ""
        docs = spark.createDataFrame(got, docs.schema)


def test_stages_keep_the_results_of_their_operators(spark):
    """Near copies and passages that the first stages leave, against brute force over what they were given."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {i: shingles(t) for i, t in sorted(rows.items())}
    first = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if j >= i:
                break
            if a and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((first[i], first[j]))
                first = {k: x if v == y else v for k, v in first.items()}
    kept = pipeline.ngram_jaccard_join(spark, docs, SMALL)
    assert {r.doc_id for r in kept.collect()} == {i for i, x in first.items() if i == x}
