"""The queries op1 to op10 over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import balltree, bpe, html, jaccard, media, packing, paragraphs, pii, quality, warc
from spindrift.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op3_bayes_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op4_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicate(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_tree_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, capacity=1024, end_id=2)


def op7_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_iso_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_texts(table(spark, sf_dir, "documents"))


def op9_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.deduplicate(table(spark, sf_dir, "documents"), report=True)


def op10_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_bradley_terry, op2_host_paths, op3_bayes_minhash_join, op4_weak_supervision_pii, op5_warc_revisits, op6_tree_packing, op7_ball_tree_top_k, op8_iso_media, op9_paragraph_minhash, op10_pair_index_bpe)}
#: The bits of a SHA-1, five at a time, as letters of base32.
BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(5), lambda j: ((strpos('0123456789abcdef', substr(h, 1 + (5 * i + j) // 4, 1)) - 1)
    >> (3 - (5 * i + j) % 4)) % 2 * (16 >> j)))::INT, 1)), '')"""

ORACLES: dict[str, str] = {
    "op3_bayes_minhash_join": r"""WITH RECURSIVE w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS ws FROM documents),
    k AS MATERIALIZED (SELECT ws, min(doc_id) AS c, count(*) AS copies FROM w WHERE len(ws) > 0 GROUP BY ws),
    g AS (SELECT DISTINCT c, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM k),
    h AS MATERIALIZED (SELECT c, s FROM g), n AS MATERIALIZED (SELECT c, count(*) AS n FROM h GROUP BY c),
    l AS MATERIALIZED (SELECT p.a, p.b FROM (SELECT x.c AS a, y.c AS b, count(*) AS both FROM h x JOIN h y ON x.s = y.s AND x.c <> y.c GROUP BY x.c, y.c) p JOIN n na ON na.c = p.a JOIN n nb ON nb.c = p.b WHERE p.both >= 0.8 * (na.n + nb.n - p.both) - 1e-9),
    m(c, root) USING KEY (c) AS (SELECT c, c FROM k UNION SELECT l.b, min(m.root) FROM m JOIN l ON l.a = m.c JOIN recurring.m y ON y.c = l.b WHERE m.root < y.root GROUP BY l.b),
    e AS (SELECT k.c, sum(z.copies) AS n FROM k JOIN l ON l.a = k.c JOIN k z ON z.c = l.b GROUP BY k.c)
    SELECT w.doc_id, CASE WHEN k.c IS NULL THEN w.doc_id ELSE m.root END AS class_id, CAST(CASE WHEN k.c IS NULL THEN 0 ELSE k.copies - 1 + coalesce(e.n, 0) END AS BIGINT) AS n_links
    FROM w LEFT JOIN k ON k.ws = w.ws LEFT JOIN m ON m.c = k.c LEFT JOIN e ON e.c = k.c""",
    "op5_warc_revisits": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
    SELECT page_id, payload_bytes, {BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to FROM f""",
    "op7_ball_tree_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
    r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
