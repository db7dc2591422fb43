"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import (alignment, exact_dedup, hard_negatives, html_text, license_scan, minhash, mixing, ngram_join, packing, pii, quality,
                          toxicity, warc)
from playlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.refine(table(spark, sf_dir, "documents"), hash_all=True)
    return found.withColumnRenamed("full_hash", "text_sha256")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


def minhash_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of every hundredth document among all, by bands and exact Jaccard."""
    docs = table(spark, sf_dir, "documents")
    return minhash.search(docs, docs.filter("doc_id % 100 = 0"))[1]


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality, op2_html_text, op3_mixing, op4_warc, op5_toxicity, op6_packing,
    op7_ngram_join, op8_exact_dedup, op9_pii, op10_minhash, op11_alignment,
    op12_license_scan, op13_hard_negatives, minhash_search)}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha1(coalesce(html, '')) AS payload_digest FROM pages),
             f AS (SELECT payload_digest, max(page_id) AS first_id FROM p
                   WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 1000""",
    "op7_ngram_join": r"""
        WITH RECURSIVE
        w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
              FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i
                    FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
              FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * c >= 90 * (x.n + y.n - c)),
        r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
               least(d.doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = d.doc_id), d.doc_id))
                   AS component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')
                   AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM n WINDOW same AS (PARTITION BY body)""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
                          CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
                   FROM v a JOIN v r ON a.vec_id % 50 = 0),
             p AS (SELECT anchor_id, id AS positive_id, score AS positive_score,
                          row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id)
                              AS positive_rank
                   FROM s WHERE same AND id <> anchor_id),
             n AS (SELECT anchor_id, positive_id, CAST(positive_rank AS INTEGER) AS positive_rank,
                          CAST(row_number() OVER (PARTITION BY anchor_id, positive_rank
                                                  ORDER BY score DESC, id) AS INTEGER) AS rank,
                          id AS negative_id, positive_score, score AS negative_score
                   FROM p JOIN s USING (anchor_id)
                   WHERE positive_rank <= 5 AND NOT same
                     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
        SELECT * FROM n WHERE rank <= 3""",
}
