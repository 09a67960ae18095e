"""Registered queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

from ledgerlake.llm import (
    archive,
    exact,
    html,
    language,
    middle,
    minhash,
    mixing,
    negatives,
    packing,
    pii,
    quality,
    secrets,
    spots,
)
from ledgerlake.llm.common import table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.fingerprints(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), words=4, percent=80)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_report(table(spark, sf_dir, "documents"))


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.with_digests(middle.transformed(table(spark, sf_dir, "documents")))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), repeats=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language,
        op2_spotsigs,
        op3_packing,
        op4_quality,
        op5_warc,
        op6_exact,
        op7_html,
        op8_minhash,
        op9_mixing,
        op10_secrets,
        op11_pii,
        op12_middle,
        op13_negatives,
    )
}

ORACLES = {
    "op5_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_page FROM p
        )
        SELECT page_id, octet_length(payload) AS payload_bytes, payload_digest,
               CASE WHEN octet_length(payload) >= 100 AND page_id <> first_page
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN octet_length(payload) >= 100 AND page_id <> first_page
                    THEN first_page END AS refers_to
        FROM f
    """,
    "op6_exact": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text FROM documents
        ), g AS (
            SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
                   count(*) OVER (PARTITION BY text) AS group_size,
                   sha256(text) AS text_sha256
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
    "op9_mixing": mixing.oracle(),
    "op12_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                   sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS name
            FROM documents
        ), h AS (
            SELECT *, len(units) AS n,
                   cast('0x' || name[1:8] AS bigint) % (len(units) + 1) AS one,
                   cast('0x' || name[9:16] AS bigint) % (len(units) + 1) AS two,
                   cast('0x' || name[17:24] AS bigint) % 100 AS plain,
                   cast('0x' || name[25:32] AS bigint) % 100 AS turned
            FROM d
        ), p AS (
            SELECT *,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR plain >= 90 THEN 'plain'
                        WHEN turned < 20 THEN 'spm' ELSE 'psm' END AS form,
                   coalesce(array_to_string(units[1:least(one, two)], ''), '') AS prefix,
                   coalesce(array_to_string(units[least(one, two) + 1:greatest(one, two)], ''), '')
                       AS middle,
                   coalesce(array_to_string(units[greatest(one, two) + 1:], ''), '') AS suffix
            FROM h
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
                   AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p
    """,
    "op13_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * cast(x AS double))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), a AS (
            SELECT vec_id AS anchor_id, label, v FROM v WHERE vec_id % 100 = 0
        ), s AS (
            SELECT a.anchor_id, v.vec_id, a.label = v.label AS same,
                   cast(list_dot_product(a.v, v.v) AS bigint) AS score
            FROM a JOIN v ON a.anchor_id <> v.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id,
               score AS negative_score,
               cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                                       ORDER BY score DESC, vec_id) AS integer) AS rank
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
             AND 100 * score BETWEEN 80 * positive_score AND 100 * positive_score
        QUALIFY rank <= 5
    """,
}
