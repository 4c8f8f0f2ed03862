"""The thin queries of this subpackage's operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuesheet.scratch import spread

from . import bpe, conversations, exact_dedup, html_extract, langid, line_dedup, merkle, mixing, negatives, packing, secrets, simhash, token_counts
from .common import prepare


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir), keep="largest", runs=exact_dedup.RUNS)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_common_lines(_documents(spark, sf_dir), min_docs=10, least=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_extract.extract(spread(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edited(_documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return langid.identify(docs, langid.fit(docs))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir), weights=(1, 2, 3), most=3)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    damaged = conversations.damage(spread(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return conversations.repair(damaged, F.col("present"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_merkle_fingerprints": op5_merkle_fingerprints,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_secret_scans": op9_secret_scans,
    "op10_language_id": op10_language_id,
    "op11_mixing": op11_mixing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS own FROM documents),
        lines AS (SELECT r, unnest(own) AS line, unnest(range(len(own))) AS i FROM docs),
        keyed AS (SELECT r, i, line, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
        common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
        kept AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM keyed ANTI JOIN common USING (key) GROUP BY r)
        SELECT doc_id, len(own)::BIGINT AS n_lines, len(own)::BIGINT - coalesce(n, 0) AS n_dropped, sha256(coalesce(body, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (r)
    """,
    "op4_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY body ORDER BY doc_id DESC) = 1 AS kept, sha256(body) AS text_sha256
        FROM (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS body FROM documents)
        WINDOW w AS (PARTITION BY body)
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        s AS (
            SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id AS id, a.label = b.label AS alike, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0
        ),
        p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST, r) <= 5)
        SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.id NULLS LAST, n.r)::INTEGER AS rank
        FROM p JOIN s n ON p.anchor = n.anchor AND NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3
    """,
}
