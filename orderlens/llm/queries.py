"""The operators of this package as queries, ``(spark, folder) -> DataFrame``, on whole
tables and with their production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import (
    conversations,
    decontaminate,
    divergence,
    embeddings,
    license_scan,
    packing,
    quality,
    secrets,
    token_counts,
    toxicity,
    url_filter,
    warc,
)
from orderlens.llm.common import table
from orderlens.llm.near_dup import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"), path_col="source")


def op2_minhash_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(spark, table(spark, folder, "documents"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_embedding_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = token_counts.typical_edits(table(spark, folder, "documents"))
    return token_counts.counts_through_edits(docs, "edits")


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.cut_into_pieces(table(spark, folder, "documents")))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, folder, "conversations")))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergences(table(spark, folder, "documents"))


# Rules on host and path, as the query's contract gives them.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(spark, table(spark, folder, "pages"), URL_RULES)


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_minhash_near_dup": op2_minhash_near_dup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_license_scan": op4_license_scan,
    "op5_warc": op5_warc,
    "op6_embedding_near_dup": op6_embedding_near_dup,
    "op7_token_counts": op7_token_counts,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_divergence": op12_source_divergence,
    "op13_url_filter": op13_url_filter,
}

STATEMENTS: dict[str, str] = {
    "op4_license_scan": license_scan.oracle(),
    "op11_conversation_repair": conversations.oracle(),
    "op12_source_divergence": divergence.oracle(),
    "op5_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first,
         payload_bytes >= 100 AS compared
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN compared AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN compared AND page_id <> first THEN first END AS refers_to
FROM f
""",
}
