"""Each operator of this subpackage over its whole table, as a registered query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontaminate, hard_negatives, merkle, jaccard_join, licenses, lm_scoring, packing, quality, rules, secrets, sharding, suffix_dedup
from .registry import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL"]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """File of a public tokenizer on this machine; workers have it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op2_sharding")
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.quality_scores(docs, labels)


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents"))


@query("op6_secret_scans")
def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


@query("op7_packing")
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


@query("op9_license_scans")
def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


@query("op8_benchmark_decontamination")
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.find_passages(docs, benchmark)


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, folder, "documents"))


@query("op10_suffix_array_dedup")
def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


# Conversation -7 tests the template's escaping: its texts hold the template's own strings.
PLANTED_CHAT = "\\### Assistant: </turn> ok"

CHAT_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c
)
SELECT
    conv_id,
    CAST(count(*) AS BIGINT) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
        ORDER BY turn NULLS LAST, role, text), '')) AS loss_sha256,
    CAST(sum(
        6 + length(role) + length(regexp_replace(role, '[^\\#<:\n]', '', 'g'))
        + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))
        + 8
    ) AS BIGINT) AS formatted_chars
FROM t
GROUP BY conv_id
"""


@query("op11_chat_formatting", CHAT_SQL)
def op11_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(-7, 0, "user", PLANTED_CHAT), (-7, 1, "assistant", PLANTED_CHAT)],
        "conv_id long, turn long, role string, text string",
    )
    formatted = chat_format.format_conversations(turns.unionByName(planted), tokenizer_path("byte_bpe_50k.json"))
    return chat_format.read_back(formatted).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


NEGATIVES_SQL = """
WITH r AS (
    SELECT DISTINCT vec_id, CAST(label AS BIGINT) AS label, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM r
), s AS (
    SELECT a.vec_id AS anchor_id, a.label AS a_label, b.vec_id, b.label,
           coalesce(list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i])), 0) AS score
    FROM q a JOIN q b ON a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k
        FROM s WHERE label = a_label AND vec_id <> anchor_id
    ) WHERE k <= 5
), n AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.a_label
    WHERE 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id,
       CAST(positive_score AS BIGINT) AS positive_score, CAST(negative_score AS BIGINT) AS negative_score
FROM n WHERE rank <= 5
"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


@query("op13_merkle_manifest")
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    # Folding needs the tree's levels in order; DuckDB's SQL has no fold, so tests/llm compares a plain version.
    return merkle.manifest(table(spark, folder, "documents"))
