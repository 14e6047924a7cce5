"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernstone.llm import chat, exact, html, packing, pieces, quality, rules, shards, simhash, suffix
from quernstone.llm.common import scratch
from quernstone.llm.tokens import tokenizer_path
from quernstone.session import load


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "conversations")
    fixed = "</s>[INST] ok [/INST]"
    probe = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{fixed}' AS text UNION ALL SELECT -7L, 1L, 'assistant', '{fixed}'")
    rows = table.selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text").unionByName(probe)
    return chat.conversation_digests(chat.format_conversations(rows))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(load(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, with_text=False)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(load(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digests(load(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(load(spark, sf_dir, "documents"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "shards")
    manifest = shards.write_shards(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), folder)
    return shards.shard_contents(manifest, folder)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_verdicts(load(spark, sf_dir, "documents"))


ALL = (
    op1_chat_format,
    op2_quality_classifier,
    op3_exact_dedup,
    op4_suffix_dedup,
    op5_html_extraction,
    op6_best_fit_packing,
    op7_sentencepiece,
    op8_simhash,
    op9_token_shards,
    op10_quality_rules,
)
QUERIES = {f.__name__: f for f in ALL}

_ESCAPED = r"""len(regexp_extract_all({}, '[<\[]\\*(\|turn\|>|\|says\|>|\|end\|>|/?s>|/?INST\])'))"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(length('<|turn|><|says|><|end|>') + length(role) + length(text) + {_ESCAPED.format("role")} + {_ESCAPED.format("text")})::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id
    """,
    "op3_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM documents),
        g AS (SELECT s, max(doc_id) AS keep_id, count(*) AS group_size, sha256(s) AS text_sha256 FROM t GROUP BY s)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, g.text_sha256 FROM t JOIN g USING (s)
    """,
}
