"""Registered queries of the text operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from .chat import conversation_nodes, digests, format_trees
from .common import read_table, written
from .decontaminate import leaks
from .factor_machine import classify
from .langid import identify
from .license_scan import license_scan
from .license_scan import oracle_sql as license_sql
from .line_crf import quality
from .mixing import mix
from .prefix_trie import numbered_turns, rebuilt, trie
from .prefix_trie import oracle_sql as trie_sql
from .resample import oracle_sql as resample_sql
from .resample import resample
from .simhash import simhash_groups
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .wrappers import extract


def op1_quality_rules(spark, sf_dir):
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("content")


def op2_license_scan(spark, sf_dir):
    return license_scan(read_table(spark, sf_dir, "documents")).drop("places")


def op3_language_id(spark, sf_dir):
    return identify(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark, sf_dir):
    return substring_dedup(read_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark, sf_dir):
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("_row")


def op6_simhash_near_dedup(spark, sf_dir):
    return simhash_groups(read_table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark, sf_dir):
    return extract(read_table(spark, sf_dir, "pages"))


def op9_chat_formatting(spark, sf_dir):
    told = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return digests(format_trees(conversation_nodes(told.unionByName(planted))))


def op10_source_mixing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return mix(docs).select("doc_id", "source", "lang", "mix_topic", "mix_words", "mix_weight", "mix_expected", "mix_copies")


def op11_quality_classifier(spark, sf_dir):
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark, sf_dir):
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_prefix_trie(spark, sf_dir):
    return trie(rebuilt(written(numbered_turns(read_table(spark, sf_dir, "conversations")))))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_license_scan, op3_language_id, op4_substring_dedup, op5_benchmark_decontamination,
                                  op6_simhash_near_dedup, op7_suffix_array_dedup,
                                  op8_html_extraction, op9_chat_formatting, op10_source_mixing,
                                  op11_quality_classifier, op12_importance_resampling, op13_prefix_trie)}

_ESCAPED = r"replace(replace(replace(replace({}, '\', '\0'), '[', '\1'), '<', '\2'), '>', '\3')"

ORACLE: dict[str, str] = {
    "op2_license_scan": license_sql(),
    "op12_importance_resampling": resample_sql(),
    "op13_prefix_trie": trie_sql(),
    "op9_chat_formatting": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sums AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(length({_ESCAPED.format("text")}) + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 11
                       ELSE 11 + length({_ESCAPED.format("role")}) END) AS formatted_chars
            FROM rows GROUP BY conv_id)
        SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(told) AS turns_sha256,
               CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
               CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM sums""",
}
