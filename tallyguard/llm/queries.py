"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyguard.llm import (
    chat, collocations, grammar, language, merkle, minhash, mixing, neighbours, oracles, packing, quality, rules, secret_scan, suffixes,
)
from tallyguard.llm.tokens import default_path
from tallyguard.llm.work import read


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classified(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"), minhash.Shape(words=2))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(read(spark, folder, "documents"))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(read(spark, folder, "documents"), default_path())


def op5_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and hash by strings of 400 bytes; ``text`` is also without repeated passages of over 50 words, most of which are shorter."""
    return suffixes.repeated_bytes(read(spark, folder, "documents"), suffixes.Passage(size=400, anchor=48, words=51, least=250))


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with a reply, against itself with its last reply replaced."""
    turns = chat.turns_of(read(spark, folder, "conversations"))
    return chat.preference_rows(chat.stale_replies(turns))


def op7_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbours(read(spark, folder, "embeddings"), every=20)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op9_token_grammar(spark: SparkSession, folder: str) -> DataFrame:
    return grammar.decode(grammar.write_blocks(read(spark, folder, "documents"), default_path()))


def op10_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(read(spark, folder, "documents"))


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.checked_manifest(read(spark, folder, "documents"))


def op13_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(read(spark, folder, "documents"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_quality_classifier,
        op2_minhash_near_dedup,
        op3_language_id,
        op4_best_fit_packing,
        op5_suffix_array_dedup,
        op6_chat_formatting,
        op7_multi_index_hashing,
        op8_quality_rules,
        op9_token_grammar,
        op10_entropy_mixing,
        op11_phrase_collocations,
        op12_merkle_manifest,
        op13_secret_scan,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

# Spaces, words and turns as both engines see them; spans count characters.
_OP6 = """
WITH rows AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM rows),
replies AS (
  SELECT conv_id, max(i) AS last, arg_max(text, i) AS final, arg_min(text, i) AS stale
  FROM placed WHERE role = 'assistant' GROUP BY conv_id),
-- Only the last reply differs, so the turns before it are the common prefix.
sides AS (
  SELECT p.conv_id, p.i, r.last, p.role, p.text AS chosen,
         CASE WHEN p.i = r.last THEN CASE WHEN r.stale = r.final THEN '' ELSE r.stale END ELSE p.text END AS rejected,
         r.final = '' AND r.stale = r.final AS equal
  FROM placed p JOIN replies r USING (conv_id)),
sized AS (
  SELECT *, NOT equal AND i >= last AS after,
         coalesce(sum(length(role) + length(chosen) + 6) OVER w, 0) AS at_c,
         coalesce(sum(length(role) + length(rejected) + 6) OVER w, 0) AS at_r
  FROM sides
  WINDOW w AS (PARTITION BY conv_id, NOT equal AND i >= last ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id AS pair_id,
       CAST(count(*) FILTER (NOT after) AS INT) AS n_prompt,
       coalesce(string_agg('<|' || role || '|>' || chr(10) || chosen || chr(10), '' ORDER BY i) FILTER (NOT after), '') AS prompt,
       coalesce(string_agg('<|' || role || '|>' || chr(10) || chosen || chr(10), '' ORDER BY i) FILTER (after), '') AS chosen,
       coalesce(string_agg((at_c + length(role) + 5)::BIGINT || '-' || (at_c + length(role) + 5 + length(chosen))::BIGINT, ',' ORDER BY i)
                FILTER (after AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg('<|' || role || '|>' || chr(10) || rejected || chr(10), '' ORDER BY i) FILTER (after), '') AS rejected,
       coalesce(string_agg((at_r + length(role) + 5)::BIGINT || '-' || (at_r + length(role) + 5 + length(rejected))::BIGINT, ',' ORDER BY i)
                FILTER (after AND role = 'assistant'), '') AS rejected_mask
FROM sized GROUP BY conv_id
"""

# The others learn, hash or tokenize; tests hold them against brute force.
ORACLES: dict[str, str] = {"op6_chat_formatting": _OP6, "op11_phrase_collocations": oracles.COLLOCATIONS, "op12_merkle_manifest": oracles.MERKLE}
