"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers as tokenizers
from tessera.llm import bpe, conversations, decontaminate, fingerprints, infill, langid, licenses, neighbours, passages, repeats, sharding, simhash, token_counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaking_pairs(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_classes(documents(spark, sf_dir))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_duplicate_passages(documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digests(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizers.path("piece_bpe_32k.model"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(documents(spark, sf_dir), tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(documents(spark, sf_dir))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_decontamination, op2_language_id, op3_winnowing, op4_simhash, op5_passages, op6_license_scan, op7_suffix_repeats, op8_token_counts, op9_byte_bpe, op10_sharding, op11_conversation_repair, op12_fill_in_middle, op13_neighbours)}
_HEX = lambda k: f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS BIGINT)"
ORACLES: dict[str, str] = {
    "op12_fill_in_middle": f"""WITH cut AS (
 SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
h AS (SELECT doc_id, text, tokens, len(tokens) AS n, {_HEX(0)} AS h1, {_HEX(1)} AS h2, {_HEX(2)} AS h3, {_HEX(3)} AS h4 FROM cut),
parts AS (
 SELECT *, array_to_string(tokens[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
  array_to_string(tokens[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
  array_to_string(tokens[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS suffix,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
made AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM parts),
back AS (SELECT *, CASE form WHEN 'plain' THEN output
  WHEN 'psm' THEN substr(output, 4, strpos(output, '<S>') - 4) || substr(output, strpos(output, '<M>') + 3) || substr(output, strpos(output, '<S>') + 3, strpos(output, '<M>') - strpos(output, '<S>') - 3)
  ELSE substr(output, strpos(output, '<P>') + 3, strpos(output, '<M>') - strpos(output, '<P>') - 3) || substr(output, strpos(output, '<M>') + 3) || substr(output, 4, strpos(output, '<P>') - 4) END AS restored FROM made)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM back""",
}
