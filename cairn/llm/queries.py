"""The registered queries of this package, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bpe, classifier, divergence, embeddings, minhash, mixing, packing, quality_rules, substring, token_orc, twins, urls, variants, warc
from cairn.session import read_table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.cut_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return stored.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read_table(spark, sf_dir, "pages"))


def op11_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(read_table(spark, sf_dir, "documents"), slips=variants.SLIP)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_dedup, op2_bpe, op3_packing, op4_quality_rules, op5_substring_dedup, op6_token_orc, op7_embedding_dedup, op8_warc,
    op9_quality_classifier, op10_url_filter, op11_pareto_mix, op12_spelling_variants, op13_source_divergence)}
ORACLES = {
    "op1_minhash_dedup": twins.MINHASH,
    "op4_quality_rules": quality_rules.oracle(),
    "op5_substring_dedup": twins.SUBSTRING,
    "op7_embedding_dedup": twins.EMBEDDINGS,
    "op10_url_filter": urls.oracle(),
    "op11_pareto_mix": mixing.oracle(),
    "op12_spelling_variants": variants.oracle(),
    "op13_source_divergence": divergence.oracle(),
}
ORACLES["op8_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest, n) END AS first_id FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id < first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < first_id THEN first_id END AS refers_to
FROM r"""
