"""The training-data pipeline: stages that each apply one operator of
``cairn.llm`` to all that the stage before kept.

Rows are never matched by position: the filters carry a document's columns
through, near-duplicate verdicts return by id (NULL ids are kept; rows that
repeat an id stay or go together). Substring dedup rewrites only texts that it
cuts; a document left without words stays, with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import classifier, minhash, packing, quality_rules, substring
from cairn.llm.common import staged
from cairn.session import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classifier.score(docs, read_table(spark, sf_dir, "labels"), carry=COLUMNS).filter("kept").select("row.*")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. (Exploding the kept rows
    keeps the optimizer from writing all measures once more into a filter.)"""
    judged = quality_rules.judge(docs, carry=COLUMNS)
    return judged.select(F.explode(F.when(F.col("kept"), F.array("row"))).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    kept = minhash.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs.doc_id.eqNullSafe(F.col("kept_id")), "left_semi").select(COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated 35-word windows go."""
    cut = substring.cut_repeats(docs, carry=["text", "lang", "source", "n_chars"])
    was_cut = F.col("n_removed") > 0
    text = F.when(was_cut, F.col("kept_text")).otherwise(F.col("row.text"))
    size = F.when(was_cut, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    return cut.select("doc_id", text.alias("text"), "row.lang", "row.source", size.alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens: a row per piece."""
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("packing", pack),
]
#: The classifier and the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
