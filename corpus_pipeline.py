"""From raw documents to packed training sequences, one stage after the other."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from retally.llm import blob_ledger, langid, minhash, packing, repeats
from retally.llm.common import kept, workspace


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the model learns from those of them that are labelled and not held out."""
    return langid.clear(docs, langid.train(docs.where(~langid.held_out())))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8); a row without an id stays."""
    first = minhash.near_duplicates(docs).where("kept").select("doc_id").distinct()
    stay = docs.where("doc_id is not null").join(first.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stay.select(*docs.columns).unionAll(docs.where("doc_id is null"))


def without_long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; documents of nothing else go."""
    return repeats.shortened(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by a mark."""
    return blob_ledger.without_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", with_language),
    ("near copies", without_near_copies),
    ("long repeats", without_long_repeats),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Language models, tokenizers and byte positions have no SQL.  Of run() itself tests/llm looks only at columns, the share of
#: rows each stage keeps and the ids after packing; no brute-force version of the five stages holds its rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = kept(stage(spark, docs, sf_dir), f"{home}/{number}")
    return docs
