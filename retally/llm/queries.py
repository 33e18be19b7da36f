"""Registered queries of the operators, each over its whole table, and their plain SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from retally.llm import (blob_ledger, bpe, divergence, langid, lattice, minhash, negatives, packing, pivots, repeats, sql,
                         stripes, surrogates, warc)

Query = Callable[[SparkSession, str], DataFrame]
#: Key of the surrogates in the registered query; a user passes an own one.
KEY = "registered query"


def _over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(spark.read.parquet(f"{folder}/{table}.parquet"))


def _packed(docs: DataFrame) -> DataFrame:
    return packing.digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


def _encoded(docs: DataFrame) -> DataFrame:
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def _replaced(docs: DataFrame) -> DataFrame:
    done = surrogates.replaced(docs, KEY)
    return done.select("doc_id", "text", "n_entities", *[
        F.element_at("kinds", kind).alias(f"n_{kind}") for kind in surrogates.FORMS])


def _nearest(vectors: DataFrame) -> DataFrame:
    return pivots.top_scores(vectors, vectors.where("vec_id % 20 = 0"))


def _mined(vectors: DataFrame) -> DataFrame:
    moved = vectors.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return negatives.hard_negatives(moved, vectors.where("vec_id % 100 = 0"))


def build() -> dict[str, Query]:
    return {
        "op1_packing": _over("documents", _packed),
        "op2_language_id": _over("documents", langid.identified),
        "op3_byte_bpe": _over("documents", _encoded),
        "op4_minhash": _over("documents", lambda docs: minhash.near_duplicates(docs, k=3, percent=85)),
        "op5_surrogates": _over("documents", _replaced),
        "op6_secrets": _over("documents", blob_ledger.digests),
        "op7_warc": _over("pages", warc.round_trip),
        "op8_lattice": _over("embeddings", lattice.near_duplicates),
        "op9_divergence": _over("documents", divergence.quality),
        "op10_run_length_index": _over("documents", lambda docs: repeats.digests(repeats.without_repeats(docs))),
        "op11_pivot_table": _over("embeddings", _nearest),
        "op12_stripes": _over("documents", stripes.divergences),
        "op13_one_bit_codes": _over("embeddings", _mined),
        "pipeline": _pipeline,
    }


def _pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def oracle() -> dict[str, str]:
    return {"op4_minhash": sql.MINHASH, "op6_secrets": sql.secrets(), "op7_warc": sql.WARC, "op8_lattice": sql.LATTICE,
            "op11_pivot_table": sql.TOP_SCORES, "op12_stripes": sql.STRIPES, "op13_one_bit_codes": sql.NEGATIVES}
