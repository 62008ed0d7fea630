"""The registered queries of this package: each takes (spark, sf_dir) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    bpe,
    line_dedup,
    mixing,
    near_dup,
    packing,
    quality,
    secrets,
    source_audit,
    token_counts,
    toxicity,
    vector_codes,
    vector_dedup,
    vector_search,
)
from tickloom.llm.common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@_query
def op1_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), copy_col="copy")


@_query
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@_query
def op3_secret_scan(spark, sf_dir):
    test = secrets.TokenTest(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return secrets.secrets(table(spark, sf_dir, "documents"), test)


@_query
def op4_minhash_near_dedup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.Sketching(words=3, percent=85)).drop("text_key")


@_query
def op5_embedding_near_dedup(spark, sf_dir):
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@_query
def op6_nearest_neighbours(spark, sf_dir):
    return vector_search.nearest_vectors(table(spark, sf_dir, "embeddings"))


@_query
def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op8_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), counts=("n_lines", "n_removed"))


@_query
def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    held_out = remainder(F.col("doc_id"), quality.HELD_OUT) == quality.HELD_OUT_REST
    return quality.score(docs, model).withColumn("held_out", held_out)


@_query
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = remainder(F.col("doc_id"), toxicity.HELD_OUT) == toxicity.HELD_OUT_REST
    return toxicity.score(docs, model).withColumn("held_out", held_out)


@_query
def op11_bpe_codec(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op12_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


@_query
def op13_source_divergence(spark, sf_dir):
    return source_audit.source_divergence(table(spark, sf_dir, "documents"))
