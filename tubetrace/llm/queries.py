"""The registered queries of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    embed_dedup,
    exact_dedup,
    lexical,
    minhash,
    packing,
    ppm,
    pu_quality,
    quality_rules,
    sharding,
    toxicity,
    whitening,
)
from .common import fold, package_for_workers, read
from .queries_sql import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        package_for_workers(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.json"), digest=True)


@query
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op3_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 7) == 2
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out)
    return (ppm.score_documents(docs, ~F.col("held_out"), carry=("doc_id", "held_out"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                    "score"))


@query
def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.rotate(read(spark, sf_dir, "conversations"))
    shown = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return rows.withColumns({"mask_start": shown("mask_start"), "mask_end": shown("mask_end")})


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents")).drop("group_id")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    learn = labels.where(fold("doc_id", 5) != 0).select("doc_id", "toxic")
    return (toxicity.score_documents(docs, learn)
            .select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(read(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.shard_rows(read(spark, sf_dir, "documents"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


@query
def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    learn = labels.where(fold("doc_id", 3) != 1).select("doc_id", "quality")
    web = docs.where(fold("doc_id", 3) != 1)
    return (pu_quality.score_documents(docs, learn, web)
            .select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(read(spark, sf_dir, "documents"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (whitening.component_rows(whitening.whiten(read(spark, sf_dir, "embeddings")))
            .select("vec_id", "component", "n", "deviation", "whitened", "explained",
                    "identity_error"))
