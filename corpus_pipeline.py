"""From raw documents to packed training sequences.

Rejects junk, then toxic documents, keeps one document of each group of near duplicates and
packs what is left. Each stage is a function of (spark, docs, sf_dir); its result is written
as Parquet into the shared folder and read again as the documents of the next one. All stages
but the last give the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tubetrace.llm import minhash, packing, quality_rules, toxicity
from tubetrace.llm.common import fold, package_for_workers, read, stored

TOXIC = 0.5
REMEMBERED = 50_000  # words a stage keeps in a Python worker: the workers serve all stages
SIMILAR = 80  # per cent of the shingles of two documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    package_for_workers(spark)
    return quality_rules.kept_documents(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; learns from those that are labelled."""
    package_for_workers(spark)
    learn = read(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0).select("doc_id", "toxic")
    return toxicity.clean_documents(docs, learn, TOXIC, remembered=REMEMBERED)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    package_for_workers(spark)
    return minhash.one_of_each_group(docs, SIMILAR)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the sequences."""
    package_for_workers(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"),
                                  remembered=REMEMBERED)


STAGES = [("quality", quality), ("toxicity", clean), ("near_duplicates", distinct),
          ("packing", packed)]

#: A network trained on the way decides, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the table of documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
