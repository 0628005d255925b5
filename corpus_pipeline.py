"""From raw documents to packed sequences: five stages, each the next one's input as a written table.

1. language ID: documents without a letter (null, empty, signs) go, and those that no learned language's model codes better than raw bytes;
2. exact dedup: of equal texts the largest id stays;
3. near dedup: of documents linked at similarity 0.8 on five-word shingles, the smallest id stays;
4. mixing: small sources are repeated towards even weights, at most twice, and every document stays;
5. packing: all documents, cut and packed into sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptoria.llm import exact_dedup, langid, minhash, mixing, packing
from scriptoria.llm.common import materialise, read_table, small_batches


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, numerator=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, entropy_share=1.0, max_repeats=2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("mix_sources", mixed), ("best_fit_packing", packed)]

#: PPM, MinHash and BPE have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
