"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet in the cluster's shared folder and read again as the next
stage's ``docs``. All stages but the last return the columns of documents.

1. toxicity: documents that the factorization machine rejects go.
2. line dedup: later copies of repeated line runs are cut out; a document that
   only consisted of such copies goes, one that was empty before stays.
3. n-gram join: one document of each near-duplicate class stays.
4. decontamination: documents with a benchmark passage go.
5. packing: pieces of all remaining documents and their places in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from tessera.llm.scratch import crc_mod, documents, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(docs)
    chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    left = cut.where("n_removed = 0 or n_removed < n_lines").withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs).select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaking(docs, documents(spark, sf_dir, "benchmark")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenized_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_join", keep_one_of_each_class),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: The first stage learns a model, which SQL cannot express; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
