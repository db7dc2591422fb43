"""Corpus pipeline: toxicity, exact dedup, near dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps or makes; the last one
returns packed pieces. `run` stores each stage's result in the shared folder as Parquet and reads it
back, so a lost executor repeats one stage at most.

    toxicity      documents scored 0.5 or more go; the model is fitted on the labels of `sf_dir`
    exact_dedup   of equal texts (white space normalised) the smallest doc_id stays
    ngram_join    of each group linked by 5-word shingles with Jaccard 0.8 the smallest doc_id stays
    mixing        a row per document and pass with the words the mix draws; a document can come
                  twice, whole or in part, or not at all
    packing       pieces of those rows in sequences of 4096 tokens; a document that comes twice is
                  told apart by ids_crc32 and place only

Nulls, empty texts, repeated rows, empty tables and extra columns are handled as each operator's
module says; rows without a doc_id pass the two dedup stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from playlens.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from playlens.llm.common import shared_folder, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model_docs = table(spark, sf_dir, "documents")
    return toxicity.reject(docs, model_docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_dedup_stage),
          ("ngram_join", ngram_join_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

# A trained scorer, pseudorandom draws and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
