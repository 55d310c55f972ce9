"""Corpus pipeline: stages from documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the docs of the next stage.

Cases: a null or empty text, or one without letters, is rejected by the language stage; repeated rows and equal texts
(ties) leave one row, that of the least doc_id (null last); very long texts go through whole, and packing alone cuts
them; an empty table gives empty stages; columns other than those of documents are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, langid, neardup, packing
from tidemark.llm.common import read, workers_find_package, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SHARE = 0.4      # a document without one language that has this share of its letters is rejected


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a main language: not `und`, and at least LEAST_SHARE of the letters in it."""
    workers_find_package(spark)
    model = langid.language_model(docs)
    return langid.keep_identified(docs.select(*COLUMNS), model, LEAST_SHARE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates, that with the least doc_id."""
    workers_find_package(spark)
    return neardup.keep_one(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain an item of the benchmark."""
    return decontam.drop_contaminated(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 4096 tokens: one row for each piece."""
    workers_find_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]

#: The stages learn, hash and tokenize; SQL cannot express them. tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
