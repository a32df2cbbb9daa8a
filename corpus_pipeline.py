"""Corpus pipeline: five stages over `documents`, each by one of the training-data operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regioncast.llm import decontaminate, line_dedup, packing, simhash, toxicity
from regioncast.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores at 0.7 or more go; it learns from the labels of folds 0 and 2 of 3."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), folds=3, held_fold=1, threshold=0.7)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Globally repeated multi-line chunks go from the texts, but for their first occurrence; n_chars follows the text."""
    got = line_dedup.without_repeated_chunks(docs)
    chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return got.withColumn("n_chars", chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: shingles of 4 words, fingerprints linked at 4 bits."""
    return simhash.first_of_each_group(docs, shingle_words=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word in twenty inside occurrences of the benchmark's 13-word windows go; the others stay as they are."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), width=13)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as pieces packed into sequences of 2048."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
