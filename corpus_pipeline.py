"""Corpus pipeline: documents to training sequences in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
between stages the documents are written as Parquet to the shared folder and read
back. All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.llm import decontaminate, langid, simhash, toxicity
from snapweave.llm.common import small_batches, stored, table
from snapweave.llm.queries import language_net, packed, toxicity_scorer

TOXIC_SCORE = 0.5  # documents at or above it go
LANGUAGE_SCORE = 0.4  # documents below it go: no language explains most of the text

# Not expressible in SQL: two trained models, XXH64 fingerprints and a tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below ``TOXIC_SCORE``."""
    small_batches(spark)
    scorer = toxicity_scorer(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scored(docs["text"], scorer) < TOXIC_SCORE)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; without any labelled row, those with a letter."""
    small_batches(spark)
    net = language_net(docs)
    if net is None:
        return docs.filter(F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)))
    guess = langid.predicted(docs["text"], net)
    return docs.filter((guess["lang"] != langid.UNKNOWN) & (guess["score"] >= LANGUAGE_SCORE))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    small_batches(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with the benchmark."""
    small_batches(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    small_batches(spark)
    return packed(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                               "source", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
