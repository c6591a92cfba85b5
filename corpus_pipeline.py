"""The corpus pipeline: documents in, token digests of the clean corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and reread as the next one's ``docs``; all but the last return the
columns of ``documents``. Stages work on every row that their predecessor kept.

Defined results: a null or empty text, or one without letters, has no language and
goes; repeated rows are equal texts, of which one row stays (the largest doc_id, a null
id only if there is no other); of linked fingerprints the least doc_id stays; clashing
or further columns pass through every stage unchanged; texts of any length are read
whole; an empty table, or one that a stage empties, gives an empty result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenospark.llm import bpe, decontam, exact_dedup, langid, simhash
from phenospark.llm.common import fold, table
from phenospark.sinks import materialise

#: A document goes if in none of its windows the learned languages together reach this share of the network's
#: belief against noise and unseen scripts (texts in any number of languages stay).
LEAST_LANGUAGE_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a recognisable language: noise, and
    scripts that no labelled document has."""
    net = langid.train(docs.where(~fold(F.col("doc_id"), 4, 2)), reject=True)
    return langid.known_language(docs, net, LEAST_LANGUAGE_SHARE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts only the row with the largest doc_id stays."""
    return exact_dedup.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints are linked only the row with the least doc_id stays."""
    return simhash.one_of_each(docs, shingle=3, max_distance=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.token_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminated),
    ("bpe", tokens),
]

#: SQL can express neither the network nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage but the last is written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
