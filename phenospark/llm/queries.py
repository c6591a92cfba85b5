"""The contract queries of the text operators: thin calls with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenospark.llm import bpe, langid, lm, spelling, substring, toxicity
from phenospark.llm.common import fold, table
from phenospark.llm.decontam import contained_items
from phenospark.llm.exact_dedup import exact_duplicates
from phenospark.llm.html import extract_text
from phenospark.llm.quality import judge_quality
from phenospark.llm.search import ranked_search
from phenospark.llm.simhash import hex_fingerprint, near_duplicates
from phenospark.llm.urls import judge_urls

#: The rules of the contract: (host, path, action).
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3, 1))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.token_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), 7, 2)


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 4, 2)
    net = langid.train(docs.where(~held_out))
    return langid.identify(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=3)
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_html": op2_html,
    "op3_bpe": op3_bpe,
    "op4_lm": op4_lm,
    "op5_urls": op5_urls,
    "op6_language": op6_language,
    "op7_simhash": op7_simhash,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_substring": op9_substring,
    "op10_decontamination": op10_decontamination,
    "op11_quality": op11_quality,
    "op12_search": op12_search,
    "op13_spelling": op13_spelling,
}
