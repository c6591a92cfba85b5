"""Quality rules: simple counts of every text, and a likelihood ratio between trusted
text and the raw corpus.

The ratio compares two multinomials over hashed n-grams: tokens (runs of letters and
digits, runs of other characters, case kept) and pairs of neighbouring tokens, each
hashed into one of ``BUCKETS`` buckets. The raw multinomial is counted over every
document, the target over the trusted ones, both smoothed by one count a bucket. A
document's score is the mean over its n-grams of log(target / raw), so it does not
depend on the length. A document is kept if it reaches the threshold: the score that
all but ``LOST`` of trusted documents reach that took no part in the counts (a fold of
them is set aside), less ``MARGIN`` standard errors of a mean of as many n-grams as
the document has, so that short texts are not judged on a few words' chance. Nothing
is drawn at random: the same tables give the same verdicts.

Counts and scores are made where texts are read. A task sums its n-grams into two
arrays of ``BUCKETS`` numbers, and these sums alone are shuffled; the driver gets one
pair of numbers per bucket, and the threshold's histogram (bins of ``BIN``, at most
a few ten thousand whatever the corpus). Trusted ids are joined by id: broadcast
when their bytes are few by measure; beyond that a Bloom filter drops the other
documents before the exchange, so only labelled texts move.

Defined results: null or empty texts have no words and fail the base rules; repeated
rows are judged alike; a label that is null or contradicted for its document is no
trust; without trusted documents the method keeps all that pass the base rules; an
empty table gives an empty result; further columns are ignored; a text of any length
is counted whole, in blocks of some megabytes or by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenospark.llm.common import Block, fold, gram_hashes, pieces
from phenospark.operators.joins import lookup_join
from phenospark.sinks import materialise

#: Hash buckets of the two multinomials.
BUCKETS = 1 << 14
#: Trusted documents set aside for the threshold: one part in so many (by crc32 of the id).
ASIDE = 5
#: Share of trusted documents that the threshold may lose, its histogram's bin, and its allowance for short texts.
LOST, BIN, MARGIN = 0.002, 0.001, 3.0
#: Fixed by the contract: the repeated windows, and what fails a text outright.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, *range(9, 14)]] = True
#: Kinds of bytes: lines end at 10; tokens are letters and digits, or what is neither that nor white space.
_LINE = np.ones(256, dtype=np.int8)
_LINE[10] = 0
_TOKEN = np.full(256, 2, dtype=np.int8)
_TOKEN[_GAP] = 0
_TOKEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


# --- base counts -----------------------------------------------------------------

def _sums(marks: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` between every two neighbours of ``first``."""
    return np.diff(np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))[first])


def _owners(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _inside(first: np.ndarray, n: int) -> np.ndarray:
    """Whether ``n`` items from each item on belong to one text (for all but the last n - 1 items)."""
    owner = _owners(first)
    return owner[: max(0, len(owner) - n + 1)] == owner[n - 1 :]


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every text."""
    block = Block(texts, False)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(block.raw + b"\n", np.uint8)
    in_word = ~_GAP[data]
    out = {"n_words": np.diff(block.first), "word_chars": _sums(in_word & ((data & 0xC0) != 0x80), bounds),
           "n_symbols": _sums(_SYMBOL[data], bounds)}

    lines = Block(texts, False, _LINE)
    before = np.concatenate(([0], np.cumsum(in_word, dtype=np.int64)))
    worded = before[lines.end] > before[lines.start]
    owner = _owners(lines.first)[worded]
    different = np.unique(np.column_stack((owner.astype(np.uint64), lines.hash[worded])), axis=0)[:, 0].astype(np.int64)
    out["n_dup_lines"] = np.bincount(owner, minlength=len(texts)) - np.bincount(different, minlength=len(texts))

    windows, inside = gram_hashes(block.hash, WINDOW), _inside(block.first, WINDOW)
    at = np.flatnonzero(inside)
    owner = _owners(block.first)[at]
    order = np.lexsort((windows[at], owner))
    sorted_owner, sorted_window = owner[order], windows[at][order]
    same = (sorted_owner[1:] == sorted_owner[:-1]) & (sorted_window[1:] == sorted_window[:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(block.hash) + WINDOW + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    out["n_repeat_words"] = _sums(np.cumsum(cover)[: len(block.hash)] > 0, block.first)
    return out


# --- hashed n-grams ----------------------------------------------------------------

def ngram_buckets(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every token and pair of neighbouring tokens."""
    block = Block(texts, False, _TOKEN)
    owner = _owners(block.first)
    pairs, inside = gram_hashes(block.hash, 2), _inside(block.first, 2)
    grams = np.concatenate((block.hash, pairs[inside]))
    return np.concatenate((owner, owner[: len(pairs)][inside])), (grams % np.uint64(buckets)).astype(np.int64)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [(t or "").encode() for t in batch.column(column).to_pylist()]


def ngram_counts(docs: DataFrame) -> np.ndarray:
    """N-grams in each bucket, over all rows of ``docs``: summed in the tasks, then by
    bucket; ``BUCKETS`` numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in pieces(batches, 0):
            total += np.bincount(ngram_buckets(_texts(batch, 0))[1], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    found = docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in found.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(target / raw) of every bucket, smoothed by one count a bucket."""
    def log_shares(counts: np.ndarray) -> np.ndarray:
        return np.log(counts + 1.0) - math.log(int(counts.sum()) + len(counts))

    return log_shares(target) - log_shares(raw)


def scored(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, the base counts, n_grams and score of every row of ``docs``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            texts = _texts(batch, 1)
            base = base_counts(texts)
            owner, bucket = ngram_buckets(texts)
            n = np.bincount(owner, minlength=len(texts))
            score = np.bincount(owner, ratios[bucket], len(texts)) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(base[c].astype(np.int64)) for c in names), pa.array(n.astype(np.int64)), pa.array(score)],
                names=["doc_id", *names, "n_grams", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'{c} bigint' for c in names)}, n_grams bigint, score double")


# --- verdicts ------------------------------------------------------------------------

def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of documents whose labels all say quality 1."""
    return (
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
        .agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    )


def threshold(scores: DataFrame) -> float:
    """The score that all but ``LOST`` of the rows reach, to a bin of ``BIN``."""
    bins = scores.groupBy(F.floor(F.col("score") / BIN).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    lost, below = LOST * sum(r["n"] for r in bins), 0
    for r in sorted(bins, key=lambda r: r["bin"]):
        below += r["n"]
        if below > lost:
            return r["bin"] * BIN
    return -math.inf


def spread(target: np.ndarray, ratios: np.ndarray) -> float:
    """Standard deviation of an n-gram's log ratio in trusted text."""
    share = (target + 1.0) / (target.sum() + len(target))
    mean = float(share @ ratios)
    return math.sqrt(max(0.0, float(share @ (ratios - mean) ** 2)))


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score for every row of ``docs`` (doc_id, text); ``labels``:
    doc_id, quality (1: trusted)."""
    trusted = materialise(trusted_ids(labels), "quality_trusted")
    aside = fold(F.col("doc_id"), ASIDE, 0)
    known = docs.select("doc_id", "text")
    raw = ngram_counts(known)
    target = ngram_counts(lookup_join(known, trusted.where(~aside), "doc_id", "left_semi", salt_buckets=1))
    ratios = log_ratios(target, raw)
    table = materialise(scored(known, ratios), "quality_scores")
    held = lookup_join(table.select("doc_id", "score"), trusted.where(aside), "doc_id", "left_semi", salt_buckets=1)
    least = threshold(held) if target.any() else -math.inf
    allowance: Column = F.lit(MARGIN * spread(target, ratios)) / F.sqrt(F.greatest("n_grams", F.lit(1)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~failed & (F.col("score") >= F.lit(least) - allowance)
    return table.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), kept.alias("kept"), "score")
