"""Benchmark decontamination: which short test items stand inside which long
documents, by size-partitioned MinHash containment search with an exact check.

Words are lower-cased (A-Z) and split at white space; a text's shingles are
its distinct runs of five words (a text of one to four words has the one
shingle of them all). Containment of an item in a document is the share of the
item's shingles that the document has; a pair counts from 0.8 on.

Items are partitioned by their number of shingles n. A pair that counts shares
at least ceil(0.8 n) shingles, so it must share one of *any* n - ceil(0.8 n) + 1
of them: an item's sketch is that many shingles with its smallest hashes (a
bottom-k MinHash whose k follows the size partition), and a document meets
every item of which it has a sketch shingle. So the search misses no pair, at
whatever difference of length; candidates are then verified on the shingles'
words. Documents stay where they are read: the distinct item texts of one block are
sent to the tasks by a broadcast variable (a block is bounded by ``block_bytes`` of
text, by measure, and copies of an item are one text, so a benchmark of some GB or of
many repeated rows needs no more memory; more texts mean more blocks, each streamed
against all documents). Pairs get their item_ids by a join on the text's digest.

Defined results: ids are integers; null or empty texts have no shingles and meet nothing; a
repeated document row gives its pairs once for each row; repeated items with
different item_id are different items; an item_id given twice with different
texts is two items with that id; an empty table gives an empty result; further
columns are ignored; ties need no order (every pair is returned).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.llm.common import WORD, Block, gram_hashes, pieces
from phenospark.sinks import materialise

SHINGLE = 5
THRESHOLD = 0.8
#: Text of the items sent to the tasks at once.
BLOCK_BYTES = 16 << 20

_WORD = re.compile(WORD.encode())
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SCHEMA = "doc_id bigint, key string, n_shared int, n_shingles int, containment double"


def shingles(text: bytes, n: int = SHINGLE) -> set[bytes]:
    """The distinct shingles of a text, as words joined by one space."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return set()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def sketch_size(n: int, threshold: float = THRESHOLD) -> int:
    """How many of an item's ``n`` shingles a counting pair can't all miss."""
    return n - math.ceil(threshold * n - 1e-9) + 1


class _Items:
    """A block of item texts (key, text) as every task holds it."""

    def __init__(self, rows: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.items = [(i, sh) for i, text in rows if (sh := shingles(text.encode()))]
        hashes, owners = [], []
        for k, (_, sh) in enumerate(self.items):
            own = np.sort(_hashes(sh))
            own = own[: sketch_size(len(sh), threshold)]
            hashes.append(own)
            owners.append(np.full(len(own), k))
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.owner = self.hash[order], self.owner[order]
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.hash & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def candidates(self, grams: np.ndarray) -> set[int]:
        few = grams[self.seen[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)]]
        if not len(few):
            return set()
        few = np.unique(few)
        a, b = np.searchsorted(self.hash, few, "left"), np.searchsorted(self.hash, few, "right")
        return {int(k) for i, j in zip(a, b) if j > i for k in self.owner[i:j]}


def _hashes(sh: set[bytes]) -> np.ndarray:
    """Shingle hashes as a document's scan makes them."""
    block = Block(sorted(sh), lower=True)
    out = [_grams(block.hash[block.first[i] : block.first[i + 1]]) for i in range(block.n)]
    return np.concatenate(out)


def _grams(words: np.ndarray) -> np.ndarray:
    return gram_hashes(words, min(SHINGLE, len(words))) if len(words) else words


def _matches(texts: pa.Array, items: _Items) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, shared shingles, item's shingles) of every counting pair of a batch."""
    raw = [t.encode() if t else b"" for t in texts.to_pylist()]
    block = Block(raw, lower=True)
    for k in range(block.n):
        found = items.candidates(_grams(block.hash[block.first[k] : block.first[k + 1]]))
        own = shingles(raw[k]) if found else set()
        for c in sorted(found):
            n, of = len(items.items[c][1] & own), len(items.items[c][1])
            if n >= items.threshold * of - 1e-9:
                yield k, c, n, of


def _texts(items: DataFrame) -> DataFrame:
    """The distinct texts of the items that have any, with ``key``: copies of an item are one text."""
    return items.where(F.length("text") > 0).select("text").distinct().withColumn("key", F.sha2("text", 256))


def _item_blocks(texts: DataFrame, threshold: float, block_bytes: int) -> Iterator[_Items]:
    """Distinct texts in blocks of about ``block_bytes`` (by measure), one on the driver at a time."""
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_bytes))
    for b in range(n):
        rows = texts.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect()
        yield _Items([(r["key"], r["text"]) for r in rows], threshold)


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment: every pair of a row
    of ``docs`` (doc_id, text) and a row of ``items`` (item_id, text) with a
    containment of at least ``threshold``."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    texts = materialise(_texts(items), "item_texts")
    parts = []
    for block in _item_blocks(texts, threshold, block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in pieces(batches, 1):
                ids = batch.column(0).to_pylist()
                out = [(ids[r], block.items[c][0], n, of, n / of) for r, c, n, of in _matches(batch.column(1), block)]
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64())
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                                                     names=["doc_id", "key", "n_shared", "n_shingles", "containment"])
        parts.append(docs.mapInArrow(search, _SCHEMA))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionAll(more)
    named = items.where(F.length("text") > 0).select(F.col("item_id").cast("bigint").alias("item_id"), F.sha2("text", 256).alias("key"))
    return out.join(named, "key").select("doc_id", "item_id", "n_shared", "n_shingles", "containment")


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text contains no item; nothing is shuffled."""
    at = docs.columns.index("text")
    texts = materialise(_texts(items), "item_texts")
    for block in _item_blocks(texts, threshold, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, at):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[m[0] for m in _matches(batch.column(at), sent.value)]] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs
