"""Small helpers shared by the text operators: folds, text columns, the word
scanner and 64-bit word hashes (numpy, used inside Spark tasks)."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words in every operator (fixed by the contract): space and the bytes 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts of about so many bytes are handled together by one task, to bound its memory.
BLOCK_BYTES = 4 << 20


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_package(spark: SparkSession) -> None:
    """Adds this package's place to the Python workers' search path, for sessions
    whose driver imports it from a folder of its own. (On a cluster the package
    is shipped as usual, e.g. by ``--py-files``.)"""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus."""
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32(doc_id as text) mod ``parts`` is ``part``; a null id is in no such part."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def in_fold(doc_id: int | None, parts: int, part: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == part


def keep_rows(docs: DataFrame, keepers: DataFrame, mark: Column) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``keepers`` (doc_id, mark) names,
    one for each; ``mark``: a column of ``docs`` that tells texts apart."""
    key = "key"
    while key in docs.columns:
        key += "_"
    def name(mark: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), mark)

    named = keepers.select(name(F.col("mark")).alias(key)).distinct()
    return docs.withColumn(key, name(mark)).join(named, key, "left_semi").dropDuplicates([key]).drop(key)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def pieces(batches: Iterable[pa.RecordBatch], text: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in smaller batches of about ``limit`` bytes in column number ``text``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        for i, j in slices(sizes.tolist(), limit):
            yield batch.slice(i, j - i)


def slices(sizes: Iterable[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    first = total = i = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n + 1
    if total:
        yield first, i + 1


# --- word scanner -----------------------------------------------------------

_CHUNK = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=np.int8)
_IS_WORD[[32, *range(9, 14)]] = 0
_BYTE_CODE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > _CHUNK or not _powers:
        size = max(n, _CHUNK)
        made = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        if n > _CHUNK:  # one giant word: not kept
            return made[0], made[1]
        _powers[0] = (made[0], made[1])
    return _powers[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, so that every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def scan_words(raw: bytes, lower: bool, kinds: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit hash) of every word of ``raw`` (UTF-8). ``lower``: A-Z count as a-z.
    ``kinds``: each byte's kind (0: between words); a word is a longest run of one kind.

    Works through the bytes in chunks cut between words, so memory beyond the
    result is bounded but for a single word longer than a chunk."""
    data = np.frombuffer(raw, dtype=np.uint8)
    if lower:
        data = _LOWER[data]
    is_word = kinds[data]
    starts, ends, hashes = [], [], []
    i, n = 0, len(data)
    while i < n:
        j = min(i + _CHUNK, n)
        if j < n:
            gaps = np.flatnonzero(is_word[i:j] == 0)
            if len(gaps):
                j = i + int(gaps[-1]) + 1
            else:
                while j < n and is_word[j]:
                    j += 1
        edge = np.concatenate(([np.int8(0)], is_word[i:j], [np.int8(0)]))
        at = np.flatnonzero(edge[1:] != edge[:-1])  # every run, those of kind 0 between words too, ends where the next begins
        a, b = at[:-1], at[1:]
        words = edge[a + 1] != 0
        a, b = a[words], b[words]
        up, down = _power_tables(j - i)
        total = np.zeros(j - i + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[data[i:j]] * up[: j - i], out=total[1:])
        h = (total[b] - total[a]) * down[a]
        hashes.append(mix(h ^ (b - a).astype(np.uint64)))
        starts.append(a + i)
        ends.append(b + i)
        i = j
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of every ``n`` consecutive word hashes."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:m].copy()
    for k in range(1, n):
        out = mix(out * _STEP + words[k : k + m])
    return out


class Block:
    """Some texts scanned together: the words of text ``i`` are ``first[i]:first[i + 1]``."""

    def __init__(self, texts: list[bytes], lower: bool, kinds: np.ndarray = _IS_WORD):
        self.raw = b"\n".join(texts)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        self.start, self.end, self.hash = scan_words(self.raw, lower, kinds)
        self.first = np.searchsorted(self.start, bounds)
        self.n = len(texts)
