"""SimHash near-duplicates: meet-in-the-middle ball hashing of fingerprints.

A fingerprint has bit i if more than half of the text's shingle hashes (XXH64,
seed 42, of the words joined by one space, repeats included) have it. Two texts
link if their fingerprints differ in at most ``max_distance`` bits (up to 3).

Two fingerprints within distance 2 meet in a fingerprint that is within one bit
of both, half the radius. For an odd distance of 3 four views are used, each
leaving out a quarter of the bits: of three differing bits some view leaves out
at least one, so in it at most two are left and the views' halves meet. Every
distinct fingerprint emits, per view, its kept bits and all their one-bit
variants (196 keys instead of the 2,081 of a radius of 2); the keys are
shuffled, and only in buckets with several members are pairs looked for:

* members that agree in the left-out bits differ by two bits at most: each is
  linked to the bucket's first (no pairs within the group);
* left-out bits that differ in one place: their firsts are linked;
* equal kept bits and left-out bits that differ in three places: likewise.

Any pair within distance 3 falls under one of these in some view, and every link
is verified by its bit distance. A bucket can hold at most 49 * 65,536 distinct
fingerprints, a bound that doesn't grow with the corpus; copies of one
fingerprint travel once. Components are found by Spark joins (components.py).

Defined results: texts with fewer words than a shingle hash all their words at
once; texts without words (null, empty) have the fingerprint zero and link like
any other; repeated rows link; a null doc_id is never a component's name unless
all of its rows have none; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.llm.common import WORD, keep_rows, mix, pieces
from phenospark.llm.components import components
from phenospark.sinks import materialise

#: Fingerprints whose keys one part of the shuffle should get (about 12 bytes a key).
PART_FINGERPRINTS = 6_000
_WORD = re.compile(WORD.encode())
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_OWN = 63  # "no bit flipped", in place of a bit's number


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut between words."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + size)
        to = gap.end() if gap else len(text)
        yield text[at:to]
        at = to


def fingerprint(text: bytes, shingle: int = 3, piece: int = 1 << 20) -> int:
    """The 64-bit SimHash of a text; its words are listed a piece at a time."""
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    n = 0
    words: list[bytes] = []
    for part in _pieces(text, piece):
        words += _WORD.findall(part.translate(_LOWER))
        if len(words) >= shingle:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = [0, *(ends[:-1] + 1).tolist()]
            joined = b" ".join(words)
            h = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist())], dtype="<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
            words = words[len(words) - shingle + 1 :]
    if not n:  # fewer words than a shingle has
        return digest(b" ".join(words), 42) if words else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), text_hash (XXH64 of the text) for every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            raw = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
            found = np.array([fingerprint(t, shingle) for t in raw], dtype=np.uint64)
            own = np.array([xxhash.xxh64_intdigest(t, 42) for t in raw], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), pa.array(own.view(np.int64))], names=["doc_id", "fp", "text_hash"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint, text_hash bigint")


# --- ball hashing --------------------------------------------------------------


def _layout(max_distance: int) -> tuple[int, int]:
    """(views, bits left out by a view)."""
    if max_distance not in (0, 1, 2, 3):
        raise ValueError("max_distance must be from 0 to 3")
    return (4, 16) if max_distance == 3 else (1, 0)


def variants(fps: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, what was done) of every fingerprint in every view: its kept bits
    and their one-bit variants; ``what``: left-out bits * 64 + flipped bit."""
    views, left = _layout(max_distance)
    kept = 64 - left
    keys, what = [], []
    for view in range(views):
        low = np.uint64(view * left)
        if left:
            below = fps & ((np.uint64(1) << low) - np.uint64(1))
            above = (fps >> np.uint64(view * left + left)) << low if view < views - 1 else np.zeros_like(fps)
            own = above | below
            out = (fps >> low) & np.uint64((1 << left) - 1)
        else:
            own, out = fps, np.zeros_like(fps)
        flips = np.concatenate(([np.uint64(0)], np.uint64(1) << np.arange(kept, dtype=np.uint64)))
        tag = np.concatenate(([_OWN], np.arange(kept))) if left else np.concatenate(([0], np.ones(kept, dtype=np.int64)))
        key = own[:, None] ^ flips[None, :]
        if left:
            key = key | (np.uint64(view) << np.uint64(kept))
        keys.append(key.ravel())
        what.append((out[:, None].astype(np.uint32) * np.uint32(64) + tag[None, :].astype(np.uint32)).ravel())
    return np.concatenate(keys), np.concatenate(what)


def _links_of(key: np.ndarray, what: np.ndarray, fp: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The links found in the buckets of one part (arrays of one length)."""
    order = np.argsort(key, kind="stable")
    key, what, fp = key[order], what[order], fp[order]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((edge, [len(key)])))
    several = np.repeat(size > 1, size)
    key, what, fp = key[several], what[several], fp[several]
    if not len(key):
        return fp, fp
    out, flip = what // np.uint32(64), what % np.uint32(64)
    if max_distance < 2:  # distance 1: a variant meets the fingerprint that it is
        order = np.lexsort((flip, key))
        key, flip, fp = key[order], flip[order], fp[order]
        first = _first(key)
        ok = (flip[first] == 0) & (flip == 1)
        return fp[ok], fp[first[ok]]
    bucket = np.cumsum(np.concatenate(([False], key[1:] != key[:-1]))).astype(np.uint64)
    cell = bucket << np.uint64(16) | out.astype(np.uint64)
    a, b = [], []

    def cells(cell: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(cell, kind="stable")
        cell, fp = cell[order], fp[order]
        first = _first(cell)
        a.append(fp)
        b.append(fp[first])
        heads = np.unique(first)
        return cell[heads], fp[heads]

    def across(cell: np.ndarray, fp: np.ndarray, bits: int) -> None:
        near = np.concatenate(([False], cell[1:] >> np.uint64(16) == cell[:-1] >> np.uint64(16)))[: len(cell)]
        near[:-1] |= near[1:]
        cell, fp = cell[near], fp[near]
        for places in combinations(range(16), bits) if len(cell) else ():
            other = cell ^ np.uint64(sum(1 << p for p in places))
            at = np.minimum(np.searchsorted(cell, other), len(cell) - 1)
            hit = (cell[at] == other) & (cell < other)
            a.append(fp[hit])
            b.append(fp[at[hit]])

    heads = cells(cell, fp)
    if max_distance == 3:
        across(*heads, 1)
        own = flip == _OWN
        across(*cells(cell[own], fp[own]), 3)
    x, y = np.concatenate(a), np.concatenate(b)
    ok = (x != y) & (np.bitwise_count(x ^ y) <= max_distance)
    return x[ok], y[ok]


def _first(sorted_keys: np.ndarray) -> np.ndarray:
    """For every element of a sorted array, the place of the first equal one."""
    edge = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))[: len(sorted_keys)]
    return np.maximum.accumulate(np.where(edge, np.arange(len(edge)), 0))


_KEY = np.dtype([("key", "<u8"), ("what", "<u4")])


def _restore(key: np.ndarray, what: np.ndarray, max_distance: int) -> np.ndarray:
    """The fingerprints that emitted these keys (views only)."""
    views, left = _layout(max_distance)
    kept = np.uint64(64 - left)
    view, own = key >> kept, key & ((np.uint64(1) << kept) - np.uint64(1))
    flip = (what % np.uint32(64)).astype(np.uint64)
    own = np.where(flip == _OWN, own, own ^ (np.uint64(1) << np.minimum(flip, kept)))
    low = view * np.uint64(left)
    below = own & ((np.uint64(1) << low) - np.uint64(1))
    above = np.where(view < views - 1, (own >> low) << np.minimum(low + np.uint64(left), np.uint64(63)), np.uint64(0))
    return above | below | ((what // np.uint32(64)).astype(np.uint64) << low)


def links(fps: DataFrame, n: int, max_distance: int = 3) -> DataFrame:
    """a, b: links between the distinct fingerprints ``fps`` (column fp; ``n``
    of them) that connect all those within ``max_distance``; repeats possible."""
    parts = max(1, math.ceil(n / PART_FINGERPRINTS))
    views, left = _layout(max_distance)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(own), 4096):
                key, what = variants(own[i : i + 4096], max_distance)
                rows = np.empty(len(key), _KEY if left else np.dtype([*_KEY.descr, ("fp", "<u8")]))
                rows["key"], rows["what"] = key, what
                if not left:
                    rows["fp"] = np.repeat(own[i : i + 4096], len(key) // len(own[i : i + 4096]))
                part = (mix(key) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                rows, part = rows[order], part[order]
                edge = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                ends = [*edge[1:].tolist(), len(part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[edge], pa.int64()), pa.array([rows[a:b].tobytes() for a, b in zip(edge.tolist(), ends)], pa.binary())],
                    names=["part", "keys"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(group["keys"]), _KEY if left else np.dtype([*_KEY.descr, ("fp", "<u8")]))
        key, what = np.ascontiguousarray(rows["key"]), np.ascontiguousarray(rows["what"])
        fp = _restore(key, what, max_distance) if left else np.ascontiguousarray(rows["fp"])
        a, b = _links_of(key, what, fp, max_distance)
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
        return pd.DataFrame({"a": both[:, 0].view(np.int64) if len(both) else [], "b": np.ascontiguousarray(both[:, 1]).view(np.int64) if len(both) else []}).astype("int64")

    return fps.select("fp").mapInArrow(emit, "part bigint, keys binary").groupBy("part").applyInPandas(meet, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """doc_id, fp (signed long), text_hash, component_id (the least doc_id that
    is reachable over links) for every row of ``docs`` (doc_id, text)."""
    rows = materialise(fingerprints(docs, shingle), "simhash")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_distinct")
    if max_distance:
        found = components(links(distinct, distinct.count(), max_distance))
        named = found.join(distinct, found["node"] == distinct["fp"]).select("fp", "root", "least")
        least = named.groupBy("root").agg(F.min("least").alias("component_id"))
        names = named.join(least, "root").select("fp", "component_id")
        distinct = distinct.join(names, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    else:
        distinct = distinct.withColumnRenamed("least", "component_id")
    return rows.join(distinct, "fp").select("doc_id", "fp", "text_hash", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each component the row of the least doc_id."""
    found = near_duplicates(docs, shingle, max_distance)
    # A component without any doc_id is known by its fingerprint; such rows are few and stand for themselves.
    component = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp")))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    kept = found.groupBy(component.alias("c")).agg(least.alias("k")).select("k.doc_id", F.col("k.text_hash").cast("string").alias("mark"))
    return keep_rows(docs, kept, F.xxhash64(F.coalesce("text", F.lit(""))).cast("string"))


def hex_fingerprint(fp):
    """A fingerprint column as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
