"""A Bloom filter of join keys that drops facts before an exchange.

A lookup too large to broadcast would make every fact travel to meet it, though most
match nothing. Its keys alone fit in a few bytes each: they are hashed into blocks of
256 bits (four 64-bit words), up to two bits a word, and the blocks (``block, w0 ..
w3``) are or-ed together map-side and then by block. Facts get the block of their key
by a broadcast join and stay if all bits of their key are set: no fact that has a
match is dropped, and about one in 300 of the others stays (with ``BITS`` bits a
key), to be dropped by the join itself. Everything is DataFrame functions.

The filter is sized from the number of keys and bounded in bytes: with more keys than
the bound allows for, a key gets fewer bits and probes, down to one bit; beyond that
there is no filter."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenospark.sinks import materialise

#: Bits for each key, and probes at that size.
BITS, PROBES = 16, 8
#: Bits of a block, its words, and what a block takes in a broadcast relation.
_BLOCK_BITS, _WORDS, _BLOCK_BYTES = 256, 4, 80
#: Upper bound for the bytes of a filter that is broadcast.
DEFAULT_MAX_FILTER_BYTES = 64 << 20


class KeyFilter(NamedTuple):
    """The blocks of a filter (``_block, _w0 .. _w3``), how many there are, probes, keys' names and types."""

    blocks: DataFrame
    n_blocks: int
    probes: int
    keys: tuple[tuple[str, str], ...]


def key_types(df: DataFrame, on: Sequence[str]) -> tuple[tuple[str, str], ...]:
    return tuple((c, df.schema[c].dataType.simpleString()) for c in on)


def _block(on: Sequence[str], n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(*on, F.lit(1)), F.lit(n_blocks)).alias("_block")


def _masks(on: Sequence[str], probes: int) -> list[Column]:
    """The bits of a key in each word: six bits of a second hash choose one."""
    h = F.xxhash64(*on, F.lit(2))
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(probes)]
    return [reduce(Column.bitwiseOR, bits[w::_WORDS]) for w in range(min(_WORDS, probes))]


def key_filter(lookup: DataFrame, on: Sequence[str], max_bytes: int = DEFAULT_MAX_FILTER_BYTES) -> KeyFilter | None:
    """The filter of the distinct keys ``on`` of ``lookup``, or None where ``max_bytes``
    leaves less than a bit for each. Two jobs over the keys: their count, and the
    blocks, which are written once."""
    keys = lookup.select(*on).distinct()
    n = keys.count()
    n_blocks = min(max(1, math.ceil(n * BITS / _BLOCK_BITS)), max_bytes // _BLOCK_BYTES)
    bits = n_blocks * _BLOCK_BITS / max(1, n)
    if bits < 1:
        return None
    probes = max(1, min(PROBES, round(bits * math.log(2))))
    words = [F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(min(_WORDS, probes))]
    blocks = keys.select(_block(on, n_blocks), *[m.alias(f"_w{i}") for i, m in enumerate(_masks(on, probes))]).groupBy("_block").agg(*words)
    return KeyFilter(materialise(blocks, "key_filter"), n_blocks, probes, key_types(lookup, on))


def drop_unmatched(facts: DataFrame, known: KeyFilter | None) -> DataFrame:
    """The rows of ``facts`` whose key may be in the filter (all that are, and few
    others); unchanged without a filter, for a stream, or where the keys' types differ
    (equal values would hash apart). Rows do not move."""
    on = [name for name, _ in known.keys] if known else []
    if not known or facts.isStreaming or key_types(facts, on) != known.keys:
        return facts
    # The masks are columns, so that a row's key is hashed once and not for each bit.
    masks = {f"_m{i}": m for i, m in enumerate(_masks(on, known.probes))}
    held = reduce(Column.__and__, [F.col(f"_w{i}").bitwiseAND(F.col(m)) == F.col(m) for i, m in enumerate(masks)])
    return (
        facts.withColumns({"_block": _block(on, known.n_blocks), **masks})
        .join(F.broadcast(known.blocks), "_block").where(held).select(*[F.col("`" + c.replace("`", "``") + "`") for c in facts.columns])
    )
