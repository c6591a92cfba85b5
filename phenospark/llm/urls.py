"""URL filter by a cascade of Bloom filters, in DataFrame functions only.

A rule list (host, path, action) is turned into keys ``host + path``. The key
universe of a corpus is every key a url of the corpus could match: each suffix
of its host by whole labels, with each prefix of its path that has the length
of some rule's path. For the rules of one action the cascade's level 0 encodes
the listed keys, level 1 the keys of the universe that pass level 0 without
being listed, level 2 the listed keys that pass level 1, and so on until a
level has no false positive. A key of the universe is then listed if and only
if the first level that rejects it is odd (or it passes all of an odd number
of levels): exact membership by bit tests, with no join at judging time.

Level 0 is sized so that about as many unlisted keys pass as are listed, and
every further level is much smaller, so all filters together stay within a few
bytes per rule times log2(universe / rules) bits, whatever the corpus. Rules are
a list the caller holds on the driver, so that bound is the list's own. The
bits travel as binary constants of the plan. Comparing keys with the list (while
building) touches only the few that a filter passes.

Defined results: a null url, or one without ``://``, has empty host and path,
matches no rule and gets the default verdict; ports and user names stay part of
the host; paths are compared as they stand, case kept. Repeated rows are judged
alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenospark.sinks import materialise

Rule = tuple[str, str, str]

#: Bits per key and probes of the levels after the first (about 1 in 300 unlisted keys pass).
BITS, PROBES = 12, 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def candidate_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Array of the keys a url could match, the longest first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths])
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(s, p))))
    by_length = F.array_sort(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))
    return F.transform(F.reverse(by_length), lambda k: k["key"])


class Level:
    """One Bloom filter: its bits, how many there are, probes and seed."""

    def __init__(self, data: bytes, bits: int, probes: int, seed: int):
        self.data, self.bits, self.probes, self.seed = data, bits, probes, seed

    def passes(self, key: Column) -> Column:
        """Whether all of the key's bits are set."""
        def is_set(at: Column) -> Column:
            byte = F.substr(F.lit(self.data), F.floor(at / 8).cast("int") + F.lit(1), F.lit(1))
            return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
        return reduce(Column.__and__, [is_set(at) for at in _positions(key, self.bits, self.probes, self.seed)])


def _positions(key: Column, bits: int, probes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits)) for i in range(probes)]


def _build_level(keys: DataFrame, count: int, seed: int, bits_per_key: float, probes: int) -> Level:
    """The filter of a column ``key``: bits are or-ed by byte in the executors,
    and only the filter's bytes come to the driver."""
    bits = max(64, 8 * math.ceil(count * bits_per_key / 8))
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, probes, seed))).alias("at"))
    found = (
        at.groupBy(F.floor(F.col("at") / 8).cast("int").alias("byte"))
        .agg(F.bit_or(F.pow(F.lit(2), F.col("at") % 8).cast("int")).alias("value"))
        .collect()
    )
    data = bytearray(bits // 8)
    for row in found:
        data[row["byte"]] = row["value"]
    return Level(bytes(data), bits, probes, seed)


def build_cascade(listed: DataFrame, universe: DataFrame, universe_size: int, seed: int) -> list[Level]:
    """The levels for ``listed`` over ``universe`` (both one column ``key``, distinct)."""
    n = listed.count()
    if not n:
        return []
    probes = max(1, round(math.log2(max(2.0, universe_size / n))))
    levels = [_build_level(listed, n, seed, probes / math.log(2), probes)]
    inside = listed
    outside = materialise(
        universe.where(levels[0].passes(F.col("key"))).join(listed, "key", "left_anti"), "url_cascade")
    while n := outside.count():
        levels.append(_build_level(outside, n, seed + len(levels), BITS, PROBES))
        inside, outside = outside, materialise(inside.where(levels[-1].passes(F.col("key"))), "url_cascade")
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: the parity of the first level that rejects it."""
    out = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        out = F.when(~levels[i].passes(key), F.lit(i % 2 == 1)).otherwise(out)
    return out


def _keys(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.split(F.lit("\n".join(keys)), "\n")).alias("key")).distinct()


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    The longest listed key decides; ``default`` where none is listed. A key
    listed twice is an error (its action would be open)."""
    listed = [h + p for h, p, _ in rules]
    if len(set(listed)) != len(listed):
        raise ValueError("a rule is listed twice")
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not rules:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = candidate_keys(F.col("host"), F.col("path"), sorted({len(p) for _, p, _ in rules}))
    # Only the first characters of a path take part: hosts with those are pre-aggregated before they are expanded.
    longest = max(len(p) for _, p, _ in rules)
    universe = materialise(
        parts.select("host", F.substring("path", 1, longest).alias("path")).distinct()
        .select(F.explode(keys).alias("key")).distinct(), "url_universe")
    size = universe.count()
    cascades = {
        action: build_cascade(_keys(pages.sparkSession, [h + p for h, p, a in rules if a == action]), universe, size, 1000 * i)
        for i, action in enumerate(sorted({a for _, _, a in rules}))
    }
    hits = F.filter(keys, lambda k: reduce(Column.__or__, [member(levels, k) for levels in cascades.values()]))
    judged = parts.withColumn("rule", F.get(hits, F.lit(0)))
    verdict = F.lit(default)
    for action, levels in cascades.items():
        verdict = F.when(F.col("rule").isNotNull() & member(levels, F.col("rule")), F.lit(action)).otherwise(verdict)
    return judged.withColumn("verdict", verdict)
