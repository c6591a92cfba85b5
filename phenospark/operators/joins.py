"""Lookup joins with a checked broadcast and a salted fallback.

A lookup side (codelist, catalog, category mapping) is broadcast only after
its size in bytes has been summed and checked against a bound. Above the bound
the join is a sort-merge join that must survive a hot key (one code holding a
third of all records). A lookup whose copies stay small is salted: the fact rows get
a salt from a hash of their content and of the partition they are in, the lookup rows
are replicated once per salt value, and the join key is ``(keys..., salt)``, so a hot
key, and even copies of one hot record, are spread over many tasks. A retried task
reads the same rows in the same partition, so it sends every row to the same place
again. A larger lookup is sent once (:func:`keyed_join`), and a hot key's partition is
cut by AQE's skew join. Facts whose key is not in the lookup need no exchange at all: a
Bloom filter of the lookup's keys (:mod:`phenospark.operators.bloom`) drops them first,
map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenospark.operators.bloom import DEFAULT_MAX_FILTER_BYTES, drop_unmatched, key_filter, key_types

# Upper bound for the bytes of a lookup side that is broadcast.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20

SALTABLE_JOINS = ("inner", "left", "leftouter", "left_outer", "left_semi", "leftsemi",
                  "semi", "left_anti", "leftanti", "anti")

#: Joins that keep only facts with a match, so others can be dropped early.
MATCHING_JOINS = ("inner", "left_semi", "leftsemi", "semi")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: its strings' bytes, and 16 for every column."""
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
               if f.dataType.simpleString() in ("string", "binary")]
    return sum(strings, F.lit(16 * len(df.columns))).cast("bigint")


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of all rows, by one aggregate; one number reaches the driver."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


def fits(df: DataFrame, max_bytes: int) -> bool:
    """Whether ``df`` is small enough to be sent to every task."""
    return size_in_bytes(df) <= max_bytes


#: Most salt values of the fallback. The lookup is copied once for each, so they don't grow with the cluster: a key
#: with a third of all rows is cut into 32 parts, and what is still too large for a task AQE's skew join cuts further.
MAX_SALTS = 32


#: Bytes that the salted copies of a lookup may take together.
MAX_REPLICATED_BYTES = DEFAULT_MAX_BROADCAST_BYTES


def salt_count(df: DataFrame) -> int:
    """Salt values of the fallback: as many as the session's shuffle has
    partitions, up to ``MAX_SALTS``."""
    return min(MAX_SALTS, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_buckets: int | None = None,
) -> DataFrame:
    """Sort-merge join with the facts spread by a salt (default: :func:`salt_count`
    values). Exact for inner, left outer, semi and anti joins: every
    salt value of a key exists on the lookup side, so each fact row meets
    exactly the rows it would meet without the salt. Streams are salted by their
    content alone."""
    salt_buckets = salt_buckets or salt_count(facts)
    spread_by = [F.col("`" + c.replace("`", "``") + "`") for c in facts.columns]
    if not facts.isStreaming:
        spread_by.append(F.spark_partition_id())
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salt_buckets))
    spread = facts.withColumn("_salt", salt.cast("int"))
    replicated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return spread.join(replicated.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _splits_skew(df: DataFrame) -> bool:
    """Whether Spark cuts the skewed partitions of a join of ``df`` itself."""
    conf = df.sparkSession.conf
    return not df.isStreaming and all(conf.get(f"spark.sql.adaptive.{k}", "true") == "true" for k in ("enabled", "skewJoin.enabled"))


def salts_for(facts: DataFrame, lookup: DataFrame, lookup_bytes: int | None = None) -> int:
    """Salt values of the fallback for a lookup of ``lookup_bytes`` (summed here when not
    given): :func:`salt_count`, but where Spark splits skewed joins only as many as keep
    the copies within ``MAX_REPLICATED_BYTES``, so that what a lookup adds to the shuffle
    grows with the lookup and not with 32 copies of it."""
    most = salt_count(facts)
    if not _splits_skew(facts):
        return most
    size = size_in_bytes(lookup) if lookup_bytes is None else lookup_bytes
    return max(1, min(most, MAX_REPLICATED_BYTES // max(1, size)))


def keyed_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Sort-merge join with one copy of the lookup. A hash of the keys leads the join's
    keys: rows sort by a number before their strings are compared, and as the hash is
    dropped, what follows does not build on this partitioning, so AQE may cut a hot key's
    partition. The keys' types are the same on both sides (equal values hash alike)."""
    at = F.xxhash64(*["`" + c.replace("`", "``") + "`" for c in on])
    return facts.withColumn("_at", at).join(lookup.withColumn("_at", at).hint("merge"), ["_at", *on], how).drop("_at")


#: Parts into which a key's rows are cut by :func:`grouped_lookup_join`, and bytes of a
#: lookup that one of its tasks may hold as a hash table.
GROUP_CUTS, MAX_HASHED_BYTES = 4, 64 << 20


def grouped_lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    by: Sequence[str],
    aggs: Sequence[Column] = (),
    how: str = "inner",
    cuts: int = GROUP_CUTS,
    lookup_bytes: int | None = None,
) -> DataFrame:
    """``facts`` grouped by ``by`` (the columns ``on`` are among them; with ``aggs``, or
    without: their distinct rows), then joined to a lookup too large to broadcast, by one
    exchange of the facts for both. They move by the join's keys and a cut, a hash of the
    group's other columns: rows of one group meet, and a hot key's groups are spread over
    ``cuts`` tasks. The lookup is sent once for every cut; where its ``lookup_bytes``, spread
    over the shuffle's partitions, are at most ``MAX_HASHED_BYTES`` each, a task holds its
    part as a hash table and sorts nothing, else (or with none given) both sides are
    sorted and merged. Only for inner and left joins."""
    others = [c for c in by if c not in on]
    cut = F.pmod(F.xxhash64(*["`" + c.replace("`", "``") + "`" for c in others]), F.lit(cuts)) if others else F.lit(0)
    names = ["`" + c.replace("`", "``") + "`" for c in (*on, *others)]
    placed = facts.withColumn("_cut", cut.cast("int")).repartition(*names[: len(on)], "_cut")
    grouped = placed.groupBy(*names, "_cut").agg(*aggs) if aggs else placed.select(*names, "_cut").dropDuplicates()
    copies = lookup.withColumn("_cut", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))))
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = lookup_bytes is not None and lookup_bytes * cuts <= partitions * MAX_HASHED_BYTES
    return grouped.join(copies.hint("shuffle_hash" if hashed else "merge"), [*on, "_cut"], how).drop("_cut")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
    broadcast: bool | None = None,
    salt_buckets: int | None = None,
    max_filter_bytes: int = DEFAULT_MAX_FILTER_BYTES,
    lookup_bytes: int | None = None,
) -> DataFrame:
    """Join a large ``facts`` side to a ``lookup`` side on equal keys.

    ``broadcast=True/False`` applies a decision the caller already checked
    (e.g. once for a codelist used by several joins); ``None`` checks here
    against ``max_broadcast_bytes``. ``max_broadcast_bytes=None`` with
    ``broadcast=None`` leaves the choice to the planner (its size estimate,
    then AQE's runtime statistics). When the lookup does not fit, the facts that
    match nothing are dropped by a filter of its keys of at most
    ``max_filter_bytes`` (0: none; inner and semi joins of batch data), and the
    join is salted (``salt_buckets=1``: a plain shuffle join; default: :func:`salts_for`
    the ``lookup_bytes``, summed here when not given, and with one value the
    :func:`keyed_join`)."""
    keys = [on] if isinstance(on, str) else list(on)
    if broadcast is None and max_broadcast_bytes is not None:
        lookup_bytes = size_in_bytes(lookup)
        broadcast = lookup_bytes <= max_broadcast_bytes
    if broadcast:
        return facts.join(F.broadcast(lookup), keys, how)
    if broadcast is False and how.lower() in MATCHING_JOINS and not facts.isStreaming and max_filter_bytes:
        facts = drop_unmatched(facts, key_filter(lookup, keys, max_filter_bytes))
    if broadcast is False and salt_buckets != 1 and how.lower() in SALTABLE_JOINS:
        if salt_buckets is None and key_types(facts, keys) == key_types(lookup, keys):
            salt_buckets = salts_for(facts, lookup, lookup_bytes)
            if salt_buckets == 1:
                return keyed_join(facts, lookup, keys, how)
        return salted_join(facts, lookup, keys, how, salt_buckets)
    return facts.join(lookup, keys, how)
