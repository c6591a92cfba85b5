"""Distinct counts for many cuts from one stored table of sketches.

An exact distinct count of people has to be made again for every cut (a source, a
year, a range of years, any of them together), each time moving the distinct people.
Here mentions are summed once per ``by`` value (for instance source and year) into a
row of counts and two HyperLogLog sketches, of people and of phenotypes; a sketch is a
few kilobytes whatever it has seen, and sketches of any rows unite, so every cut is
answered from the small table. Counts of mentions stay exact; the sketches' relative
standard error is :func:`relative_error` of their size. A row of the exact counts next
to the estimates says how far off a cut is (:func:`with_exact`)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenospark.operators.mentions import PERSON

#: log2 of a sketch's buckets: 4,096 buckets, an error of about 1.6 %.
LOG_BUCKETS = 12


def relative_error(log_buckets: int = LOG_BUCKETS) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / math.sqrt(2**log_buckets)


def _value(column: str) -> Column:
    """What a sketch takes: text."""
    return F.col(column).cast("string")


def sketch_coverage(mentions: DataFrame, by: Sequence[str], log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """``by..., mentions, people, phenotypes``: per value of ``by`` the number of
    mentions and the sketches of its people and phenotypes. Partial sketches are made
    where the mentions are, so what is shuffled is a sketch per task and value."""
    return mentions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("mentions"),
        F.hll_sketch_agg(_value(PERSON), F.lit(log_buckets)).alias("people"),
        F.hll_sketch_agg(_value("phenotype"), F.lit(log_buckets)).alias("phenotypes"))


def unite_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`sketch_coverage` (of any number of stored tables) united per
    value of ``by``, fewer columns than they were made by, or none for one row of all.
    Sketches of overlapping rows unite exactly; the counts of mentions add up."""
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("mentions"), F.lit(0)).cast("bigint").alias("mentions"),
        F.hll_union_agg("people").alias("people"), F.hll_union_agg("phenotypes").alias("phenotypes"))


def estimates(sketches: DataFrame) -> DataFrame:
    """The sketches as ``unique_pts_estimate, phenotypes_estimate``."""
    return sketches.withColumns({
        "unique_pts_estimate": F.coalesce(F.hll_sketch_estimate("people"), F.lit(0)),
        "phenotypes_estimate": F.coalesce(F.hll_sketch_estimate("phenotypes"), F.lit(0))}).drop("people", "phenotypes")


def coverage_of_cuts(sketches: DataFrame, cuts: Sequence[Sequence[str]], by: Sequence[str]) -> DataFrame:
    """``by..., cut, mentions, unique_pts_estimate, phenotypes_estimate`` for every one of
    ``cuts``, each a choice of the columns ``by`` (the others are NULL in its rows): one
    pass over the sketch table (grouping sets)."""
    sets = [[F.col(c) for c in cut] for cut in cuts]
    united = sketches.groupingSets(sets, *by).agg(
        F.grouping_id(*by).alias("cut"), F.sum("mentions").alias("mentions"),
        F.hll_union_agg("people").alias("people"), F.hll_union_agg("phenotypes").alias("phenotypes"))
    return estimates(united)


def with_exact(found: DataFrame, mentions: DataFrame, cuts: Sequence[Sequence[str]], by: Sequence[str]) -> DataFrame:
    """The cuts with exact ``unique_pts`` and ``phenotypes`` and the measured relative
    errors ``unique_pts_error, phenotypes_error`` of the estimates."""
    sets = [[F.col(c) for c in cut] for cut in cuts]

    def exact(column: str, name: str) -> DataFrame:
        # Distinct per finest value first: the cuts multiply those rows, not the mentions.
        return mentions.select(*by, column).distinct().groupingSets(sets, *by).agg(
            F.grouping_id(*by).alias("cut"), F.count_distinct(column).alias(name))

    def same(one: str, other: str) -> Column:
        return reduce(Column.__and__, [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in [*by, "cut"]])

    e = exact(PERSON, "unique_pts").alias("p").join(exact("phenotype", "phenotypes").alias("q"), same("p", "q")).select("p.*", "q.phenotypes")
    joined = found.alias("f").join(e.alias("e"), same("f", "e"))

    def error(name: str) -> Column:
        off = F.abs(F.col(f"f.{name}_estimate") - F.col(f"e.{name}"))
        return F.when(F.col(f"e.{name}") > 0, off / F.col(f"e.{name}")).otherwise(off.cast("double")).alias(f"{name}_error")

    return joined.select("f.*", "e.unique_pts", "e.phenotypes", error("unique_pts"), error("phenotypes"))
