"""Coverage summaries: one function per count the workflow reports.

Each returns a small DataFrame; distinct counts are exact (Spark plans several
``count(DISTINCT ...)`` in one aggregate with ``Expand``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.operators.bloom import drop_unmatched, key_filter
from phenospark.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, grouped_lookup_join, lookup_join, size_in_bytes
from phenospark.operators.mentions import PERSON


def codelist_totals(codelist: DataFrame) -> DataFrame:
    """``n_codes`` (non-NULL codes, repeats counted), ``n_phenotypes``."""
    return codelist.agg(
        F.count("code").alias("n_codes"),
        F.count_distinct("phenotype").alias("n_phenotypes"),
    )


def _distinct_codes(by_terminology: bool):
    """Distinct codes; a code string used by two vocabularies counts once
    unless ``by_terminology`` counts ``(terminology, code)`` pairs."""
    if by_terminology:
        return F.count_distinct("terminology", "code")
    return F.count_distinct("code")


def codelist_per_phenotype(codelist: DataFrame, by_terminology: bool = False) -> DataFrame:
    """``phenotype, n_codes, n_terminologies`` (distinct counts)."""
    return codelist.groupBy("phenotype").agg(
        _distinct_codes(by_terminology).alias("n_codes"),
        F.count_distinct("terminology").alias("n_terminologies"),
    )


def codelist_phenotypes(codelist: DataFrame) -> DataFrame:
    """Distinct phenotypes of a codelist."""
    return codelist.select("phenotype").distinct()


def coverage(mentions: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """``mentions, unique_pts, phenotypes`` of a mention table.

    Exact by default. ``approx_rsd`` (e.g. 0.01) switches the two distinct
    counts to HyperLogLog sketches: one pass, merged map-side, no shuffle of
    the distinct values — for quick looks at very large tables."""
    if approx_rsd is None:
        people = F.count_distinct(PERSON)
        phenotypes = F.count_distinct("phenotype")
    else:
        people = F.approx_count_distinct(PERSON, approx_rsd)
        phenotypes = F.approx_count_distinct("phenotype", approx_rsd)
    return mentions.agg(
        F.count(F.lit(1)).alias("mentions"),
        people.alias("unique_pts"),
        phenotypes.alias("phenotypes"),
    )


def duplicate_volume(mentions: DataFrame) -> DataFrame:
    """``n_raw, n_dedup, n_duplicates`` of a raw mention table, in one
    aggregation over its distinct rows (raw = sum of multiplicities)."""
    per_row = mentions.groupBy(*mentions.columns).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_row.agg(
        F.sum("_n").alias("n_raw"), F.count(F.lit(1)).alias("n_dedup")
    )
    return totals.select(
        F.coalesce(F.col("n_raw"), F.lit(0)).cast("bigint").alias("n_raw"),
        "n_dedup",
        (F.coalesce(F.col("n_raw"), F.lit(0)) - F.col("n_dedup")).cast("bigint").alias("n_duplicates"),
    )


def mention_volumes(
    codelist: DataFrame,
    narrow: DataFrame | None = None,
    wide: DataFrame | None = None,
    narrow_terminology: str = "SNOMEDCT",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Every count of the mentions stage from one pass over each source: raw and
    deduplicated mentions, duplicates, people and phenotypes, and the narrow
    source's own raw coverage.

    Copies of a record are counted first, and so are repeated codelist rows; each
    distinct record then meets the distinct codelist once, and a mention's raw
    multiplicity is the product of the two counts. With a codelist too large to
    broadcast, records that match nothing are dropped where they are read and one
    exchange serves both the counts and the join."""
    sources = []
    if narrow is not None:
        sources.append(narrow.select(PERSON, "date", "code", F.lit(narrow_terminology).alias("terminology"),
                                     F.lit(1).alias("_narrow")))
    if wide is not None:
        sources.append(wide.select(PERSON, "date", "code", "terminology", F.lit(0).alias("_narrow")))
    keys = [PERSON, "date", "code", "terminology"]
    records = reduce(DataFrame.unionByName, sources)
    counts = [F.count(F.lit(1)).alias("_copies"), F.sum("_narrow").alias("_narrow")]
    listed = codelist.groupBy("phenotype", "terminology", "code").agg(F.count(F.lit(1)).alias("_listed"))
    on = ["terminology", "code"]
    size = size_in_bytes(listed)
    if size <= max_broadcast_bytes:
        found = lookup_join(records.groupBy(*keys).agg(*counts), listed, on, "inner", None, True)
    else:
        known = drop_unmatched(records.where(F.col("code").isNotNull()), key_filter(listed, on))
        found = grouped_lookup_join(known, listed, on[::-1], keys, counts, lookup_bytes=size if max_broadcast_bytes else None)
    in_narrow = F.col("_narrow") > 0
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return found.agg(
        total(F.col("_copies") * F.col("_listed")).alias("n_raw"),
        F.count(F.lit(1)).alias("n_dedup"),
        (total(F.col("_copies") * F.col("_listed")) - F.count(F.lit(1))).alias("n_duplicates"),
        F.count_distinct(PERSON).alias("unique_pts"),
        F.count_distinct("phenotype").alias("phenotypes"),
        total(F.col("_narrow") * F.col("_listed")).alias("narrow_raw"),
        F.count_distinct(F.when(in_narrow, F.col(PERSON))).alias("narrow_pts"),
        F.count_distinct(F.when(in_narrow, F.col("phenotype"))).alias("narrow_phenotypes"),
    )


def category_sizes(mapping: DataFrame) -> DataFrame:
    """``category, cat, n_phenotypes`` of a category mapping."""
    return mapping.groupBy("cat", "category").agg(
        F.count_distinct("phenotype").alias("n_phenotypes")
    ).select("category", "cat", "n_phenotypes")


def codes_per_category(categorised: DataFrame, by_terminology: bool = False) -> DataFrame:
    """``category, n_codes``; unmapped mentions form the NULL group."""
    return categorised.groupBy("category").agg(_distinct_codes(by_terminology).alias("n_codes"))


def codes_per_phenotype(mentions: DataFrame, by_terminology: bool = False) -> DataFrame:
    """``phenotype, n_codes`` seen in a mention table."""
    return mentions.groupBy("phenotype").agg(_distinct_codes(by_terminology).alias("n_codes"))
