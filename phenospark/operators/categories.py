"""Phenotype -> category mapping and its application to mentions.

The category list (``Phenotype, Category``) and the category abbreviations
(``Category, Short``) are normalised with the same rule as the codelist's
phenotypes, joined on the category into the mapping
``phenotype, category, cat``, and attached to mentions with a left join:
an unmapped phenotype gets a NULL category and is never dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.functions.names import normalise_name
from phenospark.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, lookup_join, row_bytes

MAPPING_COLUMNS = ("phenotype", "category", "cat")


def tidy_categories(
    categories: DataFrame, phenotype: str = "Phenotype", category: str = "Category"
) -> DataFrame:
    """``phenotype, category``, both normalised; rows without a phenotype are
    dropped (report them with :func:`phenospark.operators.checks.null_keys`)."""
    return categories.where(F.col(phenotype).isNotNull()).select(
        normalise_name(phenotype).alias("phenotype"),
        normalise_name(category).alias("category"),
    )


def tidy_abbreviations(
    abbreviations: DataFrame, category: str = "Category", short: str = "Short"
) -> DataFrame:
    """``category, cat`` with the category normalised."""
    return abbreviations.select(
        normalise_name(category).alias("category"), F.col(short).alias("cat")
    )


def build_mapping(
    categories: DataFrame,
    abbreviations: DataFrame,
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of tidied categories and abbreviations on ``category`` ->
    ``phenotype, category, cat``. A category without an abbreviation drops
    its phenotypes (:func:`phenospark.operators.checks.orphans` lists them)."""
    joined = lookup_join(
        tidy_categories(categories), tidy_abbreviations(abbreviations),
        "category", "inner", max_broadcast_bytes,
    )
    return joined.select(*MAPPING_COLUMNS)


def key_profile(df: DataFrame, key: str = "phenotype") -> tuple[int, int, str | None]:
    """``(bytes, number of repeated keys, one repeated key)`` in one job: the
    size check for broadcasting and the uniqueness check together."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(row_bytes(df)).alias("_bytes"))
    repeated = F.col("_n") > 1
    row = per_key.agg(
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
        F.count(F.when(repeated, F.lit(1))).alias("repeated"),
        F.min(F.when(repeated, F.col(key))).alias("example"),
    ).first()
    return int(row["bytes"]), int(row["repeated"]), row["example"]


def _fail_on_repeats(repeated: int, example, key: str) -> None:
    if repeated:
        raise ValueError(f"duplicate {key} in mapping: {repeated} keys repeat, e.g. {example!r}")


def assert_unique_keys(df: DataFrame, key: str = "phenotype") -> DataFrame:
    """Raise when a key occurs twice; a lookup join on such a key would
    multiply the rows it is applied to. Returns ``df`` for chaining."""
    _, repeated, example = key_profile(df, key)
    _fail_on_repeats(repeated, example, key)
    return df


def categorise(
    mentions: DataFrame,
    mapping: DataFrame,
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
    check_unique: bool = True,
) -> DataFrame:
    """Mentions + ``category`` (NULL when the phenotype is unmapped), by a
    left join on ``phenotype``; mention columns keep their order, and an
    existing ``category`` column is replaced.

    One job over the mapping checks that its keys are unique and sums its
    bytes for the broadcast decision."""
    lookup = mapping.select("phenotype", "category")
    mentions = mentions.drop("category")
    broadcast = size = None
    if check_unique:
        size, repeated, example = key_profile(lookup, "phenotype")
        _fail_on_repeats(repeated, example, "phenotype")
        if max_broadcast_bytes is not None:
            broadcast = size <= max_broadcast_bytes
    joined = lookup_join(mentions, lookup, "phenotype", "left", max_broadcast_bytes, broadcast, lookup_bytes=size)
    return joined.select(*mentions.columns, "category")


#: Bytes of a mapping that may become one map value of the plan.
MAX_MAP_BYTES = 4 << 20


def categorise_map(mentions: DataFrame, mapping: DataFrame, max_map_bytes: int = MAX_MAP_BYTES) -> DataFrame:
    """Same result as :func:`categorise`, through a ``map`` looked up in the
    projection (no join in the plan). The map is a scalar subquery over the mapping, so
    Spark builds it when the query runs and nothing is collected here; a mapping of more
    than ``max_map_bytes`` (by measure) is an error, since every task would hold it as
    one value: it belongs in :func:`categorise`. Keys must be unique; an existing
    ``category`` column is replaced."""
    lookup = mapping.select("phenotype", "category").where(F.col("phenotype").isNotNull())
    size, repeated, example = key_profile(lookup, "phenotype")
    _fail_on_repeats(repeated, example, "phenotype")
    if size > max_map_bytes:
        raise ValueError(f"the mapping has {size} bytes, the map form takes {max_map_bytes}: use categorise()")
    table = lookup.agg(F.map_from_entries(F.collect_list(F.struct("phenotype", "category"))).alias("table"))
    return mentions.drop("category").withColumn("category", F.try_element_at(table.scalar(), F.col("phenotype")))
