"""Integrity checks between the tables of the workflow.

Each returns the offending keys as a DataFrame (empty = clean), so a caller
can count, show or write them; none drops or repairs anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unmapped(left: DataFrame, right: DataFrame, key: str = "phenotype") -> DataFrame:
    """Distinct ``key`` values of ``left`` that ``right`` lacks (e.g. codelist
    phenotypes without a category)."""
    keys = left.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(right.select(key).distinct(), key, "left_anti")


def orphans(right: DataFrame, left: DataFrame, key: str = "phenotype") -> DataFrame:
    """Distinct ``key`` values of ``right`` that ``left`` never uses (e.g.
    categorised phenotypes without codes). The mirror of :func:`unmapped`."""
    return unmapped(right, left, key)


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their count ``n``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is NULL."""
    return df.where(F.col(key).isNull())


def missing_sources(catalog: DataFrame, sources: DataFrame, source_col: str = "source") -> DataFrame:
    """Catalog rows whose table has no source (file or table) at all."""
    present = sources.select(F.col(source_col).alias("table")).distinct()
    return catalog.join(present, "table", "left_anti")
