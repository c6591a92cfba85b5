"""Dictionary -> codelist catalog.

The dictionary is wide: one row per phenotype, one codelist file name per
terminology (``phenotype, CPRD, ICD, OPCS``; empty cell = no list). The
catalog is long: one row per (phenotype, terminology) naming the source table
that holds the codes: ``phenotype, terminology, table, database, path``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.operators.reshape import map_columns
from phenospark.functions.names import (
    normalise_name,
    qualified_name,
    strip_extension,
    with_prefix,
    with_suffix,
)

# The dictionary's file columns, the terminology derived from the
# CPRD lists (SNOMED CT versions of them) and the suffix naming those tables.
FILE_COLUMNS = ("CPRD", "ICD", "OPCS")
DERIVED_TERMINOLOGY = "SNOMEDCT"
DERIVED_FROM = "CPRD"
DERIVED_SUFFIX = "_snomedct"

# Naming prefix of the codelist tables in the user's store (a deployment
# setting: pass the one your tables carry).
DEFAULT_TABLE_PREFIX = "codelist_"

CATALOG_COLUMNS = ("phenotype", "terminology", "table", "database", "path")


def to_catalog(
    dictionary: DataFrame,
    prefix: str = DEFAULT_TABLE_PREFIX,
    database: str | None = None,
    file_columns: Sequence[str] = FILE_COLUMNS,
    derived_from: str | None = DERIVED_FROM,
    derived_terminology: str = DERIVED_TERMINOLOGY,
    derived_suffix: str = DERIVED_SUFFIX,
) -> DataFrame:
    """Unpivot the dictionary into the catalog.

    Per cell: strip ``.csv``; add the derived SNOMED CT table name (the CPRD
    name + ``_snomedct``, only where a CPRD list exists); one row per non-NULL
    cell; lower-case and prefix the table name; normalise the phenotype.
    A phenotype without any file yields no row."""
    stripped = map_columns(dictionary.select("phenotype", *file_columns), strip_extension, file_columns)
    names = {c: F.col(c) for c in file_columns}
    if derived_from is not None:
        names[derived_terminology] = with_suffix(derived_from, derived_suffix)
    wide = stripped.select("phenotype", *[expr.alias(term) for term, expr in names.items()])
    long = wide.unpivot("phenotype", list(names), "terminology", "table").na.drop("any")
    table = with_prefix(F.lower("table"), prefix)
    return long.select(
        normalise_name("phenotype").alias("phenotype"),
        "terminology",
        table.alias("table"),
        F.lit(database).cast("string").alias("database"),
        qualified_name(database, table).alias("path"),
    )


def without_terminology(catalog: DataFrame, terminology: str = "CPRD") -> DataFrame:
    """Catalog rows of every other terminology (rows with a NULL terminology
    are dropped too, as an SQL ``!=`` does)."""
    return catalog.where(F.col("terminology") != F.lit(terminology))
