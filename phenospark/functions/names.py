"""Column functions for names and codes.

Every function takes a column name or ``Column`` and returns a ``Column``; all
are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they define join keys, so they must equal the reference's):
# the name normaliser deletes these five characters ...
REMOVED_CHARACTERS = "'(),&"
# ... turns these two into underscores, and lower-cases the rest.
UNDERSCORED_CHARACTERS = "/ "

# Fixed value: the file extension stripped from codelist file names.
CODELIST_EXTENSION = ".csv"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(c: str | Column) -> Column:
    """Phenotype / category key: drop ``' ( ) , &``, map ``/`` and every space
    to ``_``, lower-case. ``'A & B'`` becomes ``'a__b'``. NULL stays NULL.

    One ``translate`` pass: the rules touch disjoint characters, so the order
    in which they are applied does not matter.
    """
    mapped = F.translate(
        as_column(c),
        UNDERSCORED_CHARACTERS + REMOVED_CHARACTERS,
        "_" * len(UNDERSCORED_CHARACTERS),
    )
    return F.lower(mapped)


def strip_dots(c: str | Column) -> Column:
    """Remove every ``.`` from a code (``'I21.0'`` -> ``'I210'``)."""
    return F.translate(as_column(c), ".", "")


def strip_extension(c: str | Column, extension: str = CODELIST_EXTENSION) -> Column:
    """Drop a trailing file extension (``'ICD_AAA.csv'`` -> ``'ICD_AAA'``)."""
    pattern = "\\." + extension.lstrip(".").replace(".", "\\.") + "$"
    return F.regexp_replace(as_column(c), pattern, "")


def with_suffix(c: str | Column, suffix: str) -> Column:
    """``c || suffix``; NULL stays NULL."""
    return F.concat(as_column(c), F.lit(suffix))


def with_prefix(c: str | Column, prefix: str) -> Column:
    """``prefix || c``; NULL stays NULL."""
    return F.concat(F.lit(prefix), as_column(c))


def qualified_name(database: str | Column | None, table: str | Column) -> Column:
    """``database.table``; just ``table`` when there is no database."""
    if database is None:
        return as_column(table)
    db = F.lit(database) if isinstance(database, str) else database
    return F.concat_ws(".", db, as_column(table))


def file_stem(path: str | Column) -> Column:
    """Base name of a path or URI without its extension:
    ``'s3://b/x/codelist_icd_aaa.csv'`` -> ``'codelist_icd_aaa'``."""
    base = F.regexp_extract(as_column(path), r"([^/]+)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")
