"""Master codelist: ``phenotype, terminology, code`` (all strings).

The codes of every codelist source arrive as one long DataFrame
``(source, code)`` — from one multi-file scan per terminology
(:func:`phenospark.sources.codelists.read_code_files`) or from a set of
tables — and are joined to the catalog on the source name. The plan has the
same size for 6 or 6,000 codelists.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.functions.names import strip_dots
from phenospark.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, lookup_join
from phenospark.operators.reshape import melt_codes

CODELIST_COLUMNS = ("phenotype", "terminology", "code")

# Terminologies whose codes are stored without dots in the
# records (Read codes keep theirs: a dot is part of the code).
DOTLESS_TERMINOLOGIES = ("ICD", "OPCS", "SNOMEDCT")

# Fixed value: the catalog terminology left out of the master codelist (its
# two-column sources are handled by :func:`two_column_codes`).
EXCLUDED_TERMINOLOGIES = ("CPRD",)

# Catalog terminologies whose sources hold several vocabularies; when they
# are built, each code keeps the vocabulary of its column (Readcode, Medcode).
SPLIT_TERMINOLOGIES = ("CPRD",)


def tidy_codes(
    codelist: DataFrame, dotless: Sequence[str] = DOTLESS_TERMINOLOGIES
) -> DataFrame:
    """Strip dots from the codes of the ``dotless`` terminologies."""
    code = F.when(F.col("terminology").isin(*dotless), strip_dots("code")).otherwise(F.col("code"))
    return codelist.withColumn("code", code)


def build_codelist(
    catalog: DataFrame,
    codes: DataFrame,
    source_col: str = "source",
    code_col: str = "code",
    exclude: Sequence[str] = EXCLUDED_TERMINOLOGIES,
    dotless: Sequence[str] = DOTLESS_TERMINOLOGIES,
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
    split: Sequence[str] = SPLIT_TERMINOLOGIES,
) -> DataFrame:
    """Join the codes of all sources to the catalog and tidy them.

    ``catalog``: ``phenotype, terminology, table`` (more columns are ignored).
    ``codes``: one row per code with the name of its source in ``source_col``
    (the catalog's ``table``). A source listed for two phenotypes gives its
    codes to both; a catalog row without a source gives nothing (see
    :func:`phenospark.operators.checks.missing_sources`).

    The terminology is the catalog's, except for the ``split`` ones (CPRD,
    when not excluded): their codes keep the vocabulary of the column they
    were read from, if ``codes`` carries a ``terminology`` column."""
    entries = catalog.select(
        "phenotype", "terminology", F.col("table").alias(source_col)
    )
    if exclude:
        entries = entries.where(~F.col("terminology").isin(*exclude))
    per_column = "terminology" in codes.columns and bool(split)
    facts = codes.select(
        source_col,
        F.col(code_col).cast("string").alias("code"),
        *([F.col("terminology").alias("_column_terminology")] if per_column else []),
    )
    joined = lookup_join(facts, entries, source_col, "inner", max_broadcast_bytes)
    if per_column:
        term = F.when(F.col("terminology").isin(*split), F.col("_column_terminology")).otherwise(
            F.col("terminology"))
        joined = joined.withColumn("terminology", term)
    return tidy_codes(joined.select(*CODELIST_COLUMNS), dotless)


def two_column_codes(
    df: DataFrame,
    columns: Mapping[str, str],
    id_vars: Sequence[str] = ("phenotype",),
) -> DataFrame:
    """Codes held in several columns of one source (Read and Med codes)
    -> ``id_vars..., terminology, code``; ``columns`` maps each column to its
    terminology. NULL codes are dropped."""
    slots: dict[str, list[str]] = {}
    for column, term in columns.items():
        slots.setdefault(term, []).append(column)
    long = melt_codes(df, id_vars, slots)
    return long.select(*id_vars, "terminology", "code")
