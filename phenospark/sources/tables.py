"""Readers for the workflow's small text inputs and its record tables.

The dictionary, the category list and the abbreviations are CSV files with a
header row (RFC-4180 quoting; an empty cell is NULL). They are read with a
declared all-string schema, never inferred, and stay distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DICTIONARY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("phenotype", "CPRD", "ICD", "OPCS")]
)
CATEGORY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("Phenotype", "Category")]
)
ABBREVIATION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("Category", "Short")]
)


def read_csv_table(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema; columns are matched by position and
    the header is checked against the schema's names."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_dictionary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``phenotype, CPRD, ICD, OPCS`` — codelist file names per phenotype."""
    return read_csv_table(spark, path, DICTIONARY_SCHEMA)


def read_categories(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``Phenotype, Category``."""
    return read_csv_table(spark, path, CATEGORY_SCHEMA)


def read_abbreviations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``Category, Short``."""
    return read_csv_table(spark, path, ABBREVIATION_SCHEMA)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A record table: a metastore name (``db.table``) or a path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)
