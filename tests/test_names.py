import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from phenospark.functions import (
    code_columns_for,
    code_columns_for_name,
    file_stem,
    normalise_name,
    qualified_name,
    strip_dots,
    strip_extension,
    with_prefix,
    with_suffix,
)


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "raw, key",
    [
        ("Crohn's disease", "crohns_disease"),
        ("Lupus erythematosus (local and systemic)", "lupus_erythematosus_local_and_systemic"),
        ("Postviral fatigue syndrome, neurasthenia and fibromyalgia",
         "postviral_fatigue_syndrome_neurasthenia_and_fibromyalgia"),
        ("Enthesopathies & synovial disorders", "enthesopathies__synovial_disorders"),
        ("Dermatitis (atopc/contact/other/unspecified)", "dermatitis_atopc_contact_other_unspecified"),
        ("Haematological/Immunological conditions", "haematological_immunological_conditions"),
        (None, None),
    ],
)
def test_normalise_name(spark, raw, key):
    assert _one(spark, normalise_name, raw) == key


def test_normalise_name_is_idempotent(spark):
    df = spark.createDataFrame([("A (b)/c, d & e's",), ("x  y",)], "x string")
    once = df.select(normalise_name("x").alias("x"))
    twice = once.select(normalise_name("x").alias("x"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_code_and_file_helpers(spark):
    assert _one(spark, strip_dots, "I21.0") == "I210"
    assert _one(spark, strip_dots, "A.B.C") == "ABC"
    assert _one(spark, strip_extension, "ICD_AAA.csv") == "ICD_AAA"
    assert _one(spark, strip_extension, "ICD_AAA.csvx") == "ICD_AAA.csvx"
    assert _one(spark, lambda c: with_suffix(c, "_snomedct"), "CPRD_x") == "CPRD_x_snomedct"
    assert _one(spark, lambda c: with_suffix(c, "_snomedct"), None) is None
    assert _one(spark, lambda c: with_prefix(c, "codelist_"), "icd_x") == "codelist_icd_x"
    assert _one(spark, lambda c: qualified_name("db", c), "t") == "db.t"
    assert _one(spark, lambda c: qualified_name(None, c), "t") == "t"
    assert _one(spark, file_stem, "s3://bucket/dir/codelist_icd_aaa.csv") == "codelist_icd_aaa"
    assert _one(spark, file_stem, "/a/b/x.part.parquet") == "x.part"


@pytest.mark.parametrize(
    "name, columns",
    [
        ("db.codelist_icd_aaa", "ICD10code"),
        ("db.codelist_cprd_aaa_snomedct", "conceptId"),
        ("db.codelist_cprd_aaa", "Readcode,Medcode"),
        ("db.codelist_opcs_aaa", "OPCS4code"),
        # first match wins: a name with both tokens routes to ICD
        ("db.codelist_icd_x_snomedct", "ICD10code"),
    ],
)
def test_code_column_routing(spark, name, columns):
    assert _one(spark, code_columns_for, name) == columns
    assert ",".join(code_columns_for_name(name)) == columns


def test_unroutable_source_name_raises(spark):
    with pytest.raises(ValueError):
        code_columns_for_name("db.codelist_unknown")
    df = spark.createDataFrame([("db.codelist_unknown",)], "x string")
    with pytest.raises(PySparkException):
        df.select(code_columns_for("x")).collect()
