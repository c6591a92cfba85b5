"""Mentions travel with phenotype ids; results carry names."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from phenospark.operators import categories as category_ops
from phenospark.operators import features
from phenospark.operators.sparse import encode_phenotypes, name_phenotypes, phenotype_dictionary
from phenospark.plans import contract
from phenospark.sources.starschema import DIAG_SLOTS, OPERTN_SLOTS
from tests.conftest import rows

CODES = [("gout", "ICD", "P1"), ("gout", "ICD", "P1"), ("gout", "OPCS", "S1"), ("acne", "ICD", "P1"), (None, "ICD", "P2"),
         ("acne", "SNOMEDCT", "7"), ("cough", "SNOMEDCT", None), ("gout", "SNOMEDCT", "7")]


def _tables(spark, mapped):
    """Stands for a StarSchema: repeated and NULL rows, a code of several phenotypes, one without a name."""
    day = [dt.date(2020, 1, i) for i in (1, 2, 3)]
    narrow = [(1, day[0], "7"), (1, day[0], "7"), (1, None, "7"), (2, day[2], "8"), (None, day[1], "7")]
    empty = (None,) * 6
    wide = [(1, day[1], "P1", *empty, "S1", *empty), (1, day[1], "P1", *empty, "S9", *empty), (2, None, "P2", *empty, None, *empty)]
    slots = ", ".join(f"{s} string" for s in DIAG_SLOTS + OPERTN_SLOTS)
    frames = {
        "codelist": spark.createDataFrame(CODES, "phenotype string, terminology string, code string"),
        "narrow": spark.createDataFrame(narrow, "person_id long, dt date, code string"),
        "wide": spark.createDataFrame(wide, f"person_id long, dt date, {slots}"),
        "categories": spark.createDataFrame(mapped, "Phenotype string, Category string"),
        "abbreviations": spark.createDataFrame([("Skin", "sk"), ("Joints", "jo")], "Category string, Short string"),
    }
    return SimpleNamespace(spark=spark, **{k: lambda df=df: df for k, df in frames.items()})


MAPPED = [("gout", "Joints"), ("elsewhere", "Skin"), (None, "Skin")]


def _watch(monkeypatch, module, name, seen):
    plain = getattr(module, name)

    def watched(found, *args, **kwargs):
        seen.append(found.schema["phenotype"].dataType.simpleString())
        return plain(found, *args, **kwargs)

    monkeypatch.setattr(module, name, watched)
    return plain


@pytest.mark.parametrize("name", ["features_by_phenotype", "first_dates_by_phenotype", "n_occurrences", "first_dates"])
def test_features_are_grouped_by_ids(spark, monkeypatch, name):
    s, seen = _tables(spark, MAPPED), []
    plain = _watch(monkeypatch, features, name, seen)
    got = getattr(contract, {"first_dates": "first_dates_by_code"}.get(name, name))(s)
    expected = plain(contract._mentions_dedup(s))
    assert seen == ["int"] and got.schema.simpleString() == expected.schema.simpleString()
    assert rows(got) == rows(expected) and any(r["phenotype"] is None for r in got.collect())


def test_features_from_summary_are_grouped_by_ids(spark, monkeypatch):
    s, seen = _tables(spark, MAPPED), []
    _watch(monkeypatch, features, "code_summary", seen)
    assert rows(contract.features_from_code_summary(s)) == rows(contract.features_by_phenotype(s))
    assert seen == ["int"]


def test_mentions_meet_the_mapping_by_ids(spark, monkeypatch):
    s, seen = _tables(spark, MAPPED), []
    plain = _watch(monkeypatch, category_ops, "categorise", seen)
    got, expected = contract.categorise_join_shuffle(s), plain(contract._mentions_dedup(s), contract._mapping(s))
    assert seen == ["int"] and got.columns == expected.columns
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(expected) and {r["category"] for r in got.collect()} == {"joints", None}


def test_a_repeated_mapping_key_is_an_error_with_its_name(spark):
    with pytest.raises(ValueError, match="elsewhere"):
        contract.categorise_join_shuffle(_tables(spark, [*MAPPED, ("elsewhere", "Joints")]))


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_names_come_back(spark, bound):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (2, None, 3), (1, "b", 2)], "`x.y` long, phenotype string, n long")
    names = phenotype_dictionary(df)
    coded = encode_phenotypes(df, names, bound)
    assert coded.columns == df.columns and rows(coded.select("phenotype").distinct()) == [(None,), (0,), (1,)]
    assert rows(name_phenotypes(coded, names, bound)) == rows(df)
    with pytest.raises(Exception, match="not in the dictionary: b"):
        encode_phenotypes(df, names.where(F.col("phenotype") == "a"), bound).collect()
