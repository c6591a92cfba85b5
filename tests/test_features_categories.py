import datetime as dt

import pytest
from pyspark.sql import functions as F

from phenospark.operators import (
    build_mapping,
    categorise,
    categorise_map,
    first_dates,
    first_dates_by_phenotype,
    flag_matrix,
    n_occurrences,
)
from phenospark.operators.checks import duplicate_keys, null_keys, orphans, unmapped
from phenospark.operators.summary import category_sizes, codes_per_category, codes_per_phenotype
from phenospark.sources import read_abbreviations, read_categories
from tests.conftest import rows

D = [dt.date(2020, 1, d) for d in range(1, 6)]
MENTIONS = [
    ("p1", "aki", D[2], "N170", "ICD"),
    ("p1", "aki", D[0], "N170", "ICD"),
    ("p1", "aki", D[1], "N179", "ICD"),
    ("p1", "ckd", None, "N18", "ICD"),
    ("p2", "aki", D[4], "N170", "ICD"),
    ("p2", "crohns_disease", D[3], "34000006", "SNOMEDCT"),
    ("p2", "unmapped_one", D[3], "X1", "SNOMEDCT"),
]


@pytest.fixture()
def mentions(spark):
    return spark.createDataFrame(
        MENTIONS, "person_id_deid string, phenotype string, date date, code string, terminology string")


def test_first_dates(mentions):
    got = rows(first_dates(mentions))
    assert ("p1", "aki", D[0], "N170", "ICD") in got
    assert ("p1", "ckd", None, "N18", "ICD") in got
    assert len(got) == 6
    by_pheno = {(r[0], r[1]): r[2] for r in first_dates_by_phenotype(mentions).collect()}
    assert by_pheno[("p1", "aki")] == D[0]
    assert by_pheno[("p1", "ckd")] is None


def test_n_occurrences(mentions):
    got = {(r[0], r[1]): r[2] for r in n_occurrences(mentions).collect()}
    assert got[("p1", "aki")] == 3 and got[("p2", "aki")] == 1


def test_flag_matrix(mentions):
    flags = flag_matrix(mentions)
    assert flags.columns == ["person_id_deid", "aki", "ckd", "crohns_disease", "unmapped_one"]
    assert rows(flags) == [("p1", 1, 1, 0, 0), ("p2", 1, 0, 1, 1)]
    counts = flag_matrix(mentions, phenotypes=["aki", "zzz"], binary=False)
    assert counts.columns == ["person_id_deid", "aki", "zzz"]
    assert rows(counts) == [("p1", 3, 0), ("p2", 1, 0)]
    from phenospark.operators.features import flag_cells, flag_sizes

    assert {tuple(r) for r in flag_sizes(flags).collect()} == {
        ("aki", 2, 0), ("ckd", 1, 1), ("crohns_disease", 1, 1), ("unmapped_one", 1, 1)}
    assert flag_cells(flags).count() == 8


# Invented names that hold the traps: an apostrophe, a comma, a category without an abbreviation and the reverse, no phenotype.
CATEGORIES = """Phenotype,Category
Left Knee Creak,Joints & Hinges
Miller's cough,"Dust, Lungs"
Slow Knee Creak,Joints & Hinges
Orphaned thing,Uncategorised Stuff
,"Dust, Lungs"
"""
ABBREVIATIONS = """Category,Short
Joints & Hinges,jh
"Dust, Lungs",dl
Nowhere used,nu
"""


@pytest.fixture()
def lists(spark, tmp_dir):
    for name, text in (("c.csv", CATEGORIES), ("a.csv", ABBREVIATIONS)):
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.write(text)
    return read_categories(spark, f"{tmp_dir}/c.csv"), read_abbreviations(spark, f"{tmp_dir}/a.csv")


def test_mapping_and_categorise(spark, lists, mentions):
    categories, abbreviations = lists
    assert null_keys(categories, "Phenotype").count() == 1
    mapping = build_mapping(categories, abbreviations)
    assert rows(mapping) == [
        ("left_knee_creak", "joints__hinges", "jh"),
        ("millers_cough", "dust_lungs", "dl"),
        ("slow_knee_creak", "joints__hinges", "jh"),
    ]
    sizes = {r["cat"]: r["n_phenotypes"] for r in category_sizes(mapping).collect()}
    assert sizes == {"jh": 2, "dl": 1}
    new = {"aki": "left_knee_creak", "crohns_disease": "millers_cough"}
    m = mentions.replace(new, subset=["phenotype"])
    joined = categorise(m, mapping)
    assert joined.count() == m.count()  # never drops a mention
    assert joined.where(F.col("category").isNull()).count() == 2  # two phenotypes without a category
    assert rows(categorise_map(m, mapping)) == rows(joined)
    per_cat = {r["category"]: r["n_codes"] for r in codes_per_category(joined).collect()}
    assert per_cat[None] == 2 and per_cat["joints__hinges"] == 2
    assert {r["phenotype"]: r["n_codes"] for r in codes_per_phenotype(m).collect()}["left_knee_creak"] == 2


def test_duplicate_mapping_key_fails(spark, mentions):
    mapping = spark.createDataFrame(
        [("aki", "gu_a", "gu"), ("aki", "gu_b", "gu")], "phenotype string, category string, cat string")
    assert duplicate_keys(mapping, "phenotype").count() == 1
    with pytest.raises(ValueError, match="duplicate phenotype"):
        categorise(mentions, mapping)
    with pytest.raises(ValueError, match="duplicate phenotype"):
        categorise_map(mentions, mapping)


def test_integrity_checks(spark, lists):
    categories, abbreviations = lists
    from phenospark.operators import tidy_abbreviations, tidy_categories

    listed, short = tidy_categories(categories), tidy_abbreviations(abbreviations)
    assert rows(unmapped(listed, short, "category")) == [("uncategorised_stuff",)]
    assert rows(orphans(short, listed, "category")) == [("nowhere_used",)]
    codelist = spark.createDataFrame([("left_knee_creak",), ("zzz",)], "phenotype string")
    mapping = build_mapping(categories, abbreviations)
    assert rows(unmapped(codelist, mapping)) == [("zzz",)]
    assert rows(orphans(mapping, codelist)) == [("millers_cough",), ("slow_knee_creak",)]


def test_distinct_code_counts_by_terminology_and_approx(spark):
    from phenospark.operators.summary import codelist_per_phenotype, coverage

    cl = spark.createDataFrame(
        [("p", "ICD", "X1"), ("p", "OPCS", "X1"), ("p", "ICD", "X2")],
        "phenotype string, terminology string, code string")
    assert codelist_per_phenotype(cl).first()["n_codes"] == 2
    assert codelist_per_phenotype(cl, by_terminology=True).first()["n_codes"] == 3
    m = spark.range(1000).select(F.col("id").alias("person_id_deid"), (F.col("id") % 7).cast("string").alias("phenotype"))
    exact = coverage(m).first()
    approx = coverage(m, approx_rsd=0.01).first()
    assert exact["unique_pts"] == 1000 and exact["phenotypes"] == 7
    assert abs(approx["unique_pts"] - 1000) <= 30 and approx["phenotypes"] == 7


def test_flag_matrix_keeps_null_person_and_odd_names(spark):
    m = spark.createDataFrame([(1, "a.b"), (None, "c d"), (2, "x`y")], "person_id_deid bigint, phenotype string")
    got = rows(flag_matrix(m))
    assert (None, 0, 1, 0) in got and (1, 1, 0, 0) in got and (2, 0, 0, 1) in got


def test_features_from_one_summary_equal_direct(mentions):
    from phenospark.operators.features import code_summary, features_from_summary

    derived = features_from_summary(code_summary(mentions))
    assert rows(derived["first_dates"]) == rows(first_dates(mentions))
    from phenospark.operators.features import features_by_phenotype

    both = rows(derived["features_by_phenotype"])
    assert both == rows(features_by_phenotype(mentions))
    assert [r[:3] for r in both] == rows(first_dates_by_phenotype(mentions))
    assert [(*r[:2], r[3]) for r in both] == rows(n_occurrences(mentions))


def test_categorise_replaces_an_existing_category(spark, mentions):
    mapping = spark.createDataFrame([("aki", "renal", "gu")], "phenotype string, category string, cat string")
    once = categorise(mentions, mapping)
    twice = categorise(once, mapping)
    assert twice.columns == once.columns
    assert rows(twice) == rows(once)


def test_categorise_map_equals_the_join_and_takes_no_rows(spark, mentions):
    schema = "phenotype string, category string, cat string"
    mapping = spark.createDataFrame([("aki", "renal", "gu"), ("ckd", "renal", "gu")], schema)
    assert rows(categorise_map(mentions, mapping)) == rows(categorise(mentions, mapping))
    none = spark.createDataFrame([], schema)
    assert rows(categorise_map(mentions, none)) == rows(categorise(mentions, none))


def test_mention_volumes_equal_the_separate_counts(spark):
    from phenospark.operators import match, mentions as all_mentions, narrow_records
    from phenospark.operators.summary import coverage, duplicate_volume, mention_volumes

    narrow = narrow_records(spark.createDataFrame(
        [("a", D[0], "1"), ("a", D[0], "1"), ("b", None, "2"), ("b", None, "9")], "p string, d date, c string"), "p", "d", "c")
    wide = spark.createDataFrame(
        [("a", D[0], "K1", "ICD"), ("a", D[0], "K1", "ICD"), ("c", D[1], "1", "SNOMEDCT"), ("a", D[0], "1", "SNOMEDCT")],
        "person_id_deid string, date date, code string, terminology string")
    codelist = spark.createDataFrame(
        [("x", "SNOMEDCT", "1"), ("y", "SNOMEDCT", "1"), ("x", "SNOMEDCT", "1"), ("z", "SNOMEDCT", "2"), ("w", "ICD", "K1")],
        "phenotype string, terminology string, code string")
    raw = all_mentions(codelist, narrow=narrow, wide=wide, deduplicate=False)
    v = mention_volumes(codelist, narrow, wide).first()
    assert (v.n_raw, v.n_dedup, v.n_duplicates) == tuple(duplicate_volume(raw).first())
    assert (v.n_raw, v.unique_pts, v.phenotypes) == tuple(coverage(raw).first())
    own = coverage(match(narrow, codelist, "SNOMEDCT")).first()
    assert (v.narrow_raw, v.narrow_pts, v.narrow_phenotypes) == tuple(own)
    assert mention_volumes(codelist.limit(0), narrow, wide).first().n_raw == 0


def test_categorise_map_is_a_subquery_with_a_bound(spark, mentions):
    mapping = spark.createDataFrame([("a", "x"), ("b", None), (None, "z")], "phenotype string, category string")
    mapped = categorise_map(mentions.withColumn("category", F.lit("old")), mapping)
    assert "Subquery" in mapped._jdf.queryExecution().executedPlan().toString()
    assert rows(mapped) == rows(categorise(mentions, mapping))
    with pytest.raises(ValueError, match="use categorise"):
        categorise_map(mentions, mapping, max_map_bytes=10)
    none = mentions.limit(0)
    assert categorise_map(none, mapping).columns == [*none.columns, "category"] and categorise_map(none, mapping).count() == 0
