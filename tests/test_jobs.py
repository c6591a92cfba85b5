"""The three jobs end to end on files written from invented rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from phenospark.operators.mentions import DIAGNOSIS_SLOTS, OPERATION_SLOTS
from phenospark.plans.jobs import categories_job, codelist_job, mentions_job


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_three_jobs(spark, tmp_dir):
    _write(f"{tmp_dir}/dictionary.csv",
           "phenotype,CPRD,ICD,OPCS\n"
           "Crohn's disease,CPRD_crohns.csv,ICD_crohns.csv,\n"
           "Abdominal Hernia,,ICD_hernia.csv,OPCS_hernia.csv\n"
           "Raised LDL-C,,,\n")
    lists = os.path.join(tmp_dir, "lists")
    os.makedirs(lists)
    _write(f"{lists}/codelist_icd_crohns.csv", "Disease,ICD10code\nCrohns,K50.0\nCrohns,K50.1\n")
    _write(f"{lists}/codelist_icd_hernia.csv", "Disease,ICD10code\nHernia,K40\n")
    _write(f"{lists}/codelist_opcs_hernia.csv", "Disease,OPCS4code\nHernia,T20.1\n")
    _write(f"{lists}/codelist_cprd_crohns_snomedct.csv", "Disease,conceptId\nCrohns,34000006\n")
    out = os.path.join(tmp_dir, "out")
    c = codelist_job(spark, f"{tmp_dir}/dictionary.csv", lists, out, database="cl")
    assert c["totals"].first()["n_codes"] == 5
    assert sorted(r[0] for r in c["phenotypes"].collect()) == ["abdominal_hernia", "crohns_disease"]
    # the CPRD (Read/Med code) list is catalogued but has no file
    assert [r["table"] for r in c["missing_sources"].collect()] == ["codelist_cprd_crohns"]

    d1 = dt.date(2021, 3, 1)
    spark.createDataFrame(
        [("a", d1, "34000006"), ("a", d1, "34000006"), ("b", d1, "999")],
        "NHS_NUMBER_DEID string, DATE date, CODE string").write.parquet(f"{tmp_dir}/narrow")
    blank = [None] * (len(DIAGNOSIS_SLOTS) + len(OPERATION_SLOTS))
    row = list(blank)
    row[0], row[1], row[len(DIAGNOSIS_SLOTS)] = "K500", "K40", "T201"
    cols = ", ".join(["PERSON_ID_DEID string", "ADMIDATE date"]
                     + [f"{c} string" for c in DIAGNOSIS_SLOTS + OPERATION_SLOTS])
    spark.createDataFrame([("a", d1, *row), ("a", d1, *row)], cols).write.parquet(f"{tmp_dir}/wide")
    m = mentions_job(spark, c["codelist"], out, narrow_table=f"{tmp_dir}/narrow",
                     wide_table=f"{tmp_dir}/wide", keep_raw=True)
    assert m["mentions"].count() == 4  # crohns x2 codes/terminologies + hernia x2
    assert m["totals_raw"].first()["mentions"] == 8
    assert m["duplicate_volume"].first()["n_duplicates"] == 4
    assert m["narrow_coverage"].first()["mentions"] == 2

    _write(f"{tmp_dir}/categories.csv",
           "Phenotype,Category\nCrohn's disease,Diseases of the Digestive System\n"
           "Appendicitis,Diseases of the Digestive System\n,Cancers\n")
    _write(f"{tmp_dir}/abbr.csv", "Category,Short\nDiseases of the Digestive System,gi\n")
    k = categories_job(spark, f"{tmp_dir}/categories.csv", f"{tmp_dir}/abbr.csv",
                       m["mentions"], out, codelist=c["codelist"])
    cats = {r["phenotype"]: r["category"] for r in k["mentions_categorised"].collect()}
    assert cats == {"crohns_disease": "diseases_of_the_digestive_system", "abdominal_hernia": None}
    assert [r[0] for r in k["unmapped_phenotypes"].collect()] == ["abdominal_hernia"]
    assert [r[0] for r in k["orphan_categories"].collect()] == ["appendicitis"]
    assert k["rows_without_phenotype"].count() == 1
    assert k["category_sizes"].where(F.col("cat") == "gi").first()["n_phenotypes"] == 2


def test_command_line(spark, tmp_dir):
    from phenospark.plans.__main__ import main

    _write(f"{tmp_dir}/dictionary.csv", "phenotype,CPRD,ICD,OPCS\nAcute Kidney Injury,,ICD_AKI.csv,\n")
    lists = os.path.join(tmp_dir, "lists")
    os.makedirs(lists)
    _write(f"{lists}/codelist_icd_aki.csv", "Disease,ICD10code\nAKI,N17.0\n")
    d1 = dt.date(2021, 3, 1)
    blank = [None] * (len(DIAGNOSIS_SLOTS) + len(OPERATION_SLOTS))
    row = list(blank)
    row[0] = "N170"
    cols = ", ".join(["PERSON_ID_DEID string", "ADMIDATE date"]
                     + [f"{c} string" for c in DIAGNOSIS_SLOTS + OPERATION_SLOTS])
    spark.createDataFrame([("a", d1, *row)], cols).write.parquet(f"{tmp_dir}/wide")
    out = main(["--dictionary", f"{tmp_dir}/dictionary.csv", "--codelists", lists,
                "--wide", f"{tmp_dir}/wide", "--out", f"{tmp_dir}/out"], spark=spark)
    assert [tuple(r) for r in out["mentions"].collect()] == [("a", "acute_kidney_injury", d1, "N170", "ICD")]


def _mention_rows(seed, n=250):
    import random

    rng = random.Random(seed)
    people = ["hot"] * 20 + [f"p{i}" for i in range(25)]
    return [(rng.choice(people), f"ph {rng.randrange(9)}", rng.choice([None, *(dt.date(2000 + y, 5, 1 + d) for y in range(3) for d in range(9))]),
             f"c{rng.randrange(6)}", rng.choice(["ICD", "OPCS"])) for _ in range(n)]


def test_features_job_keeps_the_state_of_all_deliveries(spark, tmp_dir):
    from phenospark.operators import features, sparse
    from phenospark.plans.jobs import features_job
    from tests.conftest import rows

    schema = "person_id_deid string, phenotype string, date date, code string, terminology string"
    first, second = _mention_rows(1), _mention_rows(2)
    out = f"{tmp_dir}/kept"
    names = spark.createDataFrame([(f"ph {i}",) for i in range(9)], "phenotype string")
    features_job(spark, spark.createDataFrame(first, schema), names.limit(9), out, parts=6)
    more = names.unionByName(spark.createDataFrame([("a later one",)], "phenotype string"))
    delivery = second + first[:50] + [("new", "a later one", dt.date(2010, 1, 1), "c9", "ICD")]
    for _ in range(2):  # run again after a failure
        got = features_job(spark, spark.createDataFrame(delivery, schema), more, out, parts=6)
    whole = spark.createDataFrame(first + delivery, schema).dropDuplicates()
    assert rows(got["code_summary"]) == rows(features.code_summary(whole))
    assert rows(got["features_by_phenotype"]) == rows(features.features_by_phenotype(whole))
    assert rows(got["first_dates"]) == rows(features.first_dates(whole))
    assert rows(got["person_rows"]) == rows(sparse.person_rows(whole, got["dictionary"]))
    assert {r.phenotype: r.id for r in got["dictionary"].collect()}["a later one"] == 9
    total = [r for r in got["coverage"].collect() if r.cut == 3]
    assert [(r.mentions, r.unique_pts_estimate, r.phenotypes_estimate) for r in total] == [(whole.count(), whole.select("person_id_deid").distinct().count(), 10)]
    import pytest

    with pytest.raises(ValueError, match="nothing is kept"):
        features_job(spark, whole.limit(0), more, f"{tmp_dir}/never", parts=6)
    nothing = features_job(spark, whole.limit(0), more, out, parts=6)
    assert rows(nothing["code_summary"]) == rows(got["code_summary"])


def test_jobs_on_a_database_of_codelists_write_tables(spark, tmp_dir):
    from phenospark.plans.__main__ import main
    from tests.conftest import rows

    _write(f"{tmp_dir}/dictionary.csv", "phenotype,CPRD,ICD,OPCS\nAcute Kidney Injury,CPRD_aki.csv,ICD_AKI.csv,OPCS_gone.csv\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS job_lists")
    spark.sql("CREATE DATABASE IF NOT EXISTS job_out")
    for name, column in (("codelist_icd_aki", "ICD10code"), ("codelist_cprd_aki_snomedct", "conceptId"), ("codelist_icd_unlisted", "ICD10code")):
        spark.createDataFrame([("N17.0",), ("N17.9",)], f"{column} string").write.mode("overwrite").saveAsTable(f"job_lists.{name}")
    spark.createDataFrame([("x",)], "readme string").write.mode("overwrite").saveAsTable("job_lists.codelist_notes")
    d1 = dt.date(2021, 3, 1)
    spark.createDataFrame([("a", d1, "N170"), ("a", d1, "N170"), ("b", None, "N179")], "NHS_NUMBER_DEID string, DATE date, CODE string").write.parquet(f"{tmp_dir}/narrow")
    for _ in range(2):  # a second run replaces the tables of the first
        out = main(["--dictionary", f"{tmp_dir}/dictionary.csv", "--codelist-database", "job_lists", "--database", "job_lists",
                    "--narrow", f"{tmp_dir}/narrow", "--zorder-mentions", "person_id_deid", "code", "--features", f"{tmp_dir}/kept",
                    "--out", "job_out"], spark=spark)
    expected = [("a", "acute_kidney_injury", d1, "N170", "SNOMEDCT"), ("b", "acute_kidney_injury", None, "N179", "SNOMEDCT")]
    assert rows(spark.table("job_out.mentions")) == rows(out["mentions"]) == expected
    assert spark.table("job_out.codelist").count() == 4
    assert sorted(r["table"] for r in out["missing_sources"].collect()) == ["codelist_cprd_aki", "codelist_opcs_gone"]
    assert rows(out["features_by_phenotype"]) == [("a", "acute_kidney_injury", d1, 1), ("b", "acute_kidney_injury", None, 1)]
    import pytest

    with pytest.raises(ValueError, match="name one of them"):
        codelist_job(spark, f"{tmp_dir}/dictionary.csv", None, "job_out")
