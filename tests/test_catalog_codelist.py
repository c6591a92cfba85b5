import os

import pytest
from pyspark.sql import functions as F

from phenospark.operators import build_codelist, to_catalog, two_column_codes, without_terminology
from phenospark.operators.checks import missing_sources
from phenospark.operators.summary import codelist_per_phenotype, codelist_phenotypes, codelist_totals
from phenospark.sources import (
    list_sources,
    list_tables,
    read_code_files,
    read_code_tables,
    read_dictionary,
)
from tests.conftest import rows

# Invented phenotypes that hold the traps: a quoted comma, an apostrophe, no CPRD list, upper case, no list at all.
DICTIONARY_CSV = """phenotype,CPRD,ICD,OPCS
Creaking Knee,CPRD_knee.csv,ICD_knee.csv,OPCS_knee.csv
"Restless sleep, humming and sighs",CPRD_rshs.csv,ICD_rshs.csv,
Miller's cough,CPRD_miller.csv,ICD_miller.csv,
Loud Ear Ring,,ICD_LER.csv,
Cold Toe-T,,,
"""


@pytest.fixture()
def dictionary(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dictionary.csv")
    with open(path, "w") as fh:
        fh.write(DICTIONARY_CSV)
    return read_dictionary(spark, path)


def test_read_dictionary_handles_quotes_and_empty_cells(dictionary):
    got = {r["phenotype"]: r for r in dictionary.collect()}
    assert len(got) == 5
    pv = got["Restless sleep, humming and sighs"]
    assert pv["CPRD"] == "CPRD_rshs.csv" and pv["OPCS"] is None
    assert got["Cold Toe-T"]["ICD"] is None


def test_catalog_unpivot(dictionary):
    cat = to_catalog(dictionary, database="cldb")
    got = rows(cat.select("phenotype", "terminology", "table", "path"))
    assert ("creaking_knee", "SNOMEDCT", "codelist_cprd_knee_snomedct",
            "cldb.codelist_cprd_knee_snomedct") in got
    assert ("millers_cough", "ICD", "codelist_icd_miller", "cldb.codelist_icd_miller") in got
    # a phenotype without a CPRD list has no SNOMED CT row; one without files has none
    aki = [r for r in got if r[0] == "loud_ear_ring"]
    assert aki == [("loud_ear_ring", "ICD", "codelist_icd_ler", "cldb.codelist_icd_ler")]
    assert not [r for r in got if r[0] == "cold_toe-t"]
    # 3 + 3 + 3 files plus their SNOMED CT twins (3) + AKI
    assert len(got) == 4 + 3 + 3 + 1
    assert without_terminology(cat, "CPRD").where(F.col("terminology") == "CPRD").count() == 0
    assert without_terminology(cat, "CPRD").count() == 11 - 3


def test_build_codelist_joins_sources_and_strips_dots(spark, dictionary):
    cat = to_catalog(dictionary)
    codes = spark.createDataFrame(
        [
            ("codelist_icd_ler", "N17.0"),
            ("codelist_icd_ler", "N17.9"),
            ("codelist_icd_miller", "K50"),
            ("codelist_cprd_miller_snomedct", "34000006"),
            ("codelist_cprd_miller", "J40..00"),  # CPRD is left out
            ("codelist_opcs_knee", "T20.1"),
            ("codelist_icd_unlisted", "Z99"),
        ],
        "source string, code string",
    )
    cl = build_codelist(cat, codes)
    assert rows(cl) == sorted(
        [
            ("creaking_knee", "OPCS", "T201"),
            ("loud_ear_ring", "ICD", "N170"),
            ("loud_ear_ring", "ICD", "N179"),
            ("millers_cough", "ICD", "K50"),
            ("millers_cough", "SNOMEDCT", "34000006"),
        ]
    )
    assert dict(cl.schema.fields and [(f.name, f.dataType.simpleString()) for f in cl.schema.fields]) == {
        "phenotype": "string", "terminology": "string", "code": "string"}
    # no seed row: totals count only real codes
    totals = codelist_totals(cl).first()
    assert (totals["n_codes"], totals["n_phenotypes"]) == (5, 3)
    per = {r["phenotype"]: (r["n_codes"], r["n_terminologies"]) for r in codelist_per_phenotype(cl).collect()}
    assert per["millers_cough"] == (2, 2)
    assert codelist_phenotypes(cl).count() == 3


def test_numeric_source_codes_become_strings(spark):
    cat = spark.createDataFrame([("p", "SNOMEDCT", "t")], "phenotype string, terminology string, table string")
    codes = spark.createDataFrame([("t", 1234), ("t", 5678)], "source string, code bigint")
    cl = build_codelist(cat, codes)
    assert cl.schema["code"].dataType.simpleString() == "string"
    assert rows(cl.select("code")) == [("1234",), ("5678",)]


def test_missing_sources_lists_catalog_rows_without_files(spark, dictionary):
    cat = to_catalog(dictionary)
    present = spark.createDataFrame([("codelist_icd_ler",)], "source string")
    missing = missing_sources(cat, present)
    assert missing.count() == 10
    assert missing.where(F.col("table") == "codelist_icd_ler").count() == 0


def test_two_code_columns(spark):
    df = spark.createDataFrame(
        [("asthma", "H33..00", "1234"), ("asthma", "H33z.00", None), ("copd", None, None)],
        "phenotype string, Readcode string, Medcode string",
    )
    out = two_column_codes(df, {"Readcode": "Readcode", "Medcode": "Medcode"})
    assert rows(out) == [
        ("asthma", "Medcode", "1234"),
        ("asthma", "Readcode", "H33..00"),
        ("asthma", "Readcode", "H33z.00"),
    ]


def _write_csv(path, header, lines):
    with open(path, "w") as fh:
        fh.write(header + "\n" + "\n".join(lines) + "\n")


def test_read_code_files_routes_every_file_once(spark, tmp_dir):
    _write_csv(f"{tmp_dir}/codelist_icd_ler.csv", "Disease,ICD10code", ["AKI,N17.0", "AKI,N17.9"])
    _write_csv(f"{tmp_dir}/codelist_icd_miller.csv", "Disease,ICD10code", ["Crohns,K50"])
    _write_csv(f"{tmp_dir}/codelist_cprd_miller_snomedct.csv", "Disease,conceptId", ["Crohns,34000006"])
    _write_csv(f"{tmp_dir}/codelist_cprd_miller.csv", "Disease,Readcode,Medcode",
               ["Crohns,J40..00,123", "Crohns,J40z.00,"])
    _write_csv(f"{tmp_dir}/codelist_opcs_hernia.csv", "Disease,OPCS4code", ["Hernia,T20.1"])
    got = rows(read_code_files(spark, tmp_dir))
    assert got == sorted([
        ("codelist_cprd_miller", "Medcode", "123"),
        ("codelist_cprd_miller", "Readcode", "J40..00"),
        ("codelist_cprd_miller", "Readcode", "J40z.00"),
        ("codelist_cprd_miller_snomedct", "SNOMEDCT", "34000006"),
        ("codelist_icd_ler", "ICD", "N17.0"),
        ("codelist_icd_ler", "ICD", "N17.9"),
        ("codelist_icd_miller", "ICD", "K50"),
        ("codelist_opcs_hernia", "OPCS", "T20.1"),
    ], key=lambda t: tuple((v is not None, str(v)) for v in t))
    listed = rows(list_sources(spark, tmp_dir, "codelist_*").select("source"))
    assert len(listed) == 5


def test_read_code_tables_and_list_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cl_test")
    spark.createDataFrame([("N17.0",)], "ICD10code string").write.mode("overwrite").saveAsTable(
        "cl_test.codelist_icd_ler")
    spark.createDataFrame([(34000006,)], "conceptId bigint").write.mode("overwrite").saveAsTable(
        "cl_test.codelist_cprd_x_snomedct")
    spark.createDataFrame([("T20.1",)], "OPCS4code string").write.mode("overwrite").saveAsTable(
        "cl_test.codelist_opcs_h")
    names = rows(list_tables(spark, "cl_test", "codelist*").select("table"))
    assert [n[0] for n in names] == ["codelist_cprd_x_snomedct", "codelist_icd_ler", "codelist_opcs_h"]
    codes = read_code_tables(spark, [f"cl_test.{n[0]}" for n in names])
    assert rows(codes) == [
        ("codelist_cprd_x_snomedct", "SNOMEDCT", "34000006"),
        ("codelist_icd_ler", "ICD", "N17.0"),
        ("codelist_opcs_h", "OPCS", "T20.1"),
    ]


def test_read_code_files_takes_columns_by_name(spark, tmp_dir):
    _write_csv(f"{tmp_dir}/codelist_icd_a.csv", "Disease,ICD10code", ['"A, quoted",N17'])
    _write_csv(f"{tmp_dir}/codelist_icd_b.csv", "ICD10code,Disease,Extra", ["K50,B,x", ",C,y"])
    assert rows(read_code_files(spark, tmp_dir)) == [
        ("codelist_icd_a", "ICD", "N17"), ("codelist_icd_b", "ICD", None), ("codelist_icd_b", "ICD", "K50")]


def test_read_code_files_names_upper_case_spaces_and_plus(spark, tmp_dir):
    _write_csv(f"{tmp_dir}/codelist icd a+b 100%.csv", "ICD10code", ["N17"])
    _write_csv(f"{tmp_dir}/ICD_AAA.csv", "ICD10code", ["K50"])
    assert rows(read_code_files(spark, tmp_dir)) == [("codelist icd a+b 100%", "ICD", "N17"), ("icd_aaa", "ICD", "K50")]
    listed = rows(list_sources(spark, tmp_dir).select("source"))
    assert listed == [("codelist icd a+b 100%",), ("icd_aaa",)]


def test_read_code_files_reads_only_what_the_catalog_names(spark, tmp_dir):
    _write_csv(f"{tmp_dir}/codelist_icd_a.csv", "Disease,ICD10code", ["A,N17"])
    _write_csv(f"{tmp_dir}/codelist_icd_other.csv", "Something", ["without the column"])
    _write_csv(f"{tmp_dir}/readme.csv", "notes", ["no codes here"])
    _write_csv(f"{tmp_dir}/codelist_icd_empty.csv", "Disease,ICD10code", [])
    catalog = spark.createDataFrame(
        [("a", "ICD", "codelist_icd_A"), ("b", "ICD", "codelist_icd_empty"), ("c", "ICD", "codelist_icd_none")],
        "phenotype string, terminology string, table string")
    assert rows(read_code_files(spark, tmp_dir, catalog=catalog)) == [("codelist_icd_a", "ICD", "N17")]
    # an empty codelist exists, an absent one is missing
    lower = catalog.withColumn("table", F.lower("table"))
    assert [r["table"] for r in missing_sources(lower, list_sources(spark, tmp_dir)).collect()] == ["codelist_icd_none"]
    odd = catalog.withColumn("table", F.lit("readme"))
    with pytest.raises(Exception, match="no terminology in source name"):
        read_code_files(spark, tmp_dir, catalog=odd).collect()


def test_read_code_files_requires_the_routed_column(spark, tmp_dir):
    _write_csv(f"{tmp_dir}/codelist_opcs_a.csv", "Disease,conceptId", ["A,123"])
    with pytest.raises(ValueError, match="codelist_opcs_a.*OPCS4code"):
        read_code_files(spark, tmp_dir)


def test_typed_sources_without_their_column_fail_by_name(spark, tmp_dir):
    spark.createDataFrame([("N17",)], "ICD10code string").write.parquet(f"{tmp_dir}/codelist_icd_good")
    spark.createDataFrame([("N18",)], "icd_code string").write.parquet(f"{tmp_dir}/codelist_icd_bad")
    with pytest.raises(ValueError, match="codelist_icd_bad.*ICD10code"):
        read_code_files(spark, tmp_dir, fmt="parquet", source_from="directory")
    spark.createDataFrame([("N18",)], "icd_code string").write.mode("overwrite").saveAsTable("codelist_icd_lacking")
    with pytest.raises(ValueError, match="codelist_icd_lacking"):
        read_code_tables(spark, ["codelist_icd_lacking"])


def test_read_code_tables_code_column_as_partition_column(spark):
    spark.createDataFrame([("a", "N17"), ("b", "N18")], "x string, ICD10code string").write.mode(
        "overwrite").partitionBy("ICD10code").saveAsTable("codelist_icd_by_code")
    assert rows(read_code_tables(spark, ["codelist_icd_by_code"])) == [
        ("codelist_icd_by_code", "ICD", "N17"), ("codelist_icd_by_code", "ICD", "N18")]


def test_read_code_files_parquet_table_per_folder(spark, tmp_dir):
    spark.createDataFrame([("N17.0",), ("N17.9",)], "ICD10code string").coalesce(2).write.parquet(
        f"{tmp_dir}/codelist_icd_ler")
    spark.createDataFrame([(34000006,)], "conceptId bigint").write.parquet(
        f"{tmp_dir}/codelist_cprd_x_snomedct")
    got = rows(read_code_files(spark, tmp_dir, fmt="parquet", source_from="directory"))
    assert got == [
        ("codelist_cprd_x_snomedct", "SNOMEDCT", "34000006"),
        ("codelist_icd_ler", "ICD", "N17.0"),
        ("codelist_icd_ler", "ICD", "N17.9"),
    ]


def test_read_code_files_partitioned_by_source(spark, tmp_dir):
    root = f"{tmp_dir}/lists"
    spark.createDataFrame([("codelist_icd_ler", "N17.0"), ("codelist_icd_ckd", "N18")],
                          "source string, ICD10code string").write.partitionBy("source").option(
        "header", True).csv(root)
    spark.createDataFrame([("codelist_opcs_h", "T20.1")], "source string, OPCS4code string").write.mode(
        "append").partitionBy("source").option("header", True).csv(root)
    got = rows(read_code_files(spark, root, source_from="partition"))
    assert got == [("codelist_icd_ckd", "ICD", "N18"), ("codelist_icd_ler", "ICD", "N17.0"),
                   ("codelist_opcs_h", "OPCS", "T20.1")]


def test_tidy_codes_keeps_read_code_dots(spark):
    from phenospark.operators import tidy_codes

    cl = spark.createDataFrame(
        [("p", "ICD", "I21.0"), ("p", "OPCS", "K40.1"), ("p", "SNOMEDCT", "1.2"), ("p", "Readcode", "G30..00")],
        "phenotype string, terminology string, code string")
    got = {r["terminology"]: r["code"] for r in tidy_codes(cl).collect()}
    assert got == {"ICD": "I210", "OPCS": "K401", "SNOMEDCT": "12", "Readcode": "G30..00"}


def test_build_codelist_with_cprd_keeps_read_and_med_codes(spark, dictionary, tmp_dir):
    lists = os.path.join(tmp_dir, "lists")
    os.makedirs(lists)
    _write_csv(f"{lists}/codelist_cprd_miller.csv", "Disease,Readcode,Medcode",
               ["Crohns,J40..00,123", "Crohns,J40z.00,"])
    _write_csv(f"{lists}/codelist_icd_miller.csv", "Disease,ICD10code", ["Crohns,K50.0"])
    cat = to_catalog(dictionary, prefix="codelist_")
    codes = read_code_files(spark, lists)
    default = rows(build_codelist(cat, codes))
    assert default == [("millers_cough", "ICD", "K500")]
    with_cprd = rows(build_codelist(cat, codes, exclude=()))
    assert with_cprd == [
        ("millers_cough", "ICD", "K500"),
        ("millers_cough", "Medcode", "123"),
        ("millers_cough", "Readcode", "J40..00"),
        ("millers_cough", "Readcode", "J40z.00"),
    ]


def test_read_code_tables_partitioned_and_other_formats(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cl_test2")
    spark.createDataFrame([("N17.0", "a"), ("N17.9", "b")], "ICD10code string, part string").write.mode(
        "overwrite").partitionBy("part").saveAsTable("cl_test2.codelist_icd_parted")
    spark.createDataFrame([("K50",)], "ICD10code string").write.mode("overwrite").format("json").saveAsTable(
        "cl_test2.codelist_icd_json")
    spark.createDataFrame([("K51",)], "ICD10code string").write.mode("overwrite").saveAsTable(
        "cl_test2.codelist_icd_plain")
    codes = read_code_tables(spark, ["cl_test2.codelist_icd_parted", "cl_test2.codelist_icd_json",
                                     "cl_test2.codelist_icd_plain"])
    assert rows(codes) == [
        ("codelist_icd_json", "ICD", "K50"),
        ("codelist_icd_parted", "ICD", "N17.0"),
        ("codelist_icd_parted", "ICD", "N17.9"),
        ("codelist_icd_plain", "ICD", "K51"),
    ]


def test_read_code_files_empty_folder_and_single_route(spark, tmp_dir):
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    assert read_code_files(spark, empty).count() == 0
    only = os.path.join(tmp_dir, "only_opcs")
    os.makedirs(only)
    _write_csv(f"{only}/codelist_opcs_h.csv", "Disease,OPCS4code", ["H,T20.1", "H,"])
    # a NULL code cell stays a row (the codelist keeps what its sources hold)
    assert rows(read_code_files(spark, only)) == [("codelist_opcs_h", "OPCS", None),
                                                  ("codelist_opcs_h", "OPCS", "T20.1")]
