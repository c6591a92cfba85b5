"""Many codelist sources as few scans: parquet files, metastore tables, CSV records."""

import os

import pytest
from pyspark.sql import functions as F

from phenospark.sources import bad_code_rows, codelists, read_code_files, read_code_tables
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _write_lists(spark, root, n):
    """``n`` sources of each of two types of the same code column, and one of another route."""
    for kind in ("bigint", "string"):
        spark.range(n).select(F.concat(F.lit(f"codes_cprd_{kind}"), F.col("id").cast("string"), F.lit("_snomedct")).alias("source"),
                              F.col("id").cast(kind).alias("conceptId")).repartition("source").write.mode("append").partitionBy("source").parquet(root)
    spark.createDataFrame([("codes_icd_x", "N17", 1.5)], "source string, ICD10code string, other double").write.mode("append").partitionBy("source").parquet(root)


def test_parquet_sources_are_one_scan_a_group(spark, tmp_dir):
    plans = []
    for n in (3, 25):
        root = f"{tmp_dir}/lists{n}"
        _write_lists(spark, root, n)
        codes = read_code_files(spark, root, fmt="parquet", source_from="partition")
        assert rows(codes) == sorted(
            [(f"codes_cprd_{k}{i}_snomedct", "SNOMEDCT", str(i)) for k in ("bigint", "string") for i in range(n)] + [("codes_icd_x", "ICD", "N17")])
        plans.append(_plan(codes).count("FileScan parquet"))
    assert plans == [2, 2]  # two types of one column; the other route's files stand with one of them


def test_files_with_columns_of_other_routes_and_two_code_columns(spark, tmp_dir):
    """A file may hold another route's column, of a type that differs from that route's own files."""
    def write(name, schema, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.parquet(f"{tmp_dir}/{name}")

    write("codes_icd_a", "ICD10code string, conceptId int", ("N17", 5))
    write("codes_icd_b", "conceptId double, ICD10code string", (0.5, "N18"))
    write("codes_cprd_c_snomedct", "conceptId bigint", (77,))
    write("codes_cprd_d", "Readcode string, Medcode bigint", ("A..", 1), (None, 2))
    write("codes_opcs_e", "OPCS4code string, note string", ("T20", "x"), (None, "y"))
    got = read_code_files(spark, tmp_dir, fmt="parquet", source_from="directory")
    assert rows(got) == sorted([
        ("codes_cprd_c_snomedct", "SNOMEDCT", "77"), ("codes_cprd_d", "Medcode", "1"), ("codes_cprd_d", "Medcode", "2"), ("codes_cprd_d", "Readcode", "A.."),
        ("codes_icd_a", "ICD", "N17"), ("codes_icd_b", "ICD", "N18"), ("codes_opcs_e", "OPCS", None), ("codes_opcs_e", "OPCS", "T20")],
        key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_a_scan_reads_only_its_group_s_files(spark, tmp_dir):
    """Files of another type would fail the scan: they are pruned by their names."""
    root = f"{tmp_dir}/a list [1] {{x}} *"
    _write_lists(spark, root, 12)
    assert read_code_files(spark, root.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}").replace("*", "\\*"),
                           fmt="parquet", source_from="partition").count() == 25


def test_large_parquet_files_are_asked_for_their_columns_one_by_one(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(codelists, "_FOOTER_FILE_BYTES", 0)
    _write_lists(spark, f"{tmp_dir}/l", 2)
    assert read_code_files(spark, f"{tmp_dir}/l", fmt="parquet", source_from="partition").count() == 5


def test_parquet_sources_of_a_catalog(spark, tmp_dir):
    _write_lists(spark, f"{tmp_dir}/l", 3)
    catalog = spark.createDataFrame([("codes_ICD_x",), ("codes_cprd_string1_snomedct",), ("codes_icd_none",)], "table string")
    got = read_code_files(spark, f"{tmp_dir}/l", fmt="parquet", source_from="partition", catalog=catalog)
    assert rows(got) == [("codes_cprd_string1_snomedct", "SNOMEDCT", "1"), ("codes_icd_x", "ICD", "N17")]


def test_plain_tables_are_one_scan_a_group(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS grouped_lists")
    names = []
    for i in range(6):
        name = f"grouped_lists.codelist_icd_t{i}"
        writer = spark.createDataFrame([(f"N{i}", "x")], "ICD10code string, other string").write.mode("overwrite")
        (writer.option("path", f"{tmp_dir}/an odd place {i}") if i % 2 else writer).saveAsTable(name)
        names.append(name)
    spark.createDataFrame([(7,)], "conceptId int").write.mode("overwrite").format("orc").saveAsTable("grouped_lists.codelist_cprd_a_snomedct")
    spark.sql("CREATE OR REPLACE VIEW grouped_lists.codelist_opcs_v AS SELECT 'T1' AS OPCS4code")
    codes = read_code_tables(spark, [*names, "grouped_lists.codelist_cprd_a_snomedct", "grouped_lists.codelist_opcs_v"])
    assert _plan(codes).count("FileScan") == 2  # the six tables, and the one of another format
    assert rows(codes) == sorted([(f"codelist_icd_t{i}", "ICD", f"N{i}") for i in range(6)]
                                 + [("codelist_cprd_a_snomedct", "SNOMEDCT", "7"), ("codelist_opcs_v", "OPCS", "T1")])
    assert rows(read_code_tables(spark, [])) == []


def _file(tmp_dir, name, text):
    with open(os.path.join(tmp_dir, name), "w", newline="") as f:
        f.write(text)


def test_csv_cells_may_hold_line_breaks_and_quotes(spark, tmp_dir):
    _file(tmp_dir, "codelist_icd_a.csv", 'Disease,ICD10code\n"two\nlines, ""quoted""",N17\nplain,K50\n')
    _file(tmp_dir, "codelist_icd_b.csv", 'ICD10code,Disease\r\nN18,"x\r\n\r\ny"\r\n\r\n,"no code"\r\n')
    _file(tmp_dir, "codelist_icd_c.csv", "Disease,ICD10code\nDisease,ICD10code\n")  # data that repeats the header
    assert rows(read_code_files(spark, tmp_dir)) == [
        ("codelist_icd_a", "ICD", "K50"), ("codelist_icd_a", "ICD", "N17"), ("codelist_icd_b", "ICD", None),
        ("codelist_icd_b", "ICD", "N18"), ("codelist_icd_c", "ICD", "ICD10code")]
    assert bad_code_rows(spark, tmp_dir).count() == 0


def test_bad_csv_records_fail_or_are_listed(spark, tmp_dir):
    _file(tmp_dir, "codelist_icd_a.csv", "Disease,ICD10code\nonly one cell\na,N17\na,b,c\n")
    _file(tmp_dir, "codelist_opcs_b.csv", 'OPCS4code\nT20\n"never closed\nT21\n')
    with pytest.raises(Exception, match="codelist_icd_a.csv: only one cell"):
        read_code_files(spark, tmp_dir, name_glob="*_icd_a.csv").collect()
    codes = read_code_files(spark, tmp_dir, bad_rows="skip")
    assert ("codelist_icd_a", "ICD", "N17") in rows(codes) and codes.where("source = 'codelist_icd_a'").count() == 1
    bad = bad_code_rows(spark, tmp_dir)
    assert {(r.source, r.record) for r in bad.collect() if "icd" in r.source} == {("codelist_icd_a", "only one cell"), ("codelist_icd_a", "a,b,c")}
    assert all(r.file.endswith(f"{r.source}.csv") for r in bad.collect())
    with pytest.raises(ValueError, match="bad_rows"):
        read_code_files(spark, tmp_dir, bad_rows="maybe")


def test_csv_files_are_one_scan_a_group(spark, tmp_dir):
    for i in range(15):
        _file(tmp_dir, f"codelist_icd_{i}.csv", f"{'Name' if i % 2 else 'Disease'},ICD10code\nx,N{i}\n")
    codes = read_code_files(spark, tmp_dir)
    assert rows(codes) == sorted((f"codelist_icd_{i}", "ICD", f"N{i}") for i in range(15))
    assert _plan(codes).count("FileScan csv") == 1
    _file(tmp_dir, "codelist_opcs_x.csv", "Text,OPCS4code\nx,T20\n")
    assert _plan(read_code_files(spark, tmp_dir)).count("FileScan csv") == 1  # as is another vocabulary in the same place
    assert ("codelist_opcs_x", "OPCS", "T20") in rows(read_code_files(spark, tmp_dir))
