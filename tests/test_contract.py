"""Every contract query against its DuckDB twin on the smoke scale factor
(the driver runs the same comparison at sf0.01)."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as contract
from phenospark.plans.contract import QUERIES
from phenospark.plans.workflow import WorkflowInputs, run_workflow
from phenospark.operators.mentions import narrow_records, wide_records
from phenospark.sources.starschema import DIAG_SLOTS, OPERTN_SLOTS, SOURCE_DATABASE, SOURCE_PREFIX, StarSchema
from tests.conftest import SMOKE_DIR

TABLES = ["region", "nation", "supplier", "part", "orders", "lineitem", "events"]


def _canon(v):
    if v is None:
        return "\x00"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return str(v)


def _digest(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_canon(r[i]) for i in order) for r in data)
    return len(lines), [columns[i] for i in order], hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_oracles_work_as_views(duck):
    """The driver compares through views: no statement that only runs by itself."""
    for name in QUERIES:
        duck.execute(f"CREATE OR REPLACE VIEW check_view AS {contract.oracle_sql()[name]}")


def test_shuffle_queries_plan_a_merge_join(spark):
    for name in ("mentions_dedup_shuffle", "mentions_raw_shuffle", "categorise_join_shuffle"):
        plan = contract.queries()[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan, name


def test_the_flagship_scans_each_record_table_once(spark):
    plan = contract.queries()["mentions_dedup"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("l_linenumber") and plan.count("lineitem.parquet") == 1


def test_the_flag_matrix_has_no_wide_exchange(spark):
    """The pivot's partial and final aggregate stand in one stage."""
    from phenospark.operators.features import flag_matrix

    m = spark.createDataFrame([(1, "a"), (2, "b")], "person_id_deid bigint, phenotype string")
    plan = flag_matrix(m, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the pairs' distinct, and their move to the person


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SMOKE_DIR)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(contract.oracle_sql()[name])
    want = _digest([c[0] for c in res.description], res.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["person_id_deid", "phenotype", "date", "code", "terminology"]
    assert df.count() == 8746  # FIXTURES.md, sf0.001


def test_workflow_equals_contract_queries(spark):
    s = StarSchema(spark, SMOKE_DIR)
    inputs = WorkflowInputs(
        dictionary=s.dictionary(),
        codes=s.sources().withColumnRenamed("stem", "source"),
        narrow=narrow_records(s.narrow(), person="person_id", date="dt", code="code"),
        wide=wide_records(s.wide(), person="person_id", date="dt",
                          slots={"ICD": DIAG_SLOTS, "OPCS": OPERTN_SLOTS}),
        categories=s.categories(),
        abbreviations=s.abbreviations(),
        table_prefix=SOURCE_PREFIX,
        database=SOURCE_DATABASE,
    )
    out = run_workflow(inputs)
    q = contract.queries()
    assert sorted(out["codelist"].collect()) == sorted(q["codelist_build"](spark, SMOKE_DIR).collect())
    # the workflow matches against the codelist it built from the sources
    assert out["mentions"].count() > 0
    assert out["mentions_categorised"].count() == out["mentions"].count()
    assert os.path.commonprefix([out["mentions"].inputFiles()[0], "file:/"]) == "file:/"
    flags = out["flag_matrix"]
    n_phenotypes = out["codelist"].select("phenotype").distinct().count()
    assert flags.columns[0] == "person_id_deid" and len(flags.columns) == 1 + n_phenotypes
    pairs = out["mentions"].select("person_id_deid", "phenotype").distinct().count()
    assert sum(sum(r[1:]) for r in flags.collect()) == pairs
