"""Wide records derived from the star schema."""

import datetime as dt

import pytest

from phenospark.sources.starschema import StarSchema
from tests.conftest import rows

NUMBERS = [0, 5, 50, 500, 51, 9, 10, 99, 123456789012345, 12345678901234567, 10**17 - 1]


@pytest.mark.parametrize("more", [[], [10**17], [-3, -31]])
def test_wide_records_hold_the_least_text_of_a_slot(spark, tmp_dir, more):
    numbers = NUMBERS + more
    lines = [(o, numbers[(o * 7 + k * 3) % len(numbers)], numbers[(o + k) % len(numbers)], k % 8 + 1) for o in range(30) for k in range(20)]
    lines += [(1, None, None, 2), (2, None, 5, 3), (None, 1, 1, 1)]
    orders = [(o, o % 4, dt.datetime(2020, 1, 1 + o % 20)) for o in range(28)] + [(3, 3, dt.datetime(2021, 1, 1)), (99, 1, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_dir}/orders.parquet")
    expected = set()
    for o, c, d in orders:
        own = [x for x in lines if x[0] == o]
        if own:
            slots = [min((p + str(x[i]) for x in own if x[3] == n and x[i] is not None), default=None)
                     for p, i in (("P", 1), ("S", 2)) for n in range(1, 8)]
            expected.add((c, o, d.date(), *slots))
    wide = StarSchema(spark, tmp_dir).wide()
    assert rows(wide) == sorted(expected, key=lambda t: tuple((v is not None, str(v)) for v in t))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert ("SortAggregate" in plan) == bool(more)  # numbers are aggregated by hash


def test_ranks_are_no_wider_than_the_keys(spark, tmp_dir):
    """Small numbers travel, a line's two slots side by side."""
    keys = [0, 7, 70, 1234, 124, 99]
    lines = [(o, keys[(o + k) % 6], (o + k) % 9, k) for o in range(12) for k in range(1, 8)] * 2
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_dir}/lineitem.parquet")
    orders = [(o, o, dt.datetime(2020, 1, 1)) for o in range(12)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_dir}/orders.parquet")
    wide = StarSchema(spark, tmp_dir).wide()
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "rpad(cast(l_partkey" in plan and ", 4, 0)" in plan and ", 1, 0)" in plan and ", 17, 0)" not in plan
    assert rows(wide.select("person_id", "diag_03", "opertn_03")) == rows(spark.createDataFrame(
        [(o, f"P{keys[(o + 3) % 6]}", f"S{(o + 3) % 9}") for o in range(12)], "a long, b string, c string"))
    empty = StarSchema(spark, tmp_dir)
    empty.table = lambda name: StarSchema.table(empty, name).limit(0)
    assert empty.wide().count() == 0
