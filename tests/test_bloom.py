"""The Bloom filter that drops unmatched facts before an exchange."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from phenospark.operators import bloom, joins
from phenospark.operators.bloom import drop_unmatched, key_filter
from tests.conftest import SMOKE_DIR, rows


def _keys(spark, n, step=1):
    return spark.range(0, n * step, step).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("code"), F.lit("ICD").alias("terminology"))


def test_every_match_stays_and_few_others(spark):
    keys = _keys(spark, 3000, 7)
    facts = _keys(spark, 42_000).withColumn("n", F.lit(1))
    left = drop_unmatched(facts, key_filter(keys, ["terminology", "code"]))
    assert left.columns == facts.columns
    assert left.join(keys, ["terminology", "code"], "left_semi").count() == 3000
    assert left.count() - 3000 < 0.01 * (42_000 - 3000)


@pytest.mark.parametrize("bound, most", [(4000, 0.7), (10_000, 0.5), (30_000, 0.1)])
def test_a_bound_costs_selectivity_never_matches(spark, bound, most):
    keys = _keys(spark, 4000, 5)
    known = key_filter(keys, ["terminology", "code"], bound)
    assert known.n_blocks * 80 <= bound and 1 <= known.probes <= bloom.PROBES
    left = drop_unmatched(_keys(spark, 20_000), known)
    assert left.join(keys, ["terminology", "code"], "left_semi").count() == 4000
    assert left.count() - 4000 < most * 16_000


def test_no_filter_for_too_many_keys_other_types_or_no_keys(spark):
    keys = _keys(spark, 4000)
    assert key_filter(keys, ["code"], 80) is None
    facts = spark.range(10).select(F.col("id").cast("int").alias("code"))
    numbers = key_filter(spark.range(3).select(F.col("id").alias("code")), ["code"])
    assert drop_unmatched(facts, numbers) is facts and drop_unmatched(facts, None) is facts
    assert drop_unmatched(_keys(spark, 10), key_filter(keys.limit(0), ["code"])).count() == 0


def test_odd_names_nulls_and_clashing_columns(spark):
    facts = spark.createDataFrame([("a", 1, 2), (None, 3, 4), ("b", 5, 6)], "code string, `a.b` int, other int")
    lookup = spark.createDataFrame([("a",), (None,)], "code string")
    left = drop_unmatched(facts, key_filter(lookup, ["code"]))
    assert left.columns == facts.columns and ("a", 1, 2) in rows(left) and ("b", 5, 6) not in rows(left)
    joined = joins.lookup_join(facts, lookup, "code", "inner", broadcast=False)
    assert rows(joined) == [("a", 1, 2)]


@pytest.mark.parametrize("how", ["inner", "left_semi", "left", "left_anti"])
def test_lookup_join_equals_the_broadcast_join(spark, how):
    facts = spark.range(3000).select((F.col("id") % 50).cast("string").alias("code"), "id").unionByName(
        spark.range(1500).select(F.lit("7").alias("code"), "id"))  # a hot key
    lookup = spark.range(0, 60, 6).select(F.col("id").cast("string").alias("code"), (F.col("id") * 2).alias("twice"))
    lookup = lookup.unionByName(lookup.limit(3))
    one = joins.lookup_join(facts, lookup, "code", how, broadcast=True)
    assert rows(joins.lookup_join(facts, lookup, "code", how, broadcast=False)) == rows(one)
    assert rows(joins.lookup_join(facts, lookup, "code", how, broadcast=False, salt_buckets=1)) == rows(one)


@pytest.mark.parametrize("name", ["mentions_dedup_shuffle", "mentions_raw_shuffle"])
def test_records_are_dropped_below_the_exchange(spark, name):
    """Below the exchange that moves records stand the filter's masks and its broadcast join."""
    plan = contract.queries()[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    masked = [m.start() for m in re.finditer(r"Filter [^\n]*_w0#", plan)]
    assert masked and all("Exchange" in plan[:at] for at in masked)
    assert re.search(r"BroadcastHashJoin \[_block#", plan)


def test_fewer_records_are_shuffled(spark):
    """The records that reach the deduplication are those of the codelist and few others."""
    facts = _keys(spark, 20_000).withColumn("person_id_deid", F.lit(1)).withColumn("date", F.lit(None).cast("date"))
    codelist = _keys(spark, 100).withColumn("phenotype", F.lit("p"))
    from phenospark.operators.mentions import mentions

    out = mentions(codelist, wide=facts, max_broadcast_bytes=0)
    assert out.count() == 100
    known = key_filter(codelist, ["terminology", "code"])
    assert drop_unmatched(facts, known).count() < 300
