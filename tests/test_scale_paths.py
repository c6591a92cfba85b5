"""Paths that matter at scale: a hot key holding a third of all rows, the
shuffle (non-broadcast) join, materialisation, streaming matching. Results
are checked against brute force on the same small fixture."""

import collections
import datetime as dt
import os

from pyspark.sql import functions as F

from phenospark.operators import dedup, first_dates, match, n_occurrences, narrow_records
from phenospark.sinks import materialise, preview, write_table
from phenospark.streaming.incremental import match_stream, read_mentions, store_mentions
from tests.conftest import rows


def _hot_records(spark, n=3000):
    # person 'hot' and code 'H1' each hold a third of all rows
    data = []
    for i in range(n):
        person = "hot" if i % 3 == 0 else f"p{i % 97}"
        code = "H1" if i % 3 == 1 else f"C{i % 13}"
        data.append((person, dt.date(2020, 1, 1 + i % 28), code))
    return data, narrow_records(
        spark.createDataFrame(data, "NHS_NUMBER_DEID string, DATE date, CODE string"))


def _codelist(spark):
    entries = [("hot_pheno", "SNOMEDCT", "H1"), ("other", "SNOMEDCT", "H1")]
    entries += [(f"ph{c % 5}", "SNOMEDCT", f"C{c}") for c in range(13)]
    return entries, spark.createDataFrame(entries, "phenotype string, terminology string, code string")


def _brute_mentions(data, entries):
    by_code = collections.defaultdict(list)
    for ph, term, code in entries:
        by_code[code].append(ph)
    return [(p, ph, d, c, "SNOMEDCT") for p, d, c in data for ph in by_code.get(c, [])]


def test_hot_key_match_dedup_features_exact(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    data, records = _hot_records(spark)
    entries, codelist = _codelist(spark)
    expected = _brute_mentions(data, entries)
    for bc in (True, False):  # broadcast and shuffle join paths
        raw = match(records, codelist, "SNOMEDCT", broadcast=bc)
        assert raw.count() == len(expected)
        d = dedup(raw)
        assert rows(d) == sorted(set(expected), key=lambda t: tuple((v is not None, str(v)) for v in t))
        firsts = {}
        for p, ph, day, c, t in set(expected):
            key = (p, ph, c, t)
            firsts[key] = min(firsts.get(key, day), day)
        got = {(r[0], r[1], r[3], r[4]): r[2] for r in first_dates(d).collect()}
        assert got == firsts
        occ = collections.Counter((p, ph) for p, ph, *_ in set(expected))
        assert {(r[0], r[1]): r[2] for r in n_occurrences(d).collect()} == dict(occ)


def test_materialise_and_write_table(spark, tmp_dir):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    back = materialise(df, "t_mat", cluster_by=["k"])
    assert rows(back) == rows(df)
    from phenospark.session import checkpoint_dir

    root = checkpoint_dir(spark).replace("file:", "").rstrip("/")
    assert back.inputFiles()[0].replace("file://", "").replace("file:", "").startswith(root + "/phenospark/")
    target = os.path.join(tmp_dir, "written")
    write_table(df, target, cluster_by=["k"], partitions=4)
    assert spark.read.parquet(target).count() == 100
    assert preview(df, 5).count() == 5


def test_streamed_mentions_are_stored_once_whatever_their_date(spark, tmp_dir):
    """Three batches; the last one holds records that are ten years older than
    what came before, next to repeats of the earlier ones."""
    entries, codelist = _codelist(spark)
    recent, _ = _hot_records(spark, 300)
    old = [(p, day.replace(year=2010), c) for p, day, c in recent[:90]]
    batches = [recent[:200], recent[100:], old + recent[50:150] + old[:10] + [("px", None, "H1")] * 2]
    schema = "NHS_NUMBER_DEID string, DATE date, CODE string"
    src, target, checkpoint = (os.path.join(tmp_dir, d) for d in ("records", "stored", "checkpoint"))
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        stream = match_stream(narrow_records(spark.readStream.schema(schema).parquet(src)), codelist, "SNOMEDCT")
        store_mentions(stream, target, checkpoint).awaitTermination()
    got = rows(read_mentions(spark, target))
    expected = set(_brute_mentions([r for b in batches for r in b], entries))
    assert got == sorted(expected, key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_a_batch_run_again_writes_the_same(spark, tmp_dir):
    from phenospark.streaming.incremental import add_new_mentions

    entries, codelist = _codelist(spark)
    data, records = _hot_records(spark, 60)
    found = match(records, codelist, "SNOMEDCT")
    target = os.path.join(tmp_dir, "stored")
    for batch_id in (0, 1, 1, 2):
        add_new_mentions(found, batch_id, target)
    assert rows(read_mentions(spark, target)) == rows(found.distinct())


def test_salted_join_is_planned_as_a_merge_join_and_spreads_copies(spark):
    from phenospark.operators.joins import salted_join

    facts = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("code"))  # copies of one record in eight partitions
    lookup = spark.createDataFrame([("hot", "p")], "code string, phenotype string")
    joined = salted_join(facts, lookup, ["code"], salt_buckets=64)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 4000
    salts = facts.select(F.pmod(F.xxhash64("code", F.spark_partition_id()), F.lit(64)).alias("s")).distinct().count()
    assert salts > 1


def test_fallback_paths_equal_broadcast_paths(spark):
    """max_broadcast_bytes=0 forces every lookup join onto the salted shuffle
    path; results must not change."""
    from phenospark.operators import categorise, mentions
    from phenospark.operators.joins import lookup_join

    data, records = _hot_records(spark, 900)
    entries, codelist = _codelist(spark)
    # copies: every record twice
    doubled = records.unionByName(records)
    for dedup_flag in (True, False):
        a = mentions(codelist, narrow=doubled, deduplicate=dedup_flag)
        b = mentions(codelist, narrow=doubled, deduplicate=dedup_flag, max_broadcast_bytes=0)
        assert rows(a) == rows(b)
    raw = mentions(codelist, narrow=doubled, deduplicate=False)
    assert raw.count() == 2 * len(_brute_mentions(data, entries))
    mapping = spark.createDataFrame([("hot_pheno", "cat_a", "a"), ("ph1", "cat_b", "b")],
                                    "phenotype string, category string, cat string")
    m = mentions(codelist, narrow=records)
    assert rows(categorise(m, mapping)) == rows(categorise(m, mapping, max_broadcast_bytes=0))
    for how in ("left_semi", "left_anti", "left"):
        keys = codelist.select("code").distinct()
        x = lookup_join(records, keys, "code", how, broadcast=True)
        y = lookup_join(records, keys, "code", how, broadcast=False)
        assert rows(x) == rows(y)


def test_clustered_write_splits_a_hot_key(spark, tmp_dir):
    # one key holds a third of the rows; the range tie-breakers spread it
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        "id")
    target = os.path.join(tmp_dir, "clustered")
    write_table(df, target, cluster_by=["k"], partitions=8)
    back = spark.read.parquet(target)
    files_with_hot = back.where(F.col("k") == "hot").select(F.input_file_name()).distinct().count()
    assert files_with_hot > 1
    assert back.count() == 30000


def test_views_and_drop_table(spark):
    from phenospark.sinks import drop_table, register_view

    df = spark.range(3)
    register_view(df, "pheno_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM pheno_view").first()["n"] == 3
    register_view(df, "pheno_gview", global_view=True)
    assert spark.sql("SELECT COUNT(*) AS n FROM global_temp.pheno_gview").first()["n"] == 3
    write_table(df, "pheno_table")
    assert spark.catalog.tableExists("pheno_table")
    drop_table(spark, "pheno_table")
    assert not spark.catalog.tableExists("pheno_table")
    drop_table(spark, "pheno_table")  # absent: no error


def test_streaming_match_shuffle_path(spark, tmp_dir):
    data, _ = _hot_records(spark, 120)
    entries, codelist = _codelist(spark)
    src = os.path.join(tmp_dir, "records2")
    spark.createDataFrame(data, "NHS_NUMBER_DEID string, DATE date, CODE string").write.parquet(src)
    stream = spark.readStream.schema("NHS_NUMBER_DEID string, DATE date, CODE string").parquet(src)
    out = match_stream(narrow_records(stream), codelist, "SNOMEDCT", max_broadcast_bytes=0)
    q = out.writeStream.format("memory").queryName("stream_mentions_shuffle").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = rows(spark.table("stream_mentions_shuffle"))
    expected = sorted(_brute_mentions(data, entries), key=lambda t: tuple((v is not None, str(v)) for v in t))
    assert got == expected


def test_a_large_lookup_is_sent_once(spark, monkeypatch):
    """Copies for every salt only while they stay small; hot, null and odd keys meet alike."""
    from phenospark.operators import joins

    facts = spark.createDataFrame([("hot", i) for i in range(200)] + [("c1", 1), ("c1", 1), ("none", 2), (None, 3)], "`the code` string, n int")
    lookup = spark.createDataFrame([("hot", "p"), ("hot", "q"), ("c1", "r"), (None, "s")], "`the code` string, phenotype string")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    salted = {how: joins.lookup_join(facts, lookup, "the code", how, broadcast=False) for how in ("inner", "left", "left_semi", "left_anti")}
    assert all("explode" in plan(df) for df in salted.values())
    monkeypatch.setattr(joins, "MAX_REPLICATED_BYTES", 100)
    for how, before in salted.items():
        once = joins.lookup_join(facts, lookup, "the code", how, broadcast=False)
        assert "explode" not in plan(once) and once.columns == before.columns and rows(once) == rows(before)


def test_a_row_s_key_is_hashed_once_by_the_filter(spark):
    from phenospark.operators.bloom import drop_unmatched, key_filter

    facts = spark.range(50).select(F.col("id").cast("string").alias("code"))
    kept = drop_unmatched(facts, key_filter(facts.where("id < 5"), ["code"]))
    join = next(line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in line)
    assert "xxhash64" not in join and kept.where("code < '5' and length(code) = 1").count() == 5


def test_one_exchange_serves_dedup_and_codelist_join(spark):
    """Above the broadcast bound records move once: to their copies and to the codelist."""
    from phenospark.operators import mentions
    from phenospark.operators.summary import mention_volumes

    data, records = _hot_records(spark, 900)
    entries, codelist = _codelist(spark)
    doubled = records.unionByName(records).unionByName(records.withColumn("date", F.lit(None).cast("date")))
    small = mentions(codelist, narrow=doubled)
    for bound in (0, 1):  # sorted and merged; held as hash tables
        large = mentions(codelist, narrow=doubled, max_broadcast_bytes=bound)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" if bound == 0 else "ShuffledHashJoin") in plan
        assert sum("person_id_deid" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line) == 0
        assert plan.count("REPARTITION_BY_COL") == 1
        assert rows(large) == rows(small)
        assert rows(mention_volumes(codelist, doubled, max_broadcast_bytes=bound)) == rows(mention_volumes(codelist, doubled))


def test_hot_key_is_cut_by_the_grouped_join(spark):
    from phenospark.operators.joins import GROUP_CUTS, grouped_lookup_join

    facts = spark.range(0, 4000, 1, 4).select(F.lit("hot").alias("code"), (F.col("id") % 2000).alias("x"))
    lookup = spark.createDataFrame([("hot", "p"), ("hot", "q")], "code string, phenotype string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for size in (None, 100):
            joined = grouped_lookup_join(facts, lookup, ["code"], ["code", "x"], lookup_bytes=size)
            assert joined.count() == 4000 and joined.distinct().count() == 4000
            assert 1 < joined.select(F.spark_partition_id()).distinct().count() <= GROUP_CUTS
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
