"""Written tables: Z-order, safe replacement, regrouping of files."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from phenospark import sinks
from phenospark.sources import read_code_tables
from tests.conftest import rows


def _failing(spark, n=100):
    return spark.range(n).select("id", F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost")).cast("int")).otherwise(0).alias("x"))


def _data_files(path):
    return sorted(glob.glob(f"{path}/**/*.parquet", recursive=True))


# -- replacement ------------------------------------------------------------------

def test_a_failed_write_leaves_the_folder_s_rows(spark, tmp_dir):
    path = f"{tmp_dir}/a place/t"
    sinks.write_table(spark.range(5).select("id", F.lit(1).alias("x")), path)
    with pytest.raises(Exception, match="lost"):
        sinks.write_table(_failing(spark), path)
    assert spark.read.parquet(path).count() == 5
    sinks.write_table(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7
    assert os.listdir(f"{tmp_dir}/a place") == ["t"]  # nothing staged or old is left


def test_a_folder_may_be_replaced_by_what_is_read_from_it(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sinks.write_table(spark.range(10), path)
    sinks.write_table(spark.read.parquet(path).where("id > 3"), path, cluster_by=["id"])
    assert spark.read.parquet(path).count() == 6


def test_a_replacement_cut_off_between_its_renames_is_restored(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    sinks.write_table(spark.range(5), path)
    real, calls = sinks._rename, []

    def dies(fs, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise KeyboardInterrupt
        real(fs, source, target)

    monkeypatch.setattr(sinks, "_rename", dies)
    with pytest.raises(KeyboardInterrupt):
        sinks.write_table(spark.range(9), path)
    monkeypatch.setattr(sinks, "_rename", real)
    assert spark.read.parquet(path).count() == 5  # rolled back at once
    os.rename(path, f"{tmp_dir}/_replaced-t-0123")  # the driver died there
    assert sinks.restore_folder(spark, path) and spark.read.parquet(path).count() == 5
    assert not sinks.restore_folder(spark, path) and not sinks.restore_folder(spark, f"{tmp_dir}/none/t")


def test_a_failed_write_leaves_the_table_s_rows(spark):
    name = "replaced_rows"
    sinks.drop_table(spark, name)
    sinks.write_table(spark.range(5).select("id", F.lit(1).alias("x")), name)
    before = sinks.describe_table(spark, name)["location"]
    with pytest.raises(Exception, match="lost"):
        sinks.write_table(_failing(spark), name)
    assert spark.table(name).count() == 5 and sinks.describe_table(spark, name)["location"] == before
    sinks.write_table(spark.table(name).where("id > 1"), name)  # reads what it replaces
    assert spark.table(name).count() == 3
    after = sinks.describe_table(spark, name)["location"]
    assert after != before and not os.path.exists(before.removeprefix("file:"))
    sinks.drop_table(spark, name)


def test_a_table_may_change_its_columns(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS replaced")
    name = "replaced.codelist_icd_t"
    sinks.drop_table(spark, name)
    spark.createDataFrame([("N17", 1)], "ICD10code string, a int").write.mode("overwrite").partitionBy("a").saveAsTable(name)
    sinks.write_table(spark.createDataFrame([("N18",), ("N19",)], "ICD10code string"), name)
    assert rows(read_code_tables(spark, [name])) == [("codelist_icd_t", "ICD", "N18"), ("codelist_icd_t", "ICD", "N19")]
    assert [t.name for t in spark.catalog.listTables("replaced") if not t.isTemporary] == ["codelist_icd_t"]


def test_append_adds(spark, tmp_dir):
    for _ in range(2):
        sinks.write_table(spark.range(3), f"{tmp_dir}/t", mode="append")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 6


# -- Z-order -----------------------------------------------------------------------

def _points(spark, n=8000):
    h = F.xxhash64("id")
    return spark.range(n).select(
        F.pmod(h, F.lit(500)).alias("person"), F.concat(F.lit("code"), F.pmod(F.shiftright(h, 16), F.lit(300)).cast("string")).alias("code"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.shiftright(h, 32), F.lit(1000)).cast("int")).alias("date"), "id")


def _read_share(table, key):
    """Mean share of the files that a filter on one value of ``key`` has to read."""
    spans = table.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    values = [r[0] for r in table.select(key).distinct().collect() if r[0] is not None]
    return sum(s.lo <= v <= s.hi for v in values for s in spans if s.lo is not None) / len(values) / len(spans)


def test_zorder_files_prune_on_every_key(spark, tmp_dir):
    points = _points(spark)
    sinks.write_table(points, f"{tmp_dir}/z", zorder_by=["person", "code", "date"], partitions=27)
    sinks.write_table(points, f"{tmp_dir}/c", cluster_by=["person", "code", "date"], partitions=27)
    z, c = spark.read.parquet(f"{tmp_dir}/z"), spark.read.parquet(f"{tmp_dir}/c")
    assert z.columns == points.columns and rows(z) == rows(points)
    shares = {k: _read_share(z, k) for k in ("person", "code", "date")}
    assert max(shares.values()) < 0.6, shares
    assert _read_share(c, "code") > 0.9 and _read_share(c, "date") > 0.9  # a leading key alone prunes


def test_zorder_of_hot_null_and_constant_keys(spark, tmp_dir):
    points = _points(spark, 3000).select(
        F.when(F.col("id") % 3 > 0, F.col("person")).otherwise(7).alias("person"),
        F.when(F.col("id") % 5 > 0, F.col("code")).alias("code"), F.lit("same").alias("c.d"), "id")
    sinks.write_table(points, f"{tmp_dir}/z", zorder_by=["person", "code", "c.d"], partitions=12)
    back = spark.read.parquet(f"{tmp_dir}/z")
    assert rows(back) == rows(points)
    sizes = [r["count"] for r in back.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) < 0.25 * 3000  # the hot person is cut across files
    sinks.write_table(points.limit(0), f"{tmp_dir}/none", zorder_by=["person", "code"])
    with pytest.raises(ValueError, match="exclude"):
        sinks.write_table(points, f"{tmp_dir}/x", cluster_by=["id"], zorder_by=["id"])


# -- compaction -----------------------------------------------------------------------

def test_small_files_of_a_folder_are_regrouped(spark, tmp_dir):
    path, target = f"{tmp_dir}/a t", 400_000
    table = spark.range(200_000).select(F.xxhash64("id").alias("h"), "id")
    table.repartition(40).write.parquet(path)
    total = sum(map(os.path.getsize, _data_files(path)))
    ((_, n, wanted),) = sinks.compact_table(spark, path, target_bytes=target)
    files = _data_files(path)
    sizes = list(map(os.path.getsize, files))
    assert n == 40 and wanted == -(-total // target) == len(files)
    assert min(sizes) > target / 2 and max(sizes) < 1.2 * target
    back = spark.read.parquet(path)
    assert back.count() == 200_000 and back.exceptAll(table).count() == 0
    assert sinks.compact_table(spark, path, target_bytes=target) == [] and _data_files(path) == files


def test_only_the_partitions_that_need_it_are_rewritten(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rng = random.Random(1)
    data = [("01", "a b", i) for i in range(200)] + [("1", "a/b=c", i) for i in range(200)] + [("2", None, i) for i in range(50)]
    rng.shuffle(data)
    table = spark.createDataFrame(data, "p string, `q.r` string, id bigint")
    table.where("p != '2'").repartition(12).write.partitionBy("p", "q.r").parquet(path)
    table.where("p = '2'").coalesce(1).write.mode("append").partitionBy("p", "q.r").parquet(path)
    before = _data_files(path)
    done = sinks.compact_table(spark, path, order_by=["id"])
    after = _data_files(path)
    assert len(done) == 2 and all(n == 12 and w == 1 for _, n, w in done)
    whole = [f for f in before if "/p=2/" in f]
    assert whole == [f for f in after if "/p=2/" in f] and len(after) <= 5
    with sinks._partition_values_as_text(spark):
        back = spark.read.parquet(path).select("p", "`q.r`", "id")
    assert rows(back) == rows(table)
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_a_metastore_table_is_regrouped(spark):
    name = "regrouped_rows"
    sinks.drop_table(spark, name)
    spark.range(100).repartition(10).write.saveAsTable(name)
    assert [(n, w) for _, n, w in sinks.compact_table(spark, name)] == [(10, 1)]
    assert spark.table(name).count() == 100 and len(spark.table(name).inputFiles()) == 1
    sinks.drop_table(spark, name)


def test_a_failed_regrouping_leaves_the_files(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    spark.range(100).repartition(5).write.parquet(path)
    before = _data_files(path)

    def fails(*_):
        raise OSError("no rename")

    monkeypatch.setattr(sinks, "_rename", fails)
    with pytest.raises(OSError, match="no rename"):
        sinks.compact_table(spark, path)
    assert _data_files(path) == before and os.listdir(tmp_dir) == ["t"]


def test_small_files_of_the_contract_query_grow_with_the_shuffle(spark, monkeypatch):
    from phenospark.plans import contract
    from tests.conftest import SMOKE_DIR

    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []

    def compact(session, path, **how):
        seen.append({r["folder"]: r["count"] for r in contract.table_files(session, path).groupBy("folder").count().collect()})
        return sinks.compact_table(session, path, **how)

    monkeypatch.setattr(contract, "compact_table", compact)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        got = contract.QUERIES["mentions_compacted"](spark, SMOKE_DIR).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 3 and all(r["fewer_files"] for r in got) and max(seen[0].values()) > 6


def test_a_file_s_folder_is_found_without_patterns(spark, tmp_dir):
    from pyspark.sql import functions as F

    from phenospark.sinks import _folder_of, table_files

    path = f"{tmp_dir}/odd + name"
    spark.range(6).select("id", F.concat(F.lit("a b%+/"), (F.col("id") % 2).cast("string")).alias("k")).write.partitionBy("k").parquet(path)
    at = {r[0] for r in spark.read.parquet(path).select(_folder_of("_metadata.file_path")).collect()}
    assert len(at) == 2 and at == {r["at"] for r in table_files(spark, path).select("at").collect()}
    spark.range(6, 12).select("id", F.concat(F.lit("a b%+/"), (F.col("id") % 2).cast("string")).alias("k")).write.mode("append").partitionBy("k").parquet(path)
    was = sorted(map(tuple, spark.read.parquet(path).select("id", "k").collect()))
    assert len(sinks.compact_table(spark, path, order_by=["id"])) == 2
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "k").collect())) == was
