"""Sinks: write a stage's result as a table, clustered for later reads, replace a
table without losing the old one, regroup the files of a written one, and cut lineage
by materialising into the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenospark.session import ensure_checkpoint_dir

#: Bytes of a file that compaction aims at.
TARGET_FILE_BYTES = 128 << 20
#: Rows sampled to cut a key's values into ranges, and ranges per key (log2), of a Z-ordered table.
ZORDER_SAMPLE, ZORDER_BITS = 20_000, 6


def _quoted(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def is_path(target: str) -> bool:
    """Whether a target is a folder (contains ``/`` or a scheme) and not a table's name."""
    return "/" in target or ":" in target


def write_table(
    df: DataFrame,
    target: str,
    cluster_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partitions: int | None = None,
    zorder_by: Sequence[str] | None = None,
) -> None:
    """Write ``df`` to a path (contains ``/`` or a scheme) or a metastore table.

    ``cluster_by`` range-partitions on the keys and sorts inside each file, so
    later scans filtering or joining on them skip row groups (the role of a
    table compaction with ordering). The remaining columns follow the keys in
    the range ordering as tie-breakers: a key holding a third of all rows is
    then cut across several files instead of landing in one write task.
    ``zorder_by`` orders by several keys at once (:func:`zorder`), so that scans
    filtering on any one of them skip files.

    Overwriting replaces the previous table only when the new one is complete:
    :func:`replace_folder` and :func:`replace_table`."""
    if cluster_by and zorder_by:
        raise ValueError("cluster_by and zorder_by exclude each other")
    out = df
    if cluster_by:
        keys = list(cluster_by)
        order = keys + [c for c in df.columns if c not in keys]
        out = (out.repartitionByRange(partitions, *order) if partitions
               else out.repartitionByRange(*order)).sortWithinPartitions(*keys)
    elif zorder_by:
        out = zorder(df, zorder_by, partitions)
    if mode == "overwrite":
        (replace_folder if is_path(target) else replace_table)(out, target, fmt)
    elif is_path(target):
        out.write.mode(mode).format(fmt).save(target)
    else:
        out.write.mode(mode).format(fmt).saveAsTable(target)


# -- Z-order -------------------------------------------------------------------------

def _range_id(key: Column, bounds: Sequence) -> Column:
    """The number of ``bounds`` that a value reaches (0 for NULL)."""
    if not bounds:
        return F.lit(0)
    return F.coalesce(reduce(Column.__add__, [(key >= F.lit(b)).cast("int") for b in bounds]), F.lit(0))


def _bounds(values: Sequence, parts: int) -> list:
    """Up to ``parts - 1`` values that cut the sorted non-NULL ``values`` evenly."""
    ordered = sorted(v for v in values if v is not None)
    cuts = {ordered[len(ordered) * i // parts] for i in range(1, parts)} if ordered else set()
    return sorted(c for c in cuts if c > ordered[0])


def zorder(df: DataFrame, keys: Sequence[str], partitions: int | None = None, bits: int = ZORDER_BITS) -> DataFrame:
    """``df`` range-partitioned and sorted along a Z-curve through ``keys``.

    Each key's values are cut into ``2 ** bits`` ranges of like many rows (quantiles of
    a sample of about ``ZORDER_SAMPLE`` rows, which shapes the layout only), and the
    ranges' numbers are interleaved bit by bit: rows close in *all* keys lie together,
    so every file spans a small part of each key's values and a filter on any one of
    them skips most files. Ties follow the remaining columns, so copies of a hot key
    are cut across files. ``df`` is read three times (count, sample, write): pass a
    stored table. The bounds become constants of the plan: a retried task routes every
    row as before."""
    n = df.count()
    rows = df.select(*[_quoted(k) for k in keys]).sample(min(1.0, ZORDER_SAMPLE / max(1, n)), seed=7).collect()
    ids = [_range_id(_quoted(k), _bounds([r[i] for r in rows], 1 << bits)) for i, k in enumerate(keys)]
    curve = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(ids):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            curve = curve.bitwiseOR(F.shiftleft(one, bit * len(ids) + place))
    order = [F.col("_curve"), *[_quoted(k) for k in keys], *[_quoted(c) for c in df.columns if c not in keys]]
    placed = df.withColumn("_curve", curve)
    placed = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    return placed.sortWithinPartitions("_curve", *[_quoted(k) for k in keys]).drop("_curve")


# -- replacing a table -----------------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    """(file system, path) of the cluster's file system API."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _sibling(path: str, kind: str, tag: str) -> str:
    """A folder next to ``path`` that scans of their parent pass over (leading underscore)."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{kind}-{name}-{tag}"


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` as the folder ``path``, replacing what is there when the new files are
    complete: they are written next to it, the old folder steps aside, the new one takes
    its name, and the old one goes. A write that fails (or reads ``path`` itself) leaves
    the old rows; between the two renames, if the driver dies there,
    :func:`restore_folder` brings them back. (On an object store renames copy: there, a
    metastore table is the better target.)"""
    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    restore_folder(spark, path)
    staged, old = _sibling(path, "staged", tag), _sibling(path, "replaced", tag)
    fs, place = _folder(spark, path)
    try:
        df.write.mode("error").format(fmt).partitionBy(*partition_by).save(staged)
        if fs.exists(place):
            _rename(fs, place, _folder(spark, old)[1])
        _rename(fs, _folder(spark, staged)[1], place)
    except BaseException:
        fs.delete(_folder(spark, staged)[1], True)
        restore_folder(spark, path)
        raise
    fs.delete(_folder(spark, old)[1], True)
    spark.catalog.refreshByPath(path)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def restore_folder(spark: SparkSession, path: str) -> bool:
    """Gives a folder its name back if a replacement was cut off after it had stepped
    aside; whether there was such a folder."""
    fs, place = _folder(spark, path)
    if fs.exists(place) or not fs.exists(place.getParent()):
        return False
    aside = [s.getPath() for s in fs.listStatus(place.getParent()) if s.getPath().getName().startswith(f"_replaced-{place.getName()}-")]
    if aside:
        _rename(fs, sorted(aside, key=lambda p: fs.getFileStatus(p).getModificationTime())[-1], place)
    return bool(aside)


def describe_table(spark: SparkSession, name: str) -> dict:
    """A metastore table's description (columns, location, provider, partition columns)."""
    return json.loads(spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name) AS JSON", args={"name": name}).first()[0])


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Create or replace the metastore table ``name`` with the rows of ``df``.

    The rows are written to a folder of their own in the database's location. A table
    that exists with the same columns and format is then pointed to it, by one change
    of the metastore: readers see all old rows or all new ones, and a write that fails
    leaves the table as it was. With other columns a new table is made under another
    name and takes the old one's place (drop, rename). A managed table's old files go
    afterwards; files of an external table stay."""
    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    database, _, table = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    place = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}-{tag}"
    fs = _folder(spark, place)[0]
    try:
        df.write.mode("error").format(fmt).save(place)
    except BaseException:
        fs.delete(_folder(spark, place)[1], True)
        raise
    args = {"name": name, "new": f"{name}_{tag}"}
    if not spark.catalog.tableExists(name):
        _create(spark, name, place, fmt)
        return
    old = describe_table(spark, name)
    same = spark.table(name).dtypes == df.dtypes and old.get("provider") == fmt and not old.get("partition_columns")
    if same:
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET LOCATION '{_literal(place)}'", args={"name": name})
    else:
        _create(spark, args["new"], place, fmt)
        spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
        spark.sql(f"ALTER TABLE {_name(args['new'])} RENAME TO {_name(name)}")
    spark.catalog.refreshTable(name)
    if old.get("type") == "MANAGED" or old.get("location", "").rpartition("/")[2].startswith(f"{table}-"):
        fs.delete(_folder(spark, old["location"])[1], True)


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _name(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _create(spark: SparkSession, name: str, place: str, fmt: str) -> None:
    spark.catalog.createTable(name, path=place, source=fmt)


# -- regrouping the files of a written table ----------------------------------------------

@contextmanager
def _partition_values_as_text(spark: SparkSession):
    """Partition values read as they stand (``01`` stays ``01``), so that rewritten rows
    go back to the folder they came from."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``folder, file, length`` of the data files of a table, by a distributed listing, and
    ``at``, the folder as file metadata writes it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"),
                        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length",
                        _folder_of("_metadata.file_path").alias("at"))


def files_to_regroup(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """``folder, at, files, bytes, wanted``: the folders that hold more files than their bytes
    need (``wanted`` of about ``target_bytes``), two of them or more under half that size."""
    wanted = F.greatest(F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int"), F.lit(1))
    return (
        table_files(spark, path).groupBy("folder", "at")
        .agg(F.count(F.lit(1)).cast("int").alias("files"), F.sum("length").alias("bytes"),
             F.count_if(F.col("length") < target_bytes / 2).alias("small"))
        .withColumn("wanted", wanted).where("files > wanted and small > 1").drop("small")
    )


def compact_table(spark: SparkSession, target: str, target_bytes: int = TARGET_FILE_BYTES,
                  order_by: Sequence[str] = (), fmt: str = "parquet") -> list[tuple[str, int, int]]:
    """Regroup the small files of a written table (a path, or a metastore table) into
    files of about ``target_bytes``, sorted by ``order_by``; ``(folder, files before,
    files wanted)`` of the folders rewritten.

    Only folders that need it are read and written: those of a partitioned table are
    replaced by dynamic partition overwrite, an unpartitioned one as a whole
    (:func:`replace_folder`). Rows stay the same. A folder's rows are dealt to its files
    by their content and old file, or with ``order_by`` by ranges, so no task gets much
    more than a file."""
    path = target if is_path(target) else describe_table(spark, target)["location"]
    todo = files_to_regroup(spark, path, target_bytes).collect()
    if not todo:
        return []
    with _partition_values_as_text(spark):
        table = spark.read.format(fmt).load(path)
    data = spark.read.format(fmt).option("recursiveFileLookup", "true").load(path).columns
    parts = [c for c in table.columns if c not in data]
    path_of = F.col("_metadata.file_path")
    at = _folder_of("_metadata.file_path")
    firsts = accumulate([0, *(r["wanted"] for r in todo)])  # number of a folder's first file
    plan = spark.createDataFrame([(r["at"], r["wanted"], n) for r, n in zip(todo, firsts)], "_at string, _wanted int, _first int")
    rows = table.where(at.isin([r["at"] for r in todo])).withColumns({"_at": at, "_path": path_of}).join(F.broadcast(plan), "_at")
    total = sum(r["wanted"] for r in todo)
    columns, order = [_quoted(c) for c in table.columns], [_quoted(c) for c in order_by]
    if order:
        rows = rows.repartitionByRange(total, "_first", *order, *columns).sortWithinPartitions("_first", *order)
    else:
        file = F.col("_first") + F.pmod(F.xxhash64(*columns, "_path"), F.col("_wanted")).cast("int")
        rows = rows.repartitionById(total, file)
    rows = rows.select(*columns)
    if parts:
        rows.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(path)
        spark.catalog.refreshByPath(path)
    else:
        replace_folder(rows, path, fmt)
    if not is_path(target):
        spark.catalog.refreshTable(target)
    return sorted((r["folder"], r["files"], r["wanted"]) for r in todo)


def _folder_of(path: str) -> Column:
    """The folder of a path, by what is left of its last part (evaluated for every row)."""
    return F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)


# -- stages and views ----------------------------------------------------------------------

def write_and_read(df: DataFrame, path: str, cluster_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet at ``path`` and return the table read back:
    what follows starts from the files, not from ``df``'s lineage."""
    write_table(df, path, cluster_by=cluster_by)
    return df.sparkSession.read.parquet(path)


def materialise(df: DataFrame, name: str, cluster_by: Sequence[str] | None = None,
                zorder_by: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Write ``df`` under the session's checkpoint folder and read it back.

    The returned DataFrame's lineage starts at the written files, so a lost
    executor costs a re-read, not a recomputation of the whole history, and
    several downstream counts share one computation."""
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/phenospark/{name}-{uuid.uuid4().hex[:12]}"  # new: nothing to replace
    write_table(df, path, cluster_by, "error", partitions=partitions, zorder_by=zorder_by)
    return df.sparkSession.read.parquet(path)


def register_view(df: DataFrame, name: str, global_view: bool = False) -> DataFrame:
    """Expose ``df`` to SQL as a (global) temporary view; returns ``df``.
    Inside the library DataFrames are passed directly; this is for SQL users."""
    if global_view:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return df


def drop_table(spark, name: str) -> None:
    """``DROP TABLE IF EXISTS`` with the name bound as a parameter, never
    pasted into the SQL text."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, for display."""
    return df.limit(n)
