"""Matching new records as they arrive.

Matching is a stream-static inner join (records stream x codelist table), so
the very same :func:`phenospark.operators.mentions.match` runs on a streaming
DataFrame, without state. New mentions are added to a written mention table per
micro-batch: repeated ones inside the batch are dropped, and those that the
table has already are left out by an anti join. No watermark is involved, so a
record is never too old to be counted: histories span decades, and a mention of
any date is stored exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from phenospark.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, fits, salted_join
from phenospark.operators.mentions import MENTION_COLUMNS, match


def match_stream(
    records: DataFrame,
    codelist: DataFrame,
    terminology: str | None = None,
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Streaming records -> streaming mentions (no state). The static codelist
    is measured once; it is broadcast only within the bound, else the
    stream-static join is salted (a hot code spreads over the salt values)."""
    broadcast = None
    if max_broadcast_bytes is not None:
        broadcast = fits(codelist, max_broadcast_bytes)
    if broadcast is False:
        lookup = codelist.select("terminology", "code", "phenotype")
        keys = ["terminology", "code"]
        if terminology is not None:
            lookup = codelist.where(F.col("terminology") == F.lit(terminology)).select("code", "phenotype")
            keys = ["code"]
            records = records.select(*[c for c in records.columns if c != "terminology"])
        joined = salted_join(records, lookup, keys, "inner")
        term = F.lit(terminology).alias("terminology") if terminology else F.col("terminology")
        return joined.select("person_id_deid", "phenotype", "date", "code", term)
    return match(records, codelist, terminology, max_broadcast_bytes=None, broadcast=broadcast)


def add_new_mentions(batch: DataFrame, batch_id: int, target: str) -> None:
    """Writes the mentions of ``batch`` that the table at ``target`` lacks, each
    once, into a folder of the batch's own.

    A batch that is run again after a failure replaces its folder; what it is
    compared with are the batches before it, so it writes the same rows."""
    spark = batch.sparkSession
    new = batch.select(*MENTION_COLUMNS).dropDuplicates()
    if batch_id > 0:
        known = spark.read.schema(new.schema).option("basePath", target).option("recursiveFileLookup", "true").parquet(
            f"{target}/batch=*") if _exists(spark, target) else None
        if known is not None:
            before = known.where(F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)", 1).cast("bigint") < batch_id)
            same = [new[c].eqNullSafe(before[c]) for c in MENTION_COLUMNS]
            new = new.join(before, same, "left_anti")
    new.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")


def _exists(spark, target: str) -> bool:
    """Whether anything has been written below ``target``."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        return not listed.load(target).select("path").isEmpty()
    except Exception as e:  # the folder itself is missing
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise


def store_mentions(mentions: DataFrame, target: str, checkpoint: str, trigger_once: bool = True) -> StreamingQuery:
    """Adds a streaming mention table to the parquet table at ``target``, every
    distinct mention once whenever it arrives (read it back with
    :func:`read_mentions`)."""
    writer = mentions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: add_new_mentions(batch, batch_id, target))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_mentions(spark, target: str) -> DataFrame:
    """The mention table that :func:`store_mentions` writes."""
    return spark.read.parquet(f"{target}/batch=*").select(*MENTION_COLUMNS)


def append_mentions(
    mentions: DataFrame, target: str, checkpoint: str, trigger_once: bool = True
) -> StreamingQuery:
    """Append a streaming mention table to a parquet location as it comes, as a
    bag (exactly once through the checkpoint)."""
    writer = (
        mentions.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
