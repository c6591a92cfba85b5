"""First dates and occurrence counts kept up to date, delivery by delivery.

The stored state is the distinct mentions, one row each (``KEYS, date, n``): the row of
a key's (person, phenotype, code and terminology) first date carries in ``n`` how many
distinct mentions the key has, other rows carry NULL. Distinct mentions unite with
others in any order, and uniting them with what they already hold changes nothing; so a
delivery may repeat earlier mentions, or be run again after a failure, and first date
and number of mentions stay exact, which sums of counts could not give.

Rows lie in ``parts`` folders by a hash of the person. A delivery reads and rewrites
only the folders of the persons it mentions (Spark's dynamic partition overwrite: the
new files are staged next to the table and moved in when the job has ended); a lost
executor costs its tasks, and running the delivery again completes it. The hash is that
of Spark's own exchanges, so one exchange by person brings old and new rows together in
the task that writes their folder: nothing else moves, and reading the summary is a
filter."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenospark.operators.mentions import PERSON
from phenospark.sinks import materialise

KEYS = (PERSON, "phenotype", "code", "terminology")
#: Folders of a store by default, least number of files of a rewritten folder, and rows
#: that a file (which one task sorts) gets on average at most.
PARTS, FILES_PER_PART, ROWS_PER_FILE = 64, 1, 2_000_000


def code_history(mentions: DataFrame) -> DataFrame:
    """``person_id_deid, phenotype, code, terminology, date, n``: the distinct mentions of
    ``mentions`` (deduplicated or not), the first date of a key with the key's number of
    them (an undated mention counts as one, and is first only if there are no others).
    One sort by key and date; no exchange if persons lie together already."""
    along = Window.partitionBy(*KEYS).orderBy(F.col("date").desc_nulls_first())
    last = F.lead(F.lit(True)).over(along).isNull()  # down the dates, so a key's first date comes last
    again = F.lead("date").over(along).eqNullSafe(F.col("date"))
    marked = mentions.select(*KEYS, "date", last.alias("_last"), again.alias("_again"), F.dense_rank().over(along).alias("_n"))
    n = F.when(F.col("_last"), F.col("_n").cast("bigint"))
    return marked.where(F.col("_last") | ~F.col("_again")).select(*KEYS, "date", n.alias("n"))


def unite_histories(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two histories as one."""
    return code_history(one.select(*KEYS, "date").unionByName(other.select(*KEYS, "date")))


def code_summary_of(history: DataFrame) -> DataFrame:
    """``person_id_deid, phenotype, code, terminology, date, n`` (first date, number of
    distinct mentions): what :func:`phenospark.operators.features.code_summary` makes of
    the mentions in one pass. A filter."""
    return history.where("n is not null").select(*KEYS, "date", "n")


def read_history(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The stored history, or that of the folders ``only``."""
    stored = spark.read.parquet(path)
    if only is not None:
        stored = stored.where(F.col("part").isin(list(only)))
    return stored.select(*KEYS, "date", "n")


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, if there is one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def merge_delivery(mentions: DataFrame, path: str, parts: int = PARTS, files_per_part: int = FILES_PER_PART,
                   written: bool = False) -> list[int]:
    """Unites the history stored at ``path`` (created by the first delivery) with the
    ``mentions`` of a delivery; returns the numbers of the folders it rewrote.

    ``parts`` is fixed by the first delivery; another number is an error. A folder is cut
    into ``files_per_part`` files, or more so that they have ``ROWS_PER_FILE`` rows or
    less on average. The delivery is written first, unless ``written`` says that it is
    read from a table; its rows are counted by folder (at most ``parts`` numbers reach the
    driver), and stored folders it does not touch are not read."""
    spark = mentions.sparkSession
    delivered = mentions.select(*KEYS, "date")
    if not written:
        delivered = materialise(delivered, "delivery")
    counted = {r["part"]: r["count"] for r in delivered.groupBy(person_part(parts).alias("part")).count().collect()}
    touched, n, stored = sorted(counted), sum(counted.values()), stored_table(spark, path)
    if not touched:
        return []
    if stored is not None:
        if "dates" in stored.columns:
            raise ValueError(f"{path} holds sets of dates, the form of an earlier version: make the history again")
        if (made := stored.select("parts").first()) is not None and made["parts"] != parts:
            raise ValueError(f"{path} has {made['parts']} parts, not {parts}")
        stored = stored.where(F.col("part").isin(touched)).select(*KEYS, "date")
        n += stored.count()
        delivered = delivered.unionByName(stored)
    files = max(files_per_part, math.ceil(n / len(touched) / ROWS_PER_FILE))
    # Partitions of the exchange are files: the hash's remainder by parts * files fixes that by parts.
    placed = code_history(delivered.repartition(parts * files, PERSON))
    rewrite_parts(placed.withColumn("parts", F.lit(parts)), path, parts)
    return touched


def person_part(parts: int) -> Column:
    """The number of a person's folder; the hash is that of Spark's exchanges."""
    return F.pmod(F.hash(PERSON), F.lit(parts)).cast("int")


def rewrite_parts(rows: DataFrame, path: str, parts: int) -> None:
    """Replaces the folders of the table at ``path`` that ``rows`` fall in by them (they
    are those of all persons in these folders, ``person_id_deid`` among their columns, and
    lie in a multiple of ``parts`` partitions by person, so that a task writes one file)."""
    (
        rows.withColumn("part", person_part(parts))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    )
