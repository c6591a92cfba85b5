"""The person x phenotype flags as sparse rows: a dictionary of phenotypes and, per
person, the sorted ids of the person's phenotypes.

A wide flag matrix spends a cell on every phenotype a person does *not* have. Here a
person is one row (``person_id_deid, ids``) whose size follows the person's own
phenotypes, at most the dictionary's. Sets unite, so rows of several deliveries are
merged by union (in any order, a delivery given twice changes nothing), and cells,
sizes and pair counts come from the ids. The wide matrix is a projection of the row,
without a pivot, for consumers that want columns.

The dictionary is a table that only grows: an id, once given, never changes its
meaning, so rows stored under an older dictionary stay valid."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenospark.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, grouped_lookup_join, lookup_join, size_in_bytes
from phenospark.operators.mentions import PERSON
from phenospark.sinks import materialise


def phenotype_dictionary(phenotypes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``phenotype, id``: the distinct non-NULL ``phenotype`` values numbered from 0 in
    their order; with ``known`` (an earlier dictionary) its ids stay and new names are
    numbered on from its largest.

    Numbering needs no single task: names are range-partitioned once (a written
    table), numbered inside their partition, and shifted by the sizes of the
    partitions before it (one row per partition)."""
    names = phenotypes.select("phenotype").where("phenotype is not null").distinct()
    first = 0
    if known is not None:
        known = known.select("phenotype", "id")
        names = names.join(known, "phenotype", "left_anti")
        most = known.agg(F.max("id")).first()[0]
        first = 0 if most is None else most + 1
    ranged = materialise(names.repartitionByRange("phenotype").withColumn("part", F.spark_partition_id()), "dictionary_names")
    before = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("phenotype")) - 1
    numbered = ranged.withColumn("place", place).join(F.broadcast(before), "part").select(
        "phenotype", (F.col("place") + F.col("before") + first).cast("int").alias("id"))
    return numbered if known is None else known.unionByName(numbered)


def encode_phenotypes(df: DataFrame, dictionary: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with its ``phenotype`` replaced by the dictionary's id (NULL stays NULL), so
    that rows travel with a number instead of a name. As ids and names are one to one,
    what is grouped, counted or joined by the one is so by the other; the results get
    their names back from :func:`name_phenotypes`. A phenotype the dictionary lacks is an
    error."""
    coded = lookup_join(df, dictionary.select("phenotype", "id"), "phenotype", "left", max_broadcast_bytes)
    known = F.coalesce("id", F.raise_error(F.concat(F.lit("not in the dictionary: "), "phenotype")).cast("int"))
    ids = F.when(F.col("phenotype").isNotNull(), known).alias("phenotype")
    return coded.select(*[ids if c == "phenotype" else "`" + c.replace("`", "``") + "`" for c in df.columns])


def name_phenotypes(df: DataFrame, dictionary: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with the ids of :func:`encode_phenotypes` replaced by their names, by a
    broadcast join where the dictionary fits: no exchange."""
    names = dictionary.select(F.col("id").alias("phenotype"), F.col("phenotype").alias("_name"))
    named = lookup_join(df, names, "phenotype", "left", max_broadcast_bytes)
    return named.select(*[F.col("_name").alias(c) if c == "phenotype" else "`" + c.replace("`", "``") + "`" for c in df.columns])


def person_rows(mentions: DataFrame, dictionary: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``person_id_deid, ids``: every person's phenotype ids, sorted. Pairs are made
    distinct, encoded (a dictionary too large to broadcast meets them in the exchange that
    makes them distinct), and meet by person; a person has at most as many ids as the
    dictionary. A phenotype the dictionary lacks is an
    error (silently losing it would not show)."""
    pairs, names = mentions.select(PERSON, "phenotype").where("phenotype is not null"), dictionary.select("phenotype", "id")
    size = size_in_bytes(names)
    if size <= max_broadcast_bytes:
        coded = lookup_join(pairs.distinct(), names, "phenotype", "left", None, True)
    else:  # rows lie by phenotype then: as pairs they travel to their person lighter than as sets of one id
        coded = grouped_lookup_join(pairs, names, ["phenotype"], [PERSON, "phenotype"], how="left",
                                    lookup_bytes=size if max_broadcast_bytes else None).repartition(PERSON)
    known = F.coalesce("id", F.raise_error(F.concat(F.lit("not in the dictionary: "), "phenotype")).cast("int"))
    return coded.groupBy(PERSON).agg(F.array_sort(F.collect_set(known)).alias("ids"))


def merge_person_rows(*deliveries: DataFrame) -> DataFrame:
    """The rows of several deliveries (of one dictionary) as one per person: the union
    of the ids."""
    united = reduce(DataFrame.unionByName, deliveries)
    return united.select(PERSON, F.explode_outer("ids").alias("id")).groupBy(PERSON).agg(
        F.array_sort(F.collect_set("id")).alias("ids"))


def cells(rows: DataFrame, dictionary: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``person_id_deid, phenotype, flag``: the cells that are one."""
    ones = rows.select(PERSON, F.explode("ids").alias("id"))
    named = lookup_join(ones, dictionary.select("id", "phenotype"), "id", "inner", max_broadcast_bytes)
    return named.select(PERSON, "phenotype", F.lit(1).cast("bigint").alias("flag"))


def sizes(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``phenotype, n_ones, n_zeros`` of every phenotype of the dictionary."""
    ones = rows.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    n_ones = F.coalesce("n", F.lit(0)).cast("bigint")
    people = rows.agg(F.count(F.lit(1)).alias("people"))
    return (
        dictionary.select("phenotype", "id").join(ones, "id", "left")
        .select("phenotype", n_ones.alias("n_ones"), (F.lit(people.scalar()) - n_ones).alias("n_zeros"))
    )


def wide_matrix(rows: DataFrame, dictionary: Sequence[tuple[str, int]]) -> DataFrame:
    """``person_id_deid`` and a 1/0 column for every (phenotype, id) given, by one
    projection of the rows: no exchange and no pivot. The columns are the caller's
    list, which a plan has to hold anyway."""
    own = F.col("ids")
    return rows.select(PERSON, *[F.array_contains(own, F.lit(i).cast("int")).cast("bigint").alias(p) for p, i in sorted(dictionary)])
