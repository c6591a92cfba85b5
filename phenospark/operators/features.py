"""Per-person features derived from mentions: first dates, occurrence counts,
and the person x phenotype flag matrix.

All are grouped aggregates; Spark plans each as partial aggregate -> shuffle
on the grouping keys -> final aggregate, so a person with a huge history is
first reduced inside every map task and never travels as one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.operators.mentions import MENTION_COLUMNS, PERSON


def code_summary(mentions: DataFrame) -> DataFrame:
    """One aggregation over the mentions per person, phenotype, code and
    terminology: first ``date`` and ``n`` mentions. Every per-person feature
    below can be derived from it, so the full mention table is shuffled once
    for all of them (:func:`features_from_summary`)."""
    keys = [PERSON, "phenotype", "code", "terminology"]
    return mentions.groupBy(*keys).agg(
        F.min("date").alias("date"), F.count(F.lit(1)).alias("n")
    )


def features_from_summary(summary: DataFrame) -> dict[str, DataFrame]:
    """``first_dates`` and ``features_by_phenotype`` (first date and number of
    mentions per person and phenotype) from a :func:`code_summary`: the same
    results as the functions applied to the mentions. The first is a projection,
    the second one aggregation of the smaller table."""
    return {
        "first_dates": summary.select(*MENTION_COLUMNS),
        "features_by_phenotype": summary.groupBy(PERSON, "phenotype").agg(
            F.min("date").alias("date"), F.sum("n").alias("n_occurrences")),
    }


def first_dates(mentions: DataFrame) -> DataFrame:
    """Earliest date of each code per person and phenotype, in mention shape
    (``person_id_deid, phenotype, date, code, terminology``)."""
    keys = [PERSON, "phenotype", "code", "terminology"]
    return mentions.groupBy(*keys).agg(F.min("date").alias("date")).select(*MENTION_COLUMNS)


def first_dates_by_phenotype(mentions: DataFrame) -> DataFrame:
    """Earliest date of any code of a phenotype per person:
    ``person_id_deid, phenotype, date``."""
    return mentions.groupBy(PERSON, "phenotype").agg(F.min("date").alias("date"))


def n_occurrences(mentions: DataFrame) -> DataFrame:
    """Number of (deduplicated) mentions per person and phenotype:
    ``person_id_deid, phenotype, n_occurrences``."""
    return mentions.groupBy(PERSON, "phenotype").agg(F.count(F.lit(1)).alias("n_occurrences"))


def features_by_phenotype(mentions: DataFrame) -> DataFrame:
    """First date and number of (deduplicated) mentions per person and phenotype
    in one aggregation: ``person_id_deid, phenotype, date, n_occurrences``."""
    return mentions.groupBy(PERSON, "phenotype").agg(
        F.min("date").alias("date"), F.count(F.lit(1)).alias("n_occurrences"))


def phenotype_names(df: DataFrame) -> list[str]:
    """The distinct phenotypes of a mention table or codelist, sorted. They
    become column names of the flag matrix, so they come to the driver (as
    many names as the codelist has phenotypes)."""
    return sorted(r[0] for r in df.select("phenotype").where("phenotype is not null").distinct().collect())


def flag_matrix(
    mentions: DataFrame, phenotypes: Sequence[str] | None = None, binary: bool = True
) -> DataFrame:
    """Wide person x phenotype matrix: ``person_id_deid`` plus one column per
    phenotype holding 1/0 (``binary``) or the mention count.

    Pass ``phenotypes`` (e.g. the codelist's) to fix the columns up front;
    otherwise they are the phenotypes present in ``mentions``, found by one
    small distinct job. Column order is the sorted phenotype names either way.

    Mentions are first reduced to one row per person and phenotype; these rows
    are sent to their person's partition and pivoted there, so the shuffles
    carry pairs, never rows as wide as the matrix, and a person has at most one
    row per phenotype."""
    if phenotypes is None:
        phenotypes = phenotype_names(mentions)
    values = sorted({p for p in phenotypes if p is not None})
    cell = F.lit(1).cast("bigint") if binary else F.count(F.lit(1))
    keys = [PERSON, "phenotype"]
    pairs = (mentions.select(*keys).distinct().withColumn("cell", cell) if binary
             else mentions.groupBy(*keys).agg(cell.alias("cell")))
    wide = pairs.repartition(PERSON).groupBy(PERSON).pivot("phenotype", values).agg(F.max("cell"))
    # One fill over the phenotype columns (names quoted, the person id untouched).
    return wide.na.fill(0, subset=["`" + v.replace("`", "``") + "`" for v in values])


def flag_cells(matrix: DataFrame) -> DataFrame:
    """A flag matrix in long form: ``person_id_deid, phenotype, flag``, every cell."""
    names = [c for c in matrix.columns if c != PERSON]
    values = [F.col("`" + c.replace("`", "``") + "`").alias(c) for c in names]
    return matrix.unpivot([PERSON], values, "phenotype", "flag")


def flag_sizes(matrix: DataFrame) -> DataFrame:
    """``phenotype, n_ones, n_zeros`` of a binary flag matrix."""
    return flag_cells(matrix).groupBy("phenotype").agg(
        F.sum("flag").alias("n_ones"), F.sum(1 - F.col("flag")).alias("n_zeros"))
