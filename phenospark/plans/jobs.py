"""The three jobs of the phenotyping workflow, from stored inputs to written
outputs, each returning the summaries it reports.

1. :func:`codelist_job` — dictionary CSV + a folder of codelist files ->
   ``catalog`` and ``codelist`` tables; totals, phenotypes, per-phenotype counts.
2. :func:`mentions_job` — codelist + narrow and wide record tables ->
   ``mentions`` (deduplicated) and optionally ``mentions_raw``; coverage of
   the narrow source, raw and deduplicated totals, duplicate volume.
3. :func:`categories_job` — category list + abbreviations CSVs + mentions ->
   ``category_mapping`` and ``mentions_categorised``; category sizes, codes per
   category and per phenotype, unmapped / orphan checks.

4. :func:`features_job` — a delivery of mentions -> the kept state of every person
   (histories of mention dates, phenotype ids, coverage sketches), of which only
   the folders of the delivery's persons are rewritten; the features read from it.

``out_root`` is a folder, or the name of a database whose tables the outputs
become. Each written table is read back before anything else uses it, so summaries
share one computation and a lost executor costs a re-read, not a replay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenospark.operators import catalog as catalog_ops
from phenospark.operators import categories as category_ops
from phenospark.operators import checks, features, history, sketches, sparse, summary
from phenospark.operators.codelist import build_codelist
from phenospark.operators.mentions import (
    HOSPITAL_SLOTS,
    PERSON,
    mentions,
    narrow_records,
    wide_records,
)
from phenospark.sinks import is_path, materialise, write_table
from phenospark.sources.codelists import list_sources, list_tables, read_code_files, read_code_tables
from phenospark.sources.tables import (
    read_abbreviations,
    read_categories,
    read_dictionary,
    read_table,
)


def _write_read(df: DataFrame, out_root: str, name: str, cluster_by: Sequence[str] | None = None,
                zorder_by: Sequence[str] | None = None) -> DataFrame:
    target = f"{out_root.rstrip('/')}/{name}" if is_path(out_root) else f"{out_root}.{name}"
    if cluster_by or zorder_by:  # the layout is made from a written table
        df = materialise(df, name)
    write_table(df, target, cluster_by, zorder_by=zorder_by)
    return read_table(df.sparkSession, target)


def codelist_job(
    spark: SparkSession,
    dictionary_csv: str,
    codelist_root: str | None,
    out_root: str,
    codelist_format: str = "csv",
    table_prefix: str = catalog_ops.DEFAULT_TABLE_PREFIX,
    database: str | None = None,
    source_from: str = "file",
    cluster_by: Sequence[str] | None = None,
    codelist_database: str | None = None,
) -> dict[str, DataFrame]:
    """Codelists are files below ``codelist_root``, or (``codelist_root`` None) the
    tables of ``codelist_database`` whose names begin with ``table_prefix``: those that
    the catalog names are read. ``cluster_by``: columns by which the written codelist
    is ordered."""
    if (codelist_root is None) == (codelist_database is None):
        raise ValueError("codelists are the files of a folder or the tables of a database: name one of them")
    catalog = _write_read(
        catalog_ops.to_catalog(read_dictionary(spark, dictionary_csv), table_prefix, database),
        out_root, "catalog",
    )
    wanted = catalog_ops.without_terminology(catalog, "CPRD")
    if codelist_root is not None:
        codes = read_code_files(spark, codelist_root, fmt=codelist_format, source_from=source_from, catalog=wanted)
        # What is missing is decided by the files, not their rows: an empty codelist exists.
        present = list_sources(spark, codelist_root, f"*.{codelist_format}", source_from)
    else:
        present = list_tables(spark, codelist_database, f"{table_prefix}*").select(F.lower("table").alias("source"))
        named = present.join(wanted.select(F.col("table").alias("source")), "source", "left_semi")
        codes = read_code_tables(spark, [f"{codelist_database}.{r['source']}" for r in named.collect()])
    codelist = _write_read(build_codelist(catalog, codes), out_root, "codelist", cluster_by)
    return {
        "catalog": catalog,
        "codelist": codelist,
        "missing_sources": checks.missing_sources(catalog, present),
        "totals": summary.codelist_totals(codelist),
        "phenotypes": summary.codelist_phenotypes(codelist),
        "per_phenotype": summary.codelist_per_phenotype(codelist),
    }


def mentions_job(
    spark: SparkSession,
    codelist: str | DataFrame,
    out_root: str,
    narrow_table: str | None = None,
    wide_table: str | None = None,
    narrow_columns: Mapping[str, str] | None = None,
    wide_columns: Mapping[str, str] | None = None,
    wide_slots: Mapping[str, Sequence[str]] = HOSPITAL_SLOTS,
    narrow_terminology: str = "SNOMEDCT",
    keep_raw: bool = False,
    cluster_by: Sequence[str] | None = None,
    zorder_by: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """``narrow_columns`` / ``wide_columns`` rename the record columns for the
    adapters (``person``, ``date``[, ``code``]); ``cluster_by``: columns by
    which the written mentions are ordered, ``zorder_by``: columns any of which
    later filters can use.

    ``volumes`` has all counts (raw, deduplicated, duplicates, people,
    phenotypes, the narrow source's coverage) from one pass over each source;
    with ``keep_raw`` the bag of mentions is written too."""
    cl = read_table(spark, codelist) if isinstance(codelist, str) else codelist
    narrow = wide = None
    if narrow_table is not None:
        narrow = narrow_records(read_table(spark, narrow_table), **(narrow_columns or {}))
    if wide_table is not None:
        wide = wide_records(read_table(spark, wide_table), slots=wide_slots, **(wide_columns or {}))
    out: dict[str, DataFrame] = {}
    out["mentions"] = _write_read(
        mentions(cl, narrow=narrow, wide=wide, narrow_terminology=narrow_terminology),
        out_root, "mentions", cluster_by, zorder_by,
    )
    out["totals_dedup"] = summary.coverage(out["mentions"])
    out["volumes"] = _write_read(
        summary.mention_volumes(cl, narrow, wide, narrow_terminology), out_root, "mention_volumes")
    out["duplicate_volume"] = out["volumes"].select("n_raw", "n_dedup", "n_duplicates")
    out["totals_raw"] = out["volumes"].select(F.col("n_raw").alias("mentions"), "unique_pts", "phenotypes")
    if narrow is not None:
        out["narrow_coverage"] = out["volumes"].select(
            F.col("narrow_raw").alias("mentions"), F.col("narrow_pts").alias("unique_pts"),
            F.col("narrow_phenotypes").alias("phenotypes"))
    if keep_raw:
        out["mentions_raw"] = _write_read(
            mentions(cl, narrow=narrow, wide=wide, narrow_terminology=narrow_terminology,
                     deduplicate=False),
            out_root, "mentions_raw", cluster_by,
        )
    return out


def categories_job(
    spark: SparkSession,
    categories_csv: str,
    abbreviations_csv: str,
    mentions_df: DataFrame,
    out_root: str,
    codelist: DataFrame | None = None,
) -> dict[str, DataFrame]:
    categories = read_categories(spark, categories_csv)
    abbreviations = read_abbreviations(spark, abbreviations_csv)
    mapping = _write_read(
        category_ops.build_mapping(categories, abbreviations), out_root, "category_mapping"
    )
    categorised = _write_read(
        category_ops.categorise(mentions_df, mapping), out_root, "mentions_categorised"
    )
    listed = category_ops.tidy_categories(categories)
    short = category_ops.tidy_abbreviations(abbreviations)
    out = {
        "category_mapping": mapping,
        "mentions_categorised": categorised,
        "category_sizes": summary.category_sizes(mapping),
        "codes_per_category": summary.codes_per_category(categorised),
        "codes_per_phenotype": summary.codes_per_phenotype(categorised),
        "categories_without_abbreviation": checks.unmapped(listed, short, "category"),
        "rows_without_phenotype": checks.null_keys(categories, "Phenotype"),
    }
    if codelist is not None:
        out["unmapped_phenotypes"] = checks.unmapped(codelist, mapping)
        out["orphan_categories"] = checks.orphans(mapping, codelist)
    return out


#: What coverage sketches are kept by.
SKETCHED_BY = ("terminology", "year")


def features_job(
    spark: SparkSession,
    mentions_df: DataFrame,
    phenotypes: DataFrame,
    out_root: str,
    parts: int = history.PARTS,
    written: bool = False,
) -> dict[str, DataFrame]:
    """Brings the state kept below the folder ``out_root`` up to date with a delivery of
    mentions (new ones, repeated ones, or all there are) and returns what it says now.

    ``phenotypes`` (``phenotype``; e.g. the codelist) extends the dictionary. Persons
    lie in ``parts`` folders: the histories of those the delivery mentions are merged,
    and their phenotype ids and coverage sketches are made again from them, so counts
    stay exact whatever a delivery repeats; other folders are not read. The job may be
    run again after a failure at any point.

    ``code_summary``, ``first_dates``, ``features_by_phenotype`` (first date and number
    of mentions), ``dictionary`` and ``person_rows`` (sorted phenotype ids), ``coverage``
    (estimates per vocabulary and year, per vocabulary, per year and of all)."""
    if not is_path(out_root):
        raise ValueError("the kept state is a folder")
    root = out_root.rstrip("/")
    history_at, rows_at, sketches_at, names_at = (f"{root}/{n}" for n in ("history", "person_rows", "coverage_sketches", "dictionary"))
    known = history.stored_table(spark, names_at)
    write_table(sparse.phenotype_dictionary(phenotypes, known), names_at)
    dictionary = spark.read.parquet(names_at)
    touched = history.merge_delivery(mentions_df, history_at, parts, written=written)
    if not touched and history.stored_table(spark, history_at) is None:
        raise ValueError(f"nothing is kept at {root} yet, and the delivery has no mentions")
    if touched:
        own = history.read_history(spark, history_at, touched)
        ids = sparse.person_rows(history.code_summary_of(own), dictionary)  # a row a key has all pairs
        history.rewrite_parts(ids.repartition(parts, PERSON), rows_at, parts)
        per_part = own.withColumns({"year": F.year("date"), "part": history.person_part(parts)})
        sketched = sketches.sketch_coverage(per_part, ["part", *SKETCHED_BY])
        sketched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(sketches_at)
    per_code = history.code_summary_of(history.read_history(spark, history_at))
    return {
        "code_summary": per_code,
        **features.features_from_summary(per_code),
        "dictionary": dictionary,
        "person_rows": spark.read.parquet(rows_at).drop("part"),
        "coverage": sketches.coverage_of_cuts(
            spark.read.parquet(sketches_at), [list(SKETCHED_BY), [SKETCHED_BY[0]], [SKETCHED_BY[1]], []], SKETCHED_BY),
    }


__all__ = ["categories_job", "codelist_job", "features_job", "mentions_job"]
