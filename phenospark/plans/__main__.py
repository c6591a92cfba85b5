"""Run the three jobs from the command line.

    python -m phenospark.plans --dictionary dictionary.csv --codelists lists/ \\
        --narrow primary_care --wide admissions \\
        --categories categories.csv --abbreviations abbreviations.csv --out out/

``--narrow`` / ``--wide`` take a table name or a path, ``--out`` a folder or a database
whose tables the outputs become; codelists are files (``--codelists``) or tables of a
database (``--codelist-database``). ``--features`` names a folder whose kept features
are brought up to date with the mentions. The session is the
one ``spark-submit`` (or the environment) configures; summaries are printed.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from phenospark.plans.jobs import categories_job, codelist_job, features_job, mentions_job


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m phenospark.plans")
    p.add_argument("--dictionary", required=True, help="dictionary CSV (phenotype,CPRD,ICD,OPCS)")
    p.add_argument("--codelists", default=None, help="folder of codelist files")
    p.add_argument("--codelist-database", default=None, help="database of codelist tables (instead of files)")
    p.add_argument("--codelist-format", default="csv")
    p.add_argument("--source-from", default="file", choices=["file", "directory", "partition"])
    p.add_argument("--table-prefix", default="codelist_")
    p.add_argument("--database", default=None)
    p.add_argument("--narrow", default=None, help="narrow record table or path")
    p.add_argument("--wide", default=None, help="wide record table or path")
    p.add_argument("--categories", default=None, help="category list CSV (Phenotype,Category)")
    p.add_argument("--abbreviations", default=None, help="abbreviations CSV (Category,Short)")
    p.add_argument("--keep-raw", action="store_true", help="also write the raw (bag) mentions")
    p.add_argument("--cluster-codelist", nargs="+", default=None, help="columns that order the written codelist")
    p.add_argument("--cluster-mentions", nargs="+", default=None, help="columns that order the written mentions")
    p.add_argument("--zorder-mentions", nargs="+", default=None, help="columns any of which later filters can use")
    p.add_argument("--features", default=None, help="folder of the kept features to bring up to date")
    p.add_argument("--out", required=True, help="output folder (shared storage on a cluster) or database")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parse(argv)
    spark = spark or SparkSession.builder.appName("phenospark").getOrCreate()
    results = codelist_job(
        spark, args.dictionary, args.codelists, args.out, codelist_format=args.codelist_format,
        table_prefix=args.table_prefix, database=args.database, source_from=args.source_from,
        cluster_by=args.cluster_codelist, codelist_database=args.codelist_database,
    )
    if args.narrow or args.wide:
        results.update(mentions_job(spark, results["codelist"], args.out, narrow_table=args.narrow,
                                    wide_table=args.wide, keep_raw=args.keep_raw,
                                    cluster_by=args.cluster_mentions, zorder_by=args.zorder_mentions))
        if args.features:
            results.update(features_job(spark, results["mentions"], results["codelist"], args.features))
        if args.categories and args.abbreviations:
            results.update(categories_job(spark, args.categories, args.abbreviations,
                                          results["mentions"], args.out, codelist=results["codelist"]))
    for name in ("totals", "totals_dedup", "totals_raw", "duplicate_volume", "category_sizes", "coverage"):
        if name in results:
            print(f"== {name}")
            results[name].show(truncate=False)
    return results


if __name__ == "__main__":
    main()
