"""Contract queries: every operator of the workflow, run over tables derived
from the driver's star schema (:mod:`phenospark.sources.starschema`).

Each query is ``(spark, sf_dir) -> DataFrame`` and has a DuckDB twin in
:mod:`phenospark.plans.oracle`; column names are the same on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenospark.functions.names import normalise_name
from phenospark.functions.routing import code_columns_for
from phenospark.operators import catalog as cat_ops
from phenospark.operators import categories as category_ops
from phenospark.operators import checks, features, history, sketches, sparse, summary
from phenospark.operators.codelist import build_codelist, two_column_codes
from phenospark.operators.mentions import (
    DIAGNOSIS_SLOTS,
    OPERATION_SLOTS,
    dedup,
    match,
    mentions,
    narrow_records,
    unite,
    wide_records,
)
from phenospark.operators.reshape import melt, melt_codes
from phenospark.plans.jobs import features_job
from phenospark.sinks import compact_table, drop_table, materialise, preview, register_view, table_files, write_table
from phenospark.session import ensure_checkpoint_dir
from phenospark.sources.codelists import bad_code_rows, list_sources, list_tables, read_code_files, read_code_tables
from phenospark.sources.tables import read_abbreviations, read_categories, read_dictionary
from phenospark.sources.starschema import (
    DIAG_SLOTS,
    OPERTN_SLOTS,
    SOURCE_DATABASE,
    SOURCE_PREFIX,
    StarSchema,
)

Query = Callable[[SparkSession, str], DataFrame]


# -- building blocks shared by several queries ------------------------------

def _narrow(s: StarSchema) -> DataFrame:
    return narrow_records(s.narrow(), person="person_id", date="dt", code="code")


def _melted(s: StarSchema, slots) -> DataFrame:
    wide = s.wide().select(
        F.col("person_id").alias("person_id_deid"), F.col("dt").alias("date"), *slots
    )
    return melt_codes(wide, ["person_id_deid", "date"], {"_": slots}, terminology_name=None)


def _catalog(s: StarSchema) -> DataFrame:
    return cat_ops.to_catalog(s.dictionary(), prefix=SOURCE_PREFIX, database=SOURCE_DATABASE)


def _wide_long(s: StarSchema) -> DataFrame:
    return wide_records(s.wide(), person="person_id", date="dt",
                        slots={"ICD": DIAG_SLOTS, "OPCS": OPERTN_SLOTS})


def _match_narrow(s: StarSchema) -> DataFrame:
    return match(_narrow(s), s.codelist(), "SNOMEDCT")


def _mentions_raw(s: StarSchema) -> DataFrame:
    """The bag: both slot families from one scan of the wide source."""
    return mentions(s.codelist(), narrow=_narrow(s), wide=_wide_long(s), deduplicate=False)


def _mentions_dedup(s: StarSchema) -> DataFrame:
    """The library's composed plan: each source scanned once, records
    deduplicated before the phenotypes are attached."""
    return mentions(s.codelist(), narrow=_narrow(s), wide=_wide_long(s))


def _mapping(s: StarSchema) -> DataFrame:
    return category_ops.build_mapping(s.categories(), s.abbreviations())


def _coded(s: StarSchema, *more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``_mentions_dedup`` with ids for phenotypes, and the dictionary that names them: the
    codelist's phenotypes and those of ``more``. The encoded codelist is written once, as
    the mentions read it several times."""
    codelist = s.codelist()
    dictionary = materialise(sparse.phenotype_dictionary(
        unite(*[df.select("phenotype") for df in (codelist, *more)])), "phenotype_dictionary")
    coded = materialise(sparse.encode_phenotypes(codelist, dictionary), "coded_codelist")
    return mentions(coded, narrow=_narrow(s), wide=_wide_long(s)), dictionary


def _by_id(s: StarSchema, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``derive`` of the deduplicated mentions; its exchanges carry phenotype ids."""
    found, dictionary = _coded(s)
    return sparse.name_phenotypes(derive(found), dictionary)


def _scratch(s: StarSchema, name: str) -> str:
    """A folder of its own below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/phenospark/{name}-{uuid.uuid4().hex[:12]}"


def _q(build: Callable[[StarSchema], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(StarSchema(spark, sf_dir))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


# -- names, dictionary, catalog -----------------------------------------------

def normalise_names(s: StarSchema) -> DataFrame:
    """Every raw phenotype / category name of the inputs and its key."""
    cats = s.categories()
    names = (
        s.codes().select(F.col("phenotype").alias("name"))
        .unionByName(cats.select(F.col("Phenotype").alias("name")))
        .unionByName(cats.select(F.col("Category").alias("name")))
        .unionByName(s.dictionary().select(F.col("phenotype").alias("name")))
        .where(F.col("name").isNotNull())
        .distinct()
    )
    return names.select("name", normalise_name("name").alias("normalised"))


def catalog_unpivot(s: StarSchema) -> DataFrame:
    """Dictionary -> catalog."""
    return _catalog(s)


def catalog_without_cprd(s: StarSchema) -> DataFrame:
    return cat_ops.without_terminology(_catalog(s), "CPRD")


def code_column_routing(s: StarSchema) -> DataFrame:
    """Code column(s) each catalog source holds, decided from its path."""
    return _catalog(s).select(
        "phenotype", "terminology", "path", code_columns_for("path").alias("code_columns")
    )


def codelist_build(s: StarSchema) -> DataFrame:
    """Catalog x all codelist sources -> master codelist."""
    codes = s.sources().select(F.col("stem").alias("source"), "code")
    return build_codelist(_catalog(s), codes)


def codelist_build_from_files(s: StarSchema) -> DataFrame:
    """``codelist_build`` through real files: the sources are written as CSV
    files partitioned by source, with headers that differ between terminologies
    and within them (the OPCS files carry a further column in front), in folders
    with spaces in their names, next to an empty file and one that is no
    codelist; then all are read by one scan and joined to the catalog."""
    root = _scratch(s, "codelist files")
    src = s.sources()
    column_of = {"codes_icd_": "ICD10code", "codes_opcs_": "OPCS4code", "codes_cprd_": "conceptId"}

    def write(df: DataFrame, folder: str) -> None:
        df.write.partitionBy("source").option("header", True).csv(f"{root}/{folder}")

    for prefix, column in column_of.items():
        part = src.where(F.col("stem").startswith(prefix))
        named = part.select(F.upper("stem").alias("source"), F.col("code").alias(column))
        if column == "OPCS4code":
            named = part.select(F.upper("stem").alias("source"), F.lit("a, b").alias("Disease"), F.col("code").alias(column))
        write(named, f"lists {prefix}")
    nothing = s.spark.range(0).select(F.lit("codes_icd_unused").alias("source"), F.lit("").alias("ICD10code"))
    write(nothing, "empty")
    write(s.table("region").select(F.lit("readme").alias("source"), "r_name"), "other")
    catalog = _catalog(s)
    wanted = cat_ops.without_terminology(catalog, "CPRD")
    codes = read_code_files(s.spark, root, source_from="partition", catalog=wanted)
    return build_codelist(catalog, codes)


def catalog_from_csv(s: StarSchema) -> DataFrame:
    """``catalog_unpivot`` from a written dictionary CSV."""
    path = _scratch(s, "dictionary")
    s.dictionary().write.option("header", True).csv(path)
    return cat_ops.to_catalog(read_dictionary(s.spark, path), prefix=SOURCE_PREFIX, database=SOURCE_DATABASE)


def category_mapping_from_csv(s: StarSchema) -> DataFrame:
    """``category_mapping`` from written category and abbreviation CSVs."""
    listed, short = _scratch(s, "categories"), _scratch(s, "abbreviations")
    s.categories().write.option("header", True).csv(listed)
    s.abbreviations().write.option("header", True).csv(short)
    return category_ops.build_mapping(read_categories(s.spark, listed), read_abbreviations(s.spark, short))


#: Codelists of each terminology in ``codelist_parquet_sources`` (three terminologies: 630 sources).
PARQUET_LISTS = 210


def codelist_parquet_sources(s: StarSchema) -> DataFrame:
    """630 codelists as parquet folders, their code columns of two types and next to
    other columns, read by one scan per (route, type); per source its codes."""
    root = _scratch(s, "codelist parquet")
    orders = s.table("orders")
    number = F.col("o_orderkey") % PARQUET_LISTS
    customer = F.col("o_custkey").cast("string")

    def write(kind: str, suffix: str, rows: DataFrame, **columns: F.Column) -> None:
        named = rows.select(F.concat(F.lit(f"codes_{kind}_o"), number.cast("string"), F.lit(suffix)).alias("source"),
                            *[c.alias(n) for n, c in columns.items()])
        named.repartition(16, "source").write.mode("append").partitionBy("source").parquet(f"{root}/{kind}")

    write("icd", "", orders, ICD10code=F.concat(F.lit("P"), customer), Disease=F.col("o_orderstatus"))
    write("opcs", "", orders, OPCS4code=F.concat(F.lit("S"), customer))
    write("cprd", "_snomedct", orders.where(number % 2 == 0), conceptId=F.col("o_custkey"))
    write("cprd", "_snomedct", orders.where(number % 2 == 1), Term=F.col("o_orderpriority"), conceptId=customer)
    codes = read_code_files(s.spark, root, fmt="parquet", source_from="partition")
    return codes.groupBy("source", "terminology").agg(
        F.count("code").alias("n_codes"), F.count_distinct("code").alias("n_distinct"), F.min("code").alias("first_code"))


def codelist_csv_records(s: StarSchema) -> DataFrame:
    """CSV codelists whose quoted cells hold line breaks, one record of which in ten
    lacks its code, one has a cell too many, and some repeat the header as data; per
    source its codes and its bad records."""
    root = _scratch(s, "codelist records")
    key = F.col("p_partkey")
    header = F.lit("Disease,ICD10code")
    good = F.concat(F.lit('"'), "p_name", F.lit("\n"), "p_type", F.lit('",P'), key.cast("string"))
    record = (
        F.when(key % 10 == 3, F.col("p_type")).when(key % 10 == 7, F.concat("p_type", F.lit(",P"), key.cast("string"), F.lit(",x")))
        .when(key % 50 == 0, header).otherwise(good)
    )
    source = F.concat(F.lit("codes_icd_s"), F.col("p_size").cast("string")).alias("source")
    part = s.table("part")
    lines = part.select(source, F.lit(1).alias("at"), record.alias("value")).unionByName(
        part.select(source, F.lit(0).alias("at"), header.alias("value")).distinct())
    # One file a source, its header first.
    lines.repartition(16, "source").sortWithinPartitions("source", "at").select("source", "value").write.partitionBy("source").text(root)
    glob = {"name_glob": "*.txt", "source_from": "partition"}
    codes = read_code_files(s.spark, root, bad_rows="skip", **glob)
    bad = bad_code_rows(s.spark, root, **glob).groupBy("source").agg(F.count(F.lit(1)).alias("n_bad"))
    return (
        codes.groupBy("source").agg(F.count("code").alias("n_codes"), F.min("code").alias("first_code"))
        .join(bad, "source", "full").select("source", F.coalesce("n_codes", F.lit(0)).cast("bigint").alias("n_codes"),
                                            "first_code", F.coalesce("n_bad", F.lit(0)).cast("bigint").alias("n_bad"))
    )


def codelist_tables(s: StarSchema) -> DataFrame:
    """Codelists stored as tables of a database (plain, partitioned and JSON ones),
    listed by a glob, read together, and counted by SQL through a global view."""
    spark, name = s.spark, f"phenospark_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        supplier = s.table("supplier").join(s.table("nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        for (region,) in s.table("region").select("r_regionkey").collect():
            own = supplier.where(F.col("n_regionkey") == region).select("s_name", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("OPCS4code"))
            own.write.saveAsTable(f"{name}.codes_opcs_r{region}")
        part = s.table("part")
        part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ICD10code"), "p_type").write.partitionBy("p_type").saveAsTable(f"{name}.codes_icd_parts")
        part.select(F.col("p_size").alias("conceptId")).write.saveAsTable(f"{name}.codes_cprd_sizes_snomedct")
        part.select(F.col("p_brand").alias("Readcode"), F.col("p_partkey").cast("string").alias("Medcode")).write.format("json").saveAsTable(f"{name}.codes_cprd_brands")
        part.select("p_name").write.saveAsTable(f"{name}.notes")
        tables = [f"{name}.{r['table']}" for r in list_tables(spark, name, "codes_*").collect()]
        register_view(read_code_tables(spark, tables), name, global_view=True)
        counted = spark.sql(f"""
            SELECT source, terminology, count(code) AS n_codes, count(DISTINCT code) AS n_distinct
            FROM global_temp.{name} GROUP BY source, terminology""")
        return materialise(counted, "codelist_tables")
    finally:
        spark.catalog.dropGlobalTempView(name)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def tables_kept_and_dropped(s: StarSchema) -> DataFrame:
    """A table per region, written and replaced; those with fewer suppliers than the mean
    are dropped. The tables that are left, with their rows and those of a preview."""
    spark, name = s.spark, f"phenospark_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        supplier = s.table("supplier").join(s.table("nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        per_region = supplier.groupBy("n_regionkey").count()
        mean = s.table("supplier").count() / s.table("region").count()
        for region, n in sorted(tuple(r) for r in per_region.collect()):
            table = f"{name}.suppliers_r{region}"
            write_table(supplier.where(F.col("n_regionkey") == region).select("s_suppkey"), table)
            write_table(spark.table(table).withColumn("region", F.lit(region)), table)  # other columns, read from itself
            if n < mean:
                drop_table(spark, table)
        drop_table(spark, f"{name}.never_made")
        left = [r["table"] for r in list_tables(spark, name, "suppliers_*").collect()]
        counted = [spark.table(f"{name}.{t}").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(t).alias("table"), "n", F.lit(preview(spark.table(f"{name}.{t}"), 3).count()).cast("bigint").alias("previewed")) for t in left]
        return materialise(reduce(DataFrame.unionByName, counted), "tables_kept")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def codelist_sources_listed(s: StarSchema) -> DataFrame:
    """The written sources of two vocabularies, listed by globs of folders and files;
    per source whether the catalog names it."""
    root = _scratch(s, "listed sources")
    s.sources().select(F.col("stem").alias("source"), "code").repartition(16, "source").write.partitionBy("source").parquet(root)
    found = list_sources(s.spark, f"{root}/source=codes_[io]*", "part-*.parquet", "partition").select("source").distinct()
    named = _catalog(s).select(F.col("table").alias("source"), F.lit(True).alias("in_catalog")).distinct()
    return found.join(named, "source", "left").select("source", F.coalesce("in_catalog", F.lit(False)).alias("in_catalog"))


def codelist_missing_sources(s: StarSchema) -> DataFrame:
    """Catalog entries whose source does not exist."""
    present = s.sources().select(F.col("stem").alias("source"))
    return checks.missing_sources(_catalog(s), present).select("phenotype", "terminology", "table")


def codelist_two_code_columns(s: StarSchema) -> DataFrame:
    """A source with Read and Med code columns -> one code column."""
    return two_column_codes(s.two_codes(), {"Readcode": "Readcode", "Medcode": "Medcode"})


def codelist_totals(s: StarSchema) -> DataFrame:
    return summary.codelist_totals(s.codelist())


def codelist_per_phenotype(s: StarSchema) -> DataFrame:
    return summary.codelist_per_phenotype(s.codelist())


def codelist_phenotypes(s: StarSchema) -> DataFrame:
    return summary.codelist_phenotypes(s.codelist())


# -- records -> mentions ---------------------------------------------------

def melt_slots_keep_nulls(s: StarSchema) -> DataFrame:
    """The general melt: every diagnosis slot of every record, NULLs kept."""
    return melt(s.wide(), ["person_id", "o_orderkey", "dt"], DIAG_SLOTS, "variable", "value")


def melt_diagnoses(s: StarSchema) -> DataFrame:
    return _melted(s, DIAG_SLOTS)


def melt_operations(s: StarSchema) -> DataFrame:
    return _melted(s, OPERTN_SLOTS)


def wide_records_one_pass(s: StarSchema) -> DataFrame:
    """Both slot families in one pass: ``person_id_deid, date, code, terminology``."""
    slots = {"ICD": DIAG_SLOTS, "OPCS": OPERTN_SLOTS}
    return wide_records(s.wide(), person="person_id", date="dt", slots=slots)


def match_narrow(s: StarSchema) -> DataFrame:
    return _match_narrow(s)


def match_diagnoses(s: StarSchema) -> DataFrame:
    return match(_melted(s, DIAG_SLOTS), s.codelist(), "ICD")


def match_operations(s: StarSchema) -> DataFrame:
    return match(_melted(s, OPERTN_SLOTS), s.codelist(), "OPCS")


def melt_codes_generate(s: StarSchema) -> DataFrame:
    """``wide_records_one_pass`` through arrays of structs, filtered and inlined."""
    return wide_records(s.wide(), person="person_id", date="dt",
                        slots={"ICD": DIAG_SLOTS, "OPCS": OPERTN_SLOTS}, method="generate")


def wide_records_hospital_layout(s: StarSchema) -> DataFrame:
    """The hospital source's own 20 diagnosis and 24 operation slots, with the
    derived slots at their front, middle and end."""
    def place(slots, names):
        first, last = names[: len(slots) - 1], names[-1]
        own = {n: F.col(c) for n, c in zip([*first, last], slots)}
        return [own.get(n, F.lit(None).cast("string")).alias(n) for n in names]

    table = s.wide().select(
        F.col("person_id").alias("PERSON_ID_DEID"), F.col("dt").alias("ADMIDATE"),
        *place(DIAG_SLOTS, DIAGNOSIS_SLOTS), *place(OPERTN_SLOTS, OPERATION_SLOTS))
    return wide_records(table)


def narrow_coverage(s: StarSchema) -> DataFrame:
    return summary.coverage(_match_narrow(s))


def mentions_raw(s: StarSchema) -> DataFrame:
    return _mentions_raw(s)


def mentions_dedup(s: StarSchema) -> DataFrame:
    return _mentions_dedup(s)


def mentions_by_source(s: StarSchema) -> DataFrame:
    """``mentions_dedup`` the long way: one match per source and slot family,
    united, deduplicated as mentions. Equals ``mentions_dedup``."""
    return dedup(unite(_match_narrow(s), match_diagnoses(s), match_operations(s)))


def mentions_dedup_shuffle(s: StarSchema) -> DataFrame:
    """``mentions_dedup`` with the codelist treated as too large to
    broadcast: records deduplicated first, then a salted shuffle join."""
    return mentions(s.codelist(), narrow=_narrow(s), wide=_wide_long(s), max_broadcast_bytes=0)


def mentions_raw_shuffle(s: StarSchema) -> DataFrame:
    """The bag of mentions through the salted shuffle join. Equals ``mentions_raw``."""
    return mentions(s.codelist(), narrow=_narrow(s), wide=_wide_long(s),
                    deduplicate=False, max_broadcast_bytes=0)


def mentions_totals_raw(s: StarSchema) -> DataFrame:
    return summary.coverage(_mentions_raw(s))


def mentions_totals_dedup(s: StarSchema) -> DataFrame:
    return summary.coverage(_mentions_dedup(s))


def duplicate_volume(s: StarSchema) -> DataFrame:
    return summary.duplicate_volume(_mentions_raw(s))


def mention_volumes(s: StarSchema) -> DataFrame:
    """All counts of the mentions stage from one pass over each source."""
    return summary.mention_volumes(s.codelist(), _narrow(s), _wide_long(s))


def coverage_by_cut(s: StarSchema) -> DataFrame:
    """Coverage per source vocabulary and year, per vocabulary, per year and of all, from
    one stored table of sketches next to the exact counts; ``close``: whether both
    estimates are within four standard errors of them (or off by one person)."""
    by, cuts = ["terminology", "year"], [["terminology", "year"], ["terminology"], ["year"], []]
    found = materialise(_mentions_dedup(s).withColumn("year", F.year("date").cast("string")), "sketched_mentions")
    stored = materialise(sketches.sketch_coverage(found, by), "coverage_sketches")
    cut = sketches.with_exact(sketches.coverage_of_cuts(stored, cuts, by), found, cuts, by)
    bound = 4 * sketches.relative_error()

    def close(name: str) -> F.Column:
        return F.abs(F.col(f"{name}_estimate") - F.col(name)) <= F.greatest(F.lit(1), bound * F.col(name))

    return cut.select(*by, "cut", "mentions", "unique_pts", "phenotypes", (close("unique_pts") & close("phenotypes")).alias("close"))


def mentions_clustered(s: StarSchema) -> DataFrame:
    """The mentions written clustered by phenotype and date and read back; per
    phenotype, its mentions and the date range of what the files hold."""
    found = materialise(_mentions_dedup(s), "unclustered_mentions")  # read twice: for the ranges' bounds, and for the rows
    back = materialise(found, "mentions_clustered", cluster_by=["phenotype", "date"])
    return back.groupBy("phenotype").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def mentions_zorder(s: StarSchema) -> DataFrame:
    """The mentions written along a Z-curve through person, code and phenotype; per key,
    the mentions of its least and greatest value, and whether a filter on either skips
    files (by the files' spans of the key)."""
    keys = ["person_id_deid", "code", "phenotype"]
    found = materialise(_mentions_dedup(s), "zorder_mentions")
    back = materialise(found, "mentions_zorder", zorder_by=keys, partitions=16)

    def probe(key: str) -> DataFrame:
        least, greatest = back.agg(F.min(key)), back.agg(F.max(key))
        spans = back.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        at_least, at_greatest = (F.count_if(F.col(end) == of.scalar()) for end, of in (("lo", least), ("hi", greatest)))
        skips = spans.agg((F.greatest(at_least, at_greatest) < F.count(F.lit(1))).alias("skips"))
        rows = back.where((F.col(key) == least.scalar()) | (F.col(key) == greatest.scalar()))
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(key).alias("key"), "n", skips.scalar().alias("skips"))

    return reduce(DataFrame.unionByName, [probe(k) for k in keys])


def mentions_compacted(s: StarSchema) -> DataFrame:
    """The mentions written by vocabulary in many small files (one a shuffle partition,
    six at least), regrouped where they stand; per vocabulary its mentions, and whether
    it has fewer files now."""
    path = _scratch(s, "small files")
    pieces = max(6, int(s.spark.conf.get("spark.sql.shuffle.partitions")))
    _mentions_dedup(s).repartition(pieces, "person_id_deid", "date", "code").write.partitionBy("terminology").parquet(path)
    before = materialise(table_files(s.spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("before")), "files_before")
    compact_table(s.spark, path, order_by=["person_id_deid"])
    after = table_files(s.spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("after"))
    terminology = F.regexp_extract("folder", r"terminology=([^/]+)$", 1).alias("terminology")
    files = before.join(after, "folder").select(terminology, (F.col("after") < F.col("before")).alias("fewer_files"))
    counted = s.spark.read.parquet(path).groupBy("terminology").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("person_id_deid").alias("unique_pts"))
    return counted.join(files, "terminology")


def mentions_table_replaced(s: StarSchema) -> DataFrame:
    """A metastore table of the primary-care mentions, replaced by all mentions (read
    from the table itself and the wide source) in one switch; per phenotype what it holds."""
    spark, name = s.spark, f"phenospark_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        write_table(mentions(s.codelist(), narrow=_narrow(s)), f"{name}.mentions", cluster_by=["phenotype"])
        wide = mentions(s.codelist(), wide=_wide_long(s))
        write_table(dedup(unite(spark.table(f"{name}.mentions"), wide)), f"{name}.mentions", cluster_by=["phenotype"])
        held = spark.table(f"{name}.mentions").groupBy("phenotype").agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
        return materialise(held, "mentions_table")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


# -- features ----------------------------------------------------------------

def first_dates_by_code(s: StarSchema) -> DataFrame:
    return _by_id(s, features.first_dates)


def first_dates_by_phenotype(s: StarSchema) -> DataFrame:
    return _by_id(s, features.first_dates_by_phenotype)


def n_occurrences(s: StarSchema) -> DataFrame:
    return _by_id(s, features.n_occurrences)


def features_by_phenotype(s: StarSchema) -> DataFrame:
    """First date and occurrences in one aggregation."""
    return _by_id(s, features.features_by_phenotype)


def features_from_code_summary(s: StarSchema) -> DataFrame:
    """The same, from the per-code summary."""
    return _by_id(s, lambda found: features.features_from_summary(features.code_summary(found))["features_by_phenotype"])


def code_summary_in_deliveries(s: StarSchema) -> DataFrame:
    """The per-code summary from a stored history that two deliveries made: the first
    half of the years, then all from a year earlier on; the second is run twice."""
    found = materialise(_mentions_dedup(s), "history_mentions")
    first, last = found.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    cut = (first + last) // 2
    path = _scratch(s, "history")
    history.merge_delivery(found.where(F.year("date") <= cut), path, written=True)
    late = found.where((F.year("date") >= cut) | F.col("date").isNull())
    history.merge_delivery(late, path, written=True)
    history.merge_delivery(late, path, written=True)
    return history.code_summary_of(history.read_history(s.spark, path))


def features_kept_in_deliveries(s: StarSchema) -> DataFrame:
    """The features job over two overlapping deliveries, the second run twice; per person
    the mentions of the kept histories and the phenotypes of the kept rows."""
    found = materialise(_mentions_dedup(s), "kept_mentions")
    first, last = found.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    cut = (first + last) // 2
    out, names = _scratch(s, "kept"), s.codelist().select("phenotype")
    features_job(s.spark, found.where(F.year("date") <= cut), names, out, parts=16, written=True)
    late = found.where((F.year("date") >= cut) | F.col("date").isNull())
    features_job(s.spark, late, names, out, parts=16, written=True)
    kept = features_job(s.spark, late, names, out, parts=16, written=True)
    counted = kept["code_summary"].groupBy("person_id_deid").agg(F.sum("n").alias("n_mentions"), F.min("date").alias("first_date"))
    return counted.join(kept["person_rows"], "person_id_deid").select(
        "person_id_deid", "n_mentions", "first_date", F.size("ids").cast("bigint").alias("n_phenotypes"))


def _sparse(s: StarSchema) -> tuple[DataFrame, DataFrame]:
    """(rows, dictionary): the person's phenotype ids, and the codelist's phenotypes."""
    dictionary = materialise(sparse.phenotype_dictionary(s.codelist()), "phenotype_dictionary")
    return sparse.person_rows(_mentions_dedup(s), dictionary), dictionary


def flag_matrix(s: StarSchema) -> DataFrame:
    """The person x phenotype flags (over the codelist's phenotypes), as the cells
    that are one."""
    return sparse.cells(*_sparse(s))


def flag_matrix_sizes(s: StarSchema) -> DataFrame:
    """Ones and zeros of every phenotype."""
    rows, dictionary = _sparse(s)
    return sparse.sizes(materialise(rows, "person_rows"), dictionary)


def flag_rows_merged(s: StarSchema) -> DataFrame:
    """The sparse rows of two deliveries (the first half of the years, and all from a
    year earlier on, under a dictionary that grew in between), merged; per person, the
    number of phenotypes and the first and last of them."""
    found = materialise(_mentions_dedup(s), "flag_mentions")
    first, last = found.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    cut = (first + last) // 2
    early, late = found.where(F.year("date") <= cut), found.where((F.year("date") >= cut) | F.col("date").isNull())
    older = materialise(sparse.phenotype_dictionary(early), "phenotype_dictionary")
    stored = materialise(sparse.person_rows(early, older), "person_rows")
    dictionary = materialise(sparse.phenotype_dictionary(late, older), "phenotype_dictionary")
    merged = sparse.merge_person_rows(stored, sparse.person_rows(late, dictionary))
    return sparse.cells(merged, dictionary).groupBy("person_id_deid").agg(
        F.count(F.lit(1)).alias("n_phenotypes"), F.min("phenotype").alias("first_phenotype"), F.max("phenotype").alias("last_phenotype"))


# -- categories ----------------------------------------------------------------

def category_mapping(s: StarSchema) -> DataFrame:
    return _mapping(s)


def category_sizes(s: StarSchema) -> DataFrame:
    return summary.category_sizes(_mapping(s))


def categorise_join(s: StarSchema) -> DataFrame:
    return category_ops.categorise(_mentions_dedup(s), _mapping(s))


def categorise_join_shuffle(s: StarSchema) -> DataFrame:
    """``categorise_join`` with the mapping treated as too large to broadcast
    (salted left join on phenotype ids). The mapping's phenotypes are checked by name."""
    mapping = category_ops.assert_unique_keys(_mapping(s))
    found, dictionary = _coded(s, mapping)
    coded = materialise(sparse.encode_phenotypes(mapping, dictionary), "coded_mapping")
    return sparse.name_phenotypes(category_ops.categorise(found, coded, max_broadcast_bytes=0), dictionary)


def categorise_map(s: StarSchema) -> DataFrame:
    return category_ops.categorise_map(_mentions_dedup(s), _mapping(s))


def codes_per_category(s: StarSchema) -> DataFrame:
    return summary.codes_per_category(category_ops.categorise(_mentions_dedup(s), _mapping(s)))


def codes_per_phenotype(s: StarSchema) -> DataFrame:
    return summary.codes_per_phenotype(_mentions_dedup(s))


def codes_per_category_by_terminology(s: StarSchema) -> DataFrame:
    """Distinct (terminology, code) pairs per category."""
    categorised = category_ops.categorise(_mentions_dedup(s), _mapping(s))
    return summary.codes_per_category(categorised, by_terminology=True)


def unmapped_phenotypes(s: StarSchema) -> DataFrame:
    """Codelist phenotypes without a category."""
    return checks.unmapped(s.codelist(), _mapping(s))


def orphan_categories(s: StarSchema) -> DataFrame:
    """Categorised phenotypes that no codelist entry uses."""
    return checks.orphans(_mapping(s), s.codelist())


def unabbreviated_categories(s: StarSchema) -> DataFrame:
    """Categories without an abbreviation (their phenotypes fall out of the
    mapping) and abbreviations without a category."""
    listed = category_ops.tidy_categories(s.categories())
    short = category_ops.tidy_abbreviations(s.abbreviations())
    return (
        checks.unmapped(listed, short, "category").withColumn("side", F.lit("category"))
        .unionByName(checks.unmapped(short, listed, "category").withColumn("side", F.lit("abbreviation")))
    )


QUERIES: dict[str, Query] = {
    f.__name__: _q(f)
    for f in (
        normalise_names,
        catalog_unpivot,
        catalog_from_csv,
        catalog_without_cprd,
        code_column_routing,
        codelist_build,
        codelist_build_from_files,
        codelist_parquet_sources,
        codelist_csv_records,
        codelist_tables,
        codelist_sources_listed,
        tables_kept_and_dropped,
        codelist_missing_sources,
        codelist_two_code_columns,
        codelist_totals,
        codelist_per_phenotype,
        codelist_phenotypes,
        melt_slots_keep_nulls,
        melt_diagnoses,
        melt_operations,
        wide_records_one_pass,
        wide_records_hospital_layout,
        melt_codes_generate,
        match_narrow,
        match_diagnoses,
        match_operations,
        narrow_coverage,
        mentions_raw,
        mentions_dedup,
        mentions_by_source,
        mentions_dedup_shuffle,
        mentions_raw_shuffle,
        mentions_totals_raw,
        mentions_totals_dedup,
        duplicate_volume,
        mention_volumes,
        coverage_by_cut,
        mentions_clustered,
        mentions_zorder,
        mentions_compacted,
        mentions_table_replaced,
        first_dates_by_code,
        first_dates_by_phenotype,
        n_occurrences,
        features_by_phenotype,
        features_from_code_summary,
        code_summary_in_deliveries,
        features_kept_in_deliveries,
        flag_matrix,
        flag_matrix_sizes,
        flag_rows_merged,
        category_mapping,
        category_mapping_from_csv,
        category_sizes,
        categorise_join,
        categorise_join_shuffle,
        categorise_map,
        codes_per_category,
        codes_per_phenotype,
        codes_per_category_by_terminology,
        unmapped_phenotypes,
        orphan_categories,
        unabbreviated_categories,
    )
}
