"""DuckDB SQL twins of the contract queries (:mod:`phenospark.plans.contract`).

Written independently of the Spark code: the fixtures are re-derived from the
raw tables, the name normaliser is spelled out as the original sequence of
single-character replacements, and the melt is a ``UNION ALL`` per slot.
Engine traps handled: ``FLOOR`` before the int cast (DuckDB rounds), and
timestamps cast to ``DATE`` on both sides.
"""

from __future__ import annotations

WIDE_SLOTS = 7
DIAG = [f"diag_{i:02d}" for i in range(1, WIDE_SLOTS + 1)]
OPERTN = [f"opertn_{i:02d}" for i in range(1, WIDE_SLOTS + 1)]


def norm(x: str) -> str:
    """Name normaliser: drop ' ( ) , &; '/' and ' ' -> '_'; lower-case."""
    out = x
    for ch in ("''", "(", ")", ",", "&"):
        out = f"replace({out}, '{ch}', '')"
    out = f"replace({out}, '/', '_')"
    out = f"lower({out})"
    return f"replace({out}, ' ', '_')"


def _wide_cte() -> str:
    diag = ",\n    ".join(
        f"MIN(CASE WHEN l.l_linenumber = {i} THEN 'P' || CAST(l.l_partkey AS VARCHAR) END) AS {s}"
        for i, s in enumerate(DIAG, 1)
    )
    op = ",\n    ".join(
        f"MIN(CASE WHEN l.l_linenumber = {i} THEN 'S' || CAST(l.l_suppkey AS VARCHAR) END) AS {s}"
        for i, s in enumerate(OPERTN, 1)
    )
    return f"""
  SELECT o.o_custkey AS person_id, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS dt,
    {diag},
    {op}
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_custkey, o.o_orderkey, CAST(o.o_orderdate AS DATE)"""


def _melt(slots: list[str], terminology: str | None = None) -> str:
    term = f", '{terminology}' AS terminology" if terminology else ""
    return "\n  UNION ALL\n".join(
        f"  SELECT person_id AS person_id_deid, dt AS date, {s} AS code{term} "
        f"FROM f_wide WHERE {s} IS NOT NULL"
        for s in slots
    )


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "f_narrow": ((), """
  SELECT user_id AS person_id, CAST(ts AS DATE) AS dt,
         CAST(CAST(FLOOR(value * 25) AS BIGINT) AS VARCHAR) AS code
  FROM events"""),
    "f_wide": ((), _wide_cte()),
    "f_codes": ((), """
  SELECT p_type || ' (' || p_name || ')' AS phenotype, 'ICD' AS terminology,
         'P' || substr(CAST(p_partkey AS VARCHAR), 1, 1) || '.' || substr(CAST(p_partkey AS VARCHAR), 2) AS code
  FROM part
  UNION ALL
  SELECT n_name || '/' || r_name, 'OPCS', 'S' || CAST(s_suppkey AS VARCHAR)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT p_type || ' & ' || p_brand, 'SNOMEDCT', CAST(CAST(FLOOR(p_partkey / 4) AS BIGINT) AS VARCHAR)
  FROM part"""),
    "f_codelist": (("f_codes",), f"""
  SELECT {norm('phenotype')} AS phenotype, terminology,
         CASE WHEN terminology IN ('ICD', 'OPCS', 'SNOMEDCT') THEN replace(code, '.', '') ELSE code END AS code
  FROM f_codes"""),
    "f_categories": ((), """
  SELECT DISTINCT p_type || ' (' || p_name || ')' AS "Phenotype", p_type || ' parts' AS "Category"
  FROM part WHERE p_type <> 'PROMO'
  UNION ALL
  SELECT n_name || '/' || r_name, 'Region, ' || r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT NULL, MIN('Region, ' || r_name) FROM region"""),
    "f_abbreviations": ((), """
  SELECT DISTINCT p_type || ' parts' AS "Category", lower(p_type) AS "Short" FROM part
  UNION ALL
  SELECT 'Region, ' || r_name, lower(replace(r_name, ' ', '_')) FROM region"""),
    "f_listed": (("f_categories",), f"""
  SELECT {norm('"Phenotype"')} AS phenotype, {norm('"Category"')} AS category
  FROM f_categories WHERE "Phenotype" IS NOT NULL"""),
    "f_short": (("f_abbreviations",), f"""
  SELECT {norm('"Category"')} AS category, "Short" AS cat FROM f_abbreviations"""),
    "f_mapping": (("f_listed", "f_short"), """
  SELECT l.phenotype, l.category, s.cat FROM f_listed l JOIN f_short s ON l.category = s.category"""),
    "f_dictionary": ((), """
  SELECT n_name || '/' || r_name AS phenotype,
         CASE WHEN n_nationkey % 5 <> 4 THEN 'CPRD_N' || CAST(n_nationkey AS VARCHAR) || '.csv' END AS "CPRD",
         CASE WHEN n_nationkey % 5 <> 3 THEN 'ICD_N' || CAST(n_nationkey AS VARCHAR) || '.csv' END AS "ICD",
         CASE WHEN n_nationkey % 4 = 0 THEN 'OPCS_N' || CAST(n_nationkey AS VARCHAR) || '.csv' END AS "OPCS"
  FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "f_catalog": (("f_dictionary",), f"""
  SELECT {norm('phenotype')} AS phenotype, terminology,
         'codes_' || lower(tbl) AS "table", 'codelists' AS database,
         'codelists.codes_' || lower(tbl) AS path
  FROM (
    SELECT phenotype, 'CPRD' AS terminology, regexp_replace("CPRD", '\\.csv$', '') AS tbl FROM f_dictionary
    UNION ALL SELECT phenotype, 'ICD', regexp_replace("ICD", '\\.csv$', '') FROM f_dictionary
    UNION ALL SELECT phenotype, 'OPCS', regexp_replace("OPCS", '\\.csv$', '') FROM f_dictionary
    UNION ALL SELECT phenotype, 'SNOMEDCT', regexp_replace("CPRD", '\\.csv$', '') || '_snomedct' FROM f_dictionary
  ) WHERE tbl IS NOT NULL AND phenotype IS NOT NULL"""),
    "f_sources": ((), """
  SELECT 'codes_icd_n' || CAST(p_partkey % 25 AS VARCHAR) AS stem,
         'P' || CAST(p_partkey AS VARCHAR) || '.0' AS code FROM part
  UNION ALL
  SELECT 'codes_opcs_n' || CAST(s_nationkey AS VARCHAR), 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION ALL
  SELECT 'codes_cprd_n' || CAST(p_size % 25 AS VARCHAR) || '_snomedct', CAST(p_size AS VARCHAR) FROM part"""),
    "f_two_codes": ((), """
  SELECT p_name AS phenotype, p_brand AS "Readcode",
         CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS "Medcode"
  FROM part"""),
    "f_diag": (("f_wide",), _melt(DIAG)),
    "f_opertn": (("f_wide",), _melt(OPERTN)),
    "f_match_narrow": (("f_narrow", "f_codelist"), """
  SELECT n.person_id AS person_id_deid, c.phenotype, n.dt AS date, n.code, 'SNOMEDCT' AS terminology
  FROM f_narrow n JOIN f_codelist c ON n.code = c.code WHERE c.terminology = 'SNOMEDCT'"""),
    "f_match_diag": (("f_diag", "f_codelist"), """
  SELECT d.person_id_deid, c.phenotype, d.date, d.code, 'ICD' AS terminology
  FROM f_diag d JOIN f_codelist c ON d.code = c.code WHERE c.terminology = 'ICD'"""),
    "f_match_opertn": (("f_opertn", "f_codelist"), """
  SELECT d.person_id_deid, c.phenotype, d.date, d.code, 'OPCS' AS terminology
  FROM f_opertn d JOIN f_codelist c ON d.code = c.code WHERE c.terminology = 'OPCS'"""),
    "f_mentions_raw": (("f_match_narrow", "f_match_diag", "f_match_opertn"), """
  SELECT * FROM f_match_narrow
  UNION ALL SELECT * FROM f_match_diag
  UNION ALL SELECT * FROM f_match_opertn"""),
    "f_mentions": (("f_mentions_raw",), """
  SELECT DISTINCT * FROM f_mentions_raw"""),
    "f_categorised": (("f_mentions", "f_mapping"), """
  SELECT m.person_id_deid, m.phenotype, m.date, m.code, m.terminology, p.category
  FROM f_mentions m LEFT JOIN f_mapping p ON m.phenotype = p.phenotype"""),
}


def with_ctes(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and theirs), in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


COVERAGE = """SELECT COUNT(*) AS mentions, COUNT(DISTINCT person_id_deid) AS unique_pts,
       COUNT(DISTINCT phenotype) AS phenotypes FROM {}"""


FEATURES = """
SELECT person_id_deid, phenotype, MIN(date) AS date, COUNT(*) AS n_occurrences
FROM f_mentions GROUP BY person_id_deid, phenotype"""


ORACLE_SQL: dict[str, str] = {
    "normalise_names": with_ctes(f"""
SELECT DISTINCT name, {norm('name')} AS normalised FROM (
  SELECT phenotype AS name FROM f_codes
  UNION ALL SELECT "Phenotype" FROM f_categories
  UNION ALL SELECT "Category" FROM f_categories
  UNION ALL SELECT phenotype FROM f_dictionary
) WHERE name IS NOT NULL""", "f_codes", "f_categories", "f_dictionary"),
    "catalog_unpivot": with_ctes(
        'SELECT phenotype, terminology, "table", database, path FROM f_catalog', "f_catalog"),
    "catalog_without_cprd": with_ctes(
        'SELECT phenotype, terminology, "table", database, path FROM f_catalog '
        "WHERE terminology <> 'CPRD'", "f_catalog"),
    "code_column_routing": with_ctes("""
SELECT phenotype, terminology, path,
  CASE WHEN path LIKE '%icd%' THEN 'ICD10code'
       WHEN path LIKE '%snomedct%' THEN 'conceptId'
       WHEN path LIKE '%cprd%' THEN 'Readcode,Medcode'
       WHEN path LIKE '%opcs%' THEN 'OPCS4code'
       ELSE error('no terminology in source name: ' || path) END AS code_columns
FROM f_catalog""", "f_catalog"),
    "codelist_build": with_ctes("""
SELECT c.phenotype, c.terminology,
  CASE WHEN c.terminology IN ('ICD', 'OPCS', 'SNOMEDCT') THEN replace(s.code, '.', '') ELSE s.code END AS code
FROM f_sources s JOIN f_catalog c ON s.stem = c."table"
WHERE c.terminology <> 'CPRD'""", "f_sources", "f_catalog"),
    "codelist_build_from_files": with_ctes("""
SELECT c.phenotype, c.terminology,
  CASE WHEN c.terminology IN ('ICD', 'OPCS', 'SNOMEDCT') THEN replace(s.code, '.', '') ELSE s.code END AS code
FROM f_sources s JOIN f_catalog c ON s.stem = c."table"
WHERE c.terminology <> 'CPRD'""", "f_sources", "f_catalog"),
    "codelist_parquet_sources": """
SELECT source, terminology, COUNT(code) AS n_codes, COUNT(DISTINCT code) AS n_distinct, MIN(code) AS first_code
FROM (
  SELECT 'codes_icd_o' || CAST(o_orderkey % 210 AS VARCHAR) AS source, 'ICD' AS terminology, 'P' || CAST(o_custkey AS VARCHAR) AS code FROM orders
  UNION ALL
  SELECT 'codes_opcs_o' || CAST(o_orderkey % 210 AS VARCHAR), 'OPCS', 'S' || CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL
  SELECT 'codes_cprd_o' || CAST(o_orderkey % 210 AS VARCHAR) || '_snomedct', 'SNOMEDCT', CAST(o_custkey AS VARCHAR) FROM orders
) GROUP BY source, terminology""",
    "codelist_csv_records": """
SELECT 'codes_icd_s' || CAST(p_size AS VARCHAR) AS source,
       COUNT(CASE WHEN p_partkey % 10 NOT IN (3, 7) THEN 1 END) AS n_codes,
       MIN(CASE WHEN p_partkey % 10 IN (3, 7) THEN NULL WHEN p_partkey % 50 = 0 THEN 'ICD10code'
                ELSE 'P' || CAST(p_partkey AS VARCHAR) END) AS first_code,
       COUNT(CASE WHEN p_partkey % 10 IN (3, 7) THEN 1 END) AS n_bad
FROM part GROUP BY p_size""",
    "codelist_tables": """
SELECT source, terminology, COUNT(code) AS n_codes, COUNT(DISTINCT code) AS n_distinct
FROM (
  SELECT 'codes_opcs_r' || CAST(n_regionkey AS VARCHAR) AS source, 'OPCS' AS terminology, 'S' || CAST(s_suppkey AS VARCHAR) AS code
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'codes_icd_parts', 'ICD', 'P' || CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT 'codes_cprd_sizes_snomedct', 'SNOMEDCT', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT 'codes_cprd_brands', 'Readcode', p_brand FROM part
  UNION ALL SELECT 'codes_cprd_brands', 'Medcode', CAST(p_partkey AS VARCHAR) FROM part
) WHERE code IS NOT NULL GROUP BY source, terminology""",
    "tables_kept_and_dropped": """
SELECT 'suppliers_r' || CAST(n_regionkey AS VARCHAR) AS "table", COUNT(*) AS n, LEAST(COUNT(*), 3) AS previewed
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey
HAVING COUNT(*) >= (SELECT COUNT(*) FROM supplier) / (SELECT COUNT(*) FROM region)""",
    "codelist_sources_listed": with_ctes("""
SELECT DISTINCT stem AS source, stem IN (SELECT "table" FROM f_catalog) AS in_catalog
FROM f_sources WHERE stem LIKE 'codes_i%' OR stem LIKE 'codes_o%'""", "f_sources", "f_catalog"),
    "codelist_missing_sources": with_ctes("""
SELECT phenotype, terminology, "table" FROM f_catalog c
WHERE NOT EXISTS (SELECT 1 FROM f_sources s WHERE s.stem = c."table")""", "f_sources", "f_catalog"),
    "codelist_two_code_columns": with_ctes("""
SELECT phenotype, 'Readcode' AS terminology, "Readcode" AS code FROM f_two_codes WHERE "Readcode" IS NOT NULL
UNION ALL
SELECT phenotype, 'Medcode', "Medcode" FROM f_two_codes WHERE "Medcode" IS NOT NULL""", "f_two_codes"),
    "codelist_totals": with_ctes(
        "SELECT COUNT(code) AS n_codes, COUNT(DISTINCT phenotype) AS n_phenotypes FROM f_codelist",
        "f_codelist"),
    "codelist_per_phenotype": with_ctes("""
SELECT phenotype, COUNT(DISTINCT code) AS n_codes, COUNT(DISTINCT terminology) AS n_terminologies
FROM f_codelist GROUP BY phenotype""", "f_codelist"),
    "codelist_phenotypes": with_ctes("SELECT DISTINCT phenotype FROM f_codelist", "f_codelist"),
    "melt_slots_keep_nulls": with_ctes("\nUNION ALL\n".join(
        f"SELECT person_id, o_orderkey, dt, '{s}' AS variable, {s} AS value FROM f_wide" for s in DIAG
    ), "f_wide"),
    "melt_diagnoses": with_ctes("SELECT * FROM f_diag", "f_diag"),
    "melt_operations": with_ctes("SELECT * FROM f_opertn", "f_opertn"),
    "wide_records_one_pass": with_ctes(
        _melt(DIAG, "ICD") + "\n  UNION ALL\n" + _melt(OPERTN, "OPCS"), "f_wide"),
    "match_narrow": with_ctes("SELECT * FROM f_match_narrow", "f_match_narrow"),
    "match_diagnoses": with_ctes("SELECT * FROM f_match_diag", "f_match_diag"),
    "match_operations": with_ctes("SELECT * FROM f_match_opertn", "f_match_opertn"),
    "narrow_coverage": with_ctes(COVERAGE.format("f_match_narrow"), "f_match_narrow"),
    "mentions_raw": with_ctes("SELECT * FROM f_mentions_raw", "f_mentions_raw"),
    "mentions_dedup": with_ctes("SELECT * FROM f_mentions", "f_mentions"),
    "mentions_by_source": with_ctes("SELECT * FROM f_mentions", "f_mentions"),
    "mentions_dedup_shuffle": with_ctes("SELECT * FROM f_mentions", "f_mentions"),
    "mentions_raw_shuffle": with_ctes("SELECT * FROM f_mentions_raw", "f_mentions_raw"),
    "mentions_totals_raw": with_ctes(COVERAGE.format("f_mentions_raw"), "f_mentions_raw"),
    "mentions_totals_dedup": with_ctes(COVERAGE.format("f_mentions"), "f_mentions"),
    "duplicate_volume": with_ctes("""
SELECT r.n AS n_raw, d.n AS n_dedup, r.n - d.n AS n_duplicates
FROM (SELECT COUNT(*) AS n FROM f_mentions_raw) r, (SELECT COUNT(*) AS n FROM f_mentions) d""",
        "f_mentions_raw", "f_mentions"),
    "first_dates_by_code": with_ctes("""
SELECT person_id_deid, phenotype, MIN(date) AS date, code, terminology
FROM f_mentions GROUP BY person_id_deid, phenotype, code, terminology""", "f_mentions"),
    "first_dates_by_phenotype": with_ctes("""
SELECT person_id_deid, phenotype, MIN(date) AS date
FROM f_mentions GROUP BY person_id_deid, phenotype""", "f_mentions"),
    "n_occurrences": with_ctes("""
SELECT person_id_deid, phenotype, COUNT(*) AS n_occurrences
FROM f_mentions GROUP BY person_id_deid, phenotype""", "f_mentions"),
    "features_by_phenotype": with_ctes(FEATURES, "f_mentions"),
    "features_from_code_summary": with_ctes(FEATURES, "f_mentions"),
    "flag_matrix": with_ctes("""
SELECT DISTINCT person_id_deid, phenotype, CAST(1 AS BIGINT) AS flag FROM f_mentions""", "f_mentions"),
    "flag_matrix_sizes": with_ctes("""
SELECT c.phenotype, COUNT(DISTINCT m.person_id_deid) AS n_ones,
       (SELECT COUNT(DISTINCT person_id_deid) FROM f_mentions) - COUNT(DISTINCT m.person_id_deid) AS n_zeros
FROM (SELECT DISTINCT phenotype FROM f_codelist) c LEFT JOIN f_mentions m ON m.phenotype = c.phenotype
GROUP BY c.phenotype""", "f_codelist", "f_mentions"),
    "coverage_by_cut": with_ctes("""
SELECT terminology, year, GROUPING(terminology, year) AS cut, COUNT(*) AS mentions, COUNT(DISTINCT person_id_deid) AS unique_pts,
       COUNT(DISTINCT phenotype) AS phenotypes, TRUE AS close
FROM (SELECT *, CAST(year(date) AS VARCHAR) AS year FROM f_mentions)
GROUP BY GROUPING SETS ((terminology, year), (terminology), (year), ())""", "f_mentions"),
    "code_summary_in_deliveries": with_ctes("""
SELECT person_id_deid, phenotype, code, terminology, MIN(date) AS date, COUNT(*) AS n
FROM f_mentions GROUP BY person_id_deid, phenotype, code, terminology""", "f_mentions"),
    "features_kept_in_deliveries": with_ctes("""
SELECT person_id_deid, COUNT(*) AS n_mentions, MIN(date) AS first_date, COUNT(DISTINCT phenotype) AS n_phenotypes
FROM f_mentions GROUP BY person_id_deid""", "f_mentions"),
    "flag_rows_merged": with_ctes("""
SELECT person_id_deid, COUNT(DISTINCT phenotype) AS n_phenotypes, MIN(phenotype) AS first_phenotype, MAX(phenotype) AS last_phenotype
FROM f_mentions GROUP BY person_id_deid""", "f_mentions"),
    "mention_volumes": with_ctes("""
SELECT r.n_raw, d.n_dedup, r.n_raw - d.n_dedup AS n_duplicates, d.unique_pts, d.phenotypes,
       n.narrow_raw, n.narrow_pts, n.narrow_phenotypes
FROM (SELECT COUNT(*) AS n_raw FROM f_mentions_raw) r,
     (SELECT COUNT(*) AS n_dedup, COUNT(DISTINCT person_id_deid) AS unique_pts,
             COUNT(DISTINCT phenotype) AS phenotypes FROM f_mentions) d,
     (SELECT COUNT(*) AS narrow_raw, COUNT(DISTINCT person_id_deid) AS narrow_pts,
             COUNT(DISTINCT phenotype) AS narrow_phenotypes FROM f_match_narrow) n""",
        "f_mentions_raw", "f_mentions", "f_match_narrow"),
    "mentions_clustered": with_ctes("""
SELECT phenotype, COUNT(*) AS n, MIN(date) AS first_date, MAX(date) AS last_date
FROM f_mentions GROUP BY phenotype""", "f_mentions"),
    "mentions_zorder": with_ctes("\nUNION ALL\n".join(f"""
SELECT '{k}' AS key, COUNT(*) AS n, TRUE AS skips FROM f_mentions
WHERE {k} = (SELECT MIN({k}) FROM f_mentions) OR {k} = (SELECT MAX({k}) FROM f_mentions)"""
        for k in ("person_id_deid", "code", "phenotype")), "f_mentions"),
    "mentions_compacted": with_ctes("""
SELECT terminology, COUNT(*) AS n, COUNT(DISTINCT person_id_deid) AS unique_pts, TRUE AS fewer_files
FROM f_mentions GROUP BY terminology""", "f_mentions"),
    "mentions_table_replaced": with_ctes("""
SELECT phenotype, COUNT(*) AS n, MIN(date) AS first_date, MAX(date) AS last_date
FROM f_mentions GROUP BY phenotype""", "f_mentions"),
    "category_mapping": with_ctes("SELECT phenotype, category, cat FROM f_mapping", "f_mapping"),
    "category_sizes": with_ctes("""
SELECT category, cat, COUNT(DISTINCT phenotype) AS n_phenotypes
FROM f_mapping GROUP BY cat, category""", "f_mapping"),
    "categorise_join": with_ctes("SELECT * FROM f_categorised", "f_categorised"),
    "categorise_map": with_ctes("SELECT * FROM f_categorised", "f_categorised"),
    "categorise_join_shuffle": with_ctes("SELECT * FROM f_categorised", "f_categorised"),
    "codes_per_category": with_ctes("""
SELECT category, COUNT(DISTINCT code) AS n_codes FROM f_categorised GROUP BY category""",
        "f_categorised"),
    "codes_per_category_by_terminology": with_ctes("""
SELECT category, COUNT(DISTINCT (terminology, code)) AS n_codes FROM f_categorised GROUP BY category""",
        "f_categorised"),
    "codes_per_phenotype": with_ctes("""
SELECT phenotype, COUNT(DISTINCT code) AS n_codes FROM f_mentions GROUP BY phenotype""",
        "f_mentions"),
    "unmapped_phenotypes": with_ctes("""
SELECT DISTINCT phenotype FROM f_codelist c
WHERE phenotype IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM f_mapping m WHERE m.phenotype = c.phenotype)""",
        "f_codelist", "f_mapping"),
    "orphan_categories": with_ctes("""
SELECT DISTINCT phenotype FROM f_mapping m
WHERE phenotype IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM f_codelist c WHERE c.phenotype = m.phenotype)""",
        "f_codelist", "f_mapping"),
    "unabbreviated_categories": with_ctes("""
SELECT DISTINCT category, 'category' AS side FROM f_listed l
WHERE category IS NOT NULL AND NOT EXISTS (SELECT 1 FROM f_short s WHERE s.category = l.category)
UNION ALL
SELECT DISTINCT category, 'abbreviation' AS side FROM f_short s
WHERE category IS NOT NULL AND NOT EXISTS (SELECT 1 FROM f_listed l WHERE l.category = s.category)""",
        "f_listed", "f_short"),
}

# The same tables by another way: through files, arrays of structs, or the full slot layout.
ORACLE_SQL |= {
    "catalog_from_csv": ORACLE_SQL["catalog_unpivot"],
    "category_mapping_from_csv": ORACLE_SQL["category_mapping"],
    "melt_codes_generate": ORACLE_SQL["wide_records_one_pass"],
    "wide_records_hospital_layout": ORACLE_SQL["wide_records_one_pass"],
}
