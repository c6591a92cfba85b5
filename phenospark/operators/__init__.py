"""DataFrame -> DataFrame operators of the phenotyping workflow."""

from phenospark.operators.bloom import drop_unmatched, key_filter
from phenospark.operators.catalog import to_catalog, without_terminology
from phenospark.operators.categories import (
    assert_unique_keys,
    build_mapping,
    categorise,
    categorise_map,
    tidy_abbreviations,
    tidy_categories,
)
from phenospark.operators.checks import (
    duplicate_keys,
    missing_sources,
    null_keys,
    orphans,
    unmapped,
)
from phenospark.operators.codelist import build_codelist, tidy_codes, two_column_codes
from phenospark.operators.features import (
    code_summary,
    features_by_phenotype,
    features_from_summary,
    first_dates,
    first_dates_by_phenotype,
    flag_matrix,
    n_occurrences,
)
from phenospark.operators.history import code_history, code_summary_of, merge_delivery, read_history, unite_histories
from phenospark.operators.joins import lookup_join, salted_join
from phenospark.operators.mentions import (
    MENTION_COLUMNS,
    dedup,
    match,
    mentions,
    narrow_records,
    unite,
    wide_records,
)
from phenospark.operators.reshape import map_columns, melt, melt_codes
from phenospark.operators.sketches import coverage_of_cuts, sketch_coverage, unite_sketches
from phenospark.operators.sparse import (
    encode_phenotypes,
    merge_person_rows,
    name_phenotypes,
    person_rows,
    phenotype_dictionary,
    wide_matrix,
)

__all__ = [
    "MENTION_COLUMNS",
    "assert_unique_keys",
    "build_codelist",
    "build_mapping",
    "categorise",
    "categorise_map",
    "code_history",
    "code_summary",
    "code_summary_of",
    "coverage_of_cuts",
    "dedup",
    "drop_unmatched",
    "duplicate_keys",
    "encode_phenotypes",
    "features_by_phenotype",
    "features_from_summary",
    "first_dates",
    "first_dates_by_phenotype",
    "flag_matrix",
    "key_filter",
    "lookup_join",
    "map_columns",
    "match",
    "melt",
    "melt_codes",
    "mentions",
    "merge_delivery",
    "merge_person_rows",
    "missing_sources",
    "n_occurrences",
    "name_phenotypes",
    "narrow_records",
    "null_keys",
    "orphans",
    "person_rows",
    "phenotype_dictionary",
    "read_history",
    "salted_join",
    "sketch_coverage",
    "tidy_abbreviations",
    "tidy_categories",
    "tidy_codes",
    "to_catalog",
    "two_column_codes",
    "unite",
    "unite_histories",
    "unite_sketches",
    "unmapped",
    "wide_matrix",
    "wide_records",
    "without_terminology",
]
