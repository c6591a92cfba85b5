"""Sources: CSV inputs, record tables, codelist files/tables, and the
star-schema derived fixtures used by the contract queries."""

from phenospark.sources.codelists import (
    bad_code_rows,
    list_sources,
    list_tables,
    read_code_files,
    read_code_tables,
)
from phenospark.sources.tables import (
    read_abbreviations,
    read_categories,
    read_dictionary,
    read_table,
)

__all__ = [
    "bad_code_rows",
    "list_sources",
    "list_tables",
    "read_abbreviations",
    "read_categories",
    "read_code_files",
    "read_code_tables",
    "read_dictionary",
    "read_table",
]
