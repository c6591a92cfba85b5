"""Column functions: name normalisation, code tidying, source routing."""

from phenospark.functions.names import (
    file_stem,
    normalise_name,
    qualified_name,
    strip_dots,
    strip_extension,
    with_prefix,
    with_suffix,
)
from phenospark.functions.routing import (
    CODE_COLUMN_ROUTES,
    TERMINOLOGY_OF_COLUMN,
    code_columns_for,
    code_columns_for_name,
)

__all__ = [
    "CODE_COLUMN_ROUTES",
    "TERMINOLOGY_OF_COLUMN",
    "code_columns_for",
    "code_columns_for_name",
    "file_stem",
    "normalise_name",
    "qualified_name",
    "strip_dots",
    "strip_extension",
    "with_prefix",
    "with_suffix",
]
