"""Which code column a codelist source holds, decided from its name.

Source tables carry no terminology column: it is implied by the name
(``codelist_icd_*`` holds ``ICD10code``, ``codelist_cprd_*_snomedct`` holds
``conceptId`` ...). The routing is a ``CASE`` over the name, evaluated in the
JVM for every catalog row; a name that matches nothing raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from phenospark.functions.names import as_column

# Name token -> code column(s), tested in this order (the first
# match wins, so 'icd' is tried before 'snomedct', and a 'cprd' name only
# counts as Read/Med codes when it does not also say 'snomedct').
CODE_COLUMN_ROUTES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("icd", ("ICD10code",)),
    ("snomedct", ("conceptId",)),
    ("cprd", ("Readcode", "Medcode")),
    ("opcs", ("OPCS4code",)),
)

# The terminology each code column belongs to.
TERMINOLOGY_OF_COLUMN = {
    "ICD10code": "ICD",
    "conceptId": "SNOMEDCT",
    "Readcode": "Readcode",
    "Medcode": "Medcode",
    "OPCS4code": "OPCS",
}


def code_columns_for(name: str | Column, separator: str = ",") -> Column:
    """The code column(s) of a source, as one string (``'Readcode,Medcode'``
    for the two-column CPRD sources). Unroutable names raise at run time."""
    name_col = as_column(name)
    expr = None
    for token, columns in CODE_COLUMN_ROUTES:
        cond = name_col.contains(token)
        value = F.lit(separator.join(columns))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(
        F.raise_error(F.concat(F.lit("no terminology in source name: "), name_col))
    )


def code_columns_for_name(name: str) -> tuple[str, ...]:
    """Driver-side twin of :func:`code_columns_for` for a single name (used
    when a reader has to pick a schema before any data is read)."""
    for token, columns in CODE_COLUMN_ROUTES:
        if token in name:
            return columns
    raise ValueError(f"no terminology in source name: {name!r}")
