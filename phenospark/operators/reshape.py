"""Wide <-> long reshaping.

* :func:`melt` — the general wide -> long transform, one row per input row and
  value column, NULL values kept (Spark's ``unpivot``, planned as ``Expand``).
* :func:`melt_codes` — the form the record sources need: many coded slots per
  row become ``(ids..., terminology, code)`` rows without the empty slots,
  for any number of slot families in one pass over the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(
    df: DataFrame,
    id_vars: Sequence[str],
    value_vars: Sequence[str],
    var_name: str = "variable",
    value_name: str = "value",
) -> DataFrame:
    """Wide -> long: ``id_vars..., var_name, value_name``; NULL values kept.

    Value columns of differing types are cast to string (``unpivot`` needs one
    type); columns of one type keep it."""
    value_vars = list(value_vars)
    types = {df.schema[c].dataType for c in value_vars}
    values = value_vars
    if len(types) > 1:
        values = [F.col(c).cast("string").alias(c) for c in value_vars]
    return df.unpivot(list(id_vars), values, var_name, value_name)


def melt_codes(
    df: DataFrame,
    id_vars: Sequence[str],
    slots: Mapping[str, Sequence[str]],
    code_name: str = "code",
    terminology_name: str | None = "terminology",
    method: str = "unpivot",
) -> DataFrame:
    """Coded slots -> one row per non-NULL code.

    ``slots`` maps a terminology to its slot columns, e.g.
    ``{"ICD": ["DIAG_4_01", ...], "OPCS": ["OPERTN_4_01", ...]}``; all of them
    are expanded in a single pass. Codes are cast to string. With
    ``terminology_name=None`` the terminology column is left out (one family).

    ``method="unpivot"`` (default) expands every slot with ``Expand`` and
    drops the NULL codes in the same codegen stage, so no empty row is ever
    materialised. ``method="generate"`` builds an array of
    ``(terminology, code)`` structs, filters it and ``inline``s the rest;
    """
    ids = [F.col(c) for c in id_vars]
    pairs = [(term, slot) for term, family in slots.items() for slot in family]
    if method == "generate":
        entries = F.array(
            *[
                F.struct(F.lit(term).alias("_t"), F.col(slot).cast("string").alias("_c"))
                for term, slot in pairs
            ]
        )
        present = F.filter(entries, lambda e: e["_c"].isNotNull())
        long = df.select(*ids, F.inline(present))
        out = [*ids, F.col("_c").alias(code_name)]
        if terminology_name:
            out.append(F.col("_t").alias(terminology_name))
        return long.select(*out)
    if method == "unpivot":
        # Each slot goes under its terminology's name, so the variable column is the terminology.
        values = [F.col(slot).cast("string").alias(term) for term, slot in pairs]
        long = df.unpivot(list(id_vars), values, "_t", "_c").where(F.col("_c").isNotNull())
        out = [*ids, F.col("_c").alias(code_name)]
        if terminology_name:
            out.append(F.col("_t").alias(terminology_name))
        return long.select(*out)
    raise ValueError(f"unknown melt method {method!r}")


def map_columns(df: DataFrame, fn, columns: Sequence[str] | None = None) -> DataFrame:
    """Apply one column function to every listed column (default: every
    string column), keeping the column names and order."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: fn(F.col(c)) for c in columns})


def slot_columns(df: DataFrame, prefix: str) -> list[str]:
    """Columns named ``prefix`` + anything, in schema order (``DIAG_4_``)."""
    return [c for c in df.columns if c.startswith(prefix)]
