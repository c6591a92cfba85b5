"""Records x codelist -> mentions.

A *mention* is one dated occurrence of a phenotype's code in a person's
record: ``person_id_deid, phenotype, date, code, terminology`` (this order).

Records come in two shapes:

* narrow — one code per row (primary care): :func:`narrow_records`;
* wide — many coded slots per row (hospital episodes: 20 diagnosis slots, 24
  operation slots): :func:`wide_records` expands all slot families in one
  pass and drops the empty slots in the same stage.

Matching is exact string equality on ``(terminology, code)``; equal strings
in two vocabularies never meet. The codelist side is broadcast behind a size
check (see :mod:`phenospark.operators.joins`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.operators.bloom import drop_unmatched, key_filter
from phenospark.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, grouped_lookup_join, lookup_join, size_in_bytes
from phenospark.operators.reshape import melt_codes

PERSON = "person_id_deid"
MENTION_COLUMNS = (PERSON, "phenotype", "date", "code", "terminology")

# Slot layout of the hospital-episode source — 20 diagnosis
# columns DIAG_4_01..DIAG_4_20 (ICD-10) and 24 operation columns
# OPERTN_4_01..OPERTN_4_24 (OPCS-4).
DIAGNOSIS_SLOTS = tuple(f"DIAG_4_{i:02d}" for i in range(1, 21))
OPERATION_SLOTS = tuple(f"OPERTN_4_{i:02d}" for i in range(1, 25))
HOSPITAL_SLOTS = {"ICD": DIAGNOSIS_SLOTS, "OPCS": OPERATION_SLOTS}


def narrow_records(
    df: DataFrame,
    person: str = "NHS_NUMBER_DEID",
    date: str = "DATE",
    code: str = "CODE",
    terminology: str | None = None,
) -> DataFrame:
    """One code per row -> ``person_id_deid, date, code[, terminology]``.
    Codes are cast to string, dates to date."""
    cols = [
        F.col(person).alias(PERSON),
        F.col(date).cast("date").alias("date"),
        F.col(code).cast("string").alias("code"),
    ]
    if terminology is not None:
        cols.append(F.lit(terminology).alias("terminology"))
    return df.select(*cols)


def wide_records(
    df: DataFrame,
    person: str = "PERSON_ID_DEID",
    date: str = "ADMIDATE",
    slots: Mapping[str, Sequence[str]] = HOSPITAL_SLOTS,
    method: str = "unpivot",
) -> DataFrame:
    """Slots -> ``person_id_deid, date, code, terminology``, one row per
    non-NULL slot, every family in the same pass over ``df``."""
    base = df.select(
        F.col(person).alias(PERSON),
        F.col(date).cast("date").alias("date"),
        *[F.col(s) for family in slots.values() for s in family],
    )
    return melt_codes(base, [PERSON, "date"], slots, method=method)


def match(
    records: DataFrame,
    codelist: DataFrame,
    terminology: str | None = None,
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
    broadcast: bool | None = None,
    codelist_bytes: int | None = None,
) -> DataFrame:
    """Inner join of records to the codelist -> mentions (a bag: a record
    listed twice, or a code listed twice, gives two mentions).

    With ``terminology`` the records are of that one vocabulary and only its
    part of the codelist is used; without, the records carry a
    ``terminology`` column and the join key is ``(terminology, code)``.
    A code listed under several phenotypes yields one mention per phenotype.
    ``broadcast`` passes a size decision already taken for ``codelist``
    (a filtered part of a codelist that fits, fits too), ``codelist_bytes`` its size.

    When the codelist is too large to broadcast, the records meet it in a
    shuffle join that splits hot codes (see :mod:`phenospark.operators.joins`)."""
    if terminology is not None:
        lookup = codelist.where(F.col("terminology") == F.lit(terminology)).select(
            "code", "phenotype"
        )
        keys = ["code"]
        fixed = [F.lit(terminology).alias("terminology")]
        out = [PERSON, "phenotype", "date", "code", *fixed]
    else:
        lookup = codelist.select("terminology", "code", "phenotype")
        keys = ["terminology", "code"]
        out = list(MENTION_COLUMNS)
    if broadcast is None and max_broadcast_bytes is not None:
        codelist_bytes = size_in_bytes(lookup)
        broadcast = codelist_bytes <= max_broadcast_bytes
    return lookup_join(records, lookup, keys, "inner", None, broadcast, lookup_bytes=codelist_bytes).select(*out)


def unite(*mentions: DataFrame) -> DataFrame:
    """Bag union of mention tables (by column name)."""
    return reduce(lambda a, b: a.unionByName(b), mentions)


def dedup(mentions: DataFrame) -> DataFrame:
    """One row per distinct mention (all five columns; NULL dates compare
    equal). Planned as a partial aggregate before the shuffle, so a repeated
    mention is collapsed inside each map task first."""
    return mentions.dropDuplicates()


def mentions(
    codelist: DataFrame,
    narrow: DataFrame | None = None,
    wide: DataFrame | None = None,
    narrow_terminology: str = "SNOMEDCT",
    deduplicate: bool = True,
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
    records: DataFrame | None = None,
) -> DataFrame:
    """All mentions from a narrow and/or a wide record source.

    ``narrow`` is the output of :func:`narrow_records` (one vocabulary,
    ``narrow_terminology``), ``wide`` of :func:`wide_records`; ``records``
    takes any further long records that carry their own ``terminology``
    column (e.g. ``narrow_records(df, terminology="Readcode")`` of several
    sources, unioned).

    With ``deduplicate`` (the default) the plan is: keep the records whose
    ``(terminology, code)`` is in the codelist (broadcast semi join, map
    side), deduplicate those *records* (the one shuffle, on four narrow
    columns), then attach the phenotypes (broadcast join, map side). Against
    a distinct codelist a mention is a function of its record, so this equals
    deduplicating the mentions, while the shuffle carries neither the
    phenotype names nor the fan-out copies. If the codelist is too large to
    broadcast, a Bloom filter of its keys drops unmatched records instead (a few
    false ones pass), and one exchange by code serves both the deduplication of the
    rest and their shuffle join to the codelist; it splits hot codes
    (:func:`phenospark.operators.joins.grouped_lookup_join`).
    Without ``deduplicate`` the bag of mentions is returned (one row per
    record x codelist entry)."""
    if narrow is None and wide is None and records is None:
        raise ValueError("mentions() needs at least one record source")
    long_sources = [df for df in (wide, records) if df is not None]
    wide = unite(*[df.select(PERSON, "date", "code", "terminology") for df in long_sources]) \
        if long_sources else None
    lookup = codelist.select("phenotype", "terminology", "code")
    if not deduplicate:
        small = size = None
        if max_broadcast_bytes is not None:
            size = size_in_bytes(lookup)
            small = size <= max_broadcast_bytes
        parts = []
        if narrow is not None:
            parts.append(match(narrow, lookup, narrow_terminology, max_broadcast_bytes, small, size))
        if wide is not None:
            parts.append(match(wide, lookup, None, max_broadcast_bytes, small, size))
        return unite(*parts)
    lookup = lookup.distinct()
    small = size = None
    if max_broadcast_bytes is not None:
        size = size_in_bytes(lookup)
        small = size <= max_broadcast_bytes
    records = []
    if narrow is not None:
        records.append(
            narrow.select(PERSON, "date", "code", F.lit(narrow_terminology).alias("terminology"))
        )
    if wide is not None:
        records.append(wide.select(PERSON, "date", "code", "terminology"))
    united = unite(*records)
    keys = ["terminology", "code"]
    if small is False:
        # Lookup too large to broadcast: a filter of its keys drops the records that
        # match nothing where they are read; one exchange brings the rest together with
        # their copies and with the codelist. Codes lead the keys: they differ early.
        known = drop_unmatched(united.where(F.col("code").isNotNull()), key_filter(lookup, keys))
        # A bound of 0 says that the codelist is to be taken as too large, whatever its size.
        joined = grouped_lookup_join(known, lookup, keys[::-1], known.columns, lookup_bytes=size if max_broadcast_bytes else None)
        return joined.select(*MENTION_COLUMNS)
    known = lookup_join(united, lookup.select(*keys).distinct(), keys, "left_semi", None, small)
    distinct_records = known.dropDuplicates()
    return match(distinct_records, lookup, None, None, small)
