"""Codelist sources: find them and read all of them as one long table.

A codelist source is a file (or table) per phenotype and terminology whose
name says which terminology it holds (see
:mod:`phenospark.functions.routing`). Sources are read together: they are grouped
by where their code columns stand (CSV) or by these columns' types (parquet files,
tables of the metastore), and each group is one scan, whatever the number of its
sources; the source's name comes from the file's metadata. Listing is a
distributed file scan too (``binaryFile`` without its content column). The result
is ``source, terminology, code`` for all of them.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from phenospark.functions.names import file_stem
from phenospark.functions.routing import (
    CODE_COLUMN_ROUTES,
    TERMINOLOGY_OF_COLUMN,
    code_columns_for,
    code_columns_for_name,
)
from phenospark.operators.joins import lookup_join
from phenospark.operators.reshape import melt_codes
from phenospark.sinks import describe_table


def decoded(path: Column) -> Column:
    """A path of file metadata without URL escapes (``a%20b`` -> ``a b``)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


#: Where a source's name stands in the path of its file.
_SOURCE_PATTERN = {"file": None, "directory": r"([^/]+)/[^/]+$", "partition": r"[^/=]+=([^/]+)/[^/]+$"}


def _source_of(path: Column, source_from: str) -> Column:
    """The source's name, in lower case as the catalog has it."""
    pattern = _SOURCE_PATTERN[source_from]
    return F.lower(file_stem(path) if pattern is None else F.regexp_extract(path, pattern, 1))


def list_sources(spark: SparkSession, root: str, pattern: str = "*", source_from: str = "file") -> DataFrame:
    """Files under ``root`` whose name matches the glob ``pattern``: ``path,
    source, length, modified`` (``source``: the file stem, or with
    ``source_from`` the folder or partition value, in lower case). A file
    with a header only is listed too (one of no bytes at all is not: Spark's
    scans skip those)."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select(
        "path",
        _source_of(F.col("path"), source_from).alias("source"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def list_tables(spark: SparkSession, database: str, pattern: str | None = None) -> DataFrame:
    """Tables of a metastore database (optionally by ``LIKE``-style pattern):
    ``database, table``. Catalog metadata, not data."""
    tables = spark.catalog.listTables(dbName=database, pattern=pattern)
    rows = [(database, t.name) for t in tables]
    return spark.createDataFrame(rows, "database string, table string")


def _melt_routed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``source`` and the code columns of one route -> ``source, terminology,
    code`` (NULL codes kept, as the sources hold them; two-column sources give
    one row per non-NULL column value)."""
    if len(columns) == 1:
        return df.select(
            "source",
            F.lit(TERMINOLOGY_OF_COLUMN[columns[0]]).alias("terminology"),
            F.col(columns[0]).cast("string").alias("code"),
        )
    slots = {TERMINOLOGY_OF_COLUMN[c]: [c] for c in columns}
    return melt_codes(df, ["source"], slots).select("source", "terminology", "code")


#: The route with two code columns; every other has one.
(_TWO_COLUMNS,) = [columns for _, columns in CODE_COLUMN_ROUTES if len(columns) == 2]


def _with_terminology(df: DataFrame) -> DataFrame:
    """``source, code`` of sources with one code column -> ``source, terminology, code``."""
    named = F.create_map(*[F.lit(x) for pair in TERMINOLOGY_OF_COLUMN.items() for x in pair])
    return df.select("source", named[code_columns_for("source")].alias("terminology"), "code")


def _balanced(parts: list[DataFrame]) -> DataFrame:
    """A union of depth log2 n."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _union(parts: list[DataFrame], spark: SparkSession) -> DataFrame:
    """A balanced union; an empty table for no parts."""
    return _balanced(parts) if parts else spark.createDataFrame([], "source string, terminology string, code string")


def _wanted(sources: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """The sources that the catalog names; without one, those whose name says a terminology."""
    if catalog is not None:
        named = catalog.select(F.lower("table").alias("source")).distinct()
        return lookup_join(sources, named, "source", "left_semi")
    tokens = "|".join(token for token, _ in CODE_COLUMN_ROUTES)
    return sources.where(F.col("source").rlike(tokens))


#: Column of a CSV record that does not fit its file's header (a name no header has).
_BAD = "_bad record"


def _csv_groups(spark: SparkSession, root: str, glob: str, source_from: str, catalog: DataFrame | None,
                options: Mapping[str, str]) -> dict[tuple, list[str]]:
    """Files by (number of columns, places of the code columns): files of different
    vocabularies whose code stands in the same place are one group.

    Each file's first line is its header. What reaches the driver is a header and a
    path per file, as Spark's own file index does."""
    lines = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(root)
        .select("value", F.col("_metadata.file_block_start").alias("block"),
                _source_of(decoded(F.col("_metadata.file_path")), source_from).alias("source"),
                F.col("_metadata.file_path").alias("file"))
    )
    # A file's first line: the least row number of its first block (numbers rise inside a block).
    first = (
        _wanted(lines, catalog).where((F.col("block") == 0) & (F.length(F.trim("value")) > 0))
        .withColumn("at", F.monotonically_increasing_id())
        .groupBy("file").agg(F.min_by("value", "at").alias("header"), F.first("source").alias("source"))
        .withColumn("route", code_columns_for("source"))
    )
    groups = defaultdict(list)
    for row in sorted(first.collect(), key=lambda r: r["file"]):
        header = next(csv.reader([row["header"]], delimiter=options["sep"], quotechar=options["quote"]))
        names = [n.strip().lstrip("\ufeff") for n in header]
        columns = row["route"].split(",")
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"codelist source {row['source']!r} lacks column(s) {missing}; it has {names}")
        groups[len(names), tuple(names.index(c) for c in columns)].append(row["file"])
    return groups


def _csv_records(spark: SparkSession, root: str, glob: str, source_from: str, catalog: DataFrame | None,
                 options: Mapping[str, str] | None) -> list[tuple[list[str], DataFrame]]:
    """(code columns, records) of every group of CSV files: ``source, file``, the code
    columns (``code``, or the columns of a two-column route) and the raw text of a record
    that does not fit the header (else NULL).

    Records are read by Spark's CSV reader, so quoted cells may hold line breaks,
    separators and (doubled) quotes; a record that repeats the header is data."""
    options = {"sep": ",", "quote": '"', **(options or {})}
    options = {"escape": options["quote"], **options}
    out = []
    for (width, places), files in sorted(_csv_groups(spark, root, glob, source_from, catalog, options).items()):
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)] + [T.StructField(_BAD, T.StringType())])
        reader = spark.read.schema(schema).options(**options).options(
            header="true", multiLine="true", mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD,
            pathGlobFilter=glob, recursiveFileLookup="true")
        path = F.col("_metadata.file_path")
        columns = ["code"] if len(places) == 1 else list(_TWO_COLUMNS)
        out.append((columns, reader.csv(root).where(path.isin(files)).select(
            _source_of(decoded(path), source_from).alias("source"), path.alias("file"),
            *[F.col(f"c{i}").alias(c) for i, c in zip(places, columns)], _BAD)))
    return out


def _is_bad(columns: Sequence[str]) -> Column:
    """Whether a CSV record does not fit. The code columns stand beside the test (to no
    effect), because Spark refuses a scan of which only the corrupt-record column is used."""
    return F.col(_BAD).isNotNull() & (F.length(F.concat_ws("", *columns)) >= 0)


def _csv_codes(spark: SparkSession, root: str, glob: str, source_from: str, catalog: DataFrame | None,
               options: Mapping[str, str] | None, bad_rows: str) -> DataFrame:
    parts = []
    for columns, records in _csv_records(spark, root, glob, source_from, catalog, options):
        bad = _is_bad(columns)
        if bad_rows == "skip":
            records = records.where(~bad)
        else:
            told = F.raise_error(F.concat(F.lit("a record does not fit the header of "), "file", F.lit(": "), F.substring(F.col(_BAD), 1, 200)))
            records = records.withColumns({c: F.when(bad, told).otherwise(F.col(c)) for c in columns})
        parts.append(_with_terminology(records) if columns == ["code"] else _melt_routed(records.select("source", *columns), columns))
    return _union(parts, spark)


def bad_code_rows(
    spark: SparkSession,
    root: str,
    name_glob: str = "*.csv",
    source_from: str = "file",
    options: dict[str, str] | None = None,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """``source, file, record``: the records of CSV codelists whose cells are more or
    fewer than their file's header has (see ``bad_rows`` of :func:`read_code_files`)."""
    parts = [
        records.where(_is_bad(columns)).select("source", decoded(F.col("file")).alias("file"), F.col(_BAD).alias("record"))
        for columns, records in _csv_records(spark, root, name_glob, source_from, catalog, options)
    ]
    if not parts:
        return spark.createDataFrame([], "source string, file string, record string")
    return parts[0] if len(parts) == 1 else _balanced(parts)


# -- parquet files ------------------------------------------------------------

#: Files up to this size have their footer read in the tasks, from so many bytes at their end.
_FOOTER_FILE_BYTES, _FOOTER_BYTES = 64 << 20, 1 << 20


def parquet_columns(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``path, columns``: each parquet file's columns, ``columns`` as array of
    ``(name, type)``. Footers are read by Spark tasks; only files above
    ``_FOOTER_FILE_BYTES`` (few, by their size) are asked for theirs one by one."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup="true").load(root)
    schema = "path string, columns array<struct<name: string, type: string>>"

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Uses nothing of this package: workers need not find it.
        def spark_type(kind: pa.DataType) -> str:
            try:
                return from_arrow_type(kind).simpleString()
            except Exception:  # a type that Spark has no name for: no code column
                return "unknown"

        for batch in batches:
            columns = []
            for tail in batch.column(1):
                found = pq.read_schema(pa.py_buffer(tail.as_py()))
                columns.append([{"name": f.name, "type": spark_type(f.type)} for f in found])
            kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns, kind)], names=["path", "columns"])

    tail = F.substring("content", -_FOOTER_BYTES, _FOOTER_BYTES)
    small = files.where(F.col("length") <= _FOOTER_FILE_BYTES).select("path", tail.alias("tail")).mapInArrow(footers, schema)
    large = files.where(F.col("length") > _FOOTER_FILE_BYTES).select("path").collect()
    if not large:
        return small
    rows = [(r["path"], [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(r["path"]).schema]) for r in large]
    return small.unionByName(spark.createDataFrame(rows, schema))


def _parquet_codes(spark: SparkSession, root: str, glob: str, source_from: str, catalog: DataFrame | None,
                   options: Mapping[str, str]) -> DataFrame:
    """Codes of parquet files: files whose code columns (of any route) don't differ in type
    are one scan, those of the two-column route apart. A column that a file lacks is
    NULL in it; each row takes the column that its source's name asks for."""
    source = _source_of(F.col("path"), source_from)
    listed = _wanted(parquet_columns(spark, root, glob).withColumn("source", source), catalog)
    kinds = defaultdict(set)  # files by the code columns that they have, and whether two are wanted
    for row in listed.select("path", "source", "columns").collect():
        wanted = code_columns_for_name(row["source"])
        types = {c["name"]: c["type"] for c in row["columns"]}
        _check_columns(row["source"], wanted, list(types))
        kinds[len(wanted), tuple(sorted((c, t) for c, t in types.items() if c in TERMINOLOGY_OF_COLUMN))].add(row["path"])
    groups: list[tuple[int, dict[str, str], set[str]]] = []
    for (width, columns), paths in sorted(kinds.items()):
        for of, types, members in groups:
            if of == width and all(types.get(c, t) == t for c, t in columns):
                types.update(columns)
                members |= paths
                break
        else:
            groups.append((width, dict(columns), set(paths)))
    parts = []
    for width, types, paths in groups:
        schema = ", ".join(f"`{name}` {kind}" for name, kind in sorted(types.items()))
        path = decoded(F.col("_metadata.file_path"))
        files = spark.read.schema(schema).options(**options).options(pathGlobFilter=glob, recursiveFileLookup="true").parquet(root)
        files = files.where(path.isin(sorted(paths))).withColumn("source", _source_of(path, source_from))
        if width == 2:
            parts.append(_melt_routed(files.select("source", *[F.col(c).cast("string").alias(c) for c in _TWO_COLUMNS]), _TWO_COLUMNS))
        else:
            route = code_columns_for("source")
            code = F.coalesce(*[F.when(route == c, F.col(c).cast("string")) for c in sorted(types) if c not in _TWO_COLUMNS])
            parts.append(_with_terminology(files.select("source", code.alias("code"))))
    return _union(parts, spark)


def read_code_files(
    spark: SparkSession,
    root: str,
    fmt: str = "csv",
    name_glob: str | None = None,
    source_from: str = "file",
    options: dict[str, str] | None = None,
    catalog: DataFrame | None = None,
    bad_rows: str = "fail",
) -> DataFrame:
    """All codelist files under ``root`` -> ``source, terminology, code``.

    ``source`` is the file stem in lower case, or with
    ``source_from="directory"`` the name of the folder holding the file (one
    folder per codelist table, e.g. parquet part files), or with
    ``"partition"`` the value of a ``key=value`` folder. With ``catalog``
    (``table`` column) only the sources it names are read, and one of them
    without a terminology in its name is an error; without, files whose name
    says no terminology are left alone. Code columns are found by name in each
    source; a source that lacks its column is an error that names it.
    ``terminology`` is the vocabulary of the column read (``ICD``,
    ``SNOMEDCT``, ``OPCS``, ``Readcode``, ``Medcode``).

    CSV cells may hold line breaks (RFC 4180 quoting). A CSV record with more or
    fewer cells than its file's header is an error that names the file, or with
    ``bad_rows="skip"`` left out (:func:`bad_code_rows` lists them)."""
    if bad_rows not in ("fail", "skip"):
        raise ValueError(f"bad_rows is 'fail' or 'skip', not {bad_rows!r}")
    glob = name_glob or ("*.csv" if fmt == "csv" else f"*.{fmt}")
    if fmt == "csv":
        return _csv_codes(spark, root, glob, source_from, catalog, options, bad_rows)
    if fmt == "parquet":
        return _parquet_codes(spark, root, glob, source_from, catalog, options or {})
    # Other formats: a codelist table per folder (or file), each with a schema of its own.
    listed = _wanted(list_sources(spark, root, glob, source_from), catalog)
    place = F.col("path") if source_from == "file" else F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    tables = listed.select("source", place.alias("place")).distinct().orderBy("place").collect()
    parts = []
    for t in tables:
        df = spark.read.format(fmt).options(**(options or {})).load(t["place"])
        parts.append(_melt_routed(_code_columns(df, t["source"]), code_columns_for_name(t["source"])))
    return _union(parts, spark)


def _check_columns(source: str, wanted: Sequence[str], present: Sequence[str]) -> None:
    missing = [c for c in wanted if c not in present]
    if missing:
        raise ValueError(f"codelist source {source!r} lacks column(s) {missing}; it has {list(present)}")


def _code_columns(df: DataFrame, source: str) -> DataFrame:
    """``source`` and the code columns that its name asks for, as strings."""
    columns = code_columns_for_name(source)
    _check_columns(source, columns, df.columns)
    return df.select(F.lit(source).alias("source"), *[F.col(c).cast("string").alias(c) for c in columns])


# -- tables of the metastore ----------------------------------------------------

#: File formats whose tables can be scanned together by their locations, and column types that are read as declared.
_SCANNED = ("parquet", "orc")
_PLAIN_TYPES = {"string": "string", "varchar": "string", "char": "string", "int": "int", "bigint": "bigint",
                "smallint": "smallint", "tinyint": "tinyint", "double": "double", "float": "float", "date": "date"}
#: Tables described at once (metastore calls, no data).
_DESCRIBE_THREADS = 16


def _place(path: Column) -> Column:
    """A folder's address in one form (``file:///a`` and ``file:/a`` are the same)."""
    return F.regexp_replace(F.regexp_replace(path, r"^([A-Za-z0-9+.-]+:)/+", "$1/"), r"/+$", "")


def read_code_tables(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Codelist tables of a metastore -> ``source, terminology, code``.

    Tables are described at once (metadata, by some threads) and grouped by format,
    route and types of the code columns; the unpartitioned file tables of a group
    are one scan of their locations, and each row's source is the table whose
    location holds its file. What needs the catalog to be read right (partitioned
    tables, views, other formats and types) is a branch of its own in a balanced
    union."""
    names = list(dict.fromkeys(tables))
    if not names:
        return _union([], spark)
    with ThreadPoolExecutor(_DESCRIBE_THREADS) as pool:
        described = dict(zip(names, pool.map(lambda n: describe_table(spark, n), names)))
    groups, parts = defaultdict(list), []
    for name, table in described.items():
        stem = name.rsplit(".", 1)[-1].lower()
        columns = code_columns_for_name(stem)
        kinds = {c["name"]: c["type"]["name"] for c in table["columns"]}
        _check_columns(stem, columns, list(kinds))
        plain = all(kinds[c] in _PLAIN_TYPES for c in columns)
        if plain and table.get("provider") in _SCANNED and table.get("location") and not table.get("partition_columns"):
            groups[table["provider"], tuple((c, _PLAIN_TYPES[kinds[c]]) for c in columns)].append((table["location"], stem))
        else:
            parts.append(_melt_routed(_code_columns(spark.table(name), stem), columns))
    for (provider, columns), own in sorted(groups.items()):
        schema = ", ".join(f"`{c}` {kind}" for c, kind in columns)
        files = spark.read.schema(schema).format(provider).load(sorted({place for place, _ in own}))
        folder = F.regexp_extract(decoded(F.col("_metadata.file_path")), r"^(.*)/[^/]+$", 1)
        names = [c for c, _ in columns]
        rows = files.select(_place(folder).alias("place"), *[F.col(c).cast("string").alias(c) for c in names])
        places = spark.createDataFrame(own, "place string, source string").select(_place(F.col("place")).alias("place"), "source")
        parts.append(_melt_routed(lookup_join(rows, places, "place"), names))
    return _union(parts, spark)
