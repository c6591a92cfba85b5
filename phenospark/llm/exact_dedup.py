"""Exact document deduplication by content-defined chunk recipes.

Each text (UTF-8) is cut where a hash of the last eight bytes says so, so equal
texts are cut alike wherever they stand. A block of documents keeps each
distinct chunk once, with a 128-bit digest; a document becomes its ordered list
of chunk numbers (its recipe). Chunks then meet by digest *and contents*: a
digest that stands for one content identifies it; should two contents ever
share a digest, their contents serve as identifiers instead. With these
verified identifiers put in for the numbers, two documents are equal if and
only if their ordered identifier lists are. Only distinct chunks of a block
travel, once; long documents are never moved whole, and no later step touches
text.

Defined results: null counts as the empty text, and all empty texts are equal;
of equal texts the row with the largest doc_id stays (a null doc_id is smaller
than any other), and of rows that repeat a doc_id with the same text one stays;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from phenospark.llm.common import keep_rows, pieces, sha256
from phenospark.sinks import materialise

#: A cut is made at about one byte position in so many, at least and at most so many bytes apart.
CHUNK_MEAN, CHUNK_LEAST, CHUNK_MOST = 2048, 256, 16384
#: More colliding digests than this (none are expected) are joined by a shuffle, not sent to every task.
MAX_BROADCAST_ROWS = 100_000
_PRIME = np.uint64(0x9FB21C651E98DF25)


def cut(text: bytes) -> list[bytes]:
    """The chunks of a text, in order; their concatenation is the text."""
    n = len(text)
    if n <= CHUNK_LEAST:
        return [text] if n else []
    last8 = np.ndarray((n - 7,), dtype="<u8", buffer=text, strides=(1,))
    marks = np.flatnonzero((last8 * _PRIME) >> np.uint64(40) < np.uint64(2**24 // CHUNK_MEAN)) + 8
    cuts, at = [0], 0
    for m in [*marks.tolist(), n]:
        while m - at > CHUNK_MOST:
            at += CHUNK_MOST
            cuts.append(at)
        if m - at >= CHUNK_LEAST or m == n > at:
            cuts.append(m)
            at = m
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in pieces(batches, 1):
        ids, raw = batch.column(0), [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
        number: dict[bytes, int] = {}
        found = [[number.setdefault(c, len(number)) for c in cut(t)] for t in raw]
        n, m = len(raw), len(number)
        docs = [pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), ids,
                pa.array([sha256(t) for t in raw]), pa.array(found, pa.list_(pa.int32())),
                pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
        yield pa.RecordBatch.from_arrays(docs, schema=schema)
        chunks = [pa.array([block] * m, pa.int64()), pa.array(range(m), pa.int32()), pa.nulls(m, ids.type),
                  pa.nulls(m, pa.string()), pa.nulls(m, pa.list_(pa.int32())),
                  pa.array([hashlib.blake2b(c, digest_size=16).digest() for c in number], pa.binary()),
                  pa.array(list(number), pa.binary())]
        yield pa.RecordBatch.from_arrays(chunks, schema=schema)
        block += 1


def recipes(docs: DataFrame) -> DataFrame:
    """block, row, doc_id, text_sha256 and ``ids``, the ordered verified chunk
    identifiers, for every row of ``docs`` (doc_id, text); written."""
    docs = docs.select("doc_id", "text")
    out = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("text_sha256", T.StringType()), T.StructField("recipe", T.ArrayType(T.IntegerType())),
        T.StructField("digest", T.BinaryType()), T.StructField("content", T.BinaryType())])
    arrow = to_arrow_schema(out)
    blocks = materialise(docs.mapInArrow(lambda batches: _blocks(batches, arrow), out), "dedup_blocks")
    chunks = blocks.where("recipe is null").select("block", "n", "digest", "content")
    collided = materialise(
        chunks.select("digest", "content").distinct().groupBy("digest").count().where("count > 1").select("digest"),
        "dedup_collided")
    few = collided.count() <= MAX_BROADCAST_ROWS
    ids = (
        chunks.join(F.broadcast(collided.withColumn("hit", F.lit(True))) if few else collided.withColumn("hit", F.lit(True)), "digest", "left")
        .select("block", F.col("n").alias("chunk"), F.when(F.col("hit"), F.col("content")).otherwise(F.col("digest")).alias("id"))
    )
    rows = blocks.where("recipe is not null").select("block", F.col("n").alias("row"), "doc_id", "text_sha256", "recipe")
    places = rows.select("block", "row", F.posexplode("recipe").alias("pos", "chunk"))
    lists = (
        places.join(ids, ["block", "chunk"])
        .groupBy("block", "row")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("at"))
        .select("block", "row", F.transform("at", lambda x: x["id"]).alias("ids"))
    )
    return materialise(
        rows.drop("recipe").join(lists, ["block", "row"], "left")
        .withColumn("ids", F.coalesce("ids", F.array().cast("array<binary>"))), "dedup_recipes")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for every row of
    ``docs`` (doc_id, text). A group is counted with partial aggregates; joining
    its figures back is a plain shuffle join, whose hot keys Spark splits."""
    rows = recipes(docs)
    at = F.struct("doc_id", "block", "row")
    groups = rows.groupBy("ids").agg(F.max(at).alias("keep"), F.count("*").alias("group_size"))
    return rows.join(groups, "ids").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (at == F.col("keep")).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay, one for each distinct text."""
    kept = exact_duplicates(docs).where("kept").select("doc_id", F.col("text_sha256").alias("mark"))
    return keep_rows(docs, kept, F.sha2(F.coalesce("text", F.lit("")), 256))
