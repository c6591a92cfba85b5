"""Documents in blocks, and questions between blocks by key.

Some operators need a fact about every token, word or window of every document
that depends on the whole corpus (its id, its count, its first owner). Sending
each occurrence would move many times the corpus. Instead each block of
documents (some megabytes, made where the documents are read) sends its
*distinct* keys once, cut by key into parts; a part's task sees the keys of all
blocks, answers each block in the order of its keys, and the block's documents
are then finished with the answers alone. A key is sent once per block however
often it occurs, so a hot key costs a part one entry per block.

Blocks are written once, in a table bucketed by the task that made them
(``grp``, a number that Spark's bucket hash sends to the task's own number, so tasks
fill the buckets evenly), so finishing joins the answers to them without moving them. What the
parts and blocks exchange is packed in numpy arrays (sorted keys as differences,
byte planes, zstd)."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from phenospark.llm.common import pieces

#: Text of a block, and text whose keys one part should get.
BLOCK_BYTES = 8 << 20
PART_BYTES = 16 << 20


def pack(x: np.ndarray, level: int = 3) -> bytes:
    """An array of integers as compressed byte planes."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T if len(x) else np.zeros((0, 0), np.uint8)
    return zstandard.compress(planes.tobytes(), level)


def unpack(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def pack_bytes(items: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, items), np.uint32, len(items))
    return zstandard.compress(np.uint32(len(items)).tobytes() + sizes.tobytes() + b"".join(items), 3)


def unpack_bytes(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = (np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def part_bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the sorted 64-bit keys of part p begin, for p = 0 .. parts."""
    edges = [(p << 64) // parts for p in range(1, parts)]
    inner = np.searchsorted(keys, np.array(edges, dtype=np.uint64)) if edges else np.zeros(0, np.int64)
    return np.concatenate(([0], inner, [len(keys)]))


#: Fixed values of MurmurHash3 (32 bits), by which Spark deals rows to buckets, and Spark's seed.
_MIX_1, _MIX_2, _ADD, _FINAL_1, _FINAL_2, _SEED = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35, 42


def group_of(task: int) -> int:
    """The number whose bucket hash is ``task``, so that bucket ``task mod buckets``
    holds it: the hash of an integer, undone step by step (its steps are one to one)."""
    def times_inverse(x: int, factor: int) -> int:
        return x * pow(factor, -1, 1 << 32) & 0xFFFFFFFF

    def turned_back(x: int, by: int) -> int:
        return (x >> by | x << (32 - by)) & 0xFFFFFFFF

    h = task ^ task >> 16
    h = times_inverse(h, _FINAL_2)
    h ^= h >> 13 ^ h >> 26
    h = times_inverse(h, _FINAL_1)
    h ^= h >> 16
    h = times_inverse((h ^ 4) - _ADD & 0xFFFFFFFF, 5)  # 4 bytes were hashed
    h = turned_back(h, 13) ^ _SEED
    h = times_inverse(turned_back(times_inverse(h, _MIX_2), 15), _MIX_1)
    return h - (1 << 32) if h >> 31 else h


Packer = Callable[[list, list[str]], dict]


def store_blocks(docs: DataFrame, name: str, packer: Packer, fields: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (doc_id, text; null text as empty) in blocks: grp, block,
    n_bytes, ids, and what ``packer(ids, texts)`` makes of a block (``fields``).

    Written as a table of the session's warehouse, bucketed by ``grp``. The rows
    of a block are ordered by doc_id (nulls first)."""
    spark = docs.sparkSession
    schema = _schema(docs, fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        grp, block = group_of(task), task << 32
        rows: list[tuple] = []
        size = 0

        def emit() -> pa.RecordBatch:
            rows.sort(key=lambda r: (r[0] is not None, r[0]))
            ids, texts = [r[0] for r in rows], [r[1] for r in rows]
            row = {"grp": grp, "block": block, "n_bytes": size, "ids": ids, **packer(ids, texts)}
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)

        for batch in pieces(batches, 1):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                if rows and size + len(text) > block_bytes:
                    yield emit()
                    block, rows, size = block + 1, [], 0
                rows.append((doc_id, text))
                size += len(text) + 1
        if rows:
            yield emit()

    table = f"phenospark_{name}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs.select("doc_id", "text").mapInArrow(run, schema).write.format("parquet").bucketBy(buckets, "grp").saveAsTable(table)
    return spark.table(table)


def _schema(docs: DataFrame, fields: str) -> T.StructType:
    own = [T.StructField("grp", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("n_bytes", T.LongType()),
           T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType))]
    return T.StructType(own + T.StructType.fromDDL(fields).fields)


def part_count(blocks: DataFrame, part_bytes: int = PART_BYTES) -> int:
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, math.ceil(total / part_bytes))


_SEND_BYTES = 2 << 20


def each(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """The rows, one at a time: those of the others are not unpacked yet."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def ask(blocks: DataFrame, columns: list[str], request: Callable[[dict], Iterator[tuple]],
        answer: Callable[[list[tuple[int, int, str, bytes]]], Iterator[tuple]]) -> DataFrame:
    """grp, block, kind, part, reply: the answers to every block's questions.

    ``request(block)`` gives (part, kind, keys) of a block (a dict of
    ``columns``); ``answer`` gets the (grp, block, kind, keys) of one part and
    gives (grp, block, kind, reply)."""
    def rows(block: dict, asked: list[tuple]) -> pa.RecordBatch:
        n = len(asked)
        return pa.RecordBatch.from_arrays(
            [pa.array([a[0] for a in asked], pa.int32()), pa.array([block["grp"]] * n, pa.int32()),
             pa.array([block["block"]] * n, pa.int64()), pa.array([a[1] for a in asked], pa.string()),
             pa.array([a[2] for a in asked], pa.binary())],
            names=["part", "grp", "block", "kind", "keys"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in each(batch):
                asked: list[tuple] = []
                size = 0
                for a in request(row):
                    asked.append(a)
                    size += len(a[2])
                    if size >= _SEND_BYTES:
                        yield rows(row, asked)
                        asked, size = [], 0
                if asked:
                    yield rows(row, asked)

    def reply(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        asked = list(zip(*(table[c].to_pylist() for c in ("grp", "block", "kind", "keys"))))
        out = list(answer(asked))
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.binary())
        columns = [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]
        return pa.table([*columns[:3], pa.array([part] * len(out), pa.int32()), columns[3]],
                        names=["grp", "block", "kind", "part", "reply"])

    sent = blocks.select("grp", "block", *columns).mapInArrow(send, "part int, grp int, block bigint, kind string, keys binary")
    return sent.groupBy("part").applyInArrow(reply, "grp int, block bigint, kind string, part int, reply binary")


def finish(blocks: DataFrame, columns: list[str], replies: DataFrame,
           work: Callable[[dict, list[dict]], Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """``work(block, its replies)`` of every block, as rows of ``schema``. The
    replies (any rows with grp, block) come to the blocks; blocks don't move."""
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        of: dict[int, list[dict]] = {}
        for row in right.to_pylist():
            of.setdefault(row["block"], []).append(row)
        out = [r for row in each(left) for r in work(row, of.pop(row["block"], []))]
        return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return (
        blocks.select("grp", "block", *columns).groupBy("grp")
        .cogroup(replies.groupBy("grp")).applyInArrow(run, schema)
    )
