"""Byte-level BPE encoding and decoding of whole documents, by a global shuffle
of distinct pre-tokens.

Texts are split by the tokenizer's pattern. A block of documents keeps each
distinct pre-token once, and each document as the positions' pre-token numbers
(blocks.py). The distinct pre-tokens meet in parts by a hash of their bytes;
there each distinct one of the corpus is encoded once, by merging its bytes in
the order of the ranks, and its ids go back to the blocks that have it. A block
puts the ids in for the numbers, position by position. Decoding looks every id
up in the table of token bytes (as large as the vocabulary) and joins.

Defined results: null counts as empty; an empty text has no ids (the hash is
that of nothing); strings that look like special tokens are ordinary text;
lone surrogates can't occur in UTF-8 input; a pre-token of any length is merged
in n log n steps; repeated rows are encoded alike; an empty table gives an empty
result; further columns are ignored. Ids that a rank file lacks for a single
byte are an error.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from phenospark.llm.blocks import BLOCK_BYTES, ask, finish, pack, pack_bytes, part_count, store_blocks, unpack, unpack_bytes
from phenospark.llm.common import sha256


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token's bytes in base64, a space and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the adjacent pair of least rank (leftmost first) is merged again and again."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here
    before = list(range(-1, n - 1))
    begins = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not begins[i] or j >= n or not begins[j] or end[j] != stop:
            continue  # one of the two has been merged since
        begins[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        k = before[i]
        if k >= 0 and (r := ranks.get(piece[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def _packer(pattern: str):
    compiled = regex.compile(pattern)

    def pieces_of(text: str) -> Iterable[str]:
        if len(text) <= BLOCK_BYTES:
            return compiled.findall(text)
        return (m[0] for m in compiled.finditer(text))  # a long text isn't listed whole

    def run(ids: list, texts: list[str]) -> dict:
        number: dict[str, int] = {}
        docs = [np.fromiter((number.setdefault(w, len(number)) for w in pieces_of(t)), np.uint32) for t in texts]
        return {
            "sizes": [len(d) for d in docs],
            "places": pack(np.concatenate(docs) if docs else np.zeros(0, np.uint32)),
            "words": pack_bytes([w.encode() for w in number]),
        }

    return run


def _part(word: bytes, parts: int) -> int:
    return zlib.crc32(word) % parts


def encode_blocks(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, replies): the documents as pre-token numbers, and the numbers' ids."""
    blocks = store_blocks(docs, "bpe", _packer(pattern), "sizes array<int>, places binary, words binary")
    parts = part_count(blocks)

    def request(block: dict) -> Iterator[tuple]:
        of: dict[int, list[bytes]] = {}
        for word in unpack_bytes(block["words"]):
            of.setdefault(_part(word, parts), []).append(word)
        for part, words in of.items():
            yield part, "words", pack_bytes(words)

    def answer(asked: list[tuple[int, int, str, bytes]]) -> Iterator[tuple]:
        known: dict[bytes, np.ndarray] = {}
        for grp, block, kind, keys in asked:
            found = []
            for word in unpack_bytes(keys):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = np.array(merge(word, ranks), dtype=np.uint32)
                found.append(ids)
            sizes = np.fromiter(map(len, found), np.uint32, len(found))
            yield grp, block, kind, pack_bytes([pack(sizes), pack(np.concatenate(found))])

    return blocks, ask(blocks, ["words"], request, answer)


def block_ids(block: dict, replies: list[dict], parts: int) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, ids) of every document of a block, reassembled by position."""
    words = unpack_bytes(block["words"])
    part_of = np.fromiter((_part(w, parts) for w in words), np.int64, len(words))
    size = np.zeros(len(words), np.int64)
    start = np.zeros(len(words), np.int64)
    flat, total = [], 0
    for r in replies:
        sizes, ids = unpack_bytes(r["reply"])
        sizes, ids = unpack(sizes, "<u4").astype(np.int64), unpack(ids, "<u4")
        mine = np.flatnonzero(part_of == r["part"])
        size[mine] = sizes
        start[mine] = total + np.cumsum(sizes) - sizes
        flat.append(ids)
        total += len(ids)
    ids = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
    places = unpack(block["places"], "<u4")
    at = 0
    for doc_id, n in zip(block["ids"], block["sizes"]):
        own = places[at : at + n]
        at += n
        sizes = size[own]
        ends = np.cumsum(sizes)
        into = np.arange(ends[-1] if n else 0) - np.repeat(ends - sizes, sizes)
        yield doc_id, ids[np.repeat(start[own], sizes) + into]


def token_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs`` (doc_id, text)."""
    blocks, replies = encode_blocks(docs, ranks, pattern)
    parts = part_count(blocks)
    most = max(ranks.values()) + 1
    token_bytes: list[bytes] = [b""] * most
    for token, rank in ranks.items():
        token_bytes[rank] = token

    def work(block: dict, own: list[dict]) -> Iterator[tuple]:
        decimal = [str(i) for i in range(most)]
        for doc_id, ids in block_ids(block, own, parts):
            ids = ids.tolist()
            text = b"".join(map(token_bytes.__getitem__, ids))
            yield doc_id, len(ids), sha256(" ".join(map(decimal.__getitem__, ids)).encode()), sha256(text)

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return finish(blocks, ["ids", "sizes", "places", "words"], replies, work, schema)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, ids (array of int) for every row of ``docs`` (doc_id, text)."""
    blocks, replies = encode_blocks(docs, ranks, pattern)
    parts = part_count(blocks)

    def work(block: dict, own: list[dict]) -> Iterator[tuple]:
        for doc_id, ids in block_ids(block, own, parts):
            yield doc_id, ids.astype(np.int32)

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return finish(blocks, ["ids", "sizes", "places", "words"], replies, work, schema)
