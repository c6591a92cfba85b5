"""Substring deduplication: spans of words that an earlier document has too are
removed, by matching statistics against suffix automata of reference passages.

A window is ``WINDOW`` consecutive words of one document; a word is removed if a
window that covers it also stands in a document with a smaller doc_id.

Sending the automaton of every shard of the corpus to every document would cost
the corpus times its shards, so documents are streamed only through the shards
that they can match. Blocks ask each other (blocks.py) which of their distinct
window hashes other documents have, which document is the first with them, and in
which of its pieces of ``PIECE`` words the window starts: this exchange decides what
can match, and the automata verify it word by word. The shared passages that start
in one piece of a document are a reference shard (a passage is longer than its piece
by a window less a word, so no window is lost at a cut, and an automaton is bounded
however long the document); the spans of later documents whose windows point to it,
cut alike, are its candidates. Equal candidate spans
travel once. Shards and candidates meet in a join on (document, piece),
which Spark splits where one shard has very many candidates (it is
then sent to each part). There a suffix automaton of the shard is built, the
candidate is read through it, and where the matching statistic (the longest
suffix read so far that the shard contains) reaches the window length, the
window is verified. Verified windows are maximal spans of removed words.

Defined results: ids are integers; null and empty texts have no words; a text shorter than a
window loses nothing; repeats inside one document, or in rows that repeat its
doc_id, don't count; a row without doc_id neither loses words nor makes others
lose any; a window whose 64-bit hash equals that of a different window fails
verification and stays; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenospark.llm.blocks import (
    ask, finish, pack, pack_bytes, pack_sorted, part_bounds, part_count, store_blocks, unpack, unpack_bytes, unpack_sorted,
)
from phenospark.llm.common import Block, mix, sha256
from phenospark.llm.lm import pack_texts, unpack_texts
from phenospark.sinks import materialise

WINDOW = 50
#: Words of a document whose passages make one shard, and windows of a candidate span at most.
PIECE = 1 << 16
#: Text of a block, and text whose windows one part should get.
_BLOCK_BYTES, _PART_BYTES = 4 << 20, 8 << 20
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, dtype=np.uint64)
    x[:1] = 1
    return np.cumprod(x, dtype=np.uint64)


class _Windows:
    """The windows of a block's documents that have a doc_id, by document in the order of doc_id."""

    def __init__(self, block: dict, window: int, piece: int):
        self.texts = unpack_texts(block)
        self.scan = Block(self.texts, lower=False)
        ids = block["ids"]
        self.ids = np.array([-1 if i is None else i for i in ids], dtype=np.int64)
        words = self.scan.hash
        n = len(words)
        row = np.repeat(np.arange(len(ids)), np.diff(self.scan.first))
        has_id = np.array([i is not None for i in ids], dtype=bool)
        at = np.arange(max(0, n - window + 1))
        self.at = at[(row[at] == row[at + window - 1]) & has_id[row[at]]] if len(at) else at
        self.row = row[self.at]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(_BASE, n), dtype=np.uint64)))
        hashes = mix((total[self.at + window] - total[self.at]) * _powers(_INVERSE, n)[self.at]) if len(self.at) else np.zeros(0, np.uint64)
        self.keys, first, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.first_id = self.ids[self.row[first]]  # rows are in the order of doc_id, and the first of equal hashes is given
        last = np.zeros(len(self.keys), dtype=np.int64)
        np.maximum.at(last, self.number, self.row)
        self.shared = self.ids[last] > self.first_id
        self.first_row = self.row[first]
        self.piece = (self.at - self.scan.first[self.row]) // piece
        self.first_piece = self.piece[first]

    def words(self, a: int, b: int) -> bytes:
        raw, s, e = self.scan.raw, self.scan.start, self.scan.end
        return b" ".join([raw[i:j] for i, j in zip(s[a:b].tolist(), e[a:b].tolist())])


class SuffixAutomaton:
    """The substrings of some word sequences, as states with suffix links."""

    def __init__(self, sequences: list[list[str]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for k, words in enumerate(sequences):
            for w in [*words, k]:  # a number parts the sequences; no word equals it
                last = self._extend(last, w)

    def _extend(self, last: int, w: object) -> int:
        nxt, link, length = self.next, self.link, self.length
        now = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = now
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = copy
                    p = link[p]
                link[q] = link[now] = copy
        return now

    def matches(self, words: list[str]) -> Iterator[int]:
        """For each word the length of the longest substring that ends with it."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                size = length[state]
            to = nxt[state].get(w)
            if to is None:
                size = 0
            else:
                state = to
                size += 1
            yield size


def verified_ranges(automaton: SuffixAutomaton, words: list[str], window: int) -> list[tuple[int, int]]:
    """[first, end) of the runs of words that verified windows cover."""
    out: list[list[int]] = []
    for i, size in enumerate(automaton.matches(words)):
        if size >= window:
            if out and i + 1 - window <= out[-1][1]:
                out[-1][1] = i + 1
            else:
                out.append([i + 1 - window, i + 1])
    return [(a, b) for a, b in out]


_SPANS = ("kind string, owner bigint, piece int, content binary, text string, grp int, block bigint, row int, start int")
_STATES = 200_000  # of the automata that a task keeps beside the one in use


def _verify(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    kept: OrderedDict[tuple[int, int], SuffixAutomaton] = OrderedDict()
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    for batch in batches:
        owners, pieces, contents, texts, shards = (batch.column(i) for i in range(5))
        out = []
        for i, key in enumerate(zip(owners.to_pylist(), pieces.to_pylist())):
            if key not in kept:
                kept[key] = SuffixAutomaton([p.split(" ") for doc in shards[i].as_py() for p in doc.split("\n")])
                while len(kept) > 1 and sum(len(a.next) for a in kept.values()) > _STATES:
                    kept.popitem(last=False)
            out.append([{"a": a, "b": b} for a, b in verified_ranges(kept[key], texts[i].as_py().split(" "), window)])
        yield pa.RecordBatch.from_arrays([owners, pieces, contents, pa.array(out, kind)], names=["owner", "piece", "content", "ranges"])


def shared_spans(blocks: DataFrame, window: int, piece_words: int = PIECE) -> DataFrame:
    """Of every block: ``ref`` rows (the passages of a document's piece that later ones
    share), ``cand`` rows (spans that point to a piece), ``text`` rows (their distinct contents)."""
    parts = part_count(blocks, _PART_BYTES)

    def request(block: dict) -> Iterator[tuple]:
        w = _Windows(block, window, piece_words)
        bounds = part_bounds(w.keys, parts)
        for p in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[p], bounds[p + 1])
            rows, of = np.unique(w.first_row[own], return_inverse=True)
            yield int(p), "w", pack_bytes([
                pack_sorted(w.keys[own]), pack(w.ids[rows]), pack(of.astype(np.uint32)), pack(w.first_piece[own].astype(np.uint32))])

    def answer(asked: list[tuple[int, int, str, bytes]]) -> Iterator[tuple]:
        keys, first, piece = [], [], []
        for _, _, _, sent in asked:
            k, ids, of, at = unpack_bytes(sent)
            keys.append(unpack_sorted(k))
            first.append(unpack(ids, "<i8")[unpack(of, "<u4")])
            piece.append(unpack(at, "<u4"))
        edges = np.cumsum([0, *map(len, keys)])
        flat, first, piece = np.concatenate(keys), np.concatenate(first), np.concatenate(piece)
        del keys
        order = np.lexsort((piece, first, flat))  # of a window's documents the first comes first, and its first piece
        flat = flat[order]
        begin = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        size = np.diff(np.concatenate((begin, [len(flat)])))
        several = size > 1
        who = order[np.repeat(several, size)]  # entries whose key other blocks have
        least = np.repeat(order[begin[several]], size[several])
        owner, at = first[least], piece[least]
        back = np.argsort(who)
        who, owner, at = who[back], owner[back], at[back]
        cut = np.searchsorted(who, edges)
        for i, (grp, block, kind, _) in enumerate(asked):
            own = slice(cut[i], cut[i + 1])
            if own.stop > own.start:
                yield grp, block, kind, pack_bytes([pack((who[own] - edges[i]).astype(np.uint32)), pack(owner[own]), pack(at[own])])

    replies = ask(blocks, ["ids", "sizes", "packed"], request, answer)

    def work(block: dict, own: list[dict]) -> Iterator[tuple]:
        w = _Windows(block, window, piece_words)
        if not len(w.at):
            return
        bounds = part_bounds(w.keys, parts)
        owner, piece, shared = w.first_id.copy(), w.first_piece.copy(), w.shared.copy()
        for r in own:
            at, ids, in_piece = unpack_bytes(r["reply"])
            at = unpack(at, "<u4").astype(np.int64) + bounds[r["part"]]
            owner[at] = unpack(ids, "<i8")
            piece[at] = unpack(in_piece, "<u4")
            shared[at] = True
        to, mine = owner[w.number], w.ids[w.row]
        role = np.where(to < mine, 1, np.where(shared[w.number], 2, 0))  # 1: candidate, 2: reference
        of = np.where(role == 1, piece[w.number], w.piece)  # the owner's piece, or the document's own
        cut = np.flatnonzero(np.concatenate((
            [True], (w.at[1:] != w.at[:-1] + 1) | (w.row[1:] != w.row[:-1]) | (role[1:] != role[:-1]) | (of[1:] != of[:-1])
            | ((role[1:] == 1) & (to[1:] != to[:-1])))))
        ends = np.concatenate((cut[1:], [len(w.at)]))
        refs: dict[tuple[int, int], list[bytes]] = {}
        sent: set[tuple[int, int, bytes]] = set()
        for start, end in zip(cut.tolist(), ends.tolist()):
            if not role[start]:
                continue
            for a in range(start, end, piece_words):  # windows that point to one piece may be many, if it repeats
                b = min(a + piece_words, end)
                row, first, in_piece = int(w.row[a]), int(w.at[a]), int(of[a])
                text = w.words(first, int(w.at[b - 1]) + window)
                if role[a] == 2:
                    refs.setdefault((row, in_piece), []).append(text)
                    continue
                content, by = hashlib.blake2b(text, digest_size=16).digest(), int(to[a])
                if (by, in_piece, content) not in sent:
                    sent.add((by, in_piece, content))
                    yield "text", by, in_piece, content, text.decode(), None, None, None, None
                yield "cand", by, in_piece, content, None, block["grp"], block["block"], row, first - int(w.scan.first[row])
        for (row, in_piece), passages in refs.items():
            yield "ref", int(w.ids[row]), in_piece, None, b"\n".join(passages).decode(), None, None, None, None

    return finish(blocks, ["ids", "sizes", "packed"], replies, work, T.StructType.fromDDL(_SPANS))


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False, piece_words: int = PIECE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept words as ``text``)
    for every row of ``docs`` (doc_id integer, text). ``piece_words`` bounds an automaton."""
    blocks = store_blocks(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), "spans", pack_texts, "sizes array<int>, packed binary", _BLOCK_BYTES)
    spans = materialise(shared_spans(blocks, window, piece_words), "spans")
    key = ["owner", "piece"]
    shards = spans.where("kind = 'ref'").groupBy(*key).agg(F.collect_list("text").alias("shard"))  # of one piece each
    contents = spans.where("kind = 'text'").select(*key, "content", "text").distinct()
    verdicts = (
        contents.join(shards, key).select(*key, "content", "text", "shard")
        .mapInArrow(lambda batches: _verify(batches, window), "owner bigint, piece int, content binary, ranges array<struct<a:int,b:int>>")
    )
    hits = (
        spans.where("kind = 'cand'").select(*key, "content", "grp", "block", "row", "start")
        .join(verdicts, [*key, "content"])
        .select("grp", "block", "row", "start", F.explode("ranges").alias("r"))
        .select("grp", "block", "row", (F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b")).alias("b"))
    )

    def work(block: dict, own: list[dict]) -> Iterator[tuple]:
        scan = Block(unpack_texts(block), lower=False)
        keep = np.ones(len(scan.start), dtype=bool)
        for r in own:
            at = scan.first[r["row"]]
            keep[at + r["a"] : at + r["b"]] = False
        for i, doc_id in enumerate(block["ids"]):
            a, b = int(scan.first[i]), int(scan.first[i + 1])
            kept = np.flatnonzero(keep[a:b]) + a
            text = b" ".join([scan.raw[s:e] for s, e in zip(scan.start[kept].tolist(), scan.end[kept].tolist())])
            yield (doc_id, b - a, b - a - len(kept), sha256(text), *([text.decode()] if with_text else []))

    schema = T.StructType.fromDDL("doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", text string" * with_text)
    return finish(blocks, ["ids", "sizes", "packed"], hits, work, schema)
