"""Ranked lexical search of many queries at once, by common-subexpression evaluation.

A query (an item's text) is a sum over its terms, and queries share terms. A block
of queries is therefore compiled to a directed acyclic graph of partial sums: the
leaves are (term, times) pairs, and sets of leaves that several queries hold are
mined greedily, the pair shared by most queries first, each becoming a node that
its queries (and later, larger sets) use instead of its parts. Pairs are mined
among leaves of like frequency (bands of ``BAND``), so mining a query is linear in
its length. Mining runs in Spark tasks, one per block of queries.

Documents are read twice, first as texts: each becomes one row of a written table,
its number of terms and its postings (the queries' terms in it, with counts). From
that table Spark sums N, L and the document frequencies. Then blocks of its rows
are scored: a vector over the block's documents for every leaf, each shared node
once from its two parts, and each query from the few nodes that are left to it.
So a shared term set costs one vector addition a block of documents, however many
queries hold it. A task keeps the best ``top`` documents of each query; these rows
alone are shuffled, in two steps, so that no task gets the candidates of a query
from all others at once.

Bounds: what the tasks are sent is the compiled queries of one round, at most about
``ROUND_BYTES`` of item text by measure (more make further rounds over the
documents; equal texts are one query). A block of documents is cut so that its
vectors stay within ``CELLS`` numbers. Terms are compared by 64-bit hashes.

Defined results: a null or empty text has no terms (a document without terms counts
nowhere, an item without terms has no rows); repeated document rows are documents
of their own; repeated (item_id, text) rows are one item, an item_id with two texts
is two items of that id; equal scores go by ascending doc_id, null last; ids are
integers; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenospark.llm.common import Block, pieces, scan_words
from phenospark.operators.joins import size_in_bytes
from phenospark.sinks import materialise

TOP = 10
#: Queries compiled together, and bytes of their texts sent to the tasks at once.
QUERIES = 256
ROUND_BYTES = 16 << 20
#: Leaves of like frequency among which shared sets are mined.
BAND = 64
#: Numbers that the vectors of a block of documents hold.
CELLS = 4 << 20
#: First step of the merge: parts of a query's candidates.
MERGE = 32

#: Fixed by the contract: what separates terms is every ASCII character but letters and digits.
_TERM = np.zeros(256, dtype=np.int8)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


# --- queries to a graph of shared sums ----------------------------------------

def mine(queries: list[dict[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]], list[list[int]]]:
    """(leaves, nodes, sums) of queries (term -> times): node k, numbered on from the
    leaves, is the sum of two earlier ones; a query is the sum of the nodes in its list."""
    held = Counter(leaf for q in queries for leaf in q.items())
    leaves = sorted(held, key=lambda leaf: (-held[leaf], leaf))
    number = {leaf: i for i, leaf in enumerate(leaves)}
    band = [i // BAND for i in range(len(leaves))]
    parts = [{number[leaf] for leaf in q.items()} for q in queries]
    users: dict[tuple[int, int], set[int]] = defaultdict(set)

    def pairs(i: int, nodes: set[int]) -> Iterator[tuple[int, int]]:
        return ((min(i, j), max(i, j)) for j in nodes if j != i and band[i] == band[j])

    for q, own in enumerate(parts):
        by_band: dict[int, list[int]] = defaultdict(list)
        for i in sorted(own):
            if held[leaves[i]] > 1:  # no other query holds it otherwise
                by_band[band[i]].append(i)
        for group in by_band.values():
            for k, i in enumerate(group):
                for j in group[k + 1:]:
                    users[i, j].add(q)
    heap = [(-len(u), pair) for pair, u in users.items() if len(u) > 1]
    heapq.heapify(heap)
    nodes: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        now = users.get(pair, set())
        if len(now) != -count:  # queries have lost the pair meanwhile
            if len(now) > 1:
                heapq.heappush(heap, (-len(now), pair))
            continue
        made = len(band)
        band.append(band[pair[0]])
        nodes.append(pair)
        new: set[tuple[int, int]] = set()
        for q in sorted(now):
            for i in pair:
                for p in pairs(i, parts[q]):
                    if p != pair and p in users:
                        users[p].discard(q)
            parts[q] -= set(pair)
            for p in pairs(made, parts[q]):
                users[p].add(q)
                new.add(p)
            parts[q].add(made)
        del users[pair]
        for p in new:
            if len(users[p]) > 1:
                heapq.heappush(heap, (-len(users[p]), p))
    return leaves, nodes, [sorted(own) for own in parts]


def _terms(text: str) -> np.ndarray:
    return scan_words((text or "").encode(), True, _TERM)[2]


def _compile(rows: pd.DataFrame) -> pd.DataFrame:
    """One block of queries as a row: its queries and their graph."""
    rows = rows.sort_values("query")
    queries = []
    for text in rows["text"]:
        terms, times = np.unique(_terms(text).view(np.int64), return_counts=True)
        queries.append(dict(zip(terms.tolist(), times.tolist())))
    leaves, nodes, sums = mine(queries)
    return pd.DataFrame({
        "block": [rows["block"].iloc[0]], "queries": [rows["query"].tolist()],
        "leaf_terms": [[t for t, _ in leaves]], "leaf_times": [[n for _, n in leaves]],
        "node_left": [[a for a, _ in nodes]], "node_right": [[b for _, b in nodes]], "sums": [sums]})


_GRAPH = ("block int, queries array<string>, leaf_terms array<bigint>, leaf_times array<bigint>, "
          "node_left array<int>, node_right array<int>, sums array<array<int>>")


def compile_queries(texts: DataFrame, blocks: int) -> DataFrame:
    """A row for every block of the queries ``texts`` (query, text; distinct)."""
    return texts.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(_compile, _GRAPH)


# --- documents to postings -----------------------------------------------------

def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n_terms, terms, counts: every row of ``docs`` with the terms of
    ``vocabulary`` (sorted hashes; a term is its place there) in its whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in pieces(batches, 1):
            block = Block([(t or "").encode() for t in batch.column(1).to_pylist()], True, _TERM)
            n = np.diff(block.first)
            doc = np.repeat(np.arange(block.n), n)
            at = np.searchsorted(known, block.hash)
            at[at == len(known)] = 0
            hit = known[at] == block.hash if len(known) else np.zeros(len(at), bool)
            pairs, counts = np.unique(doc[hit] * max(1, len(known)) + at[hit], return_counts=True)
            owner, term = np.divmod(pairs, max(1, len(known)))
            offsets = pa.array(np.searchsorted(owner, np.arange(block.n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64)))],
                names=["doc_id", "n_terms", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_terms bigint, terms array<int>, counts array<bigint>")


def term_weights(table: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """(weight of each term, N, L) of a postings table."""
    n_docs, length = table.agg(
        F.count_if(F.col("n_terms") > 0), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    weights = np.zeros(size, np.int64)
    for row in table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        weights[row["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
    return weights, n_docs, length


# --- scoring ---------------------------------------------------------------------

class _Graph:
    """A block of queries, its terms as places in the vocabulary."""

    def __init__(self, row, vocabulary: np.ndarray, first: int):
        terms = np.searchsorted(vocabulary, np.array(row["leaf_terms"], np.int64).view(np.uint64))
        self.terms, self.row_of = np.unique(terms, return_inverse=True)
        self.times = np.array(row["leaf_times"], np.int64)[:, None]
        self.nodes = list(zip(row["node_left"], row["node_right"]))
        self.sums = [np.array(s, np.int64) for s in row["sums"]]
        self.first = first  # number of its first query
        self.width = max(1, CELLS // max(1, len(self.times) + len(self.nodes) + len(self.terms) + len(self.sums)))

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Query x document scores of ``n`` documents from their postings' values."""
        at = np.searchsorted(self.terms, term)
        at[at == len(self.terms)] = 0
        own = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        base = np.zeros((max(1, len(self.terms)), n), np.int64)
        base[at[own], doc[own]] = value[own]
        leaves = len(self.times)
        acc = np.empty((leaves + len(self.nodes), n), np.int64)
        if leaves:
            np.multiply(base[self.row_of], self.times, out=acc[:leaves])
        for k, (a, b) in enumerate(self.nodes, leaves):
            np.add(acc[a], acc[b], out=acc[k])
        out = np.zeros((len(self.sums), n), np.int64)
        for q, parts in enumerate(self.sums):
            if len(parts):
                np.add.reduce(acc[parts], axis=0, out=out[q])
        return out


class _Best:
    """The best ``top`` documents of each query so far."""

    def __init__(self, queries: int, top: int):
        self.top, self.least = top, np.ones(queries, np.int64)
        self.rows = np.zeros((0, 4), np.int64)  # query, score, whether the id is null, id

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        q, d = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if len(q):
            rows = np.concatenate((self.rows, np.column_stack((q + first, scores[q, d], null[d], ids[d]))))
            rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
            starts = np.searchsorted(rows[:, 0], rows[:, 0])
            rank = np.arange(len(rows)) - starts
            self.rows = rows[rank < self.top]
            full = rows[rank == self.top - 1]
            self.least[full[:, 0]] = full[:, 1]


def _score(table: DataFrame, graphs: list, vocabulary: np.ndarray, weights: np.ndarray, n_docs: int, length: int, top: int) -> DataFrame:
    """query (number), doc_id, score: the best documents of each query in each task."""
    total = sum(len(g["queries"]) for g in graphs)
    sent = table.sparkSession.sparkContext.broadcast(([g.asDict() for g in graphs], vocabulary, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, vocabulary, weights = sent.value
        firsts = np.cumsum([0, *(len(r["queries"]) for r in rows)])
        graphs = [_Graph(r, vocabulary, int(f)) for r, f in zip(rows, firsts)]
        best = _Best(total, top)
        for batch in batches:
            column = batch.column(0)
            null = column.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = column.fill_null(0).to_numpy(zero_copy_only=False)
            # 75 n N may leave 64 bits: Python's integers here
            m = np.array([25 + 75 * n * n_docs // length if n else 0 for n in batch.column(1).to_pylist()], np.int64)
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = batch.column(3).flatten().to_numpy()
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            ends = np.concatenate(([0], np.cumsum(sizes)))
            for graph in graphs:
                for i in range(0, batch.num_rows, graph.width):
                    j = min(i + graph.width, batch.num_rows)
                    own = slice(ends[i], ends[j])
                    best.add(graph.first, graph.scores(doc[own] - i, term[own], value[own], j - i), ids[i:j], null[i:j])
        q, score, none, ids = best.rows.T
        yield pa.RecordBatch.from_arrays(
            [pa.array(q.astype(np.int32)), pa.array(ids, mask=none.astype(bool)), pa.array(score)], names=["number", "doc_id", "score"])

    return table.mapInArrow(run, "number int, doc_id bigint, score bigint")


def _first(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _merge(found: DataFrame, top: int) -> DataFrame:
    """number, rank, doc_id, score from the best rows of the tasks."""
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE))
    return _first(_first(found.withColumn("part", part), ["number", "part"], top).drop("rank", "part"), ["number"], top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring rows of ``docs``
    (doc_id, text) for every one of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    named = items.select("item_id", "text", F.sha2("text", 256).alias("query")).where("text is not null").distinct()
    texts = materialise(named.select("query", "text").distinct(), "search_queries")
    n_queries, size = texts.count(), size_in_bytes(texts)
    blocks = max(1, math.ceil(n_queries / QUERIES))
    graphs = materialise(compile_queries(texts, blocks), "search_graphs")
    rounds = min(blocks, max(1, math.ceil(size / ROUND_BYTES)))
    parts = []
    for r in range(rounds):
        own = graphs.where(F.pmod("block", F.lit(rounds)) == r).orderBy("block").collect()
        hashes = [np.array(g["leaf_terms"], np.int64).view(np.uint64) for g in own]
        vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        if not len(vocabulary):
            continue
        table = materialise(postings(docs, vocabulary), "search_postings")
        found = _merge(_score(table, own, vocabulary, *term_weights(table, len(vocabulary)), top), top)
        numbers = [(q, k) for k, q in enumerate(q for g in own for q in g["queries"])]
        parts.append(found.join(F.broadcast(spark.createDataFrame(numbers, "query string, number int")), "number").drop("number"))
    if not parts:
        return spark.createDataFrame([], f"item_id {named.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionByName(part)
    return named.select("item_id", "query").join(ranked, "query").select("item_id", "rank", "doc_id", "score")
