from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from phenospark.llm import search
from tests.llm.helpers import corpus, empty, frame, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string, score double, query string"


def terms(text: str | None) -> list[str]:
    return TERM.findall(lower(text or ""))


def brute_ranking(docs, items, top=10) -> list[tuple]:
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for doc, c in counted:
            n = sum(c.values())
            score = 0
            for t, times in Counter(terms(text)).items():
                if t in c:
                    m = 100 - 75 + 75 * n * n_docs // length
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scored)[:top], 1)]
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def questions(rows, seed: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    texts = [t for _, t in rows if t and t.strip()]
    common = rng.choice(texts).split()[:12]
    out = [(k, " ".join(rng.choices(rng.choice(texts).split(), k=rng.randint(1, 25)) + common * (k % 3))) for k in range(25)]
    return out + [(90, None), (91, ""), (92, "?!"), (93, "nowhere to be found"), (94, out[3][1]), (5, out[5][1]), (6, out[7][1]), (None, out[8][1]), (95, "ÉTÉ été É日本")]


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 0.5, "x") for i, t in items], ITEMS)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_equals_brute_force(spark, seed):
    rows = corpus(seed)
    items = questions(rows, seed)
    got = [tuple(r) for r in search.ranked_search(frame(spark, rows), items_frame(spark, items)).collect()]
    assert sorted(got, key=key) == sorted(brute_ranking(rows, items), key=key)


def test_ranking_does_not_depend_on_blocks_rounds_or_merge(spark, monkeypatch):
    rows, items = corpus(4), questions(corpus(4), 4)
    for name, value in (("QUERIES", 3), ("ROUND_BYTES", 2000), ("CELLS", 1000), ("MERGE", 2), ("BAND", 2)):
        monkeypatch.setattr(search, name, value)
    got = [tuple(r) for r in search.ranked_search(frame(spark, rows).repartition(7), items_frame(spark, items), top=3).collect()]
    assert sorted(got, key=key) == sorted(brute_ranking(rows, items, 3), key=key)


def test_equal_scores_go_by_doc_id(spark):
    rows = [(i, "one same text") for i in (9, 3, None, 7, 3, 12)] + [(20, "another text")]
    got = search.ranked_search(frame(spark, rows).repartition(3), items_frame(spark, [(1, "same")])).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.rank)] == [3, 3, 7, 9, 12, None]


def test_search_of_nothing(spark):
    docs, items = frame(spark, corpus(1, 5)), items_frame(spark, [(1, "a1 b2")])
    none = items_frame(spark, [])
    for found in (search.ranked_search(empty(spark), items), search.ranked_search(docs, none),
                  search.ranked_search(docs, items_frame(spark, [(1, None), (2, "--")])), search.ranked_search(frame(spark, [(1, None), (2, "")]), items)):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def expand(node: int, leaves, nodes) -> Counter:
    if node < len(leaves):
        return Counter([leaves[node]])
    a, b = nodes[node - len(leaves)]
    return expand(a, leaves, nodes) + expand(b, leaves, nodes)


def test_mined_graph_sums_to_the_queries_and_shares():
    rng = random.Random(8)
    shared = rng.sample(range(1000), 20)
    queries = [dict.fromkeys(rng.sample(range(1000), 5), 1) | {t: 1 + t % 2 for t in shared[: 5 + k % 15]} for k in range(60)] + [{}, {7: 3}]
    leaves, nodes, sums = search.mine(queries)
    assert [sum((expand(n, leaves, nodes) for n in s), Counter()) for s in sums] == [Counter(list(q.items())) for q in queries]
    used = Counter(n for s in sums for n in s) + Counter(n for pair in nodes for n in pair)
    assert all(used[len(leaves) + k] >= 1 for k in range(len(nodes)))
    additions = len(nodes) + sum(max(0, len(s) - 1) for s in sums)
    assert additions < 0.5 * sum(max(0, len(q) - 1) for q in queries)
    held = [{n for n in range(len(leaves) + len(nodes)) if not expand(n, leaves, nodes) - Counter(list(q.items()))} for q in queries]
    assert all(sum(len(leaves) + k in h for h in held) >= 2 for k in range(len(nodes)))  # each shared by two queries or more


def test_mining_a_long_query_is_linear():
    long = {t: 1 for t in range(30_000)}
    leaves, nodes, sums = search.mine([long, dict(long)])
    assert sum((expand(n, leaves, nodes) for n in sums[0]), Counter()) == Counter(list(long.items()))


def test_long_documents_do_not_overflow():
    graphs = [search._Graph({"leaf_terms": [5], "leaf_times": [2], "node_left": [], "node_right": [], "sums": [[0]]}, np.array([5], np.uint64), 0)]
    assert graphs[0].scores(np.array([0]), np.array([0]), np.array([10**14]), 1).tolist() == [[2 * 10**14]]
