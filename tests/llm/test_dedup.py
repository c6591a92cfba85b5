from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from phenospark.llm import decontam, exact_dedup, simhash, substring
from phenospark.llm.components import components
from tests.llm.helpers import corpus, empty, frame, lower, words


def key(row):
    return tuple((v is not None, v) for v in row)


# --- exact ---------------------------------------------------------------------


def test_cut_is_content_defined_and_lossless():
    rng = random.Random(3)
    text = bytes(rng.randrange(256) for _ in range(60_000))
    chunks = exact_dedup.cut(text)
    assert b"".join(chunks) == text and all(len(c) <= exact_dedup.CHUNK_MOST for c in chunks)
    shifted = exact_dedup.cut(b"some words in front" + text)
    assert len(set(chunks) & set(shifted)) >= len(chunks) - 3
    assert exact_dedup.cut(b"") == [] and exact_dedup.cut(b"a") == [b"a"]
    assert b"".join(exact_dedup.cut(b"a" * 100_000)) == b"a" * 100_000


def test_exact_duplicates_against_brute_force(spark):
    rows = corpus()
    same = Counter(t or "" for _, t in rows)
    keep = {}
    for i, t in rows:
        if i is not None:
            keep[t or ""] = max(i, keep.get(t or "", i))
    got = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    expected = sorted(((i, keep.get(t or ""), same[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == expected
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({r.text_sha256: 1 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    docs = frame(spark, rows)
    left = exact_dedup.without_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.text or "") for r in left.collect()) == sorted(same)


def test_exact_duplicates_of_nothing(spark):
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0


def test_colliding_digests_are_told_apart_by_content(spark, monkeypatch):
    rows = [(1, "one text"), (2, "another text"), (3, "one text")]
    blocks = exact_dedup._blocks

    def colliding(batches, schema):
        for batch in blocks(batches, schema):
            at = batch.schema.get_field_index("digest")
            import pyarrow as pa
            same = pa.array([None if d is None else b"0" * 16 for d in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([same if i == at else c for i, c in enumerate(batch.columns)], schema=schema)

    monkeypatch.setattr(exact_dedup, "_blocks", colliding)
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_duplicates(frame(spark, rows)).collect()}
    assert got == {1: 3, 2: 2, 3: 3}


# --- near ----------------------------------------------------------------------


def brute_fingerprint(text: str | None) -> int:
    w = words(lower(text or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items: dict, near) -> dict:
    names = list(items)
    root = {n: n for n in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if near(items[a], items[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in names}


def test_fingerprint_equals_spark_hash_votes(spark):
    text = "Über den  Fluß\nund in die WÄLDER hinein"
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    assert simhash.fingerprint(b"") == 0
    from pyspark.sql import functions as F
    got = spark.range(1).select(F.xxhash64(F.lit("two words"))).first()[0]
    assert got % 2**64 == brute_fingerprint("two  Words")
    long = " ".join(str(i % 977) for i in range(70_000))
    for piece in (1, 50, 5000):
        assert simhash.fingerprint(long.encode(), piece=piece) == simhash.fingerprint(long.encode()) == brute_fingerprint(long)
    assert simhash.fingerprint(b"a b", piece=1) == brute_fingerprint("a b")


def test_near_duplicates_against_brute_force(spark):
    rows = [(i, t) for i, t in corpus(n=40) if i is not None]
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    fps = {i: brute_fingerprint(t) for i, t in rows}
    expected = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    assert sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == sorted((i, fps[i], expected[i]) for i, _ in rows)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_connect_all_pairs_within_the_distance(spark, distance):
    rng = random.Random(distance)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(8):
            x = base
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << bit
            fps.add(x)
        fps.add(base ^ sum(1 << b for b in rng.sample(range(16, 32), 3)))  # all three bits in one quarter
    fps |= {0, 2**64 - 1, 1, 7}
    items = {f: f for f in sorted(fps)}
    expected = brute_components(items, lambda a, b: (a ^ b).bit_count() <= distance)
    signed = lambda f: f - 2**64 if f >= 2**63 else f
    if distance == 0:
        assert expected == items
        return
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    pairs = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(df, len(fps), distance).collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in pairs)
    linked = set(pairs) | {(b, a) for a, b in pairs}
    assert brute_components(items, lambda a, b: (a, b) in linked) == expected


def test_near_duplicates_of_awkward_rows(spark):
    got = simhash.near_duplicates(frame(spark, [(5, None), (3, ""), (None, " "), (9, "a b c d")])).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 3), (3, 3), (5, 3), (9, 9)]
    assert simhash.near_duplicates(empty(spark)).count() == 0
    left = simhash.one_of_each(frame(spark, [(5, "x y z"), (3, "x y z"), (3, "x y z"), (8, "quite other words")]))
    assert sorted(r.doc_id for r in left.collect()) == [3, 8]


def test_components_of_a_long_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(rows, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(30)}}


# --- substrings ------------------------------------------------------------------


def brute_repeats(rows, window):
    first = {}
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[s : s + window])
                first[k] = min(i, first.get(k, i))
    out = []
    for i, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                keep[s : s + window] = [False] * window
        kept = " ".join(x for x, k in zip(w, keep) if k)
        out.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("window", [50, 3])
def test_remove_repeats_against_brute_force(spark, window):
    rows = corpus(seed=window)
    got = substring.remove_repeats(frame(spark, rows), window=window)
    assert sorted((tuple(r) for r in got.collect()), key=key) == brute_repeats(rows, window)


@pytest.mark.parametrize("window, piece_words", [(50, 64), (3, 2), (5, 7)])
def test_pieces_of_documents_lose_no_window(spark, window, piece_words):
    """Passages that straddle pieces, repeat inside a document and stand in many, against brute force."""
    rng = random.Random(window)
    passage = [f"w{rng.randrange(40)}" for _ in range(400)]
    rows = corpus(seed=window + 1, n=25)
    for i in range(25, 33):
        a = rng.randrange(200)
        rows.append((i, " ".join([*rng.choices(passage, k=rng.randrange(30)), *passage[a : a + 180], "x", *passage[a + 20 : a + 190], *passage[:90] * (i % 3)])))
    rows.append((40, " ".join(passage * 6)))
    got = substring.remove_repeats(frame(spark, rows), window=window, piece_words=piece_words)
    assert sorted((tuple(r) for r in got.collect()), key=key) == brute_repeats(rows, window)


def test_shards_are_bounded_by_their_piece(spark):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(10_000)}" for _ in range(30_000))
    docs = frame(spark, [(1, long), (2, long), (3, "start " + long)]).select("doc_id", "text")
    blocks = substring.store_blocks(docs, "spans", substring.pack_texts, "sizes array<int>, packed binary", 1000)
    spans = substring.shared_spans(blocks, 50, piece_words=1000).cache()
    sizes = [len(r.text.split()) for r in spans.where("kind in ('ref', 'text')").collect()]
    assert len(sizes) >= 60 and max(sizes) <= 1000 + 49
    assert {r.piece for r in spans.where("kind = 'ref'").collect()} == set(range(30))


def test_remove_repeats_of_nothing_and_text_output(spark):
    assert substring.remove_repeats(empty(spark)).count() == 0
    got = substring.remove_repeats(frame(spark, [(1, "a b c d e"), (2, "x  a b c\ny")]), window=3, with_text=True).collect()
    assert {r.doc_id: r.text for r in got} == {1: "a b c d e", 2: "x y"}


def test_suffix_automaton_matching_statistics():
    rng = random.Random(8)
    refs = [[rng.choice("abc") for _ in range(30)] for _ in range(3)]
    automaton = substring.SuffixAutomaton(refs)
    text = [rng.choice("abcd") for _ in range(200)]
    parts = {tuple(r[i:j]) for r in refs for i in range(30) for j in range(i + 1, 31)}
    expected = [max((n for n in range(i + 2) if n == 0 or tuple(text[i + 1 - n : i + 1]) in parts)) for i in range(200)]
    assert list(automaton.matches(text)) == expected


# --- decontamination ---------------------------------------------------------------


def brute_contained(docs, items):
    def sh(t):
        w = words(lower(t or ""))
        return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return sorted((d, i, len(sh(t) & sh(x)), len(sh(x))) for d, t in docs for i, x in items if sh(x) and len(sh(t) & sh(x)) >= 0.8 * len(sh(x)) - 1e-9)


def test_copies_of_an_item_are_searched_once(spark, monkeypatch):
    made = []
    init = decontam._Items.__init__
    monkeypatch.setattr(decontam._Items, "__init__", lambda self, rows, threshold: (made.append(len(rows)), init(self, rows, threshold))[1])
    text = "one two three four five six seven"
    items = spark.createDataFrame([(i, text) for i in range(300)] + [(7, "another item of five words more")], "item_id bigint, text string")
    docs = frame(spark, [(1, f"before {text} after"), (2, "nothing of it")])
    got = decontam.contained_items(docs, items, block_bytes=100)
    assert sum(made) == 2 and sorted((r.doc_id, r.item_id) for r in got.collect()) == [(1, i) for i in range(300)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_contained_items_against_brute_force(spark, block_bytes):
    docs = [(i, t) for i, t in corpus() if i is not None]
    rng = random.Random(4)
    items = []
    for k in range(30):
        w = words(docs[rng.randrange(len(docs))][1])
        w = w[rng.randrange(max(1, len(w) - 30)) :][: rng.choice([2, 5, 12, 30])]
        if w and k % 3 == 0:
            w[rng.randrange(len(w))] = "changed"
        items.append((k, " ".join(w).upper()))
    items += [(90, None), (91, ""), (92, "lonely")]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    got = decontam.contained_items(frame(spark, docs), table, block_bytes=block_bytes).collect()
    expected = brute_contained(docs, items)
    assert len(expected) > 20
    assert sorted((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got) == expected
    left = decontam.decontaminate(frame(spark, docs), table, block_bytes=block_bytes)
    hit = {e[0] for e in expected}
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _ in docs if i not in hit)


def test_decontamination_with_empty_sides(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = frame(spark, corpus())
    assert decontam.contained_items(docs, none).count() == 0
    assert decontam.decontaminate(docs, none).count() == docs.count()
    assert decontam.contained_items(empty(spark), spark.createDataFrame([(1, "a b c d e")], "item_id bigint, text string")).count() == 0


def test_sketch_misses_no_counting_pair():
    for n in range(1, 60):
        k = decontam.sketch_size(n)
        assert n - k < np.ceil(0.8 * n - 1e-9) and k >= 1
