from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from phenospark.llm import spelling
from tests.llm.helpers import corpus, empty, frame, lower


def brute_words(rows) -> dict[str, int]:
    found: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= 6
    return {w: n for w, n in found.items() if n >= 5}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words: dict[str, int]) -> set[tuple]:
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w: str) -> str:
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def variants(seed: int) -> list[tuple[int | None, str | None]]:
    """Texts of a few word families: chains of forms, ties, anagrams, letters beyond ASCII, upper case."""
    rng = random.Random(seed)
    letters = "aabcdeéÉßüÿ×"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(12)]
    words = []
    for k, base in enumerate(bases):
        words += [base] * 160
        for n in (5, 7, 30, 30):
            i = rng.randrange(len(base) + 1)
            made = rng.choice([base[:i] + rng.choice(letters) + base[i:], base[:i] + base[i + 1 :], base[:i] + rng.choice(letters) + base[i + 1 :]])
            words += [made] * n
            words += [made[1:] + rng.choice(letters)] * n
            words += ["".join(rng.sample(made, len(made)))] * 5
            base = made if k % 2 else base
    words += ["kettenwort"] * 400 + ["kettenwor"] * 45 + ["kettenwo"] * 6  # a chain of forms
    rng.shuffle(words)
    texts = []
    while words:
        n = rng.randint(1, 60)
        texts.append(rng.choice([" ", "-", "\n", "1"]).join(words[:n]))
        words = words[n:]
    return [(i, t.upper().replace("SS", "ß") if i % 9 == 0 else t) for i, t in enumerate(texts)]


def test_variants_equal_brute_force(spark):
    for seed in (1, 2, 3):
        rows = variants(seed) + corpus(seed, 20)
        expected = brute_variants(brute_words(rows))
        got = [tuple(r) for r in spelling.spelling_variants(frame(spark, rows)).collect()]
        assert len(got) == len(set(got)) and set(got) == expected
        assert sum(e[1] is not None for e in expected) > 10 and any(e[2] != e[1] and e[1] for e in expected)


def test_words_of_long_texts_are_whole(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 7)
    rows = variants(5)[:40] + [(None, "abcdefghijklmnopqrstuvwxyz " * 6), (900, "Überlänge" * 40), (901, "Überlänge " * 7)]
    assert {tuple(r) for r in spelling.word_counts(frame(spark, rows)).collect()} == set(brute_words(rows).items())


def test_near_pairs_are_found_whatever_the_edit(spark):
    """Every single edit of a word, and pairs at two edits, against the definition."""
    base, letters = "banane", "abenz"
    words = {base}
    for i in range(len(base) + 1):
        words |= {base[:i] + c + base[i:] for c in letters} | {base[:i] + c + base[i + 1 :] for c in letters}
    words = sorted(w for w in words if len(w) >= 6)
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    got = [(r.a, r.b) for r in spelling.near_pairs(table).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def test_signatures_per_word_are_bounded(spark):
    table = spark.createDataFrame([("banane", 5), ("zzzzzzzzzzzz", 9)], "word string, n bigint")
    per_word = spelling.signatures(spelling.with_parts(table, spelling.letter_groups(table))).groupBy("word").count().collect()
    assert {r["count"] for r in per_word} == {2 * (6 + 4 + 4)}


def test_variants_of_nothing(spark):
    assert spelling.spelling_variants(empty(spark)).count() == 0
    few = frame(spark, [(1, None), (2, ""), (3, "short words only of no use")])
    assert spelling.spelling_variants(few).count() == 0
    assert spelling.spelling_variants(few).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_the_join_is_a_merge_join_on_signatures(spark):
    table = spark.createDataFrame([("banane", 5)], "word string, n bigint")
    pairs = spelling.near_pairs(table)
    assert pairs.count() == 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
