from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenospark.llm import quality
from phenospark.llm.common import in_fold, scan_words, table
from tests.llm.helpers import corpus, empty, frame, words

LABELS = "doc_id bigint, quality int, toxic int, text string"
TOKEN = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+|[^0-9A-Za-z\x80-\U0010FFFF\x20\x09-\x0D]+")


def brute_base(text: str | None) -> tuple:
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def awkward() -> list[tuple[int | None, str | None]]:
    rng = random.Random(4)
    rows = corpus(2, 30)
    for k in range(60):
        lines = [" ".join(rng.choices(["a", "b##", "é|", "<x>", "$$", "word", "日本"], k=rng.randint(0, 4))) for _ in range(rng.randint(0, 12))]
        rows.append((2000 + k, "\n".join(lines + lines[: rng.randint(0, 4)])))
    return rows + [(3000, "x " * 20), (3001, "\n\n\t\n"), (3002, "same\nsame\n same\nsame\r\nsame"), (3003, "one two three four five one two three four five"), (3004, "###")]


def test_base_counts_equal_brute_force(spark):
    rows = awkward()
    got = quality.judge_quality(frame(spark, rows), spark.createDataFrame([], LABELS)).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    counts = [(i, *brute_base(t)) for i, t in rows]
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == sorted(counts, key=key)
    for r in got:  # without trusted documents the method has no objection
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed)
    assert {r.base_failed for r in got} == {True, False}


def brute_grams(text: str | None) -> list[int]:
    tokens = TOKEN.findall(text or "")
    code = [int(scan_words(t.encode(), False, quality._TOKEN)[2][0]) for t in tokens]
    pairs = [int(quality.gram_hashes(np.array(p, np.uint64), 2)[0]) for p in zip(code, code[1:])]
    return [g % quality.BUCKETS for g in code + pairs]


def labelled(rows, seed: int = 1):
    rng = random.Random(seed)
    return [(i, rng.choice([0, 1, 1]), 0, "z") for i, _ in rows if i is not None]


def test_scores_and_verdicts_equal_brute_force(spark):
    rows = awkward()
    labels = labelled(rows) + [(1, None, 0, ""), (2, 0, 0, ""), (2, 1, 0, ""), (None, 1, 0, "")]
    by_id: dict = {}
    for i, q, *_ in labels:
        if i is not None and q is not None:
            by_id[i] = min(q, by_id.get(i, 1))
    trusted = {i for i, q in by_id.items() if q == 1}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams := brute_grams(t))
        if i in trusted and not in_fold(i, quality.ASIDE, 0):
            target.update(grams)
    ratio = [math.log((target[b] + 1) / (target.total() + quality.BUCKETS)) - math.log((raw[b] + 1) / (raw.total() + quality.BUCKETS))
             for b in range(quality.BUCKETS)]
    score = {(i, t): sum(ratio[b] for b in g) / max(1, len(g)) for i, t in rows for g in [brute_grams(t)]}
    held = sorted(math.floor(score[i, t] / quality.BIN) for i, t in rows if i in trusted and in_fold(i, quality.ASIDE, 0))
    least = held[int(quality.LOST * len(held))] * quality.BIN
    share = [(target[b] + 1) / (target.total() + quality.BUCKETS) for b in range(quality.BUCKETS)]
    mean = sum(s * x for s, x in zip(share, ratio))
    deviation = math.sqrt(sum(s * (x - mean) ** 2 for s, x in zip(share, ratio)))
    text_of = {}
    for i, t in rows:
        text_of.setdefault((i, *brute_base(t)), []).append(t)
    got = quality.judge_quality(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    for r in got:
        options = text_of[r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words]
        t = min(options, key=lambda t: abs(score[r.doc_id, t] - r.score))
        assert r.score == pytest.approx(score[r.doc_id, t], abs=1e-9)
        limit = least - quality.MARGIN * deviation / math.sqrt(max(1, len(brute_grams(t))))
        if abs(r.score - limit) > 1e-6:
            assert r.kept == (not r.base_failed and r.score > limit)


def test_threshold_loses_a_bounded_share(spark):
    scores = spark.createDataFrame([(k / 1000,) for k in range(1000)], "score double")
    assert quality.threshold(scores) == pytest.approx(0.002) and quality.LOST == 0.002
    assert quality.threshold(scores.where("score < 0")) == -math.inf


def test_labels_too_many_to_broadcast_give_the_same(spark, monkeypatch):
    rows = awkward()
    docs, labels = frame(spark, rows), spark.createDataFrame(labelled(rows), LABELS)
    one = sorted(map(str, quality.judge_quality(docs, labels).collect()))
    join = quality.lookup_join
    monkeypatch.setattr(quality, "lookup_join", lambda *a, **k: join(*a, broadcast=False, **k))
    assert sorted(map(str, quality.judge_quality(docs, labels).collect())) == one


def test_quality_of_nothing(spark):
    assert quality.judge_quality(empty(spark), spark.createDataFrame([(1, 1, 0, "")], LABELS)).count() == 0


def test_held_out_labels_are_met(spark):
    """Labelled documents that took no part in the counts: trusted ones stay, the others go."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 0)
    got = quality.judge_quality(docs, labels.join(held, "doc_id", "left_anti")).join(held, "doc_id").where(~F.col("base_failed"))
    kept = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert kept[1, True] / (kept[1, True] + kept.get((1, False), 0)) >= 0.97
    assert kept.get((0, False), 0) / (kept.get((0, False), 0) + kept.get((0, True), 0)) >= 0.9
