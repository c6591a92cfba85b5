from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from phenospark.llm import blocks, bpe, html, langid, lm, toxicity, urls
from pyspark.sql import functions as F
from tests.llm.helpers import corpus, empty, frame, lower, words

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"))


def key(row):
    return tuple((v is not None, v) for v in row)


# --- BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        own = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own, special_tokens={})


def test_merge_equals_the_library(ranks, library):
    rng = random.Random(2)
    for piece in ["a", "hello", " wonderful", "aaaaaaaaaaaaaaaaa", "日本語のテキスト", "#" * 5000, "\u0301\u0302", "🙂🙃"]:
        assert bpe.merge(piece.encode(), ranks) == library._encode_single_piece(piece.encode())
    for _ in range(300):
        piece = "".join(rng.choice("abcdeéß 日1") for _ in range(rng.randint(1, 40))).encode()
        assert bpe.merge(piece, ranks) == library._encode_single_piece(piece)


def test_tokens_round_trip_and_equal_the_library(spark, ranks, library):
    rows = corpus() + [(900, "<|endoftext|> is text"), (901, "a\u00a0b \u2003 c\x1cd  \n\n e\u0000f"), (902, "½ ² Ⅷ ٣ 𝟘 don't I'LL"), (903, "x" * 20_000)]
    got = bpe.token_digests(frame(spark, rows), ranks, public_tokenizers.PATTERN).collect()
    expected = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)
    some = {r.doc_id: r.ids for r in bpe.encode(frame(spark, rows), ranks, public_tokenizers.PATTERN).collect()}
    assert library.decode(some[901]) == rows[-3][1]
    assert bpe.token_digests(empty(spark), ranks, public_tokenizers.PATTERN).count() == 0


# --- blocks ---


def test_groups_fill_the_buckets_evenly(spark, tmp_path):
    tasks = [0, 1, 2, 31, 97, 2**16, 2**20 + 7, 2**31 - 1]
    rows = spark.createDataFrame([(blocks.group_of(t), t) for t in tasks], "grp int, task int")
    assert all(r.h == r.task for r in rows.select("task", F.hash("grp").alias("h")).collect())
    assert len({blocks.group_of(t) for t in range(5000)}) == 5000
    docs = frame(spark, corpus(n=60)).repartition(6)
    table = blocks.store_blocks(docs, "even", lambda ids, texts: {"n": len(ids)}, "n int", 500)
    per_task = table.groupBy("grp").count().count()
    files = {f.rsplit("_", 1)[1] for f in table.inputFiles()}  # a bucket's number ends a file's name
    assert len(files) == per_task == 6


# --- language model ---------------------------------------------------------------


def brute_scores(rows, order, prior):
    """base and model score by the definition, with dictionaries of word tuples."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    docs = [(i, ["<s>", *words(lower(t or "")), "</s>"]) for i, t in rows]
    c = Counter()
    for i, w in docs:
        if not held(i):
            for n in range(1, order + 1):
                for k in range(len(w) - n + 1):
                    if n > 1 or k > 0:
                        c[tuple(w[k : k + n])] += 1
    uni = {k: v for k, v in c.items() if len(k) == 1}
    total, v = sum(uni.values()), len(uni)
    ones, twos = sum(x == 1 for x in uni.values()), sum(x == 2 for x in uni.values())
    d = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
    history = lambda h: c[("</s>",)] if h == ("<s>",) else c[h]
    out = []
    for i, w in docs:
        base = score = 0.0
        for k in range(1, len(w)):
            own = c[(w[k],)]
            base += math.log10((own + 1) / (total + v + 1))
            p = (own - d if own else d * v) / total if total else 1.0
            for n in range(2, order + 1):
                h = tuple(w[k - n + 1 : k]) if k - n + 1 >= 0 else None
                if h and history(h):
                    p = (c[(*h, w[k])] + prior[n - 2] * p) / (history(h) + prior[n - 2])
            score += math.log10(p)
        out.append((i, held(i), len(w) - 1, sum(c[(x,)] > 0 for x in w[1:]), total, round(base, 6), round(score, 6)))
    return sorted(out, key=key)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_against_the_definition(spark, order):
    rows = corpus(seed=order)
    got = lm.score_texts(frame(spark, rows), 7, 2, order=order).collect()
    assert sorted(((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got), key=key) == brute_scores(rows, order, lm.PRIOR)


def test_scores_without_training_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.score_texts(frame(spark, [(held, "a b")]), 7, 2).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)
    assert lm.score_texts(empty(spark), 7, 2).count() == 0


def automaton_of(texts, trained, order, prior=lm.PRIOR):
    """The automaton of a block of texts of which the first ``trained`` are learned from, and its row of tokens."""
    grams = lm._Grams([t.encode() for t in texts])
    learned = grams.text < trained
    count, gram = [], []
    for n in range(1, order + 1):
        keys, number, last = grams.of(n)
        count.append(np.bincount(number[learned[last]], minlength=len(keys)).astype(float))
        at = np.full(len(grams.row), -1)
        at[last] = number
        gram.append(at)
    seen = count[0][count[0] > 0]
    once, twice = (seen == 1).sum(), (seen == 2).sum()
    d = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    return lm.Automaton(grams, count, gram, float(trained), prior, int(seen.sum()), len(seen), d), grams


@pytest.mark.parametrize("order", [1, 2, 3])
def test_a_state_s_probabilities_sum_to_one(order):
    rng = random.Random(3)
    training = [" ".join(rng.choices("abcdef", weights=(9, 5, 3, 2, 1, 1), k=rng.randint(1, 12))) for _ in range(30)]
    vocabulary = sorted({w for t in training for w in t.split()})
    histories = ["", "a", "b c", "a a b", "f e", "new", "new a", "a new"]
    asked = [f"{h} {w}".strip() for h in histories for w in [*vocabulary, "unseen"]] + histories
    made, grams = automaton_of(training + asked, len(training), order)
    weight = made.read()
    of = {t: i for i, t in enumerate(training + asked) if i >= len(training)}
    for h in histories:
        words_after = [weight[grams.begin[of[f"{h} {w}".strip()] + 1] - 2] for w in [*vocabulary, "unseen"]]
        end = weight[grams.begin[of[h] + 1] - 1]
        assert sum(10.0 ** x for x in [*words_after, end]) == pytest.approx(1.0, abs=1e-9), (order, h)


def test_failure_arcs_lead_to_the_longest_known_suffix():
    made, grams = automaton_of(["a b c", "b d", "x a b d"], 2, 3)
    known = {(): 0, ("<s>",): made.start}
    rows = [["<s>", *t.split(), "</s>"] for t in ("a b c", "b d")]
    for n in (1, 2):
        for i, row in enumerate(rows):
            for k in range(len(row) - n + 1):
                if n > 1 or k:
                    known[tuple(row[k : k + n])] = made.state[n - 1][made.gram[n - 1][grams.begin[i] + k + n - 1]]
    assert all(v > 0 for h, v in known.items() if h) and len(set(known.values())) == len(known) == len(made.fail)
    for h, s in known.items():
        if h:
            suffix = next(h[k:] for k in range(1, len(h) + 1) if h[k:] in known)
            assert made.fail[s] == known[suffix] and made.length[s] == len(h) and made.fail_weight[s] < 0
    state, _ = made.step(np.array([0]), np.array([grams.begin[2] + 1]))  # an unseen token leads to the state without history
    assert state[0] == 0


def test_reading_in_stretches_equals_reading_whole(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefg", k=k)) for k in (0, 1, 2, 3, 50, 127, 128, 129, 130, 400)]
    for order in (1, 2, 3, 4):
        made, _ = automaton_of(texts, 6, order, prior=(30.0, 4.0, 2.0))
        whole = {}
        for lane in (1000, 128, 7, 1):
            monkeypatch.setattr(lm, "LANE", lane)
            whole[lane] = made.read()
        assert all(np.array_equal(whole[1000], w) for w in whole.values())


def test_counts_beyond_32_bits_add_up():
    big = np.array([2**32 - 1, 2**32 - 1, 5], dtype=np.uint32)
    total = lm.add_up(np.array([1, 1, 0], dtype=np.int32), big, 3)
    assert total.tolist() == [5, 2**33 - 2, 0] and lm.unpack(lm.pack(total), "<u8").tolist() == total.tolist()


# --- toxicity -----------------------------------------------------------------------


def brute_segments(scores):
    """Maximal-scoring segments by their recursive definition."""
    best, where = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12:
                best, where = total, (i, j + 1)
    if where is None:
        return []
    a, b = where
    left = [(x, y, s) for x, y, s in brute_segments(scores[:a])]
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return [*left, (a, b, best), *right]


def test_segments_are_the_maximal_ones():
    rng = random.Random(6)
    for _ in range(200):
        scores = [rng.choice([-5, -3, -2, -1, 1, 2, 4]) + rng.random() / 100 for _ in range(rng.randint(0, 25))]
        assert [(a, b) for a, b, _ in toxicity.segments(scores)] == [(a, b) for a, b, _ in brute_segments(scores)]
    assert toxicity.segments([]) == []


def test_segments_take_linear_time():
    rising = [x for i in range(60_000) for x in (1.0, -0.5)]
    falling = [x for i in range(60_000) for x in (1.0, -1.5)]
    assert len(toxicity.segments(rising)) == 1 and len(toxicity.segments(falling)) == 60_000


def test_toxic_texts_score_high_on_held_out_rows(spark):
    rng = random.Random(9)
    plain = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{k}wort".replace(str(k), chr(97 + k % 26) + chr(97 + k // 26)) for k in range(300)]
    bad = ["vilestone", "vilestones", "vilestonish", "grubface"]
    docs, labels = [], []
    for i in range(600):
        text = rng.choices(plain, k=rng.randint(5, 60))
        if i % 6 == 0:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text) + 1), rng.choice(bad))
        docs.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(i % 6 == 0), 1))
        else:
            labels.append((i, int(i % 6 == 0), 1))
    docs += [(700, None), (701, ""), (None, "x y"), (5, docs[5][1])]
    table = spark.createDataFrame(labels + [(1, None, 1), (None, 1, 1)], "doc_id bigint, toxic int, text int")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    got = toxicity.toxicity(frame(spark, docs), table, held).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    judged = [(r.doc_id % 6 == 0, r.predicted) for r in got if r.doc_id is not None and r.doc_id < 600 and r.held_out]
    assert sum(t == bool(p) for t, p in judged) >= 0.97 * len(judged)
    assert not any(r.predicted for r in got if r.doc_id in (700, 701, None))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.toxicity(frame(spark, docs), none, held).collect()} == {0.0}
    assert toxicity.toxicity(empty(spark), table, held).count() == 0


def test_a_lexicon_beyond_the_bound_scores_alike(spark, monkeypatch):
    rng = random.Random(10)
    plain = [a + b + "wort" for a in "bdfgklmnprst" for b in "aeiou"]
    docs, labels = [], []
    for i in range(400):
        text = rng.choices(plain, k=rng.randint(5, 40))
        text += [["vilestone", "grubface", "murkhound", "vilestonish"][i // 4 % 4]] * 2 if i % 4 == 0 else ["vilepost"] if i % 50 == 1 else []
        rng.shuffle(text)
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    docs += [(700, None), (701, ""), (None, "x grubface"), (5, docs[5][1])]
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    whole = sorted((tuple(r) for r in toxicity.toxicity(frame(spark, docs), table, held).collect()), key=key)
    monkeypatch.setattr(toxicity, "MAX_NODES", 2)
    assert toxicity.train(frame(spark, docs).where(~held), table).lexicon == {}
    joined = sorted((tuple(r) for r in toxicity.toxicity(frame(spark, docs), table, held).collect()), key=key)
    assert [(r[:2], r[3]) for r in joined] == [(r[:2], r[3]) for r in whole] and sum(r[3] for r in whole) >= 20
    assert [r[2] for r in joined] == pytest.approx([r[2] for r in whole], rel=1e-6)


# --- language -----------------------------------------------------------------------


def language_rows():
    rng = random.Random(5)
    syllables = {"xx": ["ka", "to", "mi", "ru"], "yy": ["schl", "ung", "eit", "öß"], "zz": ["ção", "lhe", "ém", "qui"]}
    return [(i, " ".join("".join(rng.choices(s, k=3)) for _ in range(rng.randint(4, 300))), lang)
            for i, (lang, s) in enumerate(list(syllables.items()) * 60)]


def test_language_of_held_out_rows(spark):
    rows = language_rows()
    more = [(900, None, "xx"), (901, "", None), (902, "12 34 ++", "xx"), (903, "KATOMI RUKATO MIRUKA", None), (None, "katomi", "xx"), (3, rows[3][1], None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows + more], "doc_id bigint, text string, lang string, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    net = langid.train(docs.where(~held), steps=300)
    got = langid.identify(docs, net).collect()
    truth = {i: lang for i, _, lang in rows}
    known = [(r.lang_pred, truth[r.doc_id]) for r in got if r.doc_id in truth]
    assert sum(a == b for a, b in known) >= 0.98 * len(known)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[900] == by[901] == by[902] == ("und", 0.0) and by[903][0] == "xx" and all(0 <= s <= 1 for _, s in by.values())
    left = langid.known_language(docs, net, 0.5)
    assert left.columns == docs.columns and {900, 901, 902}.isdisjoint({r.doc_id for r in left.collect()})
    untrained = langid.train(docs.where("false"))
    assert untrained is None and {r.lang_pred for r in langid.identify(docs, untrained).collect()} == {"und"}
    assert langid.identify(docs.limit(0), net).count() == 0


def test_texts_in_several_languages_are_known(spark):
    rng = random.Random(8)
    syllables = {"xx": ["ka", "to", "mi", "ru"], "yy": ["schl", "ung", "eit", "öß"], "zz": ["ção", "lhe", "ém", "qui"], "ww": ["ндо", "при", "ска", "ть"]}

    def part(lang, size=4 * langid.WINDOW):
        text = ""
        while len(text.encode()) < size:
            text += "".join(rng.choices(syllables[lang], k=3)) + " "
        text = text.encode()[:size].decode(errors="ignore")
        return text + " " * (size - len(text.encode()))

    rows = [(i, part(lang, 600), lang) for i, lang in enumerate(list(syllables) * 40)]
    mixed = [["xx", "yy"], ["zz", "ww"], ["xx", "yy", "zz"], ["yy", "zz", "ww"], list(syllables)]
    texts = [(1000 + i, "".join(map(part, langs)), None) for i, langs in enumerate(mixed)] + [(2000, "12 34 ++ " * 300, None), (2001, "", None)]
    schema = "doc_id bigint, text string, lang string"
    net = langid.train(spark.createDataFrame(rows, schema), steps=300, reject=True)
    left = langid.known_language(spark.createDataFrame(texts, schema), net, 0.5)
    assert {r.doc_id for r in left.collect()} == {1000 + i for i in range(len(mixed))}


class _Fixed:
    """A network of three languages and noise whose windows have given log-probabilities, by their first byte."""

    languages, classes = ("en", "es", "fr"), 4

    def __init__(self, by):
        self.by = {ord(k): np.array(v, dtype=float) for k, v in by.items()}

    def log_probabilities(self, x, tables):
        z = np.stack([self.by[b] for b in x[:, 0]])
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def test_a_text_is_known_by_its_best_window_whatever_the_languages_share():
    net = _Fixed({"a": (0, -4, -8, -9), "b": (-8, -4, 0, -9), "c": (0, 0, 0, 9), "1": (0, -9, -9, -20)})
    part = {k: k * langid.WINDOW for k in "abc1"}
    found = langid.judge([part["a"] + part["b"], part["c"], part["c"] + part["1"], part["c"] + part["a"]], net, None)
    assert [round(score, 3) for _, score, _ in found][:2] == [0.333, 0.333]  # among the languages alone
    assert [round(known, 2) for _, _, known in found] == [1.0, 0.0, 0.0, 1.0]  # a window without letters says nothing


def test_looked_up_probabilities_equal_the_forward_pass():
    rng = np.random.default_rng(4)
    for reject in (False, True):
        net = langid.Network(["a", "b", "c"], seed=9, reject=reject)
        x = rng.integers(0, 256, (40, langid.WINDOW)).astype(np.uint8)
        z = np.maximum(net._forward(x)[0], 0) @ net.out + net.out_bias
        expected = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        assert np.allclose(net.log_probabilities(x, net.pair_tables()), expected, atol=1e-4) and expected.shape[1] == 3 + reject


def test_training_lowers_the_loss_as_the_gradient_says():
    """One step along the gradient's sign: every parameter group moves so that the cross entropy falls."""
    rng = np.random.default_rng(6)
    x = rng.integers(97, 110, (64, langid.WINDOW)).astype(np.uint8)
    y = rng.integers(0, 2, 64)
    x[y == 1, 10:13] = [200, 201, 202]

    def loss(net):
        return -net.log_probabilities(x, net.pair_tables())[np.arange(64), y].mean()

    losses = []
    for steps in (0, 60, 300):
        net = langid.Network(["a", "b"], seed=3)
        net.fit(x, y, steps=steps)
        losses.append(loss(net))
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.1


def test_the_draw_takes_rows_without_an_id_and_copies_as_one(spark):
    rows = [(None, f"{w} text of its own {k}", lang) for lang, w in (("xx", "kato"), ("yy", "schlung")) for k in range(30)]
    rows += [(7, "a hot copy of one row", "xx")] * 400
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = langid.train(docs, per_language=10, steps=200)
    assert net.languages == ["xx", "yy"]


def test_windows_cover_the_whole_text():
    for n in (1, 255, 256, 257, 1000):
        text = bytes(i % 251 for i in range(n)).lower()
        got = langid.windows_of(text)
        assert got.shape[1] == langid.WINDOW
        assert bytes(got[-1]).rstrip(b" ").endswith(text[-min(n, 200):].rstrip(b" "))


# --- URLs ---------------------------------------------------------------------------


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = lower(rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_against_brute_force(spark):
    rng = random.Random(7)
    hosts = ["example.com", "www.example.com", "a.b.Example.COM", "notexample.com", "x.net", "net", "com", "example.com.net", "", "x..com", "org"]
    paths = ["", "/", "/en", "/en/", "/en/a?b=/es/", "/es/x#y", "?q=1", "#top", "/EN/", "//en/", "/é/ü"]
    rows = [(i, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(300)]
    rows += [(400, None), (401, ""), (402, "no scheme/en/"), (403, "://"), (404, "http://a.com/x://b.net/es/"), (None, "http://x.net/es/"), (3, rows[3][1])]
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in rows], "page_id bigint, url string, host string, key string")
    many = RULES + tuple((f"h{k}.org", "/a", "block") for k in range(300))
    for rules in (RULES, many, ()):
        got = urls.judge_urls(pages, rules).collect()
        assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *judge(u, rules)) for i, u in rows), key=key)
    assert urls.judge_urls(pages.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        urls.judge_urls(pages, (*RULES, ("com", "/", "block")))


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("hash(key) % 97 = 0")
    levels = urls.build_cascade(listed, universe, 20_000, 5)
    assert len(levels) >= 2
    wrong = universe.withColumn("said", urls.member(levels, F.col("key"))).where("said != (hash(key) % 97 = 0)")
    assert wrong.count() == 0


# --- HTML ---------------------------------------------------------------------------


def test_main_text_of_awkward_pages():
    tree = html.trained_tree()
    page = """<!DOCTYPE html><title>No</title><script>var a="<p>no</p>";</script><body><header><p>The site's name</p></header>
      <nav><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul></nav><div class="cookie-banner">We use cookies on this site, please accept them all.</div>
      <article><h1>A &amp; B</h1><p>First&nbsp;part,\n   with <b>bold</b> words&#33;<br>Same block.<!-- <p>no</p> --><p>Tiny.
      <style>p{}</style><div class=ad>Buy now, all of it must go before the end of the week!</div><ul><li>One item</ul><form><p>Your name please, then send</p></form>
      <section id="comments"><p>I liked this article a lot, thank you very much indeed!</p></section></article>
      <aside><p>Other stories that you may want to read today</p></aside><footer>&copy; all of us, always</footer>"""
    assert html.main_text(page, tree) == "A & B\nFirst part, with bold words! Same block.\nTiny.\nOne item"
    assert html.main_text(None, tree) == html.main_text("", tree) == html.main_text("<p>", tree) == ""
    plain = "<p>" + "A long enough paragraph of plain words stands here without any links. " * 3
    assert html.main_text(plain, tree) == " ".join(plain[3:].split())
    assert html.main_text("<article><p>cut off &am", tree) == "cut off &am"
    named = ('<body class="single has-sidebar"><div class="content-wrap with-sidebar"><div class="article-header"><h1>Title</h1></div>'
             '<p>Some words of the article itself.</p><div class="site-footer">All rights kept by all of us here.</div>'
             '<div id="reader-comments"><p>I think so too, and so do all my friends.</p></div></div>')
    assert html.main_text(named, tree) == "Title\nSome words of the article itself."
    assert "x" * 100_000 in html.main_text("<article><p>" + "x" * 100_000, tree)


def test_icons_formulas_and_objects_lose_no_text():
    tree = html.trained_tree()
    page = "<article><h1>Title</h1><p>Words before {} and words after it.</p><p>The last paragraph.</p></article>"
    for icon in ('<svg class="i" width="1"/>', "<svg/>", "<SVG />", "<svg><title/><style/><path d='M0'/><text>no</text></svg>", "<math/>",
                 "<svg><svg><g></g></svg><text>no</text></svg>", "<svg><foreignObject><div>no</div></foreignObject></svg>", "<a><svg><a>no</a></svg></a>"):
        assert html.main_text(page.format(icon), tree) == "Title\nWords before and words after it.\nThe last paragraph.", icon
        assert html.main_text(icon + page.format(""), tree) == "Title\nWords before and words after it.\nThe last paragraph.", icon
    assert html.main_text(page.format("<svg><path>"), tree) == "Title\nWords before\nThe last paragraph."  # an open svg ends with its paragraph
    formula = "<math><mrow><mi>x</mi><mo>+</mo><mspace/><mn>1</mn></mrow></math>"
    assert html.main_text(page.format(formula), tree) == "Title\nWords before x+1 and words after it.\nThe last paragraph."
    assert html.main_text(page.format("<object data=x>a picture</object>"), tree) == "Title\nWords before a picture and words after it.\nThe last paragraph."


def test_a_head_without_end_tag_ends_with_the_body():
    tree = html.trained_tree()
    body = "<h1>Title</h1><p>A paragraph that says what it has to say in enough plain words.</p><p>Short.</p>"
    for start in ("<html><head><meta charset=utf-8><title>No</title><body>", "<head><link rel=x><script>no</script>", "<head><title>No</title><body class=x><div>"):
        got = html.blocks_of(start + body)
        assert [f for _, f in got] == [f for _, f in html.blocks_of(body)] and got[0][0] == "Title"
        assert html.main_text(start + body, tree) == html.main_text(body, tree)
    assert [f[6] for _, f in html.blocks_of("<head><title>No</title>Bare words. <p>More.")] == [0.0, 0.0]


_PARAGRAPHS = ("<p>The river rose for three days and the bridge was closed to carts and riders until the water fell again on Sunday.</p>"
               "<p>Nobody was hurt.</p>")
_TEXT = _PARAGRAPHS.replace("</p><p>", "\n").replace("<p>", "").replace("</p>", "")
_WORDS = ("Short one.", "This is what I have to say about it all.", " ".join(f"word{i}" for i in range(25)) + ".")


@pytest.mark.parametrize("name", ["post-comments", "user-comment-box", "user-reviews", "disqus_thread", "google-ad", "cookie-policy-banner",
                                  "page-footer-legal-notice-x", "ad", "sidebar", "newsletter", "footer", "related-posts", "myBreadcrumbs"])
def test_named_boilerplate_goes_wherever_it_stands(name):
    tree = html.trained_tree()
    for words in _WORDS:
        for key in ("class", "id"):
            box = f"<div {key}={name}><p>{words}</p></div>"
            assert html.main_text(f"<article>{_PARAGRAPHS}{box}</article>", tree) == _TEXT
            assert html.main_text(f"<article>{_PARAGRAPHS}</article>{box}", tree) == _TEXT
            assert html.main_text(f"<h1>Flood</h1>{_PARAGRAPHS}{box}", tree) == f"Flood\n{_TEXT}"
            assert html.main_text(f"{box}<h1>Flood</h1>{_PARAGRAPHS}", tree) == f"Flood\n{_TEXT}"


@pytest.mark.parametrize("inside, text", [
    ("<h2><a>Short title</a></h2>", "Short title"), ("<h1>Flood</h1><p><a>Ann Lee</a></p>", "Flood\nAnn Lee"),
    ("<header><h1>Flood</h1><address>Ann Lee, on the coast</address></header>", "Flood\nAnn Lee, on the coast"),
    ("<ul><li><a>One source</a></li><li><a>Another source of it</a></li></ul>", "One source\nAnother source of it"),
    ("<p title=don't>One text.</p><p><a href=x\">Two</a> words</p>", "One text.\nTwo words")])
def test_links_and_short_blocks_of_an_article_stay(inside, text):
    assert html.main_text(f"<nav><a>Home</a></nav><article>{inside}{_PARAGRAPHS}</article>", html.trained_tree()) == f"{text}\n{_TEXT}"


def test_neighbours_decide_where_nothing_is_named():
    tree = html.trained_tree()
    menu, links = "<div><a>Home</a></div><div><a>About us</a></div><div><a>Write to us now</a></div>", "<div><a>Next</a></div><div><a>Older posts</a></div>"
    flood = f"<h1>Flood</h1>{_PARAGRAPHS}"
    assert html.main_text(menu + flood + links, tree) == f"Flood\n{_TEXT}"
    ad = "<div>Two coats for one, only this week in all our shops in town.</div>"
    assert html.main_text(f"<ul><li><a>Home</a><li><a>News</a></ul>{ad}{flood}", tree) == f"Flood\n{_TEXT}"
    remarks = "<div><a>Ben</a></div><div>So true.</div><div><a>Ann</a></div><div>I was there too.</div><div><a>Reply</a></div>"
    assert html.main_text(flood + remarks, tree) == f"Flood\n{_TEXT}"
    assert html.main_text(f"<h2><a>Short title</a></h2>{_PARAGRAPHS}", tree) == f"Short title\n{_TEXT}"
    assert html.main_text(f"<h1>Flood</h1><p><a>Ann Lee</a></p>{_PARAGRAPHS}", tree) == f"Flood\nAnn Lee\n{_TEXT}"
    for rights in ("Copyright 2020 by the valley press", "&copy; the valley press, all rights reserved", "All rights reserved."):
        assert html.main_text(f"{menu}<div>{flood}</div><div>{rights}</div>", tree) == f"Flood\n{_TEXT}"
        assert html.main_text(f"{menu}<div>{flood}</div><div><a>Terms</a></div><div>{rights}</div>", tree) == f"Flood\n{_TEXT}"
    state = f"<body class='has-sidebar no-ads'><div class='with-comments' data-class=ad>{_PARAGRAPHS}</div>"
    assert html.main_text(state, tree) == _TEXT


def test_the_tree_splits_on_the_neighbours():
    def used(t):
        return {html.FEATURES[t[0]]} | used(t[2]) | used(t[3]) if len(t) == 4 else set()

    assert {"words_before", "words_after", "link_density_before", "link_density"} <= used(html.trained_tree())


def test_broken_pages_are_read_in_linear_time():
    for make in (lambda n: "<div>" * n + "<b>y</i>" * n, lambda n: "<i>" + "<b>y</i>" * n + "<p><b>y</i>" * n, lambda n: "<svg>" + "<g></q>" * n,
                 lambda n: "<a href='" * n, lambda n: "<p>" * n + "</section>" * n):
        t = time.perf_counter()
        html.blocks_of(make(16_000))
        assert time.perf_counter() - t < 3


def brute_tokens(page: str) -> list[tuple[str, str]]:
    """Tags and text of markup without raw elements, comments or svg, character by character as the HTML standard reads it."""
    out, i, text = [], 0, ""
    while i < len(page):
        m = re.match(r"</?[a-zA-Z]", page[i:])
        if not m:
            text += page[i]
            i += 1
            continue
        if text:
            out.append(("text", text))
            text = ""
        j, quote, before = i + 1, "", ""
        while j < len(page) and (quote or page[j] != ">"):
            c = page[j]
            if quote:
                quote = "" if c == quote else quote
            elif c in "\"'" and before == "=" and page.find(c, j + 1) >= 0:
                quote = c
            before = before if c in " \t\n" and before == "=" else c
            j += 1
        out.append(("tag", page[i + 1 : j]))
        i = j + 1
    return out + ([("text", text)] if text else [])


def test_tokens_equal_a_reader_by_characters():
    rng = random.Random(12)
    parts = ["<p>", "</p>", "<a href=x>", '<a href="a>b">', "<b title='>'>", "<i title=don't>", '<a href=x">', "text ", "1 < 2 ", "a=\"b\" ", "<div class=x id='y'>", "</div >", "<br/>", "it's "]
    for _ in range(400):
        page = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        got, at = [], 0
        for m in html._TOKEN.finditer(page):
            if m.start() > at:
                got.append(("text", page[at : m.start()]))
            got.append(("tag", m[0][1:].removesuffix(">")))
            at = m.end()
        got += [("text", page[at:])] if at < len(page) else []
        assert got == brute_tokens(page), page


def test_tree_fits_its_labelled_table():
    x, y = html.labelled_blocks()
    assert [html.classify(html.trained_tree(), list(r)) for r in x] == [bool(v) for v in y]


def test_extract_text_rows(spark):
    rows = [(1, "u", "<article><p>Grüße aus &Ouml;sterreich</p></article>", 1), (2, None, None, 2), (None, "v", "", 3), (1, "u", "<article><p>Again</p>", 4)]
    got = html.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(
        [(1, "u", "Grüße aus Österreich", 20), (2, None, "", 0), (None, "v", "", 0), (1, "u", "Again", 5)], key=key)
    assert html.extract_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
