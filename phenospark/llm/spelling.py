"""Spelling variants: which words of a corpus differ by one inserted, deleted or
replaced character, found by PartEnum signatures of their letter multisets.

A word's letter multiset, written as a binary vector with one place per letter
and occurrence, changes in one place when a character is inserted or deleted and
in two when one is replaced. Letters are dealt into ``PARTS`` groups (by corpus
frequency, in turn), so a vector falls into as many parts, and a difference in d
places touches at most d parts: two words at distance d agree on some choice of
``PARTS - d`` whole parts. The signatures enumerate those choices, partitioned by
size: words of one length meet on ``PARTS - 2`` parts (distance two), words whose
lengths differ by one on ``PARTS - 1`` parts (distance one). Every signature
carries its lengths, its choice of parts, their letters, and one half of the word:
a single edit leaves the first or the last half as it is. So no near pair is
missed, whatever the words; the equi-join on signatures verifies each meeting by
edit distance inside the join, and only near pairs leave it.

Words are counted where they are read (partial sums before the exchange), long
texts in pieces that end with a word. Words are distinct, so a copied document or
a frequent word adds to counts, not to groups; signatures that many words share
are split by Spark's skew join (a sort-merge join on hashed signatures). Forms are
followed by pointer doubling: a form has at least ``RATIO`` times the occurrences,
so the number of rounds is bounded by the logarithm of the largest count.

Defined results: null or empty texts have no words; a null doc_id counts as empty
text in the planted-error rule; repeated rows count again; equal counts among near
words go to the smallest in code-point order; an empty table, or one without words
of ``LEAST_N`` occurrences, gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenospark.sinks import materialise

#: Fixed by the contract: runs of letters, the least length of a word and the least number of its occurrences.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_N = 6, 5
#: A form has at least so many times the occurrences of its variant.
RATIO = 5
#: One run in so many loses a code point (by the crc32 of its document and itself).
ERRORS = 199
#: Groups that the letters are dealt into.
PARTS = 4
#: Code points of a piece of text (a piece is longer by what its last word needs).
PIECE = 1 << 16


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_n: int = LEAST_N) -> DataFrame:
    """word, n: the corpus's words with their occurrences, after the error rule.

    A run that is too short stays too short, so only runs of ``least_length`` on are
    taken out of the text."""
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}[{LETTERS}]*"), F.lit(0))
    runs = F.regexp_extract_all("piece", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    found = (
        docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(pieces).alias("piece"))
        .select("id", F.explode(runs).alias("run"))
        .select("id", lower_ascii(F.col("run")).alias("run"))
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(h % ERRORS == 0, shorter).otherwise(F.col("run"))
    return (
        found.select(word.alias("word")).where(F.length("word") >= least_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)
    )


def letter_groups(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters of each group: dealt in turn from the most frequent on. What
    reaches the driver is one row per letter of the alphabet."""
    found = (
        words.select(F.explode(F.split("word", "")).alias("letter")).where("letter != ''")
        .groupBy("letter").count().collect()
    )
    ranked = [r["letter"] for r in sorted(found, key=lambda r: (-r["count"], r["letter"]))]
    return ["".join(ranked[i::parts]) for i in range(parts)]


def with_parts(words: DataFrame, groups: list[str]) -> DataFrame:
    """word, n, size, p0, p1, ...: each word's letters of each group, sorted."""
    letters = F.split("word", "")

    def part(group: str) -> Column:
        own = F.filter(letters, lambda c: (c != "") & (F.instr(F.lit(group), c) > 0))
        return F.array_join(F.array_sort(own), "")

    return words.select("word", "n", F.length("word").alias("size"), *[part(g).alias(f"p{i}") for i, g in enumerate(groups)])


def signatures(parted: DataFrame, parts: int = PARTS) -> DataFrame:
    """sig, word, n, size, other: a row for every signature of every word (with its
    parts). ``other``: whether it meets words of another length."""
    size = F.col("size")

    def entries(dropped: int, shorter: Column, half: Column, other: bool) -> list[Column]:
        """``shorter``: length of the shorter word of the pairs meant; ``half``: length of the half that stays."""
        out = []
        for drop in combinations(range(parts), dropped):
            kept = [F.col(f"p{i}") for i in range(parts) if i not in drop]
            choice = F.lit(".".join(map(str, drop)))
            for side, text in (("first", F.substring(F.col("word"), F.lit(1), half)), ("last", F.substring(F.col("word"), -half, half))):
                sig = F.xxhash64(shorter, F.lit(other), choice, F.lit(side), text, *kept)
                out.append(F.struct(sig.alias("sig"), F.lit(other).alias("other")))
        return out

    every = [
        *entries(2, size, F.floor(size / 2).cast("int"), False),
        *entries(1, size, F.ceil(size / 2).cast("int"), True),  # as the shorter word
        *entries(1, size - 1, F.ceil((size - 1) / 2).cast("int"), True),  # as the longer word
    ]
    return parted.select("word", "n", "size", F.inline(F.array(*every))).select("sig", "word", "n", "size", "other")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, na, b, nb: every pair of words (a before b) at edit distance one, once."""
    sigs = signatures(with_parts(words, letter_groups(words)))
    a = sigs.select("sig", F.col("word").alias("a"), F.col("n").alias("na"), F.col("size").alias("la"), "other")
    b = sigs.select("sig", F.col("word").alias("b"), F.col("n").alias("nb"), F.col("size").alias("lb"))
    meet = (
        (F.col("other") == (F.col("la") != F.col("lb"))) & (F.col("a") < F.col("b"))
        & (F.levenshtein("a", "b", 1) >= 0)
    )
    return (
        a.join(b.hint("merge"), "sig").where(meet)
        .groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"))
    )


def _roots(forms: DataFrame, rounds: int) -> DataFrame:
    """word, root of every word with a form (word, form): forms followed to the last."""
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialise(
            now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")
    return now


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id, text)."""
    words = materialise(word_counts(docs), "spelling_words")
    pairs = materialise(near_pairs(words), "spelling_pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("near")))
    nearest = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.m") >= RATIO * F.col("n")
    judged = materialise(
        words.join(nearest, "word", "left").select(
            "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, -F.col("best.m")).alias("form_n")),
        "spelling_forms")
    most = words.agg(F.max("n")).first()[0] or 0
    # A chain of forms has at most this many steps, since every step multiplies n; each round doubles the steps taken.
    steps = math.log(max(most, RATIO) / LEAST_N) / math.log(RATIO) + 1
    roots = _roots(judged.where("form is not null"), max(0, math.ceil(math.log2(max(1.0, steps)))))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
