"""Toxicity scores: maximum-scoring segments over token log-odds, judged by
extreme-value statistics.

Tokens are the runs of letters of the lower-cased text. Training counts, for
every word, in how many labelled texts and in how many toxic ones it stands
(equal texts count once), and the same for the word's prefixes of 3 to 8
letters, so that inflected forms share what is known of their stem. A node (a
prefix, or a whole word) has the log-odds of toxic against clean texts under a
Dirichlet prior with the corpus' own share; nodes that stand out by ``Z_LEAST``
standard deviations with log-odds of at least ``ODDS_LEAST`` are marked. They
form the lexicon, together with the nodes below them that turn out plain. A word
scores as its longest node in the lexicon, if that is marked; any other word has
the slightly negative score of a toxic passage's plain words.

A linear-time scan (Ruzzo and Tompa) then finds all maximal-scoring segments of
a text's word scores. With the decay rate lambda for which clean words' scores
have a mean exponential of one, a segment of score s in a text of n words has
the expected number of chance equals E = K n exp(-lambda s) (Karlin and
Altschul). A text's evidence is the sum of -ln E over its significant segments
(E below ``SIGNIFICANT``), or its best segment's -ln E; a logistic curve,
fitted on the labelled texts' histogram of it, turns it into the score.

The lexicon has every such node. Up to ``MAX_NODES`` nodes it goes to every task;
a larger one stays a table, the distinct words of each block of texts are looked
up in it by joins, and a block gets the scores of its own words. Both ways give
the same scores. Counts cover all training rows; they are summed in Spark with
partial aggregates, and the driver sees a lexicon up to that size and two
histograms.

Defined results: a null or empty text has no segment and gets the score of a text
of no evidence; a doc_id with several labels is toxic if one of them says so;
without labelled rows of both kinds all scores are 0; a null doc_id is never
learned from; repeated rows are scored alike; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenospark.llm.blocks import each, finish, pack_bytes, store_blocks, unpack_bytes
from phenospark.llm.common import BLOCK_BYTES, pieces
from phenospark.sinks import materialise

PREFIXES = range(3, 9)
PRIOR = 4.0
Z_LEAST = 3.5
#: Least log-odds of a marked node (20 times as likely in toxic texts): a long text has many weaker ones by chance.
ODDS_LEAST = 3.0
#: Log-odds under which a node is plain though its stem is marked.
ODDS_PLAIN = 0.5
#: Least number of toxic texts that a node of the lexicon stands in.
TEXTS_LEAST = 3
#: Largest lexicon that goes to the tasks as a whole; a larger one is joined.
MAX_NODES = 1 << 17
#: Share of marked words expected inside a toxic passage: ln(1 - share) is the score of its other words.
PASSAGE_SHARE = 0.08
SIGNIFICANT = 0.05
PREDICT_AT = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_OTHER = math.log(1 - PASSAGE_SHARE)


def count_words(labelled: DataFrame) -> DataFrame:
    """word, toxic, texts: over the rows of ``labelled`` (text, toxic 0/1), in how
    many (toxic) texts each word stands; each task adds up its rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, 4 * BLOCK_BYTES):
            seen: Counter[str] = Counter()
            bad: Counter[str] = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_WORD.findall((text or "").lower()))
                seen.update(words)
                if toxic:
                    bad.update(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([bad[w] for w in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "toxic", "texts"])

    return (
        labelled.select("text", "toxic").mapInArrow(run, "word string, toxic bigint, texts bigint")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts"))
    )


def _nodes_of_word() -> Column:
    """The nodes of ``word``, the longest last: its prefixes and the whole word (marked by a final ``$``)."""
    prefix = F.transform(
        F.filter(F.array(*map(F.lit, PREFIXES)), lambda n: n <= F.length("word")), lambda n: F.substr(F.col("word"), F.lit(1), n))
    return F.concat(prefix, F.array(F.concat("word", F.lit("$"))))


def nodes(words: DataFrame) -> DataFrame:
    """node, toxic, texts: the words (marked by a final ``$``) and their prefixes."""
    return (
        words.select(F.explode(_nodes_of_word()).alias("node"), "toxic", "texts")
        .groupBy("node").agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts"))
    )


def marked_words(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """word, score of the distinct words of ``words`` whose longest node in ``lexicon`` (node, odds) is marked."""
    return (
        words.select("word").distinct().select("word", F.posexplode(_nodes_of_word()).alias("place", "node"))
        .join(lexicon, "node").groupBy("word").agg(F.max_by("odds", "place").alias("score")).where("score > 0")
    )


def _evidence(share: float) -> tuple[Column, Column]:
    """(log-odds against the corpus' share, its z) of a node under the Dirichlet prior."""
    t = F.col("toxic") + F.lit(PRIOR * share)
    c = F.col("texts") - F.col("toxic") + F.lit(PRIOR * (1 - share))
    odds = F.log(t / c) - F.lit(math.log(share / (1 - share)))
    return odds, odds / F.sqrt(1 / t + 1 / c)


class Model:
    """The lexicon (node: log-odds, 0 if plain; or the ``table`` of it, node, odds),
    and the decay rate and K of the extreme-value law."""

    def __init__(self, lexicon: dict[str, float], table: DataFrame | None = None):
        self.lexicon = lexicon
        self.table = table
        self.decay, self.k = 1.0, 1e-6
        self._known: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": {}, "table": None}

    def of_words(self, scores: dict[str, float]) -> Model:
        """The model of texts whose marked words and their scores are given."""
        own = Model({word + "$": score for word, score in scores.items()})
        own.decay, own.k = self.decay, self.k
        return own

    def word_score(self, word: str) -> float:
        score = self._known.get(word)
        if score is None:
            score = self.lexicon.get(word + "$")
            for n in range(min(len(word), PREFIXES[-1]), PREFIXES[0] - 1, -1):
                if score is not None:
                    break
                score = self.lexicon.get(word[:n])
            score = score or _OTHER
            if len(self._known) >= 200_000:  # a task's memory of words is bounded
                self._known.clear()
            self._known[word] = score
        return score

    def text_evidence(self, text: str | None) -> float:
        """Sum of -ln E over the significant segments, or the best segment's -ln E."""
        n = 0

        def scores() -> Iterator[float]:  # word by word, so a long text isn't listed whole
            nonlocal n
            for m in _WORD.finditer((text or "").lower()):
                n += 1
                yield self.word_score(m[0])

        best = segments(scores())
        base = -math.log(self.k * max(n, 1))
        found = [base + self.decay * s for _, _, s in best]
        strong = [x for x in found if x > -math.log(SIGNIFICANT)]
        return sum(strong) if strong else max(found, default=base)


def segments(scores: Iterable[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a sequence, in order.

    Runs of negative scores only add to the running total, so the work on the
    stack is in the positive ones."""
    total = 0.0
    stack: list[tuple[int, int, float, float, int]] = []  # first, end, total before, total after, nearest entry with a lower total before
    for i, s in enumerate(scores):
        before = total
        total += s
        if s <= 0:
            continue
        first, left, end = i, before, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                stack.append((first, end, left, total, j))
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def _decay(scores: np.ndarray, weight: np.ndarray) -> float:
    """The rate at which the scores' exponentials have a weighted mean of one."""
    weight = weight / weight.sum()
    if scores.max() <= 0 or scores @ weight >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while weight @ np.exp(np.minimum(high * scores, 700)) < 1:
        low, high = high, 2 * high
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if weight @ np.exp(np.minimum(mid * scores, 700)) < 1 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) by penalised Newton steps; the slope is kept positive."""
    mean, spread = np.average(x, weights=weight), 10.0
    z = (x - mean) / spread
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        g = np.array([(weight * (p - y)) @ z + 0.1 * a, (weight * (p - y)).sum() + 1e-3 * b])
        w = weight * p * (1 - p)
        h = np.array([[w @ (z * z) + 0.1, w @ z], [w @ z, w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a / spread, b - a * mean / spread


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the rows of ``docs`` that have a label; of equal texts one row."""
    said = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    known = docs.where("doc_id is not null").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    first = known.join(said, "doc_id").groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).drop("h")
    return docs.select("doc_id", "text").join(first.hint("shuffle_hash"), "doc_id")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The lexicon and its extreme-value law, from all labelled rows of ``docs``
    (doc_id, text) and ``labels`` (doc_id, toxic 0/1); the curve is fitted later."""
    words = materialise(count_words(labelled_texts(docs, labels)), "tox_words")
    seen = words.agg(F.sum("toxic"), F.sum("texts")).first()
    if not seen[0] or seen[0] == seen[1]:
        return Model({})
    share = seen[0] / seen[1]
    tree = materialise(nodes(words), "tox_nodes")
    odds, z = _evidence(share)
    marked = tree.select("node", "toxic", "texts", odds.alias("odds"), z.alias("z"))
    high = materialise(
        marked.where((F.col("z") >= Z_LEAST) & (F.col("odds") >= ODDS_LEAST) & (F.col("toxic") >= TEXTS_LEAST)).select("node", "odds"),
        "tox_marked")
    # what stands below a marked stem without being marked itself may be plain
    above = F.expr("explode(transform(sequence(3, greatest(3, least(8, length(node) - 1))), n -> substr(node, 1, n)))")
    stems = high.where(~F.col("node").endswith("$")).select(F.col("node").alias("above"))
    below = (
        marked.where((F.col("texts") >= TEXTS_LEAST) & (
            (F.col("odds") < ODDS_PLAIN) | ((F.col("odds") < ODDS_LEAST) & (F.col("z") >= Z_LEAST))))
        .select("node", above.alias("above"))
        .join(F.broadcast(stems) if stems.count() <= MAX_NODES else stems, "above", "left_semi").select("node").distinct()
    )
    lexicon = materialise(high.unionAll(below.select("node", F.lit(0.0).alias("odds"))), "tox_lexicon")
    if lexicon.count() <= MAX_NODES:
        model = Model({r["node"]: r["odds"] for r in lexicon.collect()})
        counts = words.select("word", (F.col("texts") - F.col("toxic")).alias("n"), F.lit(None).cast("double").alias("score"))
    else:
        model = Model({}, lexicon)
        counts = words.select("word", (F.col("texts") - F.col("toxic")).alias("n")).join(
            marked_words(words, lexicon), "word", "left").select("word", "n", F.coalesce("score", F.lit(_OTHER)).alias("score"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            s = [round(model.word_score(w) if known is None else known, 1) for w, known in given]
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.float64()), batch.column(1)], names=["s", "n"])

    clean = (
        counts.mapInArrow(score, "s double, n bigint")
        .groupBy("s").agg(F.sum("n").alias("n")).collect()
    )
    s = np.array([r["s"] for r in clean])
    n = np.array([float(r["n"]) for r in clean]) + np.where(s > 0, 0.5, 0.0)
    s = np.where(s <= 0, _OTHER, s)
    model.decay = _decay(s, n)
    model.k = max(float(n[s > 0].sum() / n.sum()), 1e-9) if (s > 0).any() else 1e-9
    return model


def evidence(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, evidence for every row of ``docs`` (doc_id, text); no shuffle of texts."""
    if model.table is not None:
        return _evidence_of_blocks(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            found = [model.text_evidence(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "evidence"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, evidence double")


def _evidence_of_blocks(docs: DataFrame, model: Model) -> DataFrame:
    """``evidence`` with a lexicon that stays a table: each block is scored with its own marked words."""
    blocks = store_blocks(docs, "tox", lambda ids, texts: {"texts": pack_bytes([t.encode() for t in texts])}, "texts binary")

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in each(batch):
                words = list({w for t in unpack_bytes(block["texts"]) for w in _WORD.findall(t.decode().lower())})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block["grp"]] * len(words), pa.int32()), pa.array([block["block"]] * len(words), pa.int64()),
                     pa.array(words, pa.string())], names=["grp", "block", "word"])

    words = materialise(blocks.select("grp", "block", "texts").mapInArrow(words_of, "grp int, block bigint, word string"), "tox_block_words")
    replies = words.join(marked_words(words, model.table), "word")

    def work(block: dict, own: list[dict]) -> Iterator[tuple]:
        known = model.of_words({r["word"]: r["score"] for r in own})
        for doc_id, text in zip(block["ids"], unpack_bytes(block["texts"])):
            yield doc_id, known.text_evidence(text.decode())

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("evidence", T.DoubleType())])
    return finish(blocks, ["ids", "texts"], replies, work, schema)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id,
    text). ``held_out`` (of doc_id) marks the rows whose labels are never read."""
    model = train(docs.where(~held_out), labels)
    if not model.lexicon and model.table is None:
        return docs.select("doc_id", held_out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    rows = materialise(evidence(docs, model).withColumn("held_out", held_out), "tox_evidence")
    said = labels.where("toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    bins = (
        rows.where(~F.col("held_out")).join(said, "doc_id")
        .groupBy((F.round(F.least(F.greatest("evidence", F.lit(-30.0)), F.lit(120.0)) * 2) / 2).alias("x"))
        .agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).collect()
    )
    x = np.array([r["x"] for r in bins])
    bad, n = np.array([float(r["bad"]) for r in bins]), np.array([float(r["n"]) for r in bins])
    if not len(x) or not bad.sum() or bad.sum() == n.sum():
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    slope, offset = _logistic(x, bad / n, n)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("evidence") + F.lit(offset))))
    return rows.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0))
