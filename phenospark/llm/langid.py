"""Language identification by a byte convolutional network, trained in numpy.

The network reads windows of ``WINDOW`` bytes (A-Z as a-z): filters of widths 2,
3 and 4 over the bytes, each filter's largest response in the window (max
pooling, then ReLU) and a softmax over the learned languages. A filter of width
w is w tables of 256 byte weights, so a response is a sum of table look-ups;
for whole texts the tables of neighbouring bytes are added up beforehand (one
look-up for two bytes).

Training takes a bounded sample of the labelled rows (about ``per_language``
different rows of each language, chosen by a hash of id and text, and ``SAMPLE_CHARS``
characters of each) to the driver; the languages and their counts come from all
labelled rows. Prediction uses the whole text: it is cut into consecutive
windows (the last one ends with the text), their log-probabilities are averaged,
and the largest class wins.

To tell texts in none of its languages, ``train(..., reject=True)`` adds a class of
its own, learned from noise made of the training windows: their characters shuffled,
words of random letters, digits and signs, and words of other scripts (random
neighbourhoods of code points). It takes no part in a text's language and score
(those are the languages' shares among themselves); ``known_language`` drops a text
when every one of its windows belongs to it.

Defined results: a text that is null or has no letter is ``und`` with score 0;
without any labelled row every text is ``und``; equally likely classes go to the
first in alphabetical order; a text shorter than a window is padded with spaces;
repeated rows are judged alike; an empty table gives an empty result; further
columns are ignored (``identify``) or kept (``known_language``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.llm.common import pieces

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bound of the training sample: rows of each language, and characters of a row.
PER_LANGUAGE = 800
SAMPLE_CHARS = 1024

_LETTER = re.compile(r"[^\W\d_]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Lower-cased bytes that are a letter, or part of a character beyond ASCII.
_LETTER_BYTE = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
#: Windows handled at once.
_BATCH = 1024


class Network:
    """Byte tables per width and offset (``conv[w][k]``: 256 x FILTERS), biases and the softmax layer."""

    def __init__(self, languages: list[str], seed: int = 1, reject: bool = False):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.classes = len(languages) + reject  # the last one is noise
        self.conv = {w: [rng.normal(0, 0.3, (256, FILTERS)).astype(np.float32) for _ in range(w)] for w in WIDTHS}
        n = FILTERS * len(WIDTHS)
        self.bias = np.zeros(n, dtype=np.float32)
        self.out = rng.normal(0, 0.1, (n, self.classes)).astype(np.float32)
        self.out_bias = np.zeros(self.classes, dtype=np.float32)

    # training ------------------------------------------------------------------

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pooled responses, their places) of windows (rows of bytes)."""
        pooled, places = [], []
        for w in WIDTHS:
            m = x.shape[1] - w + 1
            r = self.conv[w][0][x[:, :m]]
            for k in range(1, w):
                r += self.conv[w][k][x[:, k : k + m]]
            at = r.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(r, at[:, None, :], axis=1)[:, 0, :])
        return np.concatenate(pooled, axis=1) + self.bias, np.concatenate(places, axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 1200, batch: int = 48, rate: float = 0.01, seed: int = 2) -> None:
        """Adam on the cross entropy; ``x``: windows, ``y``: class numbers. Classes are drawn evenly."""
        rng = np.random.default_rng(seed)
        members = [np.flatnonzero(y == c) for c in range(self.classes)]
        members = [m for m in members if len(m)]
        params = [t for w in WIDTHS for t in self.conv[w]] + [self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            rows = np.array([rng.choice(members[c]) for c in rng.integers(0, len(members), batch)])
            xb, yb = x[rows], y[rows]
            pooled, places = self._forward(xb)
            hidden = np.maximum(pooled, 0)
            logits = hidden @ self.out + self.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(batch), yb] -= 1
            p /= batch
            back = (p @ self.out.T) * (pooled > 0)
            grads: list[np.ndarray] = []
            row = np.arange(batch)[:, None]
            col = np.arange(FILTERS)[None, :]
            for i, w in enumerate(WIDTHS):
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                for k in range(w):
                    g = np.zeros((256, FILTERS), dtype=np.float32)
                    np.add.at(g, (xb[row, places[:, own] + k], np.broadcast_to(col, (batch, FILTERS))), back[:, own])
                    grads.append(g)
            grads += [back.sum(axis=0), hidden.T @ p + 1e-4 * self.out, p.sum(axis=0)]
            now = rate * (1 - step / (steps + 1))
            for q, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    # prediction ----------------------------------------------------------------

    def pair_tables(self) -> dict[int, list[np.ndarray]]:
        """The look-up tables of two neighbouring bytes (65,536 x FILTERS), and of a last single one."""
        out = {}
        for w in WIDTHS:
            out[w] = [
                (self.conv[w][k][:, None, :] + self.conv[w][k + 1][None, :, :]).reshape(65536, FILTERS)
                if k + 1 < w else self.conv[w][k]
                for k in range(0, w, 2)
            ]
        return out

    def log_probabilities(self, x: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w in WIDTHS:
            m = x.shape[1] - w + 1
            r = None
            for i, t in enumerate(tables[w]):
                k = 2 * i
                part = t[pair[:, k : k + m]] if len(t) == 65536 else t[x[:, k : k + m]]
                r = part if r is None else np.add(r, part, out=r)
            pooled.append(r.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        logits = hidden @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def windows_of(text: bytes) -> np.ndarray:
    """Every window of a text, the last one ending with it."""
    data = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    if len(data) < WINDOW:
        data = np.concatenate((data, np.full(WINDOW - len(data), 32, dtype=np.uint8)))
    whole = data[: len(data) // WINDOW * WINDOW].reshape(-1, WINDOW)
    return whole if len(data) % WINDOW == 0 else np.concatenate((whole, data[None, -WINDOW:]))


#: Kinds of noise that the reject class is learned from, and signs that words of any text may carry.
_SIGNS = "0123456789%$#*&@!?.,:;-_=+/()[]{}<>|~^"


def noise(text: str, rng: np.random.Generator) -> str:
    """Text in no language, with about the length of ``text``."""
    kind = int(rng.integers(0, 4))
    if kind == 0:  # its own characters, shuffled
        return "".join(rng.permutation(list(text)))
    if kind == 1:  # words of random letters
        letters = [chr(97 + int(c)) for c in rng.integers(0, 26, len(text))]
    elif kind == 2:  # digits and signs, now and then a letter
        letters = [_SIGNS[int(c)] if c < len(_SIGNS) else chr(97 + int(c) % 26) for c in rng.integers(0, len(_SIGNS) + int(rng.integers(1, 30)), len(text))]
    else:  # words of another script: code points of one neighbourhood
        base = int(rng.choice([0x370, 0x400, 0x530, 0x590, 0x620, 0x900, 0xE00, 0x10A0, 0x3040, 0xAC00, int(rng.integers(0x4E00, 0x9F00))]))
        letters = [chr(base + int(c)) for c in rng.integers(0, 96, max(1, len(text) // 2))]
        letters = [c if c.isalpha() else chr(base + 33) for c in letters]
    length = int(rng.integers(2, 12))
    for i in range(length, len(letters), length + 1):
        letters[i] = " "
    return "".join(letters)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, steps: int = 1200, reject: bool = False) -> Network | None:
    """A network for the languages of ``docs`` (doc_id, text, lang), with a class for
    texts in none of them if ``reject``; None without labelled rows."""
    labelled = docs.select("doc_id", "text", "lang").where("lang is not null and length(text) > 0")
    # One row per language comes back: the number of its different rows, about (the bound of the sample is met as nearly).
    different = F.approx_count_distinct(F.xxhash64("doc_id", "text"), 0.02)
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(different.alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(per_language / max(1, n))).otherwise(share)
    # By id and text: rows without an id are drawn by themselves, and copies of a row, drawn together, come as one.
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(6)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    rows = (
        labelled.where(draw < share)
        .select("lang", "doc_id", F.substr(F.col("text"), place, F.lit(SAMPLE_CHARS)).alias("text"))
        .distinct().collect()
    )
    rows.sort(key=lambda r: (str(r["doc_id"]), r["lang"], r["text"]))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return None
    x, y = [], []
    rng = np.random.default_rng(5)
    for r in rows:
        if not _LETTER.search(r["text"]):
            continue
        for w in windows_of(r["text"].encode()):
            x.append(w)
            y.append(languages.index(r["lang"]))
            if rng.random() < 0.5:  # short texts are learned too: part of the window, padded
                n = int(rng.integers(12, WINDOW))
                short = np.full(WINDOW, 32, dtype=np.uint8)
                short[:n] = w[:n]
                x.append(short)
                y.append(languages.index(r["lang"]))
    if not x:
        return None
    if reject:
        for r in rows:
            n = int(rng.integers(2, WINDOW))  # of any length: a few letters are the hardest to tell
            for text in (r["text"][:WINDOW], r["text"][:n]):
                x.append(windows_of(noise(text, rng).encode()[:WINDOW].ljust(WINDOW))[0])
                y.append(len(languages))
            if _LETTER.search(r["text"]):  # a text with noise in it, up to a half, is still in its language
                cut, n = sorted(rng.integers(0, WINDOW // 2, 2).tolist())
                mixed = r["text"][:cut] + noise(r["text"][cut:n] or "-", rng) + r["text"][cut : cut + WINDOW - n]
                x.append(windows_of(mixed.encode()[:WINDOW].ljust(WINDOW))[0])
                y.append(languages.index(r["lang"]))
    net = Network(languages, reject=reject)
    net.fit(np.stack(x), np.array(y), steps)
    return net


def judge(texts: list[str | None], net: Network | None, tables: dict[int, list[np.ndarray]] | None) -> list[tuple[str, float, float]]:
    """(language, score, the languages' share in the window with letters where it is
    largest: 1 without a reject class) of whole texts; windows of several texts go
    through the network together."""
    out: list[tuple[str, float, float]] = [(UNKNOWN, 0.0, 0.0)] * len(texts)
    if net is None:
        return out
    total = np.zeros((len(texts), net.classes))
    peak = np.full(len(texts), -np.inf)
    count = np.zeros(len(texts), dtype=np.int64)
    waiting: list[np.ndarray] = []
    owner: list[int] = []

    def flush() -> None:
        x, of = np.concatenate(waiting), np.repeat(owner, [len(w) for w in waiting])
        for i in range(0, len(x), _BATCH):
            logp = net.log_probabilities(x[i : i + _BATCH], tables)
            np.add.at(total, of[i : i + _BATCH], logp)
            letters = _LETTER_BYTE[x[i : i + _BATCH]].any(axis=1)
            known = np.exp(logp[letters, : len(net.languages)]).sum(axis=1)
            np.maximum.at(peak, of[i : i + _BATCH][letters], known)
        waiting.clear()
        owner.clear()

    ready = 0
    for i, text in enumerate(texts):
        if text and _LETTER.search(text):
            w = windows_of(text.encode())
            count[i] = len(w)
            waiting.append(w)
            owner.append(i)
            ready += len(w)
            if ready >= _BATCH:
                flush()
                ready = 0
    if waiting:
        flush()
    for i in np.flatnonzero(count):
        mean = total[i, : len(net.languages)] / count[i]
        p = np.exp(mean - mean.max())
        p /= p.sum()
        best = int(p.argmax())
        out[i] = (net.languages[best], float(p[best]), float(max(0.0, peak[i])))
    return out


def predict(texts: list[str | None], net: Network | None, tables: dict[int, list[np.ndarray]] | None) -> list[tuple[str, float]]:
    """(language, score) of whole texts."""
    return [(lang, score) for lang, score, _ in judge(texts, net, tables)]


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs`` (doc_id, text); no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else None
        for batch in pieces(batches, 1):
            found = predict(batch.column(1).to_pylist(), net, tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def known_language(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The rows of ``docs`` (all columns) in whose text a learned language is
    recognised: in one of its windows at least, the languages have a share of
    ``least`` against the reject class. Windows need not agree on the language, so a
    text in several stays; without a reject class every text with a letter does."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else None
        for batch in pieces(batches, at):
            found = judge(batch.column(at).to_pylist(), net, tables)
            yield batch.filter(pa.array([lang != UNKNOWN and known >= least for lang, _, known in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
