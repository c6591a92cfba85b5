"""Scoring texts by a weighted backoff automaton of smoothed word n-grams.

The training texts' n-gram counts make an automaton: a state for every known
history of up to ``order - 1`` tokens; an arc for every n-gram seen after that
history, whose weight is the log-probability of its last token; and from every
state a failure arc to the state of the history without its oldest token, whose
weight is the log of the mass left over. Reading a text from left to right, a
token takes its arc, or failure arcs until there is one; the weights add up to
the text's log10 probability. Histories are smoothed by a Dirichlet prior around
the next shorter history, p(w|h) = (c(hw) + a p(w|h')) / (c(h) + a), so the
failure weight is a / (c(h) + a); the state without history gives seen tokens
(c - d) / N and all unseen ones together d V / N (absolute discounting, d from
the numbers of tokens seen once and twice). Probabilities of a state sum to one.

The automaton grows with the corpus and is never held whole: each block of
documents asks for the counts of its own distinct n-grams (blocks.py), which
are exactly the states and arcs that its texts can touch. From the answers the block
builds that piece of the automaton (:class:`Automaton`: states, arcs, failure arcs
and their weights) and reads its texts on it, token by token, carrying the state.
Texts are read side by side, long ones in stretches of ``LANE`` tokens: a state is
fixed by the last ``order - 1`` tokens, so a stretch takes its first state by reading
those before it. Counts cover all training texts (64-bit numbers). N-grams are
told apart by hashes: tokens by 64 bits (two of a billion share one with a chance
of a few per cent), longer n-grams by 56 (of five billion, one in ten million
meets another).

Defined results: null and empty texts consist of the end token; a null doc_id
is not held out; without training texts every token is unseen and has
probability 1; a text of any length is read whole; repeated rows count and
score each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenospark.llm.blocks import (
    ask, finish, pack, pack_bytes, pack_sorted, part_bounds, part_count, store_blocks, unpack, unpack_bytes, unpack_sorted,
)
from phenospark.llm.common import Block, gram_hashes, in_fold
from phenospark.sinks import materialise

#: Longest n-gram, and the weight of the shorter history in tokens, for histories of 1, 2, ... tokens.
ORDER = 3
PRIOR = (30.0, 4.0)
#: Bits of a longer n-gram's hash that count.
_KEPT = np.uint64(2**64 - 2**8)
#: Text of a block, and text whose n-grams one part should get.
_BLOCK_BYTES, _PART_BYTES = 4 << 20, 8 << 20
#: Tokens that a reader takes in one go; more readers stand side by side.
LANE = 128
_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def pack_texts(ids: list, texts: list[str]) -> dict:
    raw = [t.encode() for t in texts]
    return {"sizes": [len(t) for t in raw], "packed": zstandard.compress(b"".join(raw), 3)}


def unpack_texts(block: dict) -> list[bytes]:
    raw = zstandard.decompress(block["packed"])
    ends = np.cumsum(np.array(block["sizes"], dtype=np.int64)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def add_up(number: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``counts`` by number, in 64-bit whole numbers (exact up to 2^53)."""
    return np.bincount(number, weights=counts, minlength=n).astype(np.uint64)


class _Grams:
    """The tokens of a block: one row of start, words and end per text."""

    def __init__(self, texts: list[bytes]):
        scan = Block(texts, lower=True)
        words = np.diff(scan.first)
        self.begin = np.concatenate(([0], np.cumsum(words + 2)))  # of each text's row
        row = np.empty(self.begin[-1], dtype=np.uint64)
        self.is_start = np.zeros(len(row), dtype=bool)
        self.is_start[self.begin[:-1]] = True
        is_end = np.zeros(len(row), dtype=bool)
        is_end[self.begin[1:] - 1] = True
        row[self.is_start], row[is_end], row[~(self.is_start | is_end)] = _START, _END, scan.hash
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), words + 2)
        self.row = row

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the n-grams: the sorted distinct keys, each n-gram's number among them, and the place of its last token."""
        last = np.arange(n - 1, len(self.row), dtype=np.int32)
        last = last[self.text[last] == self.text[last - n + 1]] if n > 1 else last[~self.is_start]
        hashes = gram_hashes(self.row, n)[last - n + 1]
        if n > 1:
            hashes &= _KEPT
        keys, number = np.unique(hashes, return_inverse=True)
        return keys, number.astype(np.int32), last


class Automaton:
    """The states and arcs that a block's texts can touch.

    ``count[n - 1]`` are the training counts of the block's distinct n-grams, ``gram[n -
    1]`` has the number of the n-gram that ends at each place of the row (-1: none).
    State 0 has no history; the others are the known histories, numbered by length: the
    start (as a history of one), then the seen n-grams of 1 .. order - 1 tokens. An arc
    is a seen n-gram: it leaves its history's state and is found there by its number."""

    def __init__(self, grams: _Grams, count: list[np.ndarray], gram: list[np.ndarray], starts: float,
                 prior: Sequence[float], n_train: int, v: int, discount: float):
        self.order, self.grams, self.gram, self.count = len(count), grams, gram, count
        place = []  # of one occurrence of each distinct n-gram
        for c, g in zip(count, gram):
            at = np.zeros(len(c), dtype=np.int64)
            there = np.flatnonzero(g >= 0)
            at[g[there]] = there
            place.append(at)
        # States: the number of a seen n-gram's own state, 0 for one that was not seen.
        self.state, n_states = [], 2
        for n in range(1, self.order):
            seen = count[n - 1] > 0
            self.state.append(np.where(seen, n_states + np.cumsum(seen) - 1, 0))
            n_states += int(seen.sum())
        self.start = 1 if self.order > 1 and starts > 0 else 0
        self.length = np.zeros(n_states, dtype=np.int8)  # of a state's history
        self.fail = np.zeros(n_states, dtype=np.int64)
        self.fail_weight = np.zeros(n_states)
        mass = np.zeros(n_states)  # c(h)
        self.length[1], mass[1] = 1, starts
        for n in range(1, self.order):
            own = self.state[n - 1]
            seen = own > 0
            self.length[own[seen]], mass[own[seen]] = n, count[n - 1][seen]
            if n > 1:  # without its oldest token: the shorter n-gram that ends at the same place
                self.fail[own[seen]] = self.state[n - 2][gram[n - 2][place[n - 1][seen]]]
        has = self.length > 0
        weight = np.array([0.0, *prior])[self.length[has]]
        self.fail_weight[has] = np.log10(weight / (mass[has] + weight))
        # Arcs: probability of the last token, and the state that it leads to.
        seen = count[0] > 0
        p = np.where(seen, count[0] - discount, discount * v) / n_train if n_train else np.ones(len(count[0]))
        self.arc_weight, self.next = [np.log10(p)], [self.state[0] if self.order > 1 else np.zeros(len(p), dtype=np.int64)]
        for n in range(2, self.order + 1):
            at, a = place[n - 1], prior[n - 2]
            history = self._state_before(at, n - 1)
            p = (count[n - 1] + a * p[gram[n - 2][at]]) / (mass[history] + a)
            self.arc_weight.append(np.log10(p))
            self.next.append(self.state[n - 1] if n < self.order else self.state[n - 2][gram[n - 2][at]])

    def _state_before(self, at: np.ndarray, n: int) -> np.ndarray:
        """The state of the ``n`` tokens before each place (0 where they are unknown)."""
        number = self.gram[n - 1][at - 1]
        found = np.where(number >= 0, self.state[n - 1][np.maximum(number, 0)], 0)
        return np.where(self.grams.is_start[at - 1], self.start, found) if n == 1 else found

    def step(self, state: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, weight) of readers in ``state`` that take the token at ``at``:
        its arc, or failure arcs until there is one. State 0 has an arc for every token."""
        state, weight = state.copy(), np.zeros(len(at))
        todo = np.arange(len(at))
        while len(todo):
            length = self.length[state[todo]]
            rest = []
            for n in range(self.order):
                own = todo[length == n]
                if not len(own):
                    continue
                arc = self.gram[n][at[own]]
                taken = (self.count[n][arc] > 0) & (arc >= 0) if n else np.ones(len(own), bool)
                arc, go = arc[taken], own[taken]
                weight[go] += self.arc_weight[n][arc]
                state[go] = self.next[n][arc]
                back = own[~taken]
                weight[back] += self.fail_weight[state[back]]
                state[back] = self.fail[state[back]]
                rest.append(back)
            todo = np.concatenate(rest)
        return state, weight

    def read(self) -> np.ndarray:
        """The weight of every place of the row (0 at starts), read from left to right."""
        weight = np.zeros(len(self.grams.row))
        first, last = self.grams.begin[:-1] + 1, self.grams.begin[1:]
        pieces = -(-(last - first) // LANE)
        text = np.repeat(np.arange(len(first)), pieces)
        piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[text] + piece * LANE
        end = np.minimum(begin + LANE, last[text])
        warm = np.maximum(first[text], begin - (self.order - 1))  # a reader of a later stretch takes the tokens before it first
        state = np.where(warm == first[text], self.start, 0)
        for k in range(LANE + self.order - 1):
            at = warm + k
            on = np.flatnonzero(at < end)
            if not len(on):
                break
            state[on], w = self.step(state[on], at[on])
            own = at[on] >= begin[on]
            weight[at[on][own]] = w[own]
        return weight


def score_texts(docs: DataFrame, parts_of_fold: int, held_part: int, order: int = ORDER, prior: Sequence[float] = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for
    every row of ``docs`` (doc_id, text). Texts whose crc32(doc_id) mod
    ``parts_of_fold`` is ``held_part`` are scored but not learned from."""
    blocks = store_blocks(docs, "lm", pack_texts, "sizes array<int>, packed binary", _BLOCK_BYTES)
    parts = part_count(blocks, _PART_BYTES)

    def request(block: dict) -> Iterator[tuple]:
        grams = _Grams(unpack_texts(block))
        trained = np.array([not in_fold(i, parts_of_fold, held_part) for i in block["ids"]])[grams.text]
        for n in range(1, order + 1):
            keys, number, last = grams.of(n)
            counts = np.bincount(number[trained[last]], minlength=len(keys)).astype(np.uint32)
            bounds = part_bounds(keys, parts)
            for p in np.flatnonzero(np.diff(bounds)):
                own = slice(bounds[p], bounds[p + 1])
                yield int(p), str(n), pack_bytes([pack_sorted(keys[own]), pack(counts[own])])

    def answer(asked: list[tuple[int, int, str, bytes]]) -> Iterator[tuple]:
        for n in sorted({a[2] for a in asked}):
            own = [(g, b, *unpack_bytes(k)) for g, b, kind, k in asked if kind == n]
            keys = [unpack_sorted(k) for _, _, k, _ in own]
            distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
            number = number.astype(np.int32)
            counts = np.concatenate([unpack(c, "<u4") for *_, c in own])
            total = add_up(number, counts, len(distinct))
            del distinct, counts
            at = 0
            for (g, b, _, _), k in zip(own, keys):
                yield g, b, n, pack(total[number[at : at + len(k)]])
                at += len(k)
            if n == "1":  # figures of the whole corpus, summed later
                seen = total[total > 0]
                yield -1, -1, f"stat:{len(seen)}:{int(seen.sum())}:{int((seen == 1).sum())}:{int((seen == 2).sum())}", b""

    replies = materialise(ask(blocks, ["ids", "sizes", "packed"], request, answer), "lm_counts")
    figure = lambda i: F.coalesce(F.sum(F.split("kind", ":")[i].cast("bigint")), F.lit(0))
    v, n_train, once, twice = replies.where("kind like 'stat:%'").agg(*[figure(i) for i in range(1, 5)]).first()
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5

    def work(block: dict, own: list[dict]) -> Iterator[tuple]:
        grams = _Grams(unpack_texts(block))
        size = int(grams.begin[-1])
        count, gram = [], []
        for n in range(1, order + 1):
            mine = sorted((r for r in own if r["kind"] == str(n)), key=lambda r: r["part"])
            total = np.concatenate([unpack(r["reply"], "<u8") for r in mine]) if mine else np.zeros(0, np.uint64)
            _, number, last = grams.of(n)
            at = np.full(size, -1, dtype=np.int64)
            at[last] = number
            count.append(total.astype(np.float64))
            gram.append(at)
        token = ~grams.is_start
        of_token = np.where(token, count[0][gram[0]], 0.0)
        seen = of_token > 0
        base = np.where(token, np.log10((of_token + 1) / (n_train + v + 1)), 0.0)
        texts_trained = of_token[grams.begin[1:] - 1].max()  # every training text has one end
        weight = Automaton(grams, count, gram, texts_trained, prior, n_train, v, discount).read()
        edges = grams.begin[:-1]
        known, base, score = (np.add.reduceat(x, edges) if size else x for x in ((seen & token).astype(np.int64), base, weight))
        for i, doc_id in enumerate(block["ids"]):
            yield (doc_id, in_fold(doc_id, parts_of_fold, held_part), int(grams.begin[i + 1] - grams.begin[i] - 1),
                   int(known[i]), int(n_train), float(base[i]), float(score[i]))

    long, double = T.LongType(), T.DoubleType()
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", long),
        T.StructField("n_known", long), T.StructField("train_tokens", long), T.StructField("base_score", double), T.StructField("score", double)])
    return finish(blocks, ["ids", "sizes", "packed"], replies.where("kind not like 'stat:%'"), work, schema)
