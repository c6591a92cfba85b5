"""Small corpora with awkward rows, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, block int, kind string, score double"


def lower(text: str) -> str:
    return text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).decode()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def corpus(seed: int = 1, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Random texts with copies, near copies, shared passages, nulls, empties, odd white space and one very long text."""
    rng = random.Random(seed)
    vocabulary = [rng.choice("abcdefghijklmnop") * rng.randint(1, 2) + str(k) for k in range(150)] + ["Ä", "été", "naïve", "日本", "I'm", "ß"]
    passage = " ".join(rng.choices(vocabulary, k=70))
    out: list[tuple[int | None, str | None]] = []
    for i in range(n):
        text = " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 30, 60, 120])))
        if i % 5 == 0:
            text = f"{text} {passage} {text}"
        if i % 7 == 0 and out:
            text = out[rng.randrange(len(out))][1] or ""
        if i % 11 == 0:
            text = re.sub(" ", "\t \n", text, count=3).upper()
        out.append((i, text))
    out += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "lonely"), (n + 4, " ".join(rng.choices(vocabulary, k=30_000)))]
    out += [(None, passage), (7, out[7][1]), (7, out[7][1])]  # no id, and repeated rows
    return out


def frame(spark, rows, schema: str = DOCS):
    """The rows as ``documents`` with further columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1, "x", 0.5) for i, t in rows], schema)


def empty(spark):
    return spark.createDataFrame([], DOCS)
