from __future__ import annotations

import hashlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from phenospark.llm import bpe, decontam, langid
from phenospark.llm.common import fold
from pyspark.sql import functions as F
from tests.llm.test_dedup import brute_components, brute_contained, brute_fingerprint

SF = "/root/testdata/sf0.001"


def recognised(text: str, net) -> bool:
    """Window by window, through the network's forward pass."""
    shares = []
    for w in langid.windows_of(text.encode()) if any(c.isalpha() for c in text) else []:
        if langid._LETTER_BYTE[w].any():
            logits = np.maximum(net._forward(w[None])[0], 0) @ net.out + net.out_bias
            p = np.exp(logits[0] - logits.max())
            shares.append(p[: len(net.languages)].sum() / p.sum())
    return max(shares, default=0) >= corpus_pipeline.LEAST_LANGUAGE_SHARE


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(docs.where(~fold(F.col("doc_id"), 4, 2)), reject=True)
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    left = {i: t for i, t in rows.items() if recognised(t, net)}
    same = defaultdict(list)
    for i, t in left.items():
        same[t].append(i)
    left = {max(ids): t for t, ids in same.items()}
    groups = brute_components({i: brute_fingerprint(t) for i, t in left.items()}, lambda a, b: (a ^ b).bit_count() <= 3)
    left = {i: t for i, t in left.items() if groups[i] == i}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, *_ in brute_contained(list(left.items()), items)}
    left = {i: t for i, t in left.items() if i not in bad}
    got = corpus_pipeline.run(spark, SF).collect()
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert {r.doc_id: r.decoded_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in left.items()}
    assert len(got) == len(left) and len(ranks) == 50_256 and decontam.SHINGLE == 5


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes


def test_language_stage_drops_junk_and_unseen_scripts_and_keeps_prose(spark):
    """The trained network on whole documents: held-out ones, mixed languages, noise, scripts that no document has."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = docs.where(fold(F.col("doc_id"), 4, 2)).collect()
    by_lang = defaultdict(list)
    for r in held:
        by_lang[r.lang].append(r.text)
    mixed = [" ".join(texts[k][:300] for texts in list(by_lang.values())[: 2 + k % 3]) for k in range(60)]
    rng = np.random.default_rng(3)
    noise = [langid.noise(r.text[: int(rng.integers(20, 600))], rng) for r in held[:400]]
    named = ["Это русский текст, который сеть никогда не видела прежде", "這是一段中文文字沒有見過的語言樣本", "qxzv kjwq zzxq", "a1b2c3 %%", "xk",
             "Ελληνικό κείμενο", "日本語のテキストです", "", None, "12 34 !!"]
    kept = {"mixed": mixed, "noise": noise, "named": named}
    rows, start = [], 10_000_000
    for kind, texts in kept.items():
        rows += [(start + k, t, kind, "s", 0) for k, t in enumerate(texts)]
        start += 1_000_000
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema).withColumn("lang", F.lit(None).cast("string")))
    left = {r.doc_id for r in corpus_pipeline.language(spark, more, sf).select("doc_id").collect()}

    def share(first: int, n: int) -> float:
        return sum(first + k in left for k in range(n)) / n

    prose = [r.doc_id for r in held if any(c.isalpha() for c in r.text or "")]
    assert sum(i in left for i in prose) / len(prose) >= 0.998
    assert share(10_000_000, len(mixed)) == 1.0
    assert share(11_000_000, len(noise)) <= 0.05
    assert share(12_000_000, len(named)) == 0.0
