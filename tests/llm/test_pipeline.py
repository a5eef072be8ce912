"""The pipeline against a plain version of its stages, on the smallest tables."""

from __future__ import annotations

import hashlib

import numpy as np

import corpus_pipeline
from clinweave.llm.queries import ORACLE, QUERIES, toxic_model
from clinweave.llm.toxicity import toxicity
from clinweave.llm.vocab import default_path, load_ranks

FOLDER = "/root/testdata/sf0.001"


def shingles(text: str, size: int = 5) -> set:
    words = text.encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def test_run_equals_plain_stages(spark):
    import public_tokenizers
    import tiktoken

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = toxicity(docs, toxic_model(spark, FOLDER, docs)).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in scored if not r["predicted"]}
    texts = {i: t for i, t in texts.items() if i == max(j for j, u in texts.items() if u == t)}
    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in sets}
    for _ in range(5):
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = {i for i in sets if group[i] == i and not any(100 * len(q & sets[i]) >= 80 * len(q) for q in items)}
    coder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(default_path("byte_bpe_multi_50k.tiktoken")), special_tokens={}
    )
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(found) == left
    for i, row in found.items():
        ids = coder.encode_ordinary(texts[i])
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_registry():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)] and set(ORACLE) < set(QUERIES)
