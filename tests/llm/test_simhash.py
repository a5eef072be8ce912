"""SimHash groups against plain versions of fingerprint, links and components."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from clinweave.llm.queries import op13_simhash
from clinweave.llm.simhash import block_keys, cells, fingerprints, forest, near_prints, simhash_groups, simhashes
from clinweave.llm.words import words_of

rnd = random.Random(13)


def plain_print(text: str | None, size: int = 3) -> int:
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(prints: dict[int, int], bits: int = 3) -> dict[int, int]:
    names = sorted(prints)
    values = np.array([prints[n] for n in names], np.uint64)
    top = np.arange(len(names))
    while True:
        least = top.copy()
        for k in range(len(names)):
            near = np.bitwise_count(values ^ values[k]) <= bits
            least[k] = top[near].min()
        if (least == top).all():
            return {n: names[t] for n, t in zip(names, top.tolist(), strict=True)}
        top = least


def changed(value: int, bits: int) -> int:
    for bit in rnd.sample(range(64), bits):
        value ^= 1 << bit
    return value


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


TEXTS = [
    None, "", " \t\n", "a", "A  b", "a b c", "A b\nc", "a b c d", "é ß x y z " * 60, "x\x0by\x0cz w", "ab cd " * 20_000,
    " ".join(rnd.choice(["ab", "Cd", "ef.", "gh"]) for _ in range(400)),
]


def test_fingerprints_equal_a_plain_version():
    texts = TEXTS + TEXTS[3:6] + [" ".join(rnd.choice(TEXTS[7].split()) for _ in range(n)) for n in range(12)]
    for size in (1, 3, 5):
        found = simhashes(words_of(pa.array(texts, pa.string()), lower=True), size).tolist()
        assert found == [plain_print(t, size) for t in texts]
    assert simhashes(words_of(pa.array([], pa.string()), lower=True), 3).tolist() == []


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_close_prints_meet(bits):
    """In some cell one is at home and the other there; in a crowd they share a key."""
    one = [rnd.getrandbits(64) for _ in range(500)] + [0, (1 << 64) - 1, 1, 1 << 63]
    two = [changed(x, bits) for x in one]
    places = []
    for side in (one, two):
        cell, row, home = cells(np.array(side, np.uint64))
        at: list[dict] = [{} for _ in side]
        for c, r, h in zip(cell.tolist(), row.tolist(), home.tolist(), strict=True):
            at[r][c] = h
        places.append(at)
    assert all(any(c in b and (h or b[c]) for c, h in a.items()) for a, b in zip(*places, strict=True))
    same = np.zeros(len(one), np.uint64)
    keys = [block_keys(same, np.array(side, np.uint64)) for side in (one, two)]
    assert np.any([a == b for a, b in zip(*keys, strict=True)], axis=0).all()


def test_forest_keeps_components():
    pairs = np.array([(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)], np.int64)
    kept = forest(pairs)

    def groups(edges):
        top = {k: k for k in range(300)}
        for _ in range(300):
            for a, b in edges:
                top[a] = top[b] = min(top[a], top[b])
        return top

    assert groups(kept.tolist()) == groups(pairs.tolist()) and len(kept) <= 299
    assert len(forest(np.zeros((0, 2), np.int64))) == 0


@pytest.mark.parametrize("crowd", [3, 4096])
def test_links_tie_what_brute_force_ties(spark, crowd):
    """Loose values, chains, and a crowd around one value; with a crowd of three, almost all cells are split."""
    values = {rnd.getrandbits(64) for _ in range(300)}
    heart = rnd.getrandbits(64)
    values |= {changed(heart, rnd.randrange(1, 5)) for _ in range(250)} | {heart, 0, 1, 2, 7, 15, 255}
    values |= {changed(v, rnd.randrange(1, 5)) for v in list(values)[:150]}
    prints = {k: v for k, v in enumerate(rnd.sample(sorted(values), len(values)), 10)}
    classes = spark.createDataFrame([(k, signed(v)) for k, v in prints.items()], "node bigint, print bigint")
    links = [(r["a"], r["b"]) for r in near_prints(classes, crowd).collect()]
    top = {k: k for k in prints}
    for _ in range(40):
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    assert top == plain_groups(prints)
    with pytest.raises(ValueError, match="bits"):
        near_prints(classes, bits=4)


def test_groups_with_nulls_ties_and_extra_columns(spark):
    rows = [(3 * k + 1, t, "x", 0) for k, t in enumerate(TEXTS)] + [(4, "", "x", 1), (None, "a b c", "x", 1), (500, TEXTS[-1] + " x", "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string, print int")
    found = simhash_groups(docs).collect()
    assert len(found) == len(rows) and simhash_groups(docs.limit(0)).count() == 0
    prints = {i: plain_print(t) for i, t, _, _ in rows if i is not None}
    group = plain_groups(prints)
    for row in found:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["print"] == signed(plain_print("a b c"))
        else:
            assert (row["print"], row["component_id"]) == (signed(prints[row["doc_id"]]), group[row["doc_id"]])


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    group = plain_groups(prints)
    found = op13_simhash(spark, folder).collect()
    assert len(found) == len(texts)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {i: (f"{p:016x}", group[i]) for i, p in prints.items()}
    assert sum(i != g for i, g in group.items()) > 50


def test_spark_hash_agrees(spark):
    """The contract's hash is the one that Spark's xxhash64 gives for a string."""
    docs = spark.createDataFrame([(1, "one shingle here")], "doc_id bigint, text string")
    assert fingerprints(docs).join(docs, "doc_id").where(F.col("print") == F.xxhash64("text")).count() == 1
