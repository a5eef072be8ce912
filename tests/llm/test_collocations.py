"""Collocations against plain versions: cutting, the trie, the filter, counts, scores and ranks."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clinweave.llm.collocations import HatTrie, Node, Sieve, collocations, cut, frequent_phrases, part_keys, runs, sieve, word_counts

rnd = random.Random(12)


def plain_pieces(text: str | None) -> list[list[str]]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\f\r]", lower)]


def plain(rows: list[tuple], longest: int, least: int, top: int, cover: int) -> set[tuple]:
    counts: dict[str, Counter] = {}
    total: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in plain_pieces(text):
            total[lang] += len(words)
            for size in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    found = set()
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for long, n in known.items():
            for size in range(2, len(long)):
                for k in range(len(long) - size + 1):
                    if 100 * n >= cover * f[long[k : k + size]]:
                        gone.add(long[k : k + size])
        scored = []
        for p, a in known.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return found


def sentence(vocabulary: list[str]) -> str:
    words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 12))]
    if rnd.random() < 0.4:
        words[:0] = ["New", "york", "city", "hall"][: rnd.randrange(2, 5)]
    return rnd.choice([" ", "  ", "\t"]).join(words) + rnd.choice([". ", ", ", "\n", "; ", " ", "!?", "\x0c"])


VOCABULARY = ["a", "b", "c", "d", "é", "x'y", "of", "the", "漢字", "-"]
ROWS = [(rnd.choice(["en", "fr", None, "und"]), "".join(sentence(VOCABULARY) for _ in range(rnd.randrange(1, 30)))) for _ in range(150)]
ROWS += [("en", None), (None, ""), ("en", " .,\n"), ROWS[0], ROWS[0], ("zz", "one two"), ("en", "a b " * 20_000), ("", "of the")]


def test_cut():
    texts = ["A b,c  d\tE", "f", None, "", ".g h.", " i\x0bj! k"]
    cutting = cut(pa.array(texts, pa.string()), pa.array(["x", None, "x", "y", "y", "x"], pa.string()))
    words = cutting.words
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == list("abcdefghijk")
    assert [w for w, fresh in zip(found, cutting.fresh, strict=True) if fresh] == ["a", "c", "f", "g", "i", "j", "k"]
    assert [cutting.langs[k] for k in cutting.lang] == ["x"] * 5 + ["und"] + ["y"] * 2 + ["x"] * 3
    assert cutting.in_piece(2).tolist() == [0, 2, 3, 6] and cutting.in_piece(3).tolist() == [2]
    assert len(cut(pa.array([], pa.string()), pa.array([], pa.string())).fresh) == 0


@pytest.mark.parametrize("burst", [2, 50, 10**6])
@pytest.mark.parametrize("size", [2, 3, 4])
def test_trie_counts_and_leaves_by_subtrees(burst, size):
    trie, want = HatTrie(burst), Counter()
    left: Counter = Counter()
    for _ in range(40):
        chunk = [bytes(8 * size) if rnd.random() < 0.01 else b"".join(rnd.choice(b"abcd").to_bytes(8, "big") for _ in range(size)) for _ in range(200)]
        lang = rnd.choice(["x", "y"])
        chunk = [rnd.choice([b"\x00", b"\x01"]) + p[1:] for p in chunk]
        for byte in sorted({p[:1] for p in chunk}):
            trie.add(lang, byte, [p[1:] for p in chunk if p[:1] == byte])
        want.update((lang, p) for p in chunk)
        if trie.entries > 100:
            for lang, phrases, counts in trie.take(50):
                left.update({(lang, p): n for p, n in zip(phrases, counts, strict=True)})
            assert trie.entries <= 100
    for lang, phrases, counts in trie.take(0):
        assert len(set(phrases)) == len(phrases)
        for p, n in zip(phrases, counts, strict=True):
            left[lang, p] += n
    assert left == want and trie.entries == 0


def test_trie_bursts_by_word():
    trie = HatTrie(3)
    name = lambda k: k.to_bytes(8, "big")
    trie.add("x", b"\x00", [(name(a) + name(b))[1:] for a in range(3) for b in range(1)])
    assert isinstance(trie.tops["x"].children[b"\x00"], Counter)
    trie.add("x", b"\x00", [(name(a) + name(b))[1:] for a in range(3) for b in range(5)] * 2)
    below = trie.tops["x"].children[b"\x00"]
    assert isinstance(below, Node) and trie.entries == 15
    # the last word has a container of its own, however large
    assert [below.children[name(a)[1:]] for a in range(3)] == [{name(b): 2 + (b == 0) for b in range(5)}] * 3
    long = HatTrie(3)
    long.add("x", b"\x00", [(name(1) + name(b) + name(c))[1:] for b in range(2) for c in range(3)])
    word = long.tops["x"].children[b"\x00"].children[name(1)[1:]]
    long.add("x", b"\x00", [(name(1) + name(7) + name(c))[1:] for c in range(2)])
    assert isinstance(word, Counter) and isinstance(long.tops["x"].children[b"\x00"].children[name(1)[1:]], Node)


def test_runs_are_sorted_and_complete():
    phrases = sorted({bytes(rnd.randrange(256) for _ in range(24)) for _ in range(300)}, key=lambda _: rnd.random())
    batch = runs("x", phrases, list(range(1, 301)), 3, 7)
    seen = {}
    for row in batch.to_pylist():
        ids, counts = np.frombuffer(row["ids"], "<u8").reshape(3, -1), np.frombuffer(row["counts"], "<i8")
        listed = [tuple(x) for x in ids.T.tolist()]
        assert listed == sorted(listed) and 0 <= row["part"] < 7
        seen |= {b"".join(v.to_bytes(8, "big") for v in p): n for p, n in zip(listed, counts.tolist(), strict=True)}
    assert seen == dict(zip(phrases, range(1, 301), strict=True))


def test_sieve_loses_nothing(spark):
    ids = [rnd.getrandbits(63) for _ in range(500)]
    parts = spark.createDataFrame([("x", bytearray(i.to_bytes(8, "big"))) for i in ids], "lang string, ids binary")
    for bits in (9, 11, 16):
        held: Sieve = sieve(parts, len(ids), bits)
        assert held.may_hold(part_keys(np.array(ids, np.uint64), 1, "x")).all()
    strange = part_keys(np.array([rnd.getrandbits(63) for _ in range(2000)], np.uint64), 1, "x")
    assert held.may_hold(strange).mean() < 0.05


def test_words_have_ids_of_their_own(spark):
    docs = spark.createDataFrame(ROWS, "lang string, text string").fillna("und", "lang")
    table, seed = word_counts(docs)
    found = {(r["lang"], r["word"]): r["f"] for r in table.collect()}
    want = Counter((lang or "und" if lang != "" else "", w) for lang, text in ROWS for p in plain_pieces(text) for w in p)
    assert found == want and seed == 0
    assert table.groupBy("id").agg({"word": "max"}).count() == len({w for _, w in want})


@pytest.mark.parametrize(("budget", "burst", "bits"), [(40, 3, 9), (600_000, 4096, None)])
def test_collocations(spark, budget, burst, bits):
    """Also with tries that burst and spill all the time, and a filter that lets almost everything pass."""
    docs = spark.createDataFrame([(lang, text, "x", 1) for lang, text in ROWS], "lang string, text string, rank string, f int")
    for least, top in ((5, 2000), (3, 7)):
        found = {tuple(r) for r in collocations(docs, 4, least, top, 80, budget, burst, bits).collect()}
        assert found == plain(ROWS, 4, least, top, 80)
    assert collocations(docs.limit(0)).count() == 0
    words, seed = word_counts(docs.select(docs.lang, "text").fillna("und"))
    assert frequent_phrases(docs.select("lang", "text"), words, seed, 4, 10**6).count() == 0
