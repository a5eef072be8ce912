"""Spelling groups against plain versions: runs, gram bounds, near words, forms and roots."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from clinweave.llm.spelling import BEGIN, END, LONGEST, SHORTEST, GramIndex, frequent_grams, letter_mask, near_words, run_counts, spelling_groups

rnd = random.Random(11)


def plain_words(rows: list[tuple], least: int, occurrences: int, damage: int | None) -> dict[str, int]:
    total: Counter = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= occurrences}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(words: dict[str, int], times: int) -> dict[str, tuple]:
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    found = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        found[w] = (words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return found


def some_words(alphabet: str, count: int) -> set[str]:
    words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randrange(5, 16))) for _ in range(count)}
    for w in sorted(words):
        at, c = rnd.randrange(len(w)), rnd.choice(alphabet)
        words |= {w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :], w + c, c + w}
    return words


def plain_frequent(words: set[str], common: int) -> set[str]:
    found: set[str] = set()
    for size in range(SHORTEST, LONGEST):
        counts = Counter(m[k : k + size] for m in (BEGIN + w + END for w in words) for k in range(len(m) - size + 1))
        found |= {g for g, n in counts.items() if n > common}
    return found


@pytest.mark.parametrize(("alphabet", "common", "count"), [("ab", 3, 100), ("abc", 20, 500), ("abcdefgh", 8, 800), ("aé", 50, 300)])
def test_words_one_edit_apart_share_a_list(alphabet, common, count):
    """Also with dictionaries so small or so large that bounds leave few grams or none."""
    words = some_words(alphabet, count)
    index = GramIndex(plain_frequent(words, common))
    lists = {w: set(index.lists(w)) for w in words}
    pairs = 0
    for w in words:
        near = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
        for x in (near & words) - {w}:
            pairs += 1
            common_lists = lists[w] & lists[x]
            assert any(len(w) != len(x) or name[0] != ">" for name in common_lists), (w, x)
    assert pairs > 200


def test_one_edit_changes_two_bits_of_the_letters():
    for w in some_words("abcéé", 200):
        at, c = rnd.randrange(len(w)), rnd.choice("abcxyz")
        for x in (w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]):
            assert (letter_mask(w) ^ letter_mask(x)).bit_count() <= 2


def test_decomposition_leaves_no_gram_inside_another():
    words = some_words("abcd", 300)
    index = GramIndex(plain_frequent(words, 10))
    for w in words:
        marked = BEGIN + w + END
        spans = index.decompose(marked)
        assert all(a < c and b < d for (a, b), (c, d) in zip(spans, spans[1:], strict=False))
        assert all(marked[a : b - 1] in index.frequent or b - a == SHORTEST for a, b in spans)
        assert spans[-1][1] == len(marked) and 1 <= index.affected(marked, spans) <= len(spans)


def test_frequent_grams_and_near_words(spark):
    words = sorted(some_words("abce", 60))
    frame = spark.createDataFrame([(k, w, k % 7 + 2) for k, w in enumerate(words)], "id bigint, word string, n bigint")
    assert frequent_grams(frame, 5) == plain_frequent(set(words), 5)
    found = {(r["id"], r["other"], r["n"]) for r in near_words(frame).collect()}
    assert found == {(i, k, k % 7 + 2) for i, a in enumerate(words) for k, b in enumerate(words) if one_edit(a, b)}


def test_runs():
    assert run_counts("Abcdéfg ABCDéFG abc1234567 abcdefÀ", 1, 7, None) == {"abcdéfg": 2, "abcdefÀ": 1}
    assert run_counts("", 1, 7, 31) == run_counts(" \n", None, 7, 31) == {}
    runs = ["word" + "abcdefgh"[: k % 8] for k in range(60)]
    assert run_counts(" ".join(runs), 4, 7, 2) == plain_words([(4, " ".join(runs))], 7, 1, 2)


def test_groups(spark):
    """Common words, their variants, chains of variants, ties, nulls, repeated rows, a very long text."""
    base = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(7, 12))) for _ in range(40)]
    text = []
    for k, w in enumerate(base):
        text += [w] * (400 if k % 4 == 0 else 30 if k % 4 == 1 else 3)
        text += [w[:3] + "x" + w[3:]] * rnd.randrange(1, 40) + [w[:-1]] * 2 + [w + "y"] * (30 if k % 4 == 0 else 3) + [w[:2] + "z" + w[3:]] * 3 + [w + "yy"] * 2
    rnd.shuffle(text)
    rows = [(k, " ".join(text[k * 50 : k * 50 + 50]).title()) for k in range(len(text) // 50 + 1)]
    rows += [(90_001, None), (90_002, ""), (None, "abcdefgh, abcdefgh"), (90_003, " ".join(text) * 3), (5, rows[5][1]), (5, rows[5][1])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int")
    for damage in (None, 3):
        want = plain_groups(plain_words(rows, 7, 2, damage), 10)
        found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling_groups(docs, damage=damage).collect()}
        assert found == want
        assert any(v[2] and v[4] != v[2] for v in want.values()) and sum(v[2] is not None for v in want.values()) > 20
    assert spelling_groups(docs.limit(0)).count() == 0
