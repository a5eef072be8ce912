"""Spelling variants: words one edit apart, found by a variable-length gram index.

The gram dictionary is pruned by frequency: a gram that too many words hold is not used but extended by the letter that
follows it, so a word is cut into grams that are as short as their rarity allows. A gram that lies within another is left
out. For every word a bound is computed on how many of its grams a single edit can affect; words one edit apart share at
least all grams but those. So the lists of a word's rarest grams, one more than the bound, are merged and no others
(grams keep their distance from the beginning or from the end of the word, which is part of a list's name). Candidates
are verified by edit distance. Two words whose bounds leave no gram for sure share one half instead, and are listed by it.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.shared import checkpointed, written
from clinweave.llm.words import pieces, text_bytes
from clinweave.session import ship_package

#: Shortest and longest gram.
SHORTEST, LONGEST = 2, 10
#: A gram in more words than this is extended, and in more words than its level's share of all places: at most KINDS
#: grams of one length are frequent, which bounds what is broadcast whatever the vocabulary.
COMMON, KINDS = 64, 50_000
#: Distinct words that a task counts before it passes them on; bytes of text above which runs are not listed at once.
HELD, LONG_TEXT = 300_000, 4_000_000
BEGIN, END = "\x02", "\x03"


# -- the vocabulary


def run_counts(text: str, doc_id: int | None, least: int, damage: int | None) -> Counter:
    """Runs of letters of one text, lower-cased in A-Z, with how often they occur; `damage` takes a letter out of some."""
    pattern = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")
    text = text.encode().lower().decode()
    runs = Counter(pattern.findall(text) if len(text) < LONG_TEXT else (m.group() for m in pattern.finditer(text)))
    if not damage:
        return runs
    seed, kept = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % damage == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        kept[run] += n
    return kept


def _counted(least: int, damage: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for piece in pieces(batches):
            data, ends = text_bytes(piece.column("text"))
            for k, name in enumerate(piece.column("doc_id").to_pylist()):
                text = data[ends[k] : ends[k + 1]].tobytes().decode()
                for word, n in run_counts(text, name, least, damage).items():
                    total[word] += n
                if len(total) > HELD:
                    yield out()
                    total.clear()
        if total:
            yield out()

    return run


def vocabulary(docs: DataFrame, least: int = 7, occurrences: int = 2, damage: int | None = None) -> DataFrame:
    """(id, word, n): words of at least `least` letters and `occurrences` occurrences. Ids follow code-point order."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = docs.mapInArrow(_counted(least, damage), "word string, n bigint")
    words = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)
    words = written(words, "spelling-words")
    ranked = words.repartitionByRange("word").sortWithinPartitions("word").withColumn("id", F.monotonically_increasing_id())
    return written(ranked.select("id", "word", "n"), "spelling-vocabulary")


# -- the gram dictionary


def _grams(size: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value if frequent else None
        total: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                word = f"{BEGIN}{word}{END}"
                for at in range(len(word) - size + 1):
                    if known is None or word[at : at + size - 1] in known:
                        total[word[at : at + size]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["gram", "n"])

    return run


def frequent_grams(words: DataFrame, common: int = COMMON) -> frozenset[str]:
    """Grams too frequent to list words by, level by level: only extensions of frequent grams are counted.

    At most KINDS of each length, as a frequent gram holds more than that share of all places.
    """
    spark = words.sparkSession
    places = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0
    common = max(common, -(-places // KINDS))
    every: set[str] = set()
    level = None
    for size in range(SHORTEST, LONGEST):
        known = None if level is None else spark.sparkContext.broadcast(level)
        counts = words.select("word").mapInArrow(_grams(size, known), "gram string, n bigint")
        rows = counts.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > common).select("gram").collect()
        level = frozenset(r["gram"] for r in rows)
        every |= level
        if not level:
            break
    return frozenset(every)


class GramIndex:
    """Decomposes words and bounds what one edit affects, given the frequent grams."""

    def __init__(self, frequent: Collection[str]):
        self.frequent = frozenset(frequent)
        #: What may follow a new letter inside a frequent gram.
        self.tails = frozenset(g[1:] for g in self.frequent)

    def decompose(self, word: str) -> list[tuple[int, int]]:
        """Spans of the grams: at each place the shortest that is not frequent, without those inside another."""
        spans, last, size = [], 0, len(word)
        for begin in range(size - SHORTEST + 1):
            end = begin + SHORTEST
            while end < size and end - begin < LONGEST and word[begin:end] in self.frequent:
                end += 1
            if end > last:
                spans.append((begin, end))
                last = end
        return spans

    def affected(self, word: str, spans: list[tuple[int, int]]) -> int:
        """The most grams that one edit between the marks can change or hide.

        A gram that ends before the edit stays: what lies behind a gram has no say in where it ends. One that holds the
        edit may change. One behind it stays unless a new gram reaches over it, which must begin with a frequent gram
        whose tail is what follows the edit.
        """
        begins, ends = [s[0] for s in spans], [s[1] for s in spans]
        most, size = 0, len(word)
        reach = [0] * (size + 1)
        for at in range(1, size):
            end = at + 1
            while end <= size and word[at:end] in self.tails:
                end += 1
            reach[at] = min(end, size)
        reach[size] = size
        for at in range(1, size):
            first = bisect_right(ends, at)
            if at < size - 1:  # the letter goes, or is replaced
                most = max(most, max(bisect_right(begins, at), bisect_right(ends, reach[at + 1])) - first)
            most = max(most, max(bisect_left(begins, at), bisect_right(ends, reach[at])) - first)
        return most

    def lists(self, word: str) -> list[str]:
        """Names of the lists that a word is in. Words one edit apart have one in common."""
        marked = f"{BEGIN}{word}{END}"
        size, spans = len(marked), self.decompose(marked)
        keep = self.affected(marked, spans) + 1
        if keep < len(spans):
            # the rarest first: any order that all words agree on is right
            order = sorted((marked[a:b] in self.frequent, marked[a:b]) for a, b in spans)
            spans = [(a, b) for a, b in spans if (marked[a:b] in self.frequent, marked[a:b]) <= order[keep - 1]]
        names = [f"<{a}:{marked[a:b]}" for a, b in spans] + [f">{size - b}:{marked[a:b]}" for a, b in spans]
        if keep > len(spans):
            for length in (len(word), len(word) - 1):
                half = length // 2
                names += [f"[{length}:{word[:half]}", f"]{length}:{word[len(word) - (length - half) :]}"]
        return names


def letter_mask(word: str) -> int:
    """Which letters a word has once, and which twice, in 32 classes each. One edit changes two bits at most."""
    mask = 0
    for letter in word:
        bit = 1 << ord(letter) % 32
        mask |= bit << 32 if mask & bit else bit
    return mask


def _lists(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GramIndex(frequent.value)
        for batch in batches:
            rows, keys, turned, masks = [], [], [], []
            for k, word in enumerate(batch.column("word").to_pylist()):
                masks.append(letter_mask(word))
                for name in index.lists(word):
                    rows.append(k)
                    keys.append(xxhash.xxh32_intdigest(name.encode()) - (1 << 31))
                    turned.append(name[0] == ">")
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), pa.array(turned, pa.bool_()), pa.array(np.array(masks, np.uint64).view(np.int64)).take(at),
                 *(batch.column(c).take(at) for c in ("id", "word", "n"))],
                ["list", "turned", "mask", "id", "word", "n"],
            )

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(id, other, n): for every word of `words` (id, word, n) each word exactly one edit apart, with that word's n.

    Pairs may come more than once, in both directions each time.
    """
    frequent = words.sparkSession.sparkContext.broadcast(frequent_grams(words))
    listed = written(
        words.select("id", "word", "n").mapInArrow(_lists(frequent), "list int, turned boolean, mask bigint, id bigint, word string, n bigint"),
        "spelling-lists",
    )
    other = listed.select("list", "turned", *(F.col(c).alias(f"{c}2") for c in ("mask", "id", "word", "n")))
    # words of one length share their grams' places from both ends; one of them will do
    close = (F.abs(F.length("word") - F.length("word2")) <= 1) & (~F.col("turned") | (F.length("word") != F.length("word2")))
    # the cheap conditions first: most words of a list have other letters
    alike = F.bit_count(F.col("mask").bitwiseXOR(F.col("mask2"))) <= 2
    pairs = listed.join(other, ["list", "turned"]).where((F.col("id") < F.col("id2")) & alike & close & (F.levenshtein("word", "word2", 1) == 1))
    pairs = pairs.select("id", "n", "id2", "n2")
    both = F.array(F.struct("id", F.col("id2").alias("other"), F.col("n2").alias("n")), F.struct(F.col("id2").alias("id"), F.col("id").alias("other"), "n"))
    return pairs.select(F.inline(both))


def spelling_groups(docs: DataFrame, least: int = 7, occurrences: int = 2, times: int = 10, damage: int | None = None) -> DataFrame:
    """One row per word of `docs` (doc_id bigint, text): word, n, n_near, form, form_n, root.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), lower-cased in A-Z, of at least `least` letters and
    `occurrences` occurrences. n_near counts the words exactly one inserted, deleted or replaced letter apart. A word's
    form is the one of them with the largest n (the first in code-point order of equals) if it occurs at least `times` as
    often, else null; root is the last word that forms lead to. With `damage`, a letter is left out of the runs whose
    crc32 with their doc_id is divisible by it, at the place that the crc32 modulo the length names.

    Null and empty texts have no words; a null doc_id counts as an empty name; repeated rows count again; further columns
    are ignored. An empty table gives no rows.
    """
    words = vocabulary(docs, least, occurrences, damage)
    near = near_words(words)
    # of equal counts the smallest id is the first word; a word has at most some 60 * 2 * length neighbours
    seen = near.groupBy("id").agg(F.collect_set(F.struct("n", (-F.col("other")).alias("other"))).alias("near"))
    best = F.array_max("near")
    seen = seen.select("id", F.size("near").cast("bigint").alias("n_near"), (-best["other"]).alias("form_id"), best["n"].alias("form_n"))
    known = words.join(seen, "id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("bigint")))
    held = F.col("form_n") >= times * F.col("n")
    known = written(known.withColumns({"form_id": F.when(held, F.col("form_id")), "form_n": F.when(held, F.col("form_n"))}), "spelling-forms")
    # counts grow along the way, so that no way is long; every round doubles the steps
    steps = checkpointed(known.where("form_id is not null").select("id", F.col("form_id").alias("root_id")))
    while True:
        ahead = steps.select(F.col("id").alias("root_id"), F.col("root_id").alias("then"))
        longer = checkpointed(steps.join(ahead, "root_id", "left").select("id", F.coalesce("then", "root_id").alias("root_id"), F.col("then").isNotNull().alias("moved")))
        steps = longer.select("id", "root_id")
        if longer.where("moved").isEmpty():
            break
    names = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    roots = steps.join(words.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id").select("id", "root")
    return (
        known.join(names, "form_id", "left").join(roots, "id", "left")
        .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
    )
