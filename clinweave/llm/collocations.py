"""Phrase collocations: exact counts of word sequences in HAT-tries, then scores of the best-known ones.

Words are counted first and named by 64-bit hashes that are checked to tell all words apart. Longer phrases are counted
one length after the other, and only those whose two shorter parts may be frequent: a filter of fixed size over the
frequent parts says so, and lets some others pass, which costs room and nothing else.

Each task counts in a HAT-trie: a shallow trie over word names whose leaves are hash containers of the rest of each
phrase, first for a range of words; a container that outgrows BURST bursts into a node with one container per next word. When a trie holds more than BUDGET
phrases, its largest subtrees leave as sorted runs, cut by prefix partition (a hash of the first two words, so that a word
that begins a tenth of all phrases is spread). The runs of a prefix partition are merged in one task each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinweave.llm.shared import written
from clinweave.llm.words import _LOWER, Words, gram_hashes, mix, pieces, text_bytes
from clinweave.session import ship_package

#: Phrases in a container before it bursts, and in a task's trie before subtrees leave it.
BURST, BUDGET = 16_384, 600_000
#: Distinct words that a task counts before it passes them on.
HELD = 300_000
#: Words of text per prefix partition, which bounds what one merge holds.
PART_WORDS = 2_000_000
#: The filter of frequent parts is broadcast: at most 2**MAX_BITS bits, 32 MB. Beyond, it rules out less.
MIN_BITS, MAX_BITS, CHUNKS = 16, 28, 64
#: Groups that each pick their best before the final choice.
GROUPS = 64

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


@dataclass
class Pieces:
    """Words of a batch of texts; `fresh` marks those that begin a piece, `lang` is their place in `langs`."""

    words: Words
    fresh: np.ndarray
    lang: np.ndarray
    langs: list[str]

    def in_piece(self, size: int) -> np.ndarray:
        """Places where `size` words stand in one piece."""
        whole = np.ones(max(0, len(self.fresh) - size + 1), bool)
        for k in range(1, size):
            whole &= ~self.fresh[k : k + len(whole)]
        return np.flatnonzero(whole)


def cut(texts: pa.Array, langs: pa.Array) -> Pieces:
    """Texts lower-cased (A-Z) and cut at marks and line ends, the pieces cut at blanks. No piece crosses two texts."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    kind = _KIND[data]
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = kind == 0
    begins, stops = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= solid[edges + 1]
    stops[edges - 1] |= solid[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    words = Words(data, starts, ends, np.searchsorted(starts, offsets))
    row = np.repeat(np.arange(len(texts)), words.counts)
    marks = np.cumsum(kind == 2, dtype=np.int64)[starts] if len(starts) else starts
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (marks[1:] != marks[:-1]) | (row[1:] != row[:-1])
    coded = langs.cast(pa.string()).fill_null("und").dictionary_encode()
    return Pieces(words, fresh, coded.indices.to_numpy()[row] if len(row) else row, coded.dictionary.to_pylist())


def _by_lang(cutting: Pieces, at: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    for k, lang in enumerate(cutting.langs):
        mine = at[cutting.lang[at] == k]
        if len(mine):
            yield lang, mine


# -- words


def _word_counts(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], int] = {}
        names: dict[tuple[str, int], str] = {}

        def out() -> pa.RecordBatch:
            columns = [[k[0] for k in counts], list(names.values()), np.array([k[1] for k in counts], np.uint64).view(np.int64), list(counts.values())]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["lang", "word", "id", "f"])

        for piece in pieces(batches):
            cutting = cut(piece.column("text"), piece.column("lang"))
            words, ids = cutting.words, cutting.words.hashes(seed)
            for lang, at in _by_lang(cutting, np.arange(len(ids))):
                found, first, n = np.unique(ids[at], return_index=True, return_counts=True)
                for name, place, count in zip(found.tolist(), at[first].tolist(), n.tolist(), strict=True):
                    key = (lang, name)
                    if key in counts:
                        counts[key] += count
                    else:
                        counts[key] = count
                        names[key] = words.data[words.starts[place] : words.ends[place]].tobytes().decode()
            if len(counts) > HELD:
                yield out()
                counts.clear()
                names.clear()
        if counts:
            yield out()

    return run


def word_counts(docs: DataFrame, seed: int = 0) -> tuple[DataFrame, int]:
    """(lang, word, id, f) of all words, and the seed of the hash that names each by an id of its own."""
    counts = docs.mapInArrow(_word_counts(seed), "lang string, word string, id bigint, f bigint")
    table = written(counts.groupBy("lang", "word", "id").agg(F.sum("f").alias("f")), "phrase-words")
    shared = table.groupBy("id").agg(F.min("word").alias("low"), F.max("word").alias("high")).where("low < high")
    if shared.isEmpty():
        return table, seed
    return word_counts(docs, seed + 1)


# -- the filter of frequent parts


def part_keys(ids: np.ndarray, size: int, lang: str) -> np.ndarray:
    """A 64-bit key at every place of `size` consecutive ids."""
    return mix(gram_hashes(ids, size) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))


def _bits_of(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return keys >> np.uint64(64 - bits), mix(keys) >> np.uint64(64 - bits)


def _set_bits(bits: int):
    width = np.uint64(bits - CHUNKS.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [
                part_keys(np.frombuffer(ids, ">u8").astype(np.uint64), len(ids) // 8, lang)
                for ids, lang in zip(batch.column("ids").to_pylist(), batch.column("lang").to_pylist(), strict=True)
            ]
            places = np.unique(np.concatenate(_bits_of(np.concatenate(keys), bits)))
            chunk = (places >> width).astype(np.int32)
            inside = (places & ((np.uint64(1) << width) - np.uint64(1))).astype("<u4")
            cuts = np.searchsorted(chunk, np.arange(CHUNKS + 1))
            held = [k for k in range(CHUNKS) if cuts[k] < cuts[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.int32()), pa.array([inside[cuts[k] : cuts[k + 1]].tobytes() for k in held], pa.binary())], ["chunk", "places"]
            )

    return run


def _merge_bits(bits: int):
    size = 1 << (bits - CHUNKS.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places in zip(batch.column("chunk").to_pylist(), batch.column("places").to_pylist(), strict=True):
                held.setdefault(chunk, np.zeros(size, bool))[np.frombuffer(places, "<u4")] = True
        for chunk, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([np.packbits(found, bitorder="little").tobytes()])], ["chunk", "bits"])

    return run


class Sieve:
    """Says of a key that it may be among those given, or that it is not."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        may = np.ones(len(keys), bool)
        for places in _bits_of(keys, self.bits):
            may &= (self.table[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return may


def sieve(parts: DataFrame, count: int, bits: int | None = None) -> Sieve:
    """A filter over the parts (lang, ids), sixteen bits for each of `count`, within its bounds; 2**9 bits at least."""
    bits = bits or min(MAX_BITS, max(MIN_BITS, (16 * count).bit_length()))
    merged = (
        parts.select("lang", "ids").mapInArrow(_set_bits(bits), "chunk int, places binary")
        .repartition("chunk").mapInArrow(_merge_bits(bits), "chunk int, bits binary")
    )
    table = np.zeros((CHUNKS, (1 << bits) // CHUNKS // 8), np.uint8)
    for row in merged.collect():  # 2**MAX_BITS bits at most, whatever the input
        table[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return Sieve(table.reshape(-1), bits)


# -- longer phrases


class Node:
    """One container, or node, per next part of a phrase."""

    __slots__ = ("children",)

    def __init__(self):
        self.children: dict[bytes, Node | Counter] = {}


class HatTrie:
    """Counts of phrases of one length, packed as eight bytes a word, below the languages they are in.

    The top node of a language branches by the first byte of the first word's name, so a container holds the phrases of a
    range of words. A container that outgrows `burst` bursts by the first word, then by the second, and so on.
    """

    def __init__(self, burst: int = BURST):
        self.tops: dict[str, Node] = {}
        self.burst, self.entries = burst, 0

    def add(self, lang: str, byte: bytes, rests: list[bytes]) -> None:
        """Count phrases that begin with `byte`; `rests` are their other bytes, one entry per occurrence."""
        self._put(self.tops.setdefault(lang, Node()), byte, rests, 7)

    def _put(self, above: Node, name: bytes, rests: list[bytes], width: int) -> None:
        below = above.children.get(name)
        if type(below) is Node:
            groups: dict[bytes, list[bytes]] = {}
            for rest in rests:
                groups.setdefault(rest[:width], []).append(rest[width:])
            for then, more in groups.items():
                self._put(below, then, more, 8)
            return
        if below is None:
            below = above.children[name] = Counter()
        before = len(below)
        below.update(rests)
        self.entries += len(below) - before
        # the last word of a phrase has nothing to branch to
        if len(below) > self.burst and len(rests[0]) > 8:
            above.children[name] = self._burst(below, width)

    @staticmethod
    def _burst(container: Counter, width: int) -> Node:
        node = Node()
        for rest, n in container.items():
            node.children.setdefault(rest[:width], Counter())[rest[width:]] = n
        return node

    @staticmethod
    def _size(node: Node | Counter) -> int:
        return sum(map(HatTrie._size, node.children.values())) if type(node) is Node else len(node)

    @staticmethod
    def _items(node: Node | Counter, prefix: bytes, phrases: list[bytes], counts: list[int]) -> None:
        if type(node) is Node:
            for word, child in node.children.items():
                HatTrie._items(child, prefix + word, phrases, counts)
        else:
            phrases += [prefix + rest for rest in node]
            counts += node.values()

    def take(self, keep: int) -> Iterator[tuple[str, list[bytes], list[int]]]:
        """Whole subtrees, the largest first, until at most `keep` phrases are left: (lang, phrases, counts)."""
        subtrees = [(self._size(child), lang, word) for lang, top in self.tops.items() for word, child in top.children.items()]
        taken: dict[str, tuple[list, list]] = {}
        for size, lang, word in sorted(subtrees, key=lambda x: -x[0]):
            if self.entries <= keep:
                break
            self._items(self.tops[lang].children.pop(word), word, *taken.setdefault(lang, ([], [])))
            self.entries -= size
        for lang, (phrases, counts) in taken.items():
            yield lang, phrases, counts


_RUN = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("ids", pa.binary()), ("counts", pa.binary())])
_RUN_SQL = "part int, lang string, ids binary, counts binary"


def runs(lang: str, phrases: list[bytes], counts: list[int], size: int, parts: int) -> pa.RecordBatch:
    """The phrases as one sorted run for every prefix partition, ids column by column."""
    ids = np.frombuffer(b"".join(phrases), ">u8").reshape(-1, size).T.astype(np.uint64)
    part = (mix(ids[0] + mix(ids[1])) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((*ids[::-1], part))
    ids, part, counts = ids[:, order], part[order], np.array(counts, "<i8")[order]
    heads = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    spans = list(zip(heads.tolist(), [*heads[1:].tolist(), len(part)], strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[heads], pa.int32()), pa.array([lang] * len(spans)),
         pa.array([np.ascontiguousarray(ids[:, a:b]).astype("<u8").tobytes() for a, b in spans], pa.binary()),
         pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary())], schema=_RUN,
    )


def _phrase_runs(size: int, seed: int, known, parts: int, budget: int, burst: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, trie = known.value, HatTrie(burst)
        for piece in pieces(batches):
            cutting = cut(piece.column("text"), piece.column("lang"))
            ids = cutting.words.hashes(seed)
            at = cutting.in_piece(size)
            for lang, mine in _by_lang(cutting, at):
                if size == 2:
                    may = frequent.may_hold(part_keys(ids, 1, lang))
                    mine = mine[may[mine] & may[mine + 1]]
                else:
                    both = np.union1d(mine, mine + 1)
                    may = np.zeros(len(ids), bool)
                    may[both] = frequent.may_hold(part_keys(ids, size - 1, lang)[both])
                    mine = mine[may[mine] & may[mine + 1]]
                if not len(mine):
                    continue
                first = (ids[mine] >> np.uint64(56)).astype(np.uint8)
                order = np.argsort(first, kind="stable")
                mine, first, width = mine[order], first[order], 8 * size
                packed = np.stack([ids[mine + k] for k in range(size)], 1).astype(">u8").tobytes()
                rests = [packed[k + 1 : k + width] for k in range(0, len(packed), width)]
                cuts = np.searchsorted(first, np.arange(257))
                for byte in range(256):
                    if cuts[byte] < cuts[byte + 1]:
                        trie.add(lang, bytes([byte]), rests[cuts[byte] : cuts[byte + 1]])
            if trie.entries > budget:
                for out in trie.take(budget // 2):
                    yield runs(*out, size, parts)
        for out in trie.take(0):
            yield runs(*out, size, parts)

    return run


def _merge_runs(size: int, least: int):
    """Sums the runs of one prefix partition and language after the other; rows arrive sorted by both."""
    schema = pa.schema([("lang", pa.string()), ("ids", pa.binary()), ("f", pa.int64())])

    def close(lang: str, held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        ids = np.concatenate([np.frombuffer(x, "<u8").reshape(size, -1) for x, _ in held], axis=1)
        counts = np.concatenate([np.frombuffer(x, "<i8") for _, x in held])
        order = np.lexsort(ids[::-1])
        ids, counts = ids[:, order], counts[order]
        heads = np.flatnonzero(np.concatenate(([True], (ids[:, 1:] != ids[:, :-1]).any(axis=0))))
        total = np.add.reduceat(counts, heads)
        stay = total >= least
        packed = np.ascontiguousarray(ids[:, heads[stay]].T).astype(">u8").tobytes()
        names = [packed[k : k + 8 * size] for k in range(0, len(packed), 8 * size)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(names, pa.binary()), pa.array(total[stay])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []
        for batch in batches:
            for part, lang, ids, counts in zip(*(batch.column(c).to_pylist() for c in _RUN.names), strict=True):
                if (part, lang) != name and held:
                    yield close(name[1], held)
                    held = []
                name = (part, lang)
                held.append((ids, counts))
        if held:
            yield close(name[1], held)

    return run


def frequent_phrases(
    docs: DataFrame, words: DataFrame, seed: int, longest: int, least: int, budget: int = BUDGET, burst: int = BURST, bits: int | None = None
) -> DataFrame:
    """(lang, ids, f) of the phrases of one to `longest` words that occur `least` times; ids are eight bytes a word."""
    spark = docs.sparkSession
    total = words.agg(F.sum("f")).first()[0] or 0
    parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_WORDS))
    level = words.where(F.col("f") >= least).select("lang", F.unhex(F.lpad(F.hex("id"), 16, "0")).alias("ids"), "f")
    level = written(level, "phrases-1")
    found = level
    for size in range(2, longest + 1):
        count = level.count()
        if not count:
            break
        known = spark.sparkContext.broadcast(sieve(level, count, bits))
        counted = docs.mapInArrow(_phrase_runs(size, seed, known, parts, budget, burst), _RUN_SQL)
        merged = counted.repartition("part").sortWithinPartitions("part", "lang").mapInArrow(_merge_runs(size, least), "lang string, ids binary, f bigint")
        level = written(merged, f"phrases-{size}")
        found = found.union(level)
    return found


def _sub(first, count) -> F.Column:
    return F.expr(f"substring(ids, 8 * ({first}) + 1, 8 * ({count}))")


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, top: int = 2000, cover: int = 80,
    budget: int = BUDGET, burst: int = BURST, bits: int | None = None,
) -> DataFrame:
    """The `top` phrases of each language of `docs` (lang, text): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut into pieces at `.,;:!?` and line ends, pieces into words at blanks and tabs. A null
    lang is `und`; null and empty texts have no words; repeated rows count again; further columns are ignored; an empty
    table gives no rows. n counts the words of a language; a candidate is a phrase of two to `longest` words of one piece
    that occurs a >= `least` times, overlaps included. The cut that gives the lowest score floor(2000000 a / (l + r))
    counts, where l and r say how often the two sides occur; of equal ones the first. A candidate inside a longer one that
    occurs at least `cover` percent as often is left out. Best first; ties by a, then by phrase in byte order.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words, seed = word_counts(docs)
    phrases = frequent_phrases(docs, words, seed, longest, least, budget, burst, bits)
    long = phrases.withColumn("size", (F.length("ids") / 8).cast("int")).where("size > 1")
    big = lambda c: f"cast({c} as decimal(20, 0))"

    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "ids", "size", F.col("f").alias("a"), "k", _sub("0", "k").alias("one"), _sub("k", "size - k").alias("two"))
    for side, count in (("one", "l"), ("two", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("ids").alias(side), F.col("f").alias(count)), ["lang", side])
    cuts = cuts.withColumn("score", F.expr(f"({big('a')} * 2000000) div ({big('l')} + {big('r')})"))
    scored = cuts.groupBy("lang", "ids", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inside = long.where("size > 2").withColumn("w", F.explode(F.expr("sequence(2, size - 1)")))
    inside = inside.withColumn("at", F.explode(F.expr("sequence(0, size - w)"))).select("lang", _sub("at", "w").alias("ids"), "f")
    inside = inside.groupBy("lang", "ids").agg(F.max("f").alias("longer"))
    stay = scored.join(inside, ["lang", "ids"], "left").where(
        F.col("longer").isNull() | F.expr(f"100 * {big('longer')} < {cover} * {big('a')}")
    )
    stay = stay.select("lang", "ids", "a", "cut.l", "cut.r", "cut.score")
    # every group picks its best first, ties included, so that no task sees all phrases of a language
    best = W.partitionBy("lang", F.pmod(F.xxhash64("ids"), F.lit(GROUPS))).orderBy(F.desc("score"), F.desc("a"))
    stay = written(stay.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place"), "phrases-best")
    names = stay.select("lang", "ids", F.explode(F.expr("sequence(0, length(ids) div 8 - 1)")).alias("at")).withColumn(
        "id", F.conv(F.hex(_sub("at", "1")), 16, -10).cast("bigint")
    )
    spelled = names.join(words.select("lang", "id", "word"), ["lang", "id"]).groupBy("lang", "ids")
    spelled = spelled.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = stay.join(spelled, ["lang", "ids"]).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    )
    counts = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.where(F.col("rank") <= top).join(counts, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
