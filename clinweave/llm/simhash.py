"""Near-duplicates by SimHash: segment popcounts as an embedding, a grid range-join, exact confirmation.

A fingerprint of 64 bits is mapped to the popcounts of its 32 segments of two bits. The Manhattan distance of two such
vectors is never more than the Hamming distance of the fingerprints, so fingerprints that differ in at most three bits
lie within distance three. The vector is cut into two halves; one of them then lies within distance one. Each half is a
grid whose cells are its lattice points: a fingerprint is at home in one cell and visits the cells at distance one. Of
two cells at distance one, one has an even number of bits and the other an odd one, so only even ones pay visits.

Rows are dealt by cell. Fingerprints of one cell are compared on all bits, and what leaves a task is a spanning forest of
the links it found, at most one row per fingerprint however many copies are alike. A cell with more than CROWD members
is not compared there: its members pass on to a second round, keyed by the cell and by the bits themselves (of six
blocks, three must be equal), so a crowd is spread over many keys and nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.components import components
from clinweave.llm.shared import checkpointed, written
from clinweave.llm.words import Words, mix, pieces, words_of
from clinweave.session import ship_package

SEED = 42
#: The two halves cover a distance of three: one of them has a distance of one at most.
BITS = 3
#: Members of a cell that are compared at once; larger cells are split by their bits.
CROWD = 4096
#: Rows of whole cells compared at once, links held before they are reduced to a forest, shingles counted at once.
CHUNK, HELD, COUNTED = 500_000, 1_000_000, 1 << 17

_ODD_BITS = np.uint64(0x5555555555555555)
_HALF = np.uint64(0xFFFFFFFF)
#: Six blocks of bits, as masks.
_BLOCKS = [np.uint64(((1 << w) - 1) << s) for w, s in zip((11, 11, 11, 11, 10, 10), (0, 11, 22, 33, 44, 54), strict=True)]


def one_blank(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one blank after each, and their starts and ends there."""
    data = words.data.copy()
    keep = np.zeros(len(data) + 1, np.int8)
    keep[words.starts] += 1
    keep[words.ends] -= 1
    keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    # adjacent words of two texts have no blank between; no shingle crosses them
    blanks = words.ends[words.ends < len(data)]
    blanks = blanks[~keep[blanks]]
    data[blanks], keep[blanks] = 0x20, True
    gone = np.concatenate(([0], np.cumsum(~keep)))
    return data[keep].tobytes(), words.starts - gone[words.starts], words.ends - gone[words.ends]


def simhashes(words: Words, size: int) -> np.ndarray:
    """The fingerprint of each text: a bit is set that is set in over half the hashes of its shingles, repeats included."""
    text, starts, ends = one_blank(words)
    first, counts = words.first, words.counts
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    totals, digest = np.zeros((len(counts), 64), np.int64), xxhash.xxh64_intdigest
    owner = np.repeat(np.arange(len(counts)), shingles)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first[owner]
    begin, end = starts[place], ends[np.minimum(place + size, first[owner + 1]) - 1]
    for at in range(0, len(owner), COUNTED):
        part = slice(at, at + COUNTED)
        spans = zip(begin[part].tolist(), end[part].tolist(), strict=True)
        hashes = np.fromiter((digest(text[s:e], SEED) for s, e in spans), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        mine = owner[part]
        heads = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
        totals[mine[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    over = np.packbits(2 * totals > shingles[:, None], axis=1, bitorder="little")
    return over.view("<u8").reshape(-1).astype(np.uint64)


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            prints = simhashes(words_of(piece.column("text"), lower=True), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(prints)], ["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, print): the 64 bits of each row's text as a bigint; a text without words has zero."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_fingerprints(size), "doc_id bigint, print bigint")


def segment_counts(prints: np.ndarray) -> np.ndarray:
    """The popcounts of the 32 segments of two bits, two bits each."""
    return prints - ((prints >> np.uint64(1)) & _ODD_BITS)


def cells(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, row, at home): the cells of each fingerprint in both halves."""
    counts, every = segment_counts(prints), np.arange(len(prints))
    found = []
    for half in range(2):
        shift = np.uint64(32 * half)
        point, name = (counts >> shift) & _HALF, np.uint64(half << 32)
        found.append((point | name, every, np.ones(len(prints), bool)))
        even = np.flatnonzero(np.bitwise_count((prints >> shift) & _HALF) % 2 == 0)
        for k in range(16):
            unit = np.uint64(1 << (2 * k))
            held = (point[even] >> np.uint64(2 * k)) & np.uint64(3)
            for rows, step in ((even[held < 2], unit), (even[held > 0], ~unit + np.uint64(1))):
                found.append(((point[rows] + step) | name, rows, np.zeros(len(rows), bool)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def block_keys(cell: np.ndarray, prints: np.ndarray) -> list[np.ndarray]:
    """Keys of crowded members: two fingerprints of a cell that differ in three bits share a key.

    Three of six blocks are equal then. A key is a hash; what else falls under it costs a comparison and no more.
    """
    return [
        mix(cell * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) ^ mix(prints & (_BLOCKS[a] | _BLOCKS[b] | _BLOCKS[c]))
        for k, (a, b, c) in enumerate(combinations(range(6), 3), 1)
    ]


def forest(pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of the pairs, as stars: (smallest node, other node) of each group."""
    if not len(pairs):
        return pairs.reshape(-1, 2)
    names, ends = np.unique(pairs, return_inverse=True)
    ends = ends.reshape(-1, 2)
    top = np.arange(len(names))
    while True:
        one, two = top[ends[:, 0]], top[ends[:, 1]]
        apart = one != two
        if not apart.any():
            break
        ends, one, two = ends[apart], one[apart], two[apart]
        np.minimum.at(top, np.maximum(one, two), np.minimum(one, two))
        while (top[top] != top).any():
            top = top[top]
    moved = np.flatnonzero(top != np.arange(len(top)))
    return np.stack([names[top[moved]], names[moved]], 1)


def links_within(cell: np.ndarray, prints: np.ndarray, nodes: np.ndarray, home: np.ndarray, bits: int) -> np.ndarray:
    """A forest of the links between members of one cell, one of them at home. Rows are sorted by cell, homes first."""
    heads = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    end = np.repeat(np.append(heads[1:], len(cell)), np.diff(np.append(heads, len(cell))))
    at, step, found, size = np.flatnonzero(home), 0, [], 0
    while len(at):
        step += 1
        at = at[end[at] > at + step]
        near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= bits]
        if len(near):
            found.append(np.stack([nodes[near], nodes[near + step]], 1))
            size += len(near)
        if size > HELD:
            found = [forest(np.concatenate(found))]
            size = len(found[0])
    return forest(np.concatenate([*found, np.zeros((0, 2), np.int64)]))


_ROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cell", pa.int64()), ("print", pa.int64()), ("home", pa.bool_())])
_ROW_SQL = "a bigint, b bigint, cell bigint, print bigint, home boolean"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 20_000):
            part = batch.slice(k, 20_000)
            prints = part.column("print").to_numpy().view(np.uint64)
            cell, rows, home = cells(prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.view(np.int64)), part.column("print").take(pa.array(rows)),
                 part.column("node").take(pa.array(rows)), pa.array(home)], ["cell", "print", "node", "home"],
            )


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cell, prints = (batch.column(c).to_numpy().view(np.uint64) for c in ("cell", "print"))
        for key in block_keys(cell, prints):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column("print"), batch.column("node"), batch.column("home")],
                ["cell", "print", "node", "home"],
            )


def _compare(bits: int, crowd: int | None):
    """Links inside the cells of a sorted partition; cells of more than `crowd` members leave as they are, node in `a`."""

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        cell, prints, nodes, home = (rows.column(c).to_numpy() for c in ("cell", "print", "node", "home"))
        pairs = links_within(cell, prints.view(np.uint64), nodes, home, bits)
        nothing = [pa.nulls(len(pairs), f.type) for f in list(_ROW)[2:]]
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *nothing], schema=_ROW)

    def passed(part: pa.RecordBatch) -> pa.RecordBatch:
        nothing = pa.nulls(part.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [part.column("node"), nothing, part.column("cell"), part.column("print"), part.column("home")], schema=_ROW
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closed, held = [], 0  # whole cells to compare
        last, size, crowded = [], 0, None  # rows of the last cell, which may go on; the name of a cell that passes on
        for batch in (b for b in batches if b.num_rows):
            cell = batch.column("cell").to_numpy()
            if crowded is not None:
                skip = int(np.searchsorted(cell, crowded, side="right"))
                if skip:
                    yield passed(batch.slice(0, skip))
                batch, cell = batch.slice(skip), cell[skip:]
                if not len(cell):
                    continue
                crowded = None
            if last and last[0].column("cell")[0].as_py() != cell[-1]:
                # the held cell ends here; whole cells of the batch follow
                batch = pa.Table.from_batches([*last, batch]).combine_chunks().to_batches()[0]
                cell, last, size = batch.column("cell").to_numpy(), [], 0
            if not last:
                begin = int(np.searchsorted(cell, cell[-1]))
                whole, batch = batch.slice(0, begin), batch.slice(begin)
                if begin and crowd is not None:
                    heads = np.flatnonzero(np.concatenate(([True], cell[1:begin] != cell[: begin - 1])))
                    sizes = np.diff(np.append(heads, begin))
                    if (sizes > crowd).any():
                        large = np.repeat(sizes > crowd, sizes)
                        yield passed(whole.filter(pa.array(large)))
                        whole = whole.filter(pa.array(~large))
                if whole.num_rows:
                    closed.append(whole)
                    held += whole.num_rows
            last.append(batch)
            size += batch.num_rows
            if crowd is not None and size > crowd:
                yield from map(passed, last)
                crowded, last, size = int(cell[-1]), [], 0
            if held > CHUNK:
                yield links(closed)
                closed, held = [], 0
        if closed or last:
            yield links([*closed, *last])

    return run


def near_prints(classes: DataFrame, crowd: int = CROWD, bits: int = BITS) -> DataFrame:
    """Links (a, b) that tie together the nodes of `classes` (node, print) whose prints differ in `bits` bits or fewer.

    `bits` is three at most: that is the distance that the halves of the grid cover.
    """
    if not 0 <= bits <= BITS:
        raise ValueError(f"bits must be 0 to {BITS}")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("cell").sortWithinPartitions("cell", F.desc("home"))

    kind = "cell bigint, print bigint, node bigint, home boolean"
    compared = written(dealt(classes.select("node", "print").mapInArrow(_cells, kind)).mapInArrow(_compare(bits, crowd), _ROW_SQL), "simhash")
    crowds = compared.where("cell is not null").select("cell", "print", F.col("a").alias("node"), "home")
    split = dealt(crowds.mapInArrow(_split, kind)).mapInArrow(_compare(bits, None), _ROW_SQL)
    return compared.where("cell is null").select("a", "b").union(split.select("a", "b"))


def simhash_groups(docs: DataFrame, size: int = 3, bits: int = BITS) -> DataFrame:
    """One row per row of `docs` (doc_id bigint, text): doc_id, print, component_id.

    Texts are lower-cased (A-Z) and cut into words; shingles are `size` words, repeats included, or the whole sequence of
    a shorter text. A null text or one without words has print zero and is linked like any other. component_id is the
    smallest doc_id that links reach. Repeated rows share a component; a row without doc_id links nothing and has a null
    component_id. Further columns of `docs` are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    described = written(fingerprints(docs, size), "simhash-prints")
    named = described.where("doc_id is not null")
    classes = written(named.groupBy("print").agg(F.min("doc_id").alias("node")), "simhash-classes")
    # a doc_id should stand on one text; if it stands on several, it ties their classes together
    twice = named.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high")
    twice = named.join(twice.select("doc_id"), "doc_id", "left_semi").join(classes, "print").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    links = checkpointed(near_prints(classes, bits=bits).union(twice))
    groups = classes.join(components(links), "node", "left").select("print", F.coalesce("component", "node").alias("component_id"))
    return (
        described.join(groups, "print", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .select("doc_id", "print", "component_id")
    )
