"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets. An item's sketch holds, for each of SKETCH hash functions, the
shingle of least hash; a document that contains a share c of the item contains each of them with probability c, however
long it is, so short items are found inside long documents where a comparison of two signatures would see nothing. A
document is searched against a size class only if it has enough shingles to contain an item of that class; every item
of which it holds a sketch shingle is confirmed by exact containment of the full sets. Small items are sketched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.words import gram_hashes, mix, pieces, words_of
from clinweave.session import ship_package

#: Hash functions per item: at containment 0.8 all of them miss with probability 0.2 ** 16.
SKETCH = 16
#: Bytes of item sets that one pass over the documents may broadcast; more items take more passes.
BLOCK_BYTES = 64_000_000
_TABLE_BITS = 22


def _short(hashes: np.ndarray, size: int) -> np.ndarray:
    """Grams of fewer words than a shingle has, told apart from shingles by their size."""
    return mix((gram_hashes(hashes, size) + np.uint64(size)) * np.uint64(0xC2B2AE3D27D4EB4F))


def _item_sets(size: int):
    factors, masks = (mix(np.arange(k, 2 * SKETCH, 2, dtype=np.uint64)) | np.uint64(1) for k in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = words_of(piece.column("text"), lower=True)
            hashes = words.hashes()
            lines = []
            for name, begin, end in zip(piece.column("item_id").to_pylist(), words.first[:-1], words.first[1:], strict=True):
                n = int(end - begin)
                if not n or name is None:
                    continue
                grams = np.unique(gram_hashes(hashes[begin:end], size) if n >= size else _short(hashes[begin:end], n))
                least = np.unique([grams[np.argmin((grams ^ m) * f)] for f, m in zip(factors, masks, strict=True)])
                sketch = grams if len(grams) <= SKETCH else least
                lines.append((name, n if n < size else 0, grams.tobytes(), sketch.tobytes()))
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([line[k] for line in lines], kind) for k, kind in enumerate(kinds)],
                ["item_id", "short", "grams", "sketch"],
            )

    return run


class ItemIndex:
    """Sketches and sets of a block of items, by size class."""

    def __init__(self, rows, percent: int):
        self.names = np.array([r["item_id"] for r in rows], np.int64)
        self.sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
        self.short = sorted({r["short"] for r in rows} - {0})
        self.percent = percent
        sizes = np.array([len(s) for s in self.sets], np.int64)
        self.classes = []
        kinds = np.floor(np.log2(np.maximum(sizes, 1))).astype(int)
        for kind in np.unique(kinds):
            mine = np.flatnonzero(kinds == kind)
            sketches = [np.frombuffer(rows[k]["sketch"], np.uint64) for k in mine]
            values = np.concatenate(sketches)
            items = np.repeat(mine, [len(s) for s in sketches])
            order = np.argsort(values, kind="stable")
            values, items = values[order], items[order]
            table = np.zeros(1 << _TABLE_BITS, bool)
            table[values >> np.uint64(64 - _TABLE_BITS)] = True
            self.classes.append((-(-int(sizes[mine].min()) * percent // 100), values, items, table))

    def search(self, grams: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
        """Candidates (row, item) of documents' grams; `rows` says whose a gram is, `sizes` how many a row has."""
        found = []
        for least, values, items, table in self.classes:
            hits = np.flatnonzero(table[grams >> np.uint64(64 - _TABLE_BITS)])
            hits = hits[sizes[rows[hits]] >= least]
            low = np.searchsorted(values, grams[hits], side="left")
            high = np.searchsorted(values, grams[hits], side="right")
            hits, low, high = hits[high > low], low[high > low], high[high > low]
            count = high - low
            if not len(hits):
                continue
            at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            found.append(np.unique(np.stack([rows[np.repeat(hits, count)], items[at]], 1), axis=0))
        return [tuple(x) for part in found for x in part.tolist()]


def _search(index, size: int):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_item", pa.int64()), ("n_common", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: ItemIndex = index.value
        for piece in pieces(batches):
            words = words_of(piece.column("text"), lower=True)
            hashes = words.hashes()
            grams, rows = [], []
            ends = np.repeat(words.first[1:], words.counts)
            owner = np.repeat(np.arange(piece.num_rows), words.counts)
            for n in (size, *items.short):
                every = gram_hashes(hashes, n) if n == size else _short(hashes, n) if len(hashes) >= n else hashes[:0]
                whole = np.flatnonzero(np.arange(len(every)) + n <= ends[: len(every)])
                grams.append(every[whole])
                rows.append(owner[whole])
            order = np.argsort(np.concatenate(rows), kind="stable") if items.short else slice(None)
            grams, rows = np.concatenate(grams)[order], np.concatenate(rows)[order]
            first = np.searchsorted(rows, np.arange(piece.num_rows + 1))
            matches: list[list] = piece.column("matches").to_pylist()
            pairs = items.search(grams, rows, np.diff(first))
            sets: dict[int, np.ndarray] = {}
            for row, item in pairs:
                own = sets.get(row)
                if own is None:
                    sets = {row: np.unique(grams[first[row] : first[row + 1]])} if len(sets) > 1000 else sets
                    own = sets.setdefault(row, np.unique(grams[first[row] : first[row + 1]]))
                wanted = items.sets[item]
                at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                common = int((own[at] == wanted).sum())
                if 100 * common >= items.percent * len(wanted):
                    match = {"item_id": int(items.names[item]), "n_item": len(wanted), "n_common": common}
                    if match not in matches[row]:
                        matches[row].append(match)
            at = piece.schema.get_field_index("matches")
            yield piece.set_column(at, "matches", pa.array(matches, kind))

    return run


def find_items(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` (with a column text) and matches: array of (item_id, n_item, n_common), and contaminated: has a match. The two
    replace columns of that name.

    Words of `docs` and of `benchmark` (item_id, text) are lower-cased (A-Z). A document matches an item when it holds at
    least `percent` of the item's distinct shingles of `size` words, wherever they stand; an item of fewer words is one
    shingle of its own length. Items without id, text or words match nothing, nor do documents without text. Repeated
    items are reported once if their texts are equal, and once per text otherwise. All rows come back; an empty
    benchmark gives empty matches. The whole table of documents is read once for every block of items.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sets = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _item_sets(size), "item_id bigint, short int, grams binary, sketch binary"
    ).distinct()  # repeated items would all be dealt to one block
    weight = sets.agg(F.sum(F.octet_length("grams") + 512)).first()[0] or 0
    blocks = -(-weight // block_bytes)
    kind = "array<struct<item_id:bigint,n_item:bigint,n_common:bigint>>"
    docs = docs.drop("contaminated").withColumn("text", F.col("text").cast("string"))
    found = docs.withColumn("matches", F.array().cast(kind))
    for block in range(blocks):
        rows = sets.where(F.pmod(F.xxhash64("item_id", "grams"), F.lit(blocks)) == block).collect()
        if rows:
            index = spark.sparkContext.broadcast(ItemIndex(rows, percent))
            found = found.mapInArrow(_search(index, size), found.schema)
    return found.withColumn("contaminated", F.size("matches") > 0)
