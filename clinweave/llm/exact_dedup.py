"""Exact duplicates through Patricia tries.

Texts are dealt out by byte length and content hash. Each owner task inserts whole byte strings into compressed radix
tries, one per length; a terminal node keeps the smallest and largest identifier and the number of rows. A task whose
tries outgrow their budget spills its largest subtree: the entries go to a written table and through the next round's
shuffle, which deals them anew, so memory stays bounded and no entry is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.shared import written
from clinweave.llm.words import pieces
from clinweave.session import ship_package

#: Bytes of text that the tries of one task, or the pre-aggregation before the shuffle, may hold.
TRIE_BYTES = 128_000_000

_ENTRY = "length bigint, digest binary, bytes binary, least bigint, most bigint, n_rows bigint, round int"
_ARROW = pa.schema([
    ("length", pa.int64()), ("digest", pa.binary()), ("bytes", pa.binary()), ("least", pa.int64()),
    ("most", pa.int64()), ("n_rows", pa.int64()), ("round", pa.int32()),
])


def _least(one, two):
    return two if one is None else one if two is None else min(one, two)


def _most(one, two):
    return two if one is None else one if two is None else max(one, two)


class _Node:
    __slots__ = ("edge", "held", "below")

    def __init__(self, edge: bytes):
        self.edge, self.held, self.below = edge, None, {}


def _common(one: bytes, two: bytes, at: int) -> int:
    """Length of the common prefix of `one` and two[at:]."""
    most = min(len(one), len(two) - at)
    if one[:most] == two[at : at + most]:
        return most
    low, high = 0, most
    while high - low > 1:
        middle = (low + high) // 2
        if one[low:middle] == two[at + low : at + middle]:
            low = middle
        else:
            high = middle
    return low + (one[low] == two[at + low])


class PatriciaTrie:
    """Byte strings with (smallest id, largest id, rows) at their terminal nodes. Edges hold whole runs of bytes."""

    def __init__(self):
        self.root, self.size = _Node(b""), 0

    def insert(self, key: bytes, least, most, rows: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.below.get(key[at])
            if child is None:
                child = node.below[key[at]] = _Node(key[at:])
                self.size += len(child.edge)
                node, at = child, len(key)
                break
            shared = _common(child.edge, key, at)
            if shared < len(child.edge):
                upper = _Node(child.edge[:shared])
                child.edge = child.edge[shared:]
                upper.below[child.edge[0]] = child
                node.below[key[at]] = child = upper
            node, at = child, at + shared
        kept = node.held
        node.held = (least, most, rows) if kept is None else (_least(kept[0], least), _most(kept[1], most), kept[2] + rows)

    def entries(self, top: _Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, tuple]]:
        stack = [(top or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            prefix += node.edge
            if node.held is not None:
                yield prefix, node.held
            stack += [(child, prefix) for child in node.below.values()]

    def give_up(self) -> list[tuple[bytes, tuple]]:
        """Take the largest subtree below the root out of the trie; its entries."""
        weights = {first: self._weight(child) for first, child in self.root.below.items()}
        first = max(weights, key=weights.get)
        self.size -= weights[first]
        return list(self.entries(self.root.below.pop(first)))

    @staticmethod
    def _weight(top: _Node) -> int:
        total, stack = 0, [top]
        while stack:
            node = stack.pop()
            total += len(node.edge)
            stack += node.below.values()
        return total


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    size, start = 0, 0
    for k, row in enumerate(rows):
        size += len(row[2] or b"")
        if size > 16_000_000 or k == len(rows) - 1:
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r, strict=True)) for r in rows[start : k + 1]], _ARROW)
            size, start = 0, k + 1


def _gather(budget: int):
    """One entry per distinct text of a partition, or of a stretch of it that fills the budget."""

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        yield from _batches([(len(k), hashlib.sha256(k).digest(), k, *v, 0) for k, v in held.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for piece in pieces(batches):
            texts = piece.column("text").cast(pa.binary()).to_pylist()
            for key, name in zip(texts, piece.column("doc_id").to_pylist(), strict=True):
                key = key or b""
                kept = held.get(key)
                if kept is None:
                    held[key] = (name, name, 1)
                    size += len(key)
                else:
                    held[key] = (_least(kept[0], name), _most(kept[1], name), kept[2] + 1)
            if size > budget:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)

    return run


def _own(budget: int, last_round: int):
    """Merge entries in tries. Finished entries leave without their bytes; given-up ones keep them, with a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[int, PatriciaTrie] = {}
        for piece in pieces(batches, "bytes"):
            for row in piece.to_pylist():
                trie = tries.setdefault(row["length"], PatriciaTrie())
                trie.insert(row["bytes"], row["least"], row["most"], row["n_rows"])
            size = sum(t.size for t in tries.values())
            while size > budget:
                largest = max(tries.values(), key=lambda t: t.size)
                if size == largest.size and len(largest.root.below) == 1 and not next(iter(largest.root.below.values())).below:
                    break  # one text alone is over the budget; it can only be finished here
                gone = largest.give_up()
                yield from _batches([(len(k), hashlib.sha256(k).digest(), k, *v, last_round + 1) for k, v in gone])
                size = sum(t.size for t in tries.values())
        done = [(n, hashlib.sha256(k).digest(), None, *v, last_round) for n, t in tries.items() for k, v in t.entries()]
        yield from _batches(done)

    return run


def exact_owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: length, digest (SHA-256 of its bytes), least and most doc_id, n_rows."""
    spark = docs.sparkSession
    ship_package(spark)
    entries = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_gather(trie_bytes), _ENTRY)
    finished, turn = None, 0
    while True:
        # every round deals differently, so that what one task gave up spreads over all; a text's entries still meet
        dealt = entries.repartition(F.xxhash64("length", "digest", F.lit(turn)))
        merged = written(dealt.mapInArrow(_own(trie_bytes, turn), _ENTRY), "tries")
        done = merged.where("bytes is null")
        finished = done if finished is None else finished.unionByName(done)
        entries = merged.where("bytes is not null")
        if entries.isEmpty():
            break
        turn += 1
    columns = ("length", "digest", "least", "most", "n_rows")
    if not turn:
        return finished.select(*columns)
    # a subtree given up early may have left a twin that finished: add the parts up
    return finished.groupBy("length", "digest").agg(
        F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n_rows").alias("n_rows")
    )


def exact_duplicates(docs: DataFrame, keep: str = "smallest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Every row of `docs` (doc_id bigint, text) with keep_id, group_size, kept and text_sha256.

    Texts are equal when their bytes are; a null text counts as empty, so all null and empty texts are one group.
    Of a group, the row with the smallest (or `keep="largest"`) doc_id stays. Rows without doc_id are counted but never
    stay unless the whole group has none; then keep_id is null and all of them are kept. Repeated rows of the id that
    stays are all kept: they cannot be told apart. Further columns are passed through if they do not clash with the four.
    """
    owner = {"smallest": "least", "largest": "most"}[keep]
    owners = exact_owners(docs, trie_bytes).select(
        F.col("length").alias("_length"), F.lower(F.hex("digest")).alias("text_sha256"),
        F.col(owner).alias("keep_id"), F.col("n_rows").alias("group_size"),
    )
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # only small columns are shuffled here; a hot text is one skewed key that AQE splits
    rows = docs.drop("keep_id", "group_size", "kept", "text_sha256").withColumns(
        {"_length": F.octet_length(body).cast("bigint"), "text_sha256": F.sha2(body, 256)}
    )
    return (
        rows.join(owners, ["_length", "text_sha256"]).drop("_length")
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()))
    )


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of `docs` that `exact_duplicates` keeps, with their columns."""
    marked = exact_duplicates(docs.select("doc_id", "text"), keep)
    gone = marked.where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    body = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (body == F.col("_sha")), "left_anti")
