"""Repeated passages: a count-min prefilter, then exact groups of the windows that it cannot rule out.

A window is a run of `window` words. Each window is represented in the sketch by its anchor, the least hash among the
half-length grams inside it (the leftmost of equal ones): equal windows have equal anchors, so an anchor seen in one
document only rules out all its windows, and the sketch holds a dozenth of the entries. Partitions count anchors once
per document in their own sketches, which are merged cell range by cell range; merged counts are never too low.

Windows whose anchor may be repeated are grouped exactly by 128 bits of hash. Every stretch of a partition first settles
its own repeats and passes on one holder per distinct window, so a passage shared by a third of all documents reaches the
merging task once per stretch. The smallest doc_id that holds a window keeps it; all others lose its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.words import gram_hashes, mix, pieces, span_hashes, words_of
from clinweave.session import ship_package

#: The sketch is broadcast: at most 2 rows of 2**MAX_BITS cells of one bit, 128 MB. Beyond, it rules out less.
MAX_BITS = 29
MIN_BITS = 20
CHUNKS = 256
DEPTH = 2
#: Windows settled at once in a stretch of a partition.
STRETCH = 2_000_000
_NO_ID = np.iinfo(np.int64).max


def window_anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the least of `width` consecutive values, for each start; the leftmost of equal ones."""
    best, place, size = grams, np.arange(len(grams)), 1
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        take = right < left
        best, place = np.where(take, right, left), np.where(take, place[step:], place[:-step])
        size += step
    return place


def _windows(piece: pa.RecordBatch, window: int):
    """Of the windows of a piece: text row, first word, anchor position; and the anchors' and the words' hashes."""
    words = words_of(piece.column("text"))
    hashes = words.hashes()
    half = max(1, window // 2)
    starts = np.flatnonzero(np.arange(len(hashes)) + window <= np.repeat(words.first[1:], words.counts))
    if not len(starts):
        return words, hashes, starts, starts, starts, np.zeros(0, np.uint64)
    grams = gram_hashes(hashes, 1) if half == 1 else _grams(hashes, half)
    at = window_anchors(grams, window - half + 1)[starts]
    rows = np.searchsorted(words.first, starts, side="right") - 1
    return words, hashes, rows, starts, at, grams


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    begin = np.arange(len(hashes) - size + 1)
    return span_hashes(hashes, begin, begin + size, 0)


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(anchors ^ np.uint64(0x5BD1E995 * (row + 1))) >> np.uint64(64 - bits)


def _sketch(window: int, bits: int):
    """Sketch of one partition: per row and cell range, the cells touched and how often (up to 2)."""
    per_chunk = bits - int(CHUNKS).bit_length() + 1

    def emit(anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row in range(DEPTH):
            cells, counts = np.unique(_cells(anchors, row, bits), return_counts=True)
            cuts = np.searchsorted(cells >> np.uint64(per_chunk), np.arange(CHUNKS + 1, dtype=np.uint64))
            inside = (cells & np.uint64((1 << per_chunk) - 1)).astype("<u4")
            # cells hit once first, then those hit more often
            lines = []
            for chunk in range(CHUNKS):
                part = slice(cuts[chunk], cuts[chunk + 1])
                once = counts[part] == 1
                if len(once):
                    lines.append((row, chunk, inside[part][once].tobytes(), inside[part][~once].tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            columns = [pa.array([line[k] for line in lines], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "chunk", "once", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches):
            _, _, rows, _, at, grams = _windows(piece, window)
            if not len(rows):
                continue
            first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (rows[1:] != rows[:-1]))))
            anchors, rows = grams[at[first]], rows[first]
            order = np.lexsort((anchors, rows))
            anchors, rows = anchors[order], rows[order]
            new = np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])))
            held.append(anchors[new])
            size += int(new.sum())
            if size > STRETCH:
                yield from emit(np.concatenate(held))
                held, size = [], 0
        if held:
            yield from emit(np.concatenate(held))

    return run


def _merge_sketches(bits: int):
    """Add up the sketches of each cell range; one bit per cell: counted at least twice."""
    per_chunk = bits - int(CHUNKS).bit_length() + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                counts = held.setdefault((row["row"], row["chunk"]), np.zeros(1 << per_chunk, np.uint8))
                cells = np.frombuffer(row["once"], "<u4")
                counts[cells] = np.minimum(counts[cells] + 1, 2)
                counts[np.frombuffer(row["more"], "<u4")] = 2
        for (row, chunk), counts in held.items():
            yield pa.RecordBatch.from_pylist(
                [{"row": row, "chunk": chunk, "bits": np.packbits(counts >= 2, bitorder="little").tobytes()}],
                pa.schema([("row", pa.int32()), ("chunk", pa.int32()), ("bits", pa.binary())]),
            )

    return run


def repeated_anchors(docs: DataFrame, window: int, bits: int) -> np.ndarray:
    """The merged sketch as bits, one row per hash: cells that were counted at least twice."""
    merged = (
        docs.select("text").mapInArrow(_sketch(window, bits), "row int, chunk int, once binary, more binary")
        .repartition("row", "chunk").mapInArrow(_merge_sketches(bits), "row int, chunk int, bits binary")
    )
    table = np.zeros((DEPTH, CHUNKS, (1 << bits) // CHUNKS // 8), np.uint8)
    # at most 2**(MAX_BITS + 1) bits, whatever the input
    for row in merged.collect():
        table[row["row"], row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return table.reshape(DEPTH, -1)


def _may_repeat(anchors: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    may = np.ones(len(anchors), bool)
    for row in range(DEPTH):
        cells = _cells(anchors, row, bits)
        may &= (table[row][cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return may


_PART = pa.schema([
    ("bucket", pa.int32()), ("ids", pa.binary()), ("marks", pa.binary()), ("anchors", pa.binary()),
    ("windows", pa.binary()), ("owners", pa.binary()), ("starts", pa.binary()),
])
_PART_SQL = (
    "bucket int, ids binary, marks binary, anchors binary, windows binary, owners binary, starts binary"
)
_FLAGS = pa.schema([("_id", pa.int64()), ("_mark", pa.int64()), ("_starts", pa.binary())])


def _groups(anchors, windows, ids):
    """Sort order by window and id, and for each sorted row whether a smaller id holds the same window."""
    order = np.lexsort((ids, windows, anchors))
    a, w, d = anchors[order], windows[order], ids[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])))
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, d > least


def _settle(window: int, bits: int, sketch, buckets: int):
    """Repeats inside each stretch of a partition, and one holder of every distinct window for the merge.

    Rows with anchors hold windows to merge; rows without hold window starts already known to be repeats.
    """

    def settle(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids, marks, anchors, windows, starts = (np.concatenate(c) for c in zip(*columns, strict=True))
        order, repeat = _groups(anchors, windows, ids)
        gone, stay = np.sort(order[repeat]), np.sort(order[~repeat])
        bucket = (mix(anchors[stay]) % np.uint64(buckets)).astype(np.int32)
        by_bucket = np.argsort(bucket, kind="stable")
        bucket, stay = bucket[by_bucket], stay[by_bucket]
        parts = [(int(bucket[p[0]]), stay[p], True) for p in np.split(np.arange(len(stay)), np.flatnonzero(np.diff(bucket)) + 1) if len(p)]
        if len(gone):
            parts += [(k % buckets, p, False) for k, p in enumerate(np.array_split(gone, max(1, len(gone) // 50_000)))]
        lines, size = [], 0
        for number, rows, open_ in parts:
            who = np.flatnonzero(np.concatenate(([True], (ids[rows][1:] != ids[rows][:-1]) | (marks[rows][1:] != marks[rows][:-1]))))
            owner = np.repeat(np.arange(len(who)), np.diff(np.append(who, len(rows)))).astype("<u4")
            lines.append((
                number, ids[rows][who].tobytes(), marks[rows][who].tobytes(), anchors[rows].tobytes() if open_ else None,
                windows[rows].tobytes() if open_ else None, owner.tobytes(), starts[rows].astype("<u4").tobytes(),
            ))
            size += len(rows)
            if size > 200_000:
                yield pa.RecordBatch.from_pylist([dict(zip(_PART.names, x, strict=True)) for x in lines], _PART)
                lines, size = [], 0
        if lines:
            yield pa.RecordBatch.from_pylist([dict(zip(_PART.names, x, strict=True)) for x in lines], _PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, size = sketch.value, [], 0
        for piece in pieces(batches):
            words, hashes, rows, starts, at, grams = _windows(piece, window)
            if not len(rows):
                continue
            keep = _may_repeat(grams[at], table, bits)
            rows, starts, at = rows[keep], starts[keep], at[keep]
            if not len(rows):
                continue
            ids, marks = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_mark"))
            sums = span_hashes(hashes, starts, starts + window, 1)
            held.append((ids[rows], marks[rows], grams[at], sums, (starts - words.first[rows]).astype(np.int64)))
            size += len(rows)
            if size > STRETCH:
                yield from settle(held)
                held, size = [], 0
        if held:
            yield from settle(held)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated window starts of one bucket after the other (buckets arrive sorted)."""

    def flags(ids, marks, owners, starts):
        cuts = np.flatnonzero(np.diff(owners)) + 1 if len(owners) else []
        lines = []
        for part in np.split(np.arange(len(owners)), cuts):
            if len(part):
                who = owners[part[0]]
                lines.append((int(ids[who]), int(marks[who]), starts[part].astype("<u4").tobytes()))
        for k in range(0, len(lines), 10_000):
            yield pa.RecordBatch.from_pylist([dict(zip(_FLAGS.names, x, strict=True)) for x in lines[k : k + 10_000]], _FLAGS)

    def close(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        columns, base = [], 0
        for row in rows:
            ids, marks = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["marks"], np.int64)
            owners = np.frombuffer(row["owners"], "<u4").astype(np.int64)
            starts = np.frombuffer(row["starts"], "<u4")
            if row["anchors"] is None:
                yield from flags(ids, marks, owners, starts)
                continue
            anchors, windows = np.frombuffer(row["anchors"], np.uint64), np.frombuffer(row["windows"], np.uint64)
            columns.append((ids, marks, anchors, windows, owners + base, starts))
            base += len(ids)
        if columns:
            ids, marks, anchors, windows, owners, starts = (np.concatenate(c) for c in zip(*columns, strict=True))
            order, repeat = _groups(anchors, windows, ids[owners])
            gone = np.sort(order[repeat])
            yield from flags(ids, marks, owners[gone], starts[gone])

    bucket, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket and rows:
                yield from close(rows)
                rows = []
            bucket = row["bucket"]
            rows.append(row)
    if rows:
        yield from close(rows)


def _cut(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            lines = []
            flags = piece.column("flags").to_pylist()
            for name, text, starts in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), flags, strict=True):
                words = (text or "").encode().split()
                gone = 0
                if starts:
                    starts = np.frombuffer(b"".join(starts), "<u4").astype(np.int64)
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + window, -1)
                    covered = np.cumsum(cover[:-1]) > 0
                    gone = int(covered.sum())
                    kept = [word for word, out in zip(words, covered.tolist(), strict=True) if not out]
                else:
                    kept = words
                lines.append((name, len(words), gone, b" ".join(kept).decode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([line[k] for line in lines], field.type) for k, field in enumerate(schema)], schema=schema
            )

    return run


def dedup_substrings(docs: DataFrame, window: int = 50, bits: int | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id bigint, text): doc_id, n_words, n_removed, kept_text.

    A word goes when a window that covers it also starts in a document with a smaller doc_id; windows are judged on the
    input. Kept words are joined by one space. A null text has no words; texts below `window` words lose none. Rows
    without doc_id count as larger than all others, and repeated rows of one doc_id do not remove each other's words.
    `bits` is the width of the sketch as a power of two; by default eight cells per expected anchor, up to MAX_BITS.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if bits is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        bits = min(MAX_BITS, max(MIN_BITS, int(8 * size / (6 * window / 4)).bit_length()))
    sketch = spark.sparkContext.broadcast(repeated_anchors(docs, window, bits))
    keyed = docs.withColumns({
        "_id": F.coalesce("doc_id", F.lit(int(_NO_ID))),
        "_mark": F.xxhash64(F.col("doc_id").isNull(), F.coalesce("text", F.lit(""))),
    })
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    flags = (
        keyed.select("_id", "_mark", "text").mapInArrow(_settle(window, bits, sketch, buckets), _PART_SQL)
        .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge, "_id bigint, _mark bigint, _starts binary")
        .groupBy("_id", "_mark").agg(F.collect_list("_starts").alias("flags"))
    )
    return keyed.join(flags, ["_id", "_mark"], "left").select("doc_id", "text", "flags").mapInArrow(
        _cut(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
