"""Token ids as files of Simple-8b blocks, in ascending document order.

A file set is a Parquet folder whose rows are blocks: shard and block number, the id offset of the block within its
shard, the documents in it (ids and token counts), the packed words and the escapes. A block holds whole documents and
about BLOCK_IDS ids, more only for one longer document. Shards follow the order of doc_id, so the position of any
document is its shard's offset, its block's and its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinweave.llm.shared import table_path
from clinweave.llm.simple8b import pack, unpack
from clinweave.llm.vocab import TextCoder, default_path, load_tokenizer
from clinweave.llm.words import pieces
from clinweave.session import ship_package

BLOCK_IDS = 1 << 16
END_ID = 2

_BLOCK = (
    "shard int, block int, first_id bigint, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, words binary, "
    "escape_at array<bigint>, escape_ids array<decimal(20,0)>"
)
_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("words", pa.binary()),
    ("escape_at", pa.list_(pa.int64())), ("escape_ids", pa.list_(pa.decimal128(20, 0))),
])


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def _coder(path: str) -> Callable[[str], bytes]:
    """Ids by the library's model; what it has encoded is kept for the worker's life."""
    tokenizer = load_tokenizer(path)
    tokenize, letters = tokenizer.model.tokenize, _byte_letters()
    coded = [k.to_bytes(4, "little") for k in range(tokenizer.get_vocab_size())]

    blank = letters[0x20]

    def ids(piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            written = piece.replace(" ", blank)
        else:
            written = piece.encode().decode("latin-1").translate(letters)
        return b"".join([coded[t.id] for t in tokenize(written)])

    every, marks = TextCoder(ids).code, [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def code(text: str) -> bytes:
        if any(mark in text for mark in marks):  # an added token cuts the text before pre-tokens do
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return every(text)

    return code


def _block(shard: int, block: int, first: int, names: list, coded: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(coded), "<u4")
    words, at, large = pack(ids)
    row = (shard, block, first, len(ids), names, [len(c) // 4 for c in coded], words.astype("<u8").tobytes(), at.tolist(),
           [Decimal(int(x)) for x in large])
    return pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, row, strict=True))], _ARROW)


def _encode(path: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _coder(path)
        end = end_id.to_bytes(4, "little")
        shard, block, first, size = TaskContext.get().partitionId(), 0, 0, 0
        names, coded = [], []
        for piece in pieces(batches):
            for name, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                ids = code(text or "") + end
                count = len(ids) // 4
                if size and size + count > block_ids:
                    yield _block(shard, block, first, names, coded)
                    block, first, size, names, coded = block + 1, first + size, 0, [], []
                names.append(name)
                coded.append(ids)
                size += count
        if names:
            yield _block(shard, block, first, names, coded)

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Encode `docs` (doc_id bigint, text) and write the file set to `path`, which must not exist.

    A null or empty text is the end id alone. Rows of one doc_id follow each other in text order; null ids come first.
    Texts of added tokens get their ids, as the library gives them. An empty table gives an empty file set.
    """
    ship_package(docs.sparkSession)
    vocabulary = tokenizer or default_path("byte_bpe_50k.json")
    (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(_encode(vocabulary, end_id, block_ids), _BLOCK)
        .write.option("compression", "lz4_raw").parquet(path)
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with first_id counted over all shards."""
    blocks = spark.read.schema(_BLOCK).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return blocks.join(F.broadcast(offsets), "shard").withColumn("first_id", F.col("first_id") + F.col("offset"))


def block_ids(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """All ids of one block."""
    words = np.frombuffer(batch.column("words")[row].as_buffer(), "<u8")
    at = np.array(batch.column("escape_at")[row].as_py(), np.int64)
    large = np.array([int(x) for x in batch.column("escape_ids")[row].as_py()], np.uint64)
    return unpack(words, at, large)


def _documents(ids_too: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = block_ids(batch, row)
                names = batch.column("doc_ids")[row].values
                counts = batch.column("counts")[row].values.to_numpy()
                ends = np.cumsum(counts)
                places = list(zip((ends - counts).tolist(), ends.tolist(), strict=True))
                columns = [names, pa.array(batch.column("first_id")[row].as_py() + ends - counts), pa.array(counts)]
                if ids_too:
                    whole = ids.astype(np.int64)
                    columns.append(pa.array([whole[a:b] for a, b in places], pa.list_(pa.int64())))
                else:
                    flat = memoryview(ids.astype("<u4").tobytes())
                    columns.append(pa.array([zlib.crc32(flat[4 * a : 4 * b]) for a, b in places], pa.int64()))
                last = "ids" if ids_too else "ids_crc32"
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", last])

    return run


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """One row per document of a file set: doc_id, start, n_tokens, and ids_crc32 or, with `ids`, the ids (below 2**63)."""
    ship_package(spark)
    last = "ids array<bigint>" if ids else "ids_crc32 bigint"
    return read_blocks(spark, path).mapInArrow(_documents(ids), f"doc_id bigint, start bigint, n_tokens bigint, {last}")


def tokens_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the file set of `docs` to the shared folder and read its documents back."""
    path = table_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)
