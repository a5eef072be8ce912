"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that a BPE encoding of this prefix can end with: the token
is a suffix of the prefix, and it is compatible with the last token of what stands before it. Two tokens are compatible
when merging their joint bytes by rank gives these two tokens back. So one table entry per byte holds the encodings of
all prefixes: text can be appended without redoing anything, a changed byte leaves the entries before it valid, and the
encoding is read by walking back from the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.vocab import Remembered, TextCoder, default_path, load_ranks
from clinweave.llm.words import pieces
from clinweave.session import ship_package


class PrefixCoder:
    """Encoder and decoder over the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], remember: int = 400_000):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._fits = Remembered(self._compatible, remember * 3 // 4 if remember > 300_000 else remember // 2)
        self._stands = Remembered(lambda token: self.merge(token) == [token], 60_000)

    def merge(self, text: bytes) -> list[bytes]:
        """Reference merge loop for short strings: join the adjacent pair of least rank until none is a token."""
        parts = [text[k : k + 1] for k in range(len(text))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b, -1), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            ranked = [r for r in ranked if r[0] >= 0]
            if not ranked:
                break
            _, k = min(ranked)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _compatible(self, pair: tuple[bytes, bytes]) -> bool:
        return self.merge(pair[0] + pair[1]) == list(pair)

    def last_tokens(self, text: bytes, table: list[bytes] | None = None) -> list[bytes]:
        """Last token of every prefix, table[k] for text[:k]; a table of a shorter prefix is carried on in place."""
        table = [b""] if table is None else table
        ranks, fits, stands = self.ranks, self._fits, self._stands
        for end in range(len(table), len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                token = text[start:end]
                if token in ranks and (fits[table[start], token] if start else stands[token]):
                    table.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}; the vocabulary lacks single bytes")
        return table

    def encode(self, text: bytes) -> list[int]:
        """Ids of one pre-token. A pre-token that is a token itself is that token."""
        whole = self.ranks.get(text)
        return [whole] if whole is not None else self.read(self.last_tokens(text))

    def read(self, table: list[bytes]) -> list[int]:
        ids, end = [], len(table) - 1
        while end:
            ids.append(self.ranks[table[end]])
            end -= len(table[end])
        return ids[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PrefixText:
    """An editable pre-token with its prefix table. `append` and `edit` keep what stands before the change."""

    def __init__(self, coder: PrefixCoder, text: bytes = b""):
        self.coder, self.text, self.table = coder, text, coder.last_tokens(text)

    def append(self, more: bytes) -> None:
        self.text += more
        self.coder.last_tokens(self.text, self.table)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace text[start:end]. Returns how many table entries were computed again.

        After the change, entries are taken over as soon as a stretch as long as the longest token came out equal.
        """
        old, tail = self.table, self.text[end:]
        self.text = self.text[:start] + new + tail
        shift = start + len(new) - end
        table = old[: start + 1]
        done = equal = 0
        while len(table) <= len(self.text):
            here = len(table)
            self.coder.last_tokens(self.text[:here], table)
            done += 1
            before = here - shift
            equal = equal + 1 if before > end and old[before] == table[here] else 0
            if equal >= self.coder.longest and here - self.coder.longest >= start + len(new):
                table += old[before + 1 :]
        self.table = table
        return done

    @property
    def ids(self) -> list[int]:
        return self.coder.read(self.table)


@lru_cache(maxsize=1)
def _coder(path: str, remember: int) -> tuple[PrefixCoder, TextCoder]:
    """The coder, and the coder of texts that remembers its pre-tokens; kept for the worker's life."""
    coder = PrefixCoder(load_ranks(path), remember)
    return coder, TextCoder(lambda word: np.array(coder.encode(word.encode()), "<u4").tobytes(), limit=remember)


def _digests(path: str, remember: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, texts = _coder(path, remember)
        for piece in pieces(batches):
            ids, decoded = [], []
            for text in piece.column("text").to_pylist():
                coded = texts.code(text or "")
                ids.append(coded)
                decoded.append(coder.decode(np.frombuffer(coded, "<u4").tolist()))
            rest = [piece.column(k) for k in range(piece.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                [*piece.schema.names, "token_ids", "decoded"],
            )

    return run


def encode_decode(
    docs: DataFrame, ranks: str | None = None, digest: bool = False, remember: int = 400_000
) -> DataFrame:
    """`docs` (doc_id, text) with n_tokens and token_ids (little-endian unsigned 32-bit) and decoded (bytes).

    A null text counts as empty: no ids, no bytes. With `digest`, the two are given as ids_sha256 and decoded_sha256 and
    only those leave the Python workers. `remember` bounds the pre-tokens whose ids a worker keeps, some 200 bytes each.
    """
    ship_package(docs.sparkSession)
    path = ranks or default_path("byte_bpe_multi_50k.tiktoken")
    docs = docs.select("doc_id", "text")
    if not digest:
        coded = docs.mapInArrow(_digests(path, remember), "doc_id bigint, text string, token_ids binary, decoded binary")
        return coded.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("bigint"))
    return docs.mapInArrow(
        _hashed(path, remember), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _hashed(path: str, remember: int):
    inner = _digests(path, remember)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in inner(batches):
            ids = [x.as_buffer() for x in batch.column("token_ids")]
            decoded = [x.as_buffer() for x in batch.column("decoded")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x.size // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(x).hexdigest() for x in decoded])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run
