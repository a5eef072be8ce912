"""Token counts that follow edits.

A document's pre-tokens are the leaves of a segment tree whose nodes hold two sums: characters and tokens. An edit finds
its place by descending on the character sums, cuts only the touched region anew, from two pre-tokens before the change
until a cut falls on an old one behind it, and re-encodes the pre-tokens of this region alone. The total is the root.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clinweave.llm.vocab import Remembered, default_path, load_ranks, split_pattern
from clinweave.llm.words import pieces
from clinweave.session import ship_package

#: Pre-tokens per leaf block. Blocks are split and dropped by edits; the tree stands over blocks.
LEAF = 64


@lru_cache(maxsize=2)
def _counter(path: str) -> Remembered:
    """Tokens of a pre-token; kept for the worker's life."""
    import public_tokenizers
    import tiktoken

    coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    return Remembered(lambda piece: len(coder._encode_single_piece(piece)))


class PreTokenTree:
    """Text with its pre-tokens in leaf blocks and, above them, sums of characters and tokens."""

    def __init__(self, text: str, count, cut):
        self.count, self.cut, self.encoded = count, cut, 0
        words = cut.findall(text)
        self.blocks = [words[k : k + LEAF] for k in range(0, len(words), LEAF)] or [[]]
        self._build([self._sums(b) for b in self.blocks])
        self.encoded = 0

    def _sums(self, block: list[str]) -> tuple[int, int]:
        self.encoded += len(block)
        return sum(map(len, block)), sum(map(self.count.__getitem__, block))

    def _build(self, leaves: list[tuple[int, int]]) -> None:
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        tree = np.zeros((2 * self.width, 2), np.int64)
        tree[self.width : self.width + len(leaves)] = leaves
        level = self.width
        while level > 1:
            tree[level // 2 : level] = tree[level : 2 * level : 2] + tree[level + 1 : 2 * level : 2]
            level //= 2
        self.tree = tree

    def _update(self, block: int, sums: tuple[int, int]) -> None:
        node = self.width + block
        self.tree[node] = sums
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] + self.tree[2 * node + 1]

    @property
    def tokens(self) -> int:
        return int(self.tree[1, 1])

    @property
    def chars(self) -> int:
        return int(self.tree[1, 0])

    @property
    def text(self) -> str:
        return "".join(word for block in self.blocks for word in block)

    def find(self, place: int) -> tuple[int, int, int]:
        """Block, pre-token in it and first character of that pre-token, for the character at `place`."""
        node, before = 1, 0
        while node < self.width:
            left = int(self.tree[2 * node, 0])
            node, before = (2 * node, before) if place < before + left else (2 * node + 1, before + left)
        block = min(node - self.width, len(self.blocks) - 1)
        for k, word in enumerate(self.blocks[block]):
            if place < before + len(word):
                return block, k, before
            before += len(word)
        return block, len(self.blocks[block]), before

    def _back(self, block: int, word: int, first: int, steps: int) -> tuple[int, int, int]:
        while steps and (block or word):
            if word == 0:
                block -= 1
                word = len(self.blocks[block])
                continue
            word, steps = word - 1, steps - 1
            first -= len(self.blocks[block][word])
        return block, word, first

    def _follow(self, block: int, word: int) -> Iterator[tuple[int, int, str]]:
        while block < len(self.blocks):
            for k in range(word, len(self.blocks[block])):
                yield block, k, self.blocks[block][k]
            block, word = block + 1, 0

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from start to end."""
        if not 0 <= start <= end <= self.chars:
            raise ValueError("edit outside the text")
        # a match looks one character past its end, and a run of spaces one further: two pre-tokens back is enough
        block, word, first = self._back(*self.find(max(0, start - 1)), 2)
        top, skip = block, word
        old, at = [], first
        follow = self._follow(block, word)
        reach = 4
        while True:
            # take old pre-tokens until `reach` of them lie behind the change
            behind = 0
            for position in follow:
                old.append((*position, at))
                at += len(position[2])
                behind += old[-1][3] >= end
                if behind >= reach:
                    break
            ended = behind < reach
            held = "".join(w for _, _, w, _ in old)
            region = held[: start - first] + new + held[end - first :]
            shift = len(new) - (end - start)
            edges = {a + shift: k for k, (_, _, _, a) in enumerate(old) if a >= end}
            words, stop = [], None
            look = len(region) if ended else len(region) - len(old[-1][2])
            for found in self.cut.finditer(region):
                if found.start() and first + found.start() in edges and first + found.start() >= start + len(new):
                    stop = edges[first + found.start()]
                    break
                if found.end() >= look and not ended:
                    break
                words.append(found.group())
            if stop is not None or ended:
                break
            reach *= 4
        last = old[stop][:2] if stop is not None else (len(self.blocks) - 1, len(self.blocks[-1]))
        merged = self.blocks[top][:skip] + words + self.blocks[last[0]][last[1] :]
        fresh = [merged[k : k + LEAF] for k in range(0, len(merged), LEAF)] or [[]]
        self.encoded += len(words)
        keep = self.encoded
        sums = [self._sums(b) for b in fresh]
        self.encoded = keep
        if len(fresh) == last[0] - top + 1:
            self.blocks[top : last[0] + 1] = fresh
            for k, s in enumerate(sums):
                self._update(top + k, s)
        else:
            leaves = [tuple(x) for x in self.tree[self.width : self.width + len(self.blocks)].tolist()]
            leaves[top : last[0] + 1] = sums
            self.blocks[top : last[0] + 1] = fresh
            self._build(leaves)


def _apply(path: str):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("n_edits", pa.int64()),
        ("n_recoded", pa.int64()), ("n_tokens_after", pa.int64()), ("text_after", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, cut = _counter(path), split_pattern()
        for piece in pieces(batches):
            lines = []
            edits = piece.column("edits").to_pylist()
            for name, text, changes in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), edits, strict=True):
                text = text or ""
                tree = PreTokenTree(text, count, cut)
                before = tree.tokens
                wanted = [(e["start"], e["end"], e["new"] or "") for e in changes or [] if e is not None]
                wanted = [e for e in wanted if None not in e and 0 <= e[0] <= e[1] <= len(text)]
                done, limit = 0, len(text) + 1
                for start, end, new in sorted(wanted, reverse=True):  # from the back, so that places stay valid
                    if end <= limit:
                        tree.edit(start, end, new)
                        done, limit = done + 1, start
                lines.append((name, len(text), before, done, tree.encoded, tree.tokens, tree.text if done else text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([line[k] for line in lines], field.type) for k, field in enumerate(schema)], schema=schema
            )

    return run


def edited_counts(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """`docs` (doc_id bigint, text, edits array<struct<start, end, new>>): token counts before and after the edits.

    Returns doc_id, n_chars, n_tokens, n_edits (applied), n_recoded (pre-tokens encoded again), n_tokens_after and
    text_after. Edits name characters of the given text, end exclusive. Null edits and edits with null places, outside the text, or
    overlapping one that starts behind them are left out. Null text counts as empty, null edits as none, a null `new` as
    deletion. Rows are independent, so repeated rows and null ids need no care.
    """
    ship_package(docs.sparkSession)
    path = ranks or default_path("byte_bpe_50k.tiktoken")
    return docs.select("doc_id", "text", "edits").mapInArrow(
        _apply(path),
        "doc_id bigint, n_chars bigint, n_tokens bigint, n_edits bigint, n_recoded bigint, n_tokens_after bigint, text_after string",
    )


def _find_edits(pattern: str, new: str):
    import re

    wanted = re.compile(pattern)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("new", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = [
                [{"start": m.start(), "end": m.end(), "new": new} for m in wanted.finditer(text or "")]
                for text in piece.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(found, kind)], [*piece.schema.names, "edits"])

    return run


def with_edits(docs: DataFrame, pattern: str, new: str) -> DataFrame:
    """`docs` (doc_id, text) with one edit for every match of a pattern: what a masking step would change."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _find_edits(pattern, new), 'doc_id bigint, text string, edits array<struct<start:bigint,end:bigint,new:string>>'
    )
