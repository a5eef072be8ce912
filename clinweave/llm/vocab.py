"""Access to the vocabulary files of public tokenizers. The path is a parameter everywhere; nothing is copied."""

from __future__ import annotations

import base64
import re
from functools import lru_cache


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern():
    """The compiled pattern that cuts a text into pre-tokens."""
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


#: The same cuts for texts of usual characters, whose letters, digits and blanks are few enough to name. Letters and
#: digits cannot start like the endings after an apostrophe, so they may be tried first.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_USUAL_PATTERN = re.compile(
    rf" ?[{_LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^ \n{_LETTERS}0-9]+|[ \n]+(?![^ \n])|[ \n]+"
)
_UNUSUAL = re.compile("[^\\n\\x20-\\x7e\\u00c0-\\u024f]")


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Longer keys are not remembered, so that memory stays bounded whatever the texts hold.
KEY_LENGTH = 64


class Remembered(dict):
    """A dict that fills itself by `make`. At `limit` keys it starts anew and takes over what is still asked for."""

    def __init__(self, make, limit: int = 300_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(key) > KEY_LENGTH:
            return self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class TextCoder:
    """Ids of texts as little-endian bytes, each pre-token encoded on its own by `encode` (str to bytes) and remembered."""

    def __init__(self, encode, limit: int = 800_000):
        self.pieces = Remembered(encode, limit)
        self.every, self.usual = split_pattern().findall, _USUAL_PATTERN.findall

    def code(self, text: str) -> bytes:
        words = self.every(text) if _UNUSUAL.search(text) else self.usual(text)
        return b"".join(map(self.pieces.__getitem__, words))
