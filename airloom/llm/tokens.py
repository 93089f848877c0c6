"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa

CHARS_AT_ONCE = 4 << 20
LONG_RUN = 100_000  # blanks in a row; tiktoken's pattern fails on some 1,000,000
_BLANKS = re.compile(r"\s\s+")


def default_vocabulary() -> str:
    """The byte-level BPE of 50k ids as ranks: strings of special tokens are ordinary text."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenizer_file() -> str:
    """The same vocabulary as its tokenizers file: ids as that library gives them, also of special tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts by ``vocabulary``: a rank file, or the tokenizers file that lies beside it.

    tiktoken gives the ids where both libraries agree, the tokenizers library
    those of texts with a special token's string (if the vocabulary is its
    file) or a very long run of blanks.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        self.vocabulary, self.base = vocabulary, vocabulary.rsplit(".", 1)[0]
        with open(f"{self.base}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special: list[str] = []
        if vocabulary.endswith(".json"):
            with open(vocabulary, encoding="utf-8") as f:
                self.special = [t["content"] for t in json.load(f)["added_tokens"]]

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(f"{self.base}.json")
        t.encode_special_tokens = not self.vocabulary.endswith(".json")
        return t

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or (len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in _BLANKS.finditer(text))):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast(text)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.encode(text), dtype="<u4")

    def count(self, text: str) -> int:
        return len(self.encode(text))


@cache
def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(vocabulary)


def parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a string column in parts of bounded size; null counts as empty."""
    part, start, size = [], 0, 0
    for i, x in enumerate(column):
        t = x.as_py() or ""
        part.append(t)
        size += len(t)
        if size >= CHARS_AT_ONCE:
            yield start, part
            part, start, size = [], i + 1, 0
    if part:
        yield start, part
