"""Byte-pair encoding with a rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import tiktoken

# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Texts to little-endian token ids of two bytes, one text at a time."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.size = max(table.values()) + 1
        if self.size >= 1 << 16:
            raise ValueError("ids, and one more for the end mark, must fit two bytes")
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()

    def batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; none for null."""
        for text in texts:
            yield self.whole(text) if text else b""
