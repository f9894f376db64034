"""Byte-level BPE ids of whole texts.

The ids are those of the tokenizers library for the vocabulary's JSON file.
Where its rank file lies beside it, texts are encoded by the tiktoken library
from that, which gives the same ids at several times the speed (a test compares
them over every code point); a text that spells out an added token, which only
the first library knows, is left to it.
"""

from __future__ import annotations

import base64
import json
import os

import numpy as np


class ByteEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            self.added = [a["content"] for a in json.load(f)["added_tokens"]]
        self.fast = None
        ranks = path.removesuffix(".json") + ".tiktoken"
        if path.endswith(".json") and os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding(os.path.basename(ranks), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.fast is None or any(a in text for a in self.added):
            return self.exact(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


_SHARED: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One encoder for each worker process and file."""
    if path not in _SHARED:
        _SHARED[path] = ByteEncoder(path)
    return _SHARED[path]


def by_bytes(data: list[bytes], most: int = 2_000_000):
    """Slices of data of about so many bytes."""
    at = 0
    while at < len(data):
        end, size = at, 0
        while end < len(data) and (end == at or size + len(data[end]) <= most):
            size += len(data[end])
            end += 1
        yield at, end
        at = end
