"""Token ids of a public byte-level vocabulary, equal to those of its ``tokenizers`` file.

The rank file of the same vocabulary is several times faster; texts that hold
one of the file's special strings, and texts that the fast path refuses, are
encoded with the ``tokenizers`` file itself.
"""

from __future__ import annotations

import base64
import functools
import json
import os

import numpy as np


class Tokenizer:
    """``encode(text)`` gives the ids as unsigned 32-bit values, without special tokens added."""

    def __init__(self, tokenizer_file: str, rank_file: str, pattern: str):
        import tiktoken

        self._file = tokenizer_file
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        with open(tokenizer_file, encoding="utf-8") as f:
            self._special = [x["content"] for x in json.load(f).get("added_tokens", ())]
        size = max(ranks.values()) + 1
        #: which ids end a sentence
        self.ends = np.zeros(max(size, 1 << 16), dtype=bool)
        for token, rank in ranks.items():
            self.ends[rank] = token.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?", b"\n")

    @functools.cached_property
    def _exact(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer as Reference

        return Reference.from_file(self._file)

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self._special):
            return self.encode_exact(text)
        try:
            return self._fast.encode_to_numpy(text, disallowed_special=())
        except (ValueError, RuntimeError):
            return self.encode_exact(text)

    def encode_exact(self, text: str) -> np.ndarray:
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@functools.lru_cache(maxsize=4)
def tokenizer(tokenizer_file: str, rank_file: str, pattern: str) -> Tokenizer:
    """One tokenizer per worker process and vocabulary."""
    return Tokenizer(tokenizer_file, rank_file, pattern)
