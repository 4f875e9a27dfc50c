"""Byte-level BPE inside tasks: vocabularies read from files, whole texts to ids and back.

A vocabulary is read from a path on each worker, once per process (the public files are part of every
worker's Python environment); nothing is broadcast.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import regex
import tiktoken

# Fixed value: the pattern that splits text before merges, as public byte-level vocabularies define it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Ids as they travel and are written: little-endian unsigned 32-bit integers.
ID_TYPE = np.dtype("<u4")

# The characters byte-level vocabularies in JSON print as themselves; all other bytes are moved up by 256.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _byte_of_char() -> dict[str, int]:
    printed = set(_PRINTED)
    moved = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(moved)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a ``.tiktoken`` rank file or the vocabulary of a ``.json`` file.

    In vocabularies of this family the id of a token is its merge rank. Special tokens of a JSON file are
    left out: their strings in a text are ordinary text.
    """
    if not path.endswith(".json"):
        with open(path, "rb") as file:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {entry["content"] for entry in content.get("added_tokens", ())}
    byte = _byte_of_char()
    return {
        bytes(byte[c] for c in token): rank
        for token, rank in content["model"]["vocab"].items()
        if token not in special
    }


class Vocabulary:
    """Ranks of one file: encoder of texts and of single pre-tokens, table of token bytes."""

    def __init__(self, path: str, pattern: str = PATTERN):
        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.core = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.token_bytes = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null is the empty text.

        The library's own splitter gives up on white space of millions of characters; such texts are split
        by the same pattern here and encoded one pre-token at a time.
        """
        if not text:
            return np.empty(0, ID_TYPE)
        try:
            return np.frombuffer(self.core.encode_to_tiktoken_buffer(text, set()), ID_TYPE)
        except BaseException as error:  # its panics are no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
        pieces = self.pattern.finditer(text)
        return np.array([i for p in pieces for i in self.core.encode_single_piece(p[0].encode())], ID_TYPE)

    def decode(self, ids: np.ndarray) -> bytes:
        """The raw bytes of the tokens, concatenated."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
