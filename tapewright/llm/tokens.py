"""Byte-level BPE ids.  The vocabulary is a file; its path is a parameter."""

from __future__ import annotations

import base64
import functools
import json
import re

import numpy as np
import public_tokenizers
import tiktoken
import tokenizers

# An end of text, by the id that ends a document.
END = 0


@functools.cache
def byte_pairs(path: str | None = None) -> tiktoken.Encoding:
    """The encoder of a rank file, once per process; strings of special tokens are plain text."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _file(path: str | None) -> str:
    return path.removesuffix(".tiktoken") + ".json" if path else public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def _plain(path: str | None) -> tokenizers.Tokenizer:
    tokenizer = tokenizers.Tokenizer.from_file(_file(path))
    tokenizer.encode_special_tokens = True
    return tokenizer


@functools.cache
def _whole(path: str | None) -> tokenizers.Tokenizer:
    """The tokenizer as its file has it: some 30 MB, so it is loaded for a text with an added token only."""
    return tokenizers.Tokenizer.from_file(_file(path))


@functools.cache
def _added(path: str | None) -> re.Pattern[str] | None:
    """What finds an added token of the tokenizer's file (None: it has none)."""
    with open(_file(path), encoding="utf-8") as file:
        added = [re.escape(t["content"]) for t in json.load(file).get("added_tokens") or []]
    return re.compile("|".join(added)) if added else None


# A run of white space this long may exceed the stack of the fast encoder.
LONG_SPACE = re.compile(r"\s{100000}")


def encode(text: str | None, path: str | None = None) -> np.ndarray:
    """Ids of a whole text (NULL: none), with the fast encoder wherever it can."""
    text = text or ""
    if len(text) >= 100_000 and LONG_SPACE.search(text):
        return np.array(_plain(path).encode(text, add_special_tokens=False).ids, dtype="<u4")
    return np.array(byte_pairs(path).encode_ordinary(text), dtype="<u4")


def encode_added(text: str | None, path: str | None = None) -> np.ndarray:
    """As ``encode``, but a string of an added token is that token's id, as the tokenizer's file has it."""
    if text and (added := _added(path)) and added.search(text):
        return np.array(_whole(path).encode(text, add_special_tokens=False).ids, dtype="<u4")
    return encode(text, path)
