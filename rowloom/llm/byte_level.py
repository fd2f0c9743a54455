"""Byte-level BPE vocabularies (tokenizers' JSON files), encoded at tiktoken's speed.

Both libraries merge the pair of least rank first. Ranks are token ids here, which is the same order if the ids of
merged tokens rise with their merges; that is checked for every file that is read.
"""

from __future__ import annotations

import json

import numpy as np
import tiktoken

#: Fixed value: how byte-level vocabularies cut texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_character() -> dict[str, int]:
    """The byte each character of an entry stands for: printable Latin-1 is itself, the rest follows from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A vocabulary file, ready to encode."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model, rule = spec["model"], spec["pre_tokenizer"]
        if rule["type"] != "ByteLevel" or rule["add_prefix_space"] or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("only plain byte-level vocabularies are read")
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        to_byte = byte_of_character()
        entries = {bytes(map(to_byte.__getitem__, token)): i for token, i in model["vocab"].items() if token not in specials}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("ids do not rise with the merges")
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=entries, special_tokens=specials)
        self.tokens = {i: token for token, i in entries.items()}
        self.lengths = np.zeros(max([*self.tokens, *specials.values()]) + 1, np.int64)
        for i, token in self.tokens.items():
            self.lengths[i] = len(token)

    def encode(self, text: str) -> np.ndarray:
        """Ids; strings of special tokens inside the text are special tokens, as the library's default has it."""
        return self.encoding.encode_to_numpy(text, allowed_special="all")

    def encode_plain(self, text: str) -> np.ndarray:
        """Ids; strings of special tokens are text like any other."""
        return self.encoding.encode_to_numpy(text, disallowed_special=())


_READ: dict[int, ByteLevel] = {}


def byte_level(file: str) -> ByteLevel:
    """One per worker process, kept from task to task."""
    key = hash(file)
    if key not in _READ:
        _READ.clear()
        _READ[key] = ByteLevel(file)
    return _READ[key]
