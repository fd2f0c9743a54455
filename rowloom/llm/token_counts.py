"""Token counts for byte-level BPE vocabularies with word ends, by a whole-token shortcut.

Before any text is read, each vocabulary entry that ends a word is merged from its bytes; those
that come out as one token are proven whole. In the texts, a pre-token that is such an entry counts one, and
only the rest is merged. The proof depends on the vocabulary alone.

Strings of the vocabulary's special tokens inside a text count one each, as the library reads them.
NULL texts count like empty ones: no tokens. Texts are counted in whole; rows are independent.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Words a task remembers with their counts, about 170 bytes each; a full memory is emptied.
REMEMBERED = 1_200_000

#: Unicode white space, on which the vocabulary's normaliser splits.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_PLACES = 1 << 40  # an agenda entry is rank * _PLACES + place


@dataclass(frozen=True)
class Rules:
    """What counting needs to know; its size depends on the vocabulary only."""

    file: str
    ranks: dict[tuple[str, str], int]
    word_end: str
    specials: tuple[str, ...]
    whole: frozenset[str]


def merged(word: str, ranks: dict[tuple[str, str], int], word_end: str) -> list[str]:
    """Tokens of one pre-token: the pair of least rank first, leftmost among equals."""
    symbols = list(word)
    symbols[-1] += word_end
    end = len(symbols)
    left, right = list(range(-1, end - 1)), list(range(1, end + 1))
    agenda = [ranks[p] * _PLACES + i for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapify(agenda)
    while agenda:
        rank, i = divmod(heappop(agenda), _PLACES)
        j = right[i]
        if j == end or ranks.get((symbols[i], symbols[j])) != rank:
            continue  # one of the two has been merged meanwhile
        symbols[i] += symbols[j]
        symbols[j] = ""
        after = right[i] = right[j]
        if after < end:
            left[after] = i
            if (pair := (symbols[i], symbols[after])) in ranks:
                heappush(agenda, ranks[pair] * _PLACES + i)
        before = left[i]
        if before >= 0 and (pair := (symbols[before], symbols[i])) in ranks:
            heappush(agenda, ranks[pair] * _PLACES + before)
    return [s for s in symbols if s]


def read_rules(path: str) -> Rules:
    """The rules of a vocabulary file, with the proof of its whole tokens."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    spec = json.loads(text)
    model = spec["model"]
    word_end = model["end_of_word_suffix"] or ""
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ranks = {p: r for r, p in enumerate(pairs)}
    entries = (v.removesuffix(word_end) for v in model["vocab"] if v.endswith(word_end) and v != word_end)
    whole = frozenset(e for e in entries if len(merged(e, ranks, word_end)) == 1)
    specials = tuple(sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True))
    return Rules(text, ranks, word_end, specials, whole)


class Counter(dict):
    """Number of tokens of a word (a run without white space), worked out on first sight."""

    def __init__(self, rules: Rules):
        super().__init__()
        self.rules = rules
        tokenizer = Tokenizer.from_str(rules.file)
        self.normal, self.cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.words = re.compile(f"[^{SPACE}]+").findall
        self.special = re.compile("(" + "|".join(map(re.escape, rules.specials)) + ")") if rules.specials else None

    def __missing__(self, word: str) -> int:
        rules, n = self.rules, 0
        for token, _ in self.cut(self.normal(word)):
            n += 1 if token in rules.whole else len(merged(token, rules.ranks, rules.word_end))
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        n = 0
        if self.special and any(s in text for s in self.rules.specials):
            parts = self.special.split(text)
            n, text = len(parts) // 2, " ".join(parts[::2])
        return n + sum(map(self.__getitem__, self.words(text)))


_COUNTERS: dict[int, Counter] = {}


def _counter(rules: Rules) -> Counter:
    """One counter per worker process, kept from task to task."""
    key = hash(rules.file)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(rules)
    return _COUNTERS[key]


def count_tokens(df: DataFrame, text: str | Column, vocabulary_path: str, name: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens (long); a column of that name is replaced."""
    rules = df.sparkSession.sparkContext.broadcast(read_rules(vocabulary_path))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(rules.value)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return df.withColumn(name, tokens(F.col(text) if isinstance(text, str) else text))
