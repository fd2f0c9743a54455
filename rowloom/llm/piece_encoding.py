"""Encoding and decoding with merge-type (BPE) sentencepiece vocabularies.

Texts are cut where no piece can reach across: before a run of word marks, and around line breaks if
no longer piece holds one. Both are read off the vocabulary, not assumed. Every distinct
cut is encoded by an agenda of adjacent symbol pairs, best score first and leftmost among
equals; characters that are no piece fall back to their bytes. Tasks remember what they
have encoded, up to a number of cuts, and hold each new cut of an Arrow batch against the
sentencepiece library, which must agree.

NULL texts are encoded like empty ones: the end id alone. Any text is encoded in whole; rows
are independent, so repeated rows give repeated results and an empty table an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

MARK = "▁"  # stands for a space inside pieces; here both are written as a space

#: Cuts a task remembers, about 250 bytes each; a full memory is emptied.
REMEMBERED = 600_000
#: Rows that leave a task together.
ROWS_AT_ONCE = 200

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"
ENCODED = "ids array<int>, decoded string"

_PLACES = 1 << 40  # an agenda entry is rank * _PLACES + place


class Vocabulary:
    """Pieces, ranks and bytes of a model file, and what follows from them."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        pieces = [p.replace(MARK, " ") for p in self.library.id_to_piece(list(range(size)))]
        special = [i for i in range(size) if self.library.is_control(i) or self.library.is_unknown(i)]
        in_bytes = [i for i in range(size) if self.library.is_byte(i)]
        plain = set(range(size)).difference(special, in_bytes)
        scores = {i: self.library.get_score(i) for i in plain}
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ids = {pieces[i]: i for i in plain}
        self.entries = {pieces[i]: order[scores[i]] * _PLACES for i in plain}
        self.byte_ids = {int(pieces[i][3:-1], 16): i for i in in_bytes}
        self.bytes = {i: pieces[i].encode() for i in plain} | {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.bytes |= {i: b"" for i in special if self.library.is_control(i)}
        self.end = str(self.library.eos_id())
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        longer = [p for p in self.ids if len(p) > 1]
        if any(" " in p.lstrip(" ") for p in longer):
            cuts = "(?s:.+)"
        elif any("\n" in p for p in longer):
            cuts = " *[^ ]+| +"
        else:
            cuts = " *[^ \n]+| +|\n+"
        self.cut = re.compile(cuts).findall

    def encode_cut(self, text: str) -> list[int]:
        """Ids of one cut: the agenda holds adjacent pairs that are pieces, the best score first."""
        entries, symbols, end = self.entries, list(text), len(text)
        left, right = list(range(-1, end - 1)), list(range(1, end + 1))
        agenda = [entries[pair] + i for i in range(end - 1) if (pair := text[i : i + 2]) in entries]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry % _PLACES
            j = right[i]
            if not symbols[i] or j == end or entries.get(pair := symbols[i] + symbols[j], -1) != entry - i:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = pair, ""
            after = right[i] = right[j]
            if after < end:
                left[after] = i
                if (longer := pair + symbols[after]) in entries:
                    heappush(agenda, entries[longer] + i)
            before = left[i]
            if before >= 0 and (longer := symbols[before] + pair) in entries:
                heappush(agenda, entries[longer] + before)
        found: list[int] = []
        for s in filter(None, symbols):
            if s in self.ids:
                found.append(self.ids[s])
            else:
                found.extend(self.byte_ids[b] for b in s.encode())
        return found

    def decode(self, ids: list[int]) -> str:
        """Text of ids; of a whole text, the first character is the space that encoding puts before it."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode(errors="replace")

    def agrees(self, cuts: list[str], ids: list[list[int]]) -> None:
        """Raises if the library encodes or decodes a cut in another way.

        The library puts a space before every text; a cut that does not start with one is
        asked for behind a line break.
        """
        asked = [c[1:] if c[0] == " " else "\n" + c for c in cuts]
        head = self.encode_cut(" ") + self.encode_cut("\n")
        found = self.library.encode(asked, num_threads=1)
        back = self.library.decode(found, num_threads=1)
        for c, own, theirs, text in zip(cuts, ids, found, back):
            expected = own if c[0] == " " else head + own
            if c == " ":  # its text is empty, for which the library has no ids
                continue
            if theirs != expected or self.decode(expected)[1:] != text:
                raise ValueError(f"the library encodes {c!r} as {theirs}, not as {expected}")


class Encoder:
    """Encodes texts and remembers the ids of their cuts, and their decoded text where it is another."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.known: dict[str, str] = {}
        self.other: dict[str, str] = {}

    def learn(self, batch: list[list[str]]) -> None:
        """Encodes and decodes what is new in a batch and has the library check it."""
        new = {c for cuts in batch for c in cuts if c not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            self.other.clear()
            new = {c for cuts in batch for c in cuts}
        cuts = list(new)
        ids = [self.vocabulary.encode_cut(c) for c in cuts]
        self.vocabulary.agrees(cuts, ids)
        for c, own in zip(cuts, ids):
            self.known[c] = " ".join(map(str, own))
            if (decoded := self.vocabulary.decode(own)) != c:
                self.other[c] = decoded

    def encoded(self, texts: list[str | None], limit: int = 1_000_000) -> Iterator[tuple[str, str]]:
        """Ids joined by a space, end id included, and the decoded text."""
        waiting: list[list[str]] = []
        size = 0
        for n, text in enumerate(texts, 1):
            waiting.append(self.vocabulary.cut(" " + text.replace(MARK, " ")) if text else [])
            size += len(text or "")
            if size > limit or n == len(texts):
                self.learn(waiting)
                for cuts in waiting:
                    ids = " ".join([*map(self.known.__getitem__, cuts), self.vocabulary.end])
                    yield ids, "".join(self.other.get(c, c) for c in cuts)[1:] if self.other else "".join(cuts)[1:]
                waiting, size = [], 0


_ENCODERS: dict[bytes, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    """One encoder per worker process, kept from task to task."""
    key = hashlib.sha256(model).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def model_bytes(path: str) -> bytes:
    """A model file; its size does not depend on the data."""
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, text: str, model_path: str, name: str = "encoded") -> DataFrame:
    """Adds a struct (ids array<int>, decoded string); a column of that name is replaced.

    Ids and texts leave the task a few rows at a time, however many rows come in at once.
    """
    if name == text:
        raise ValueError("the result would replace the text")
    df = df.drop(name)
    model = df.sparkSession.sparkContext.broadcast(model_bytes(model_path))
    schema = StructType([*df.schema.fields, StructField(name, StructType.fromDDL(ENCODED))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                rows = list(encoder.encoded(part.column(text).to_pylist()))
                ids = [np.fromstring(i, dtype=np.int32, sep=" ") for i, _ in rows]
                starts = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(ids)))
                pair = pa.StructArray.from_arrays([lists, pa.array([d for _, d in rows], pa.string())], names=["ids", "decoded"])
                yield pa.RecordBatch.from_arrays([*part.columns, pair], names=[*part.schema.names, name])

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, text: str | Column, model_path: str, name: str = "encoded") -> DataFrame:
    """Adds a struct of the number of ids and the SHA-256 of the ids and of the decoded text.

    The same encoding as `encode`, for checks that need not carry ids and texts out of the task.
    """
    model = df.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    @F.pandas_udf(RESULT)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model.value)
        for texts in batches:
            rows = [
                (ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                for ids, decoded in encoder.encoded(texts.tolist())
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.withColumn(name, digest(F.col(text) if isinstance(text, str) else text))
