"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. At every level runs of one symbol become one symbol, deterministic coin tossing
gives neighbouring symbols small labels that depend on a few symbols to the left only, and the labels' local
maxima cut the sequence into phrases. A phrase's name is a hash of its symbols, and the names are the
next level's symbols. Equal substrings are therefore cut alike, but for a few phrases at their ends,
wherever they stand. A fingerprint is the SKETCH least names of a text, from level 2 (about a dozen characters) up; the
likeness of two fingerprints estimates the share of phrases that the texts have in common, exactly so for short texts.

NULL and empty texts have the empty fingerprint; two of these are alike (1), and unlike any other (0).
Equal texts have equal fingerprints. Texts are parsed in whole.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import row_hash
from rowloom.llm.superminhash import mix
from rowloom.sources.shared import materialize

SKETCH = 64
#: The first level whose names count; a text that has become one phrase before counts with that.
LEAST_LEVEL = 2
#: Characters parsed together.
AT_ONCE = 1_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def _starts(owner: np.ndarray) -> np.ndarray:
    """Where a new text begins."""
    first = np.ones(len(owner), dtype=bool)
    np.not_equal(owner[1:], owner[:-1], out=first[1:])
    return first


def _tossed(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which a symbol differs from its left neighbour, plus that bit of the symbol."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = x[first] ^ _ONE
    differing = x ^ before
    place = np.bitwise_count((differing & (~differing + _ONE)) - _ONE).astype(np.uint64)
    return (place << _ONE) | ((x >> place) & _ONE)


def _runs(x: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a symbol as one symbol that stands for symbol and length."""
    new = _starts(owner)
    new[1:] |= x[1:] != x[:-1]
    if new.all():
        return x, owner
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(x))).astype(np.uint64)
    x = x[at]
    return np.where(length > 1, mix(x ^ (length * _ODD)), x), owner[at]


def _cuts(x: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where phrases begin: at local maxima of the labels and at the beginning of a text."""
    first = _starts(owner)
    label = x
    for _ in range(3):  # 64 bits, then under 128, 14, 8
        label = _tossed(label, first)
    # a text's last symbol is no maximum: so every level has fewer phrases than symbols
    cut = first.copy()
    cut[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
    return np.flatnonzero(cut)


def phrases(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names and the texts they are from, repeated names included."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    x = mix(np.concatenate([np.zeros(0, np.uint32), *points]).astype(np.uint64))
    owner = np.repeat(np.arange(len(texts)), np.array([len(p) for p in points], dtype=np.int64))
    names, owners, level = [], [], 0
    while len(x):
        x, owner = _runs(x, owner)
        first = _starts(owner)
        alone = first & np.append(first[1:], True)
        kept = alone if level < LEAST_LEVEL else np.ones(len(x), dtype=bool)
        names.append(x[kept])
        owners.append(owner[kept])
        x, owner = x[~alone], owner[~alone]
        if not len(x):
            break
        at = _cuts(x, owner)
        place = np.arange(len(x)) - np.repeat(at, np.diff(np.append(at, len(x))))
        level += 1
        with np.errstate(over="ignore"):
            x = mix(np.add.reduceat(mix(x + place.astype(np.uint64) * _ODD), at) + np.uint64(level))
        owner = owner[at]
    return (np.concatenate(names), np.concatenate(owners)) if names else (x, owner)


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The least distinct names of each text, shortened to 32 bits."""
    names, owner = phrases(texts)
    order = np.lexsort((names, owner))
    names, owner = names[order] >> np.uint64(32), owner[order]
    new = _starts(owner)
    new[1:] |= names[1:] != names[:-1]
    names, owner = names[new], owner[new]
    begins = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [names[s : min(e, s + SKETCH)].astype(">u4") for s, e in zip(begins[:-1], begins[1:])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of the least names of both together, the share that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:SKETCH]
    return float((np.isin(both, a) & np.isin(both, b)).mean())


def edited(text: str, other: str) -> str:
    """A text whose last third is replaced by the beginning of another."""
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


_RESULT = (
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and order: each row with the one that follows it; guests only follow."""
    ids, texts, guests, size = [], [], [], 0
    block = None

    def done() -> pa.RecordBatch:
        rows = [i for i in range(len(texts) - 1) if not guests[i]]
        changed = [edited(texts[i], texts[i + 1]) for i in rows]
        own, new = sketches(texts), sketches(changed)
        hexed = [s.tobytes().hex() for s in own]
        out = [
            (len(texts[i]), hashlib.sha256(e.encode()).hexdigest(), hexed[i], s.tobytes().hex(), likeness(own[i], s), likeness(own[i], own[i + 1]))
            for i, e, s in zip(rows, changed, new)
        ]
        columns = [pa.array([ids[i] for i in rows], id_type)] + [pa.array([r[k] for r in out], t) for k, (_, t) in enumerate(_RESULT)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *(n for n, _ in _RESULT)])

    for batch in batches:
        id_type = batch.schema.field("doc_id").type
        for own_block, guest, doc, text in zip(*(batch.column(c).to_pylist() for c in ("block", "guest", "doc_id", "text"))):
            if own_block != block or size > AT_ONCE:
                if texts:
                    if own_block == block:
                        ids.append(doc), texts.append(text), guests.append(guest)
                    yield done()
                    if own_block == block:
                        ids.pop(), texts.pop(), guests.pop()
                ids, texts, guests, size, block = [], [], [], 0, own_block
            ids.append(doc), texts.append(text), guests.append(guest)
            size += len(text)
    if texts:
        yield done()


def _order(doc_id: Column, key: Column, id_type: str) -> Column:
    """Sorts like the ids, NULLs least (an empty value stands for them); equal ids by their texts."""
    known = F.coalesce(doc_id, F.lit(0).cast(id_type))
    return F.struct(doc_id.isNotNull().alias("known"), known.alias("doc_id"), key.alias("key"))


def fingerprint_changes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with the likeness to it and to the next text.

    The next text is that of the next lower id (NULL ids last, then the highest again; equal ids
    in the order of a hash of their texts). doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Ids are put in order first, without texts. Their range partitions become blocks; the first row of each (as
    many as shuffle partitions) is known to all tasks and is also sent to the block before, as the one
    that follows its last row. Texts are then moved once.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    id_type = dict(docs.dtypes)["doc_id"]
    docs = docs.withColumn("place", _order(F.col("doc_id"), row_hash(F.col("text")), id_type))
    first = (
        docs.select("place")
        .repartitionByRange(parts, F.col("place").desc())
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.max("place").alias("place"))
    )
    heads = sorted(tuple(r["place"]) for r in materialize(first, "heads").collect())
    n = max(len(heads), 1)

    @F.pandas_udf("array<int>")
    def targets(known: pd.Series, doc: pd.Series, key: pd.Series) -> pd.Series:
        """Twice the row's block, and if it is the block's first row, twice the block before plus 1."""
        found = []
        for place in zip(known.tolist(), doc.tolist(), key.tolist()):
            at = bisect.bisect_left(heads, place)
            own, before = 2 * (n - 1 - at), 2 * ((n - 2 - at) % n) + 1
            found.append([own, before] if heads[at] == place else [own])
        return pd.Series(found)

    dealt = docs.withColumn("to", F.explode(targets("place.known", "place.doc_id", "place.key")))
    dealt = dealt.withColumns({"block": F.shiftright("to", 1), "guest": F.col("to") % 2 == 1})
    rows = (
        dealt.select("block", "guest", "doc_id", "text", "place")
        .repartitionById(n, F.col("block"))
        .sortWithinPartitions("block", "guest", F.col("place").desc())
        .select("block", "guest", "doc_id", "text")
    )
    return rows.mapInArrow(
        _with_next,
        f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
