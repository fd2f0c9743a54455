"""Best-fit packing of documents into training sequences, under several capacities at once.

A sequence holds at most so many tokens and documents, and at most so much attention cost (the sum of the squared
lengths of its pieces). What a sequence has left is a vector; a piece goes to the sequence, among those in which
it fits under every capacity, for which the weighted dot-product of its demand with what would be left is least ("dot"),
or the norm of what would be left ("norm"). Pieces come longest first, and the rule that needs fewer sequences counts.

A piece's demand depends on its length alone, so pieces of a length are alike and so are sequences with the same contents.
The plan is made for classes of sequences from the count of each length - at most `max_tokens` numbers, whatever the
corpus - and a piece is told its sequence by its rank among the pieces of its length. Ranks come from counts
per (length, bucket) and places within them, so a length that a third of all pieces have is not numbered in one task.

Documents of more than `max_tokens` tokens are cut into pieces of that many, what is over standing first; no other is
cut. NULL texts are empty ones and have the end id alone. Rows are packed one by one, repeated rows as often as they
come; an empty table gives an empty result. Columns that are named like the results are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rowloom.llm.byte_level import byte_level
from rowloom.llm.common import fresh
from rowloom.sources.shared import materialize

#: Pieces of a length that are numbered in one task.
RANKED_AT_ONCE = 1 << 16
#: Pieces that leave a task together.
AT_ONCE = 2_000

PIECE = "piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. None: no bound but that of the tokens."""

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.5, 0.5)

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.cost or self.tokens**2], np.float64)

    def demand(self, length: int) -> np.ndarray:
        return np.array([length, 1, length * length], np.float64)


@dataclass(frozen=True)
class Kind:
    """So many sequences with the same contents: (length, pieces) in the order in which they stand."""

    sequences: int
    contents: tuple[tuple[int, int], ...]


def best_fit(counts: dict[int, int], capacity: Capacity, rule: str) -> list[Kind]:
    """Packs so many pieces of each length, the longest first."""
    full, weights = capacity.vector(), np.array(capacity.weights)
    left, kinds = np.zeros((0, 3)), []
    for length in sorted(counts, reverse=True):
        waiting, demand = counts[length], capacity.demand(length)
        if (demand > full).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while waiting:
            after = left - demand
            fits = (after >= 0).all(axis=1)
            if fits.any():
                weighed = weights * after / full
                score = weighed @ (demand / full) if rule == "dot" else (weighed * after / full).sum(axis=1)
                best = int(np.where(fits, score, np.inf).argmin())
            else:  # as many new sequences as the pieces fill
                most = int((full // demand).min())
                left, kinds = np.vstack([left, full]), [*kinds, Kind(-(-waiting // most), ())]
                best = len(kinds) - 1
            kind, most = kinds[best], int((left[best] // demand).min())
            whole, rest = divmod(min(waiting, most * kind.sequences), most)
            parts = [(whole, most), (min(rest, 1), rest), (kind.sequences - whole - min(rest, 1), 0)]
            waiting -= whole * most + rest
            made = [(Kind(n, (*kind.contents, (length, m)) if m else kind.contents), left[best] - m * demand) for n, m in parts if n]
            kinds[best], left[best] = made[0]
            kinds += [k for k, _ in made[1:]]
            left = np.vstack([left, *[r for _, r in made[1:]]])
    return kinds


def plan(counts: dict[int, int], capacity: Capacity) -> list[Kind]:
    """The plan of the rule that needs fewer sequences."""
    plans = [best_fit(counts, capacity, rule) for rule in ("dot", "norm")]
    return min(plans, key=lambda kinds: sum(k.sequences for k in kinds))


def slots(kinds: list[Kind]) -> list[tuple[int, int, int, int, int, int]]:
    """Where pieces go by rank: (length, its first rank, the first behind, pieces a sequence, first sequence, offset)."""
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for kind in kinds:
        offset = 0
        for length, pieces in kind.contents:
            first = ranks.get(length, 0)
            ranks[length] = first + pieces * kind.sequences
            out.append((length, first, ranks[length], pieces, sequence, offset))
            offset += length * pieces
        sequence += kind.sequences
    return out


def cut_pieces(df: DataFrame, text: str, vocabulary: str, max_tokens: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """A row per piece of each text's ids and end id: piece, start, length, ids_crc32, and the ids if they are kept.

    The text column goes, the others stay.
    """
    names = [n.split()[0] for n in PIECE.split(", ")] + ["ids"]
    carried = [c for c in df.columns if c != text and c not in names]
    with open(vocabulary, encoding="utf-8") as file:
        rules = df.sparkSession.sparkContext.broadcast(file.read())
    own = StructType.fromDDL(PIECE + ", ids array<int>" * keep_ids)
    schema = StructType([StructField(c, df.schema[c].dataType) for c in carried] + own.fields)
    at = fresh(df, "text_to_cut")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = byte_level(rules.value)
        for batch in batches:
            rows: list[int] = []
            found: list[tuple] = []
            kept = batch.select(carried)

            def out() -> pa.RecordBatch:
                columns = list(zip(*found))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids
                own = [pa.array(c, t) for c, t in zip(columns, types)]
                return pa.RecordBatch.from_arrays([*kept.take(pa.array(rows)).columns, *own], names=[f.name for f in schema.fields])

            for row, value in enumerate(batch.column(at)):
                ids = np.append(vocabulary.encode(value.as_py() or ""), np.uint32(end_id)).astype("<u4", copy=False)
                first = len(ids) % max_tokens or max_tokens
                starts = [0, *range(first, len(ids), max_tokens)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append(row)
                    piece = ids[a:b]
                    found.append((k, a, b - a, zlib.crc32(piece.tobytes()), *([piece.astype(np.int32)] * keep_ids)))
                if len(rows) >= AT_ONCE:
                    yield out()
                    rows, found = [], []
            if rows:
                yield out()

    given = df.select(*[F.col(c) for c in carried], F.col(text).alias(at))
    return given.mapInArrow(pieces, schema)


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), length: str = "length") -> DataFrame:
    """Adds sequence_id and offset to pieces; give a written table, it is read twice."""
    given = pieces.drop("sequence_id", "offset")
    bucket, rank, before = (fresh(given, n) for n in ("bucket", "rank", "before"))
    by_length = given.groupBy(F.col(length).cast("int").alias("n")).agg(F.count("*").alias("rows"))
    counts = {r["n"]: r["rows"] for r in by_length.collect()}  # a number per length: max_tokens at most
    buckets = -(-max(counts.values(), default=1) // RANKED_AT_ONCE)
    order = [F.col(f"`{c}`") for c, kind in given.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = given.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    n = dealt.groupBy(length, bucket).agg(F.count("*").alias(before))
    of_length = Window.partitionBy(length).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    n = n.select(F.col(length).alias("its_length"), F.col(bucket).alias("its_bucket"), F.coalesce(F.sum(before).over(of_length), F.lit(0)).alias(before))
    n = materialize(n, "buckets")
    place = Window.partitionBy(length, bucket).orderBy(*order)
    ranked = dealt.withColumn(rank, F.row_number().over(place) - 1)
    ranked = ranked.join(n, (F.col(length) == F.col("its_length")) & (F.col(bucket) == F.col("its_bucket")))
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(before)).select(*given.columns, rank)
    # its size is bounded by the lengths there can be, not by the rows
    where = given.sparkSession.createDataFrame(
        slots(plan(counts, capacity)), "its_length long, first long, behind long, pieces long, sequence long, at long"
    )
    r = F.col(rank)
    found = ranked.join(F.broadcast(where), (F.col(length) == where["its_length"]) & (r >= where["first"]) & (r < where["behind"]))
    nth = r - where["first"]
    return found.select(
        *[ranked[c] for c in given.columns],
        (where["sequence"] + F.floor(nth / where["pieces"])).cast("long").alias("sequence_id"),
        (where["at"] + nth % where["pieces"] * F.col(length)).cast("long").alias("offset"),
    )


def pack_documents(df: DataFrame, text: str, vocabulary: str, capacity: Capacity = Capacity(), end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of all texts with their places; with the ids, what a loader needs."""
    return pack(materialize(cut_pieces(df, text, vocabulary, capacity.tokens, end_id, keep_ids), "pieces"), capacity)
