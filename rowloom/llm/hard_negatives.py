"""Hard negatives by integer inner products, from Hilbert-ordered blocks with zone maps.

Vectors are ordered along a Hilbert curve and written as blocks, a Parquet row each, with the least and the greatest value of every
dimension and the labels in the block. The inner product of an anchor with any row of a block lies between
the sums of its products with those ends (interval arithmetic), which tells what an anchor need not read:

* for its positives, blocks whose upper bound is under the score of its n-th best row so far (at first that of its own block),
  and blocks without its label;
* for its negatives, blocks whose bounds miss all of its windows, and blocks that have its own label only.

Anchors are compared with the zone maps in groups, both dealt out by a number; what they choose goes to the
blocks with the anchors that need them, in portions, so a block that all anchors need is read in many rows. Tasks keep the best
of each anchor and tighten their bounds as they go on.

An anchor's positives are its first rows of the same label, itself left out; a positive's negatives are the first rows of other labels
whose scores lie in the positive's window. Higher scores come first, ties by smaller id. Rows without id or label, without a vector, or
with a component that is NULL or not finite take no part. Every row stands for itself: a repeated row is another row. Shorter
vectors count as followed by zeros. Scores are exact; vectors so long or large that a score might not fit into 62 bits are refused.
An empty table gives an empty result. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.sources.shared import materialize

#: Bits of a coordinate on the curve.
CURVE_BITS = 4
#: Rows of a block, about so many rows to a task, zone maps that are looked at together, anchors that travel together.
BLOCK_ROWS = 1024
TASK_ROWS = 8192
ZONES = 256
ANCHORS = 512
#: Candidates that a task keeps before it hands on the best.
KEPT = 200_000
#: Room left in the numbers of rows for places in a block.
PLACES = 1 << 20

BLOCK = "block long, ids binary, labels binary, vectors binary, anchors binary, floors binary, low binary, high binary, zone_labels binary"
ANCHOR = "row long, id long, label int, vector binary, floor double"
PORTION = "rows binary, ids binary, labels binary, vectors binary, floors binary, positives binary"
CHOSEN = "block long, " + PORTION
BEST = "row long, place int, anchor_id long, positive_id long, positive_score long, its_row long, id long, score long"


def components(vector: Column) -> Column:
    """256 times each component, rounded down."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def takes_part(row_id: Column, label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return row_id.isNotNull() & label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False))


def hilbert_keys(places: np.ndarray, bits: int = CURVE_BITS) -> list[bytes]:
    """Keys of points (rows of coordinates under 2**bits) in the order of a Hilbert curve through all of them."""
    n, dims = places.shape
    if not dims:
        return [b""] * n
    axes = np.ascontiguousarray(places.T.astype(np.uint32))
    bit = np.uint32(1 << (bits - 1))
    # from the coarsest cell to the finest: undo the turns and mirrors a cell brings to the cells in it
    for q in (bit >> np.uint32(k) for k in range(bits - 1)):
        below = q - np.uint32(1)
        for i in range(dims):
            mirrored = (axes[i] & q) != 0
            swapped = np.where(mirrored, 0, (axes[0] ^ axes[i]) & below).astype(np.uint32)
            axes[0] ^= np.where(mirrored, below, swapped).astype(np.uint32)
            axes[i] ^= swapped if i else np.uint32(0)
    # neighbours differ in one bit
    for i in range(1, dims):
        axes[i] ^= axes[i - 1]
    carried = np.zeros(n, np.uint32)
    for q in (bit >> np.uint32(k) for k in range(bits - 1)):
        carried ^= np.where(axes[-1] & q, q - np.uint32(1), 0).astype(np.uint32)
    axes ^= carried
    in_order = np.stack([(axes >> np.uint32(k)) & np.uint32(1) for k in reversed(range(bits))])  # bit, dimension, row
    packed = np.packbits(in_order.reshape(bits * dims, n).astype(np.uint8), axis=0)
    return [row.tobytes() for row in np.ascontiguousarray(packed.T)]


@dataclass(frozen=True)
class Space:
    """What all tasks know of the vectors."""

    rows: int
    dims: int
    low: int
    high: int

    def matrix(self, vectors: bytes) -> np.ndarray:
        """Vectors as doubles; their products are exact while they stay under 53 bits, else as integers."""
        found = np.frombuffer(vectors, "<i4").reshape(-1, self.dims) if self.dims else np.zeros((0, 0), np.int32)
        return found.astype(np.float64 if self.exact else np.int64)

    @property
    def largest(self) -> int:
        return max(abs(self.low), abs(self.high))

    @property
    def exact(self) -> bool:
        return self.dims * self.largest**2 < 1 << 53


def _space(rows: DataFrame) -> Space:
    found = rows.agg(
        F.count("*").alias("n"), F.max(F.size("c")).alias("dims"), F.min(F.array_min("c")).alias("low"), F.max(F.array_max("c")).alias("high")
    ).first()
    space = Space(found["n"], found["dims"] or 0, found["low"] or 0, found["high"] or 0)
    if space.largest >= 1 << 31 or space.dims * space.largest**2 >= 1 << 62:
        raise ValueError("inner products of these vectors may not fit into 62 bits")
    return space


def _keyed(rows: DataFrame, space: Space) -> DataFrame:
    """Rows with their place on the curve: id, label, anchor, vector, key."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = max(space.high - space.low, 1)
        for batch in batches:
            lists = batch.column("c")
            sizes = np.diff(lists.offsets.to_numpy())
            filled = np.zeros((len(batch), space.dims), np.int64)
            filled[np.arange(space.dims) < sizes[:, None]] = lists.flatten().to_numpy()
            cells = np.clip((filled - space.low) * (1 << CURVE_BITS) // (span + 1), 0, (1 << CURVE_BITS) - 1)
            vectors = [v.tobytes() for v in filled.astype("<i4")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("anchor"), pa.array(vectors, pa.binary()), pa.array(hilbert_keys(cells), pa.binary())],
                names=["id", "label", "anchor", "vector", "key"],
            )

    return rows.mapInArrow(key, "id long, label int, anchor boolean, vector binary, key binary")


def _bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with vectors between low and high, rounded outwards."""
    anchors, low, high = (x.astype(np.float64) for x in (anchors, low, high))
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    room = np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T * 1e-12
    return up @ low.T + down @ high.T - room, up @ high.T + down @ low.T + room


def write_blocks(rows: DataFrame, space: Space, n_positives: int) -> DataFrame:
    """Blocks in Hilbert order, written, each with its zone map and with a first bound for the anchors in it."""
    tasks = -(-space.rows // TASK_ROWS) or 1
    keyed = materialize(_keyed(rows, space), "keyed")
    # the id keeps equal vectors from meeting in one task
    dealt = keyed.repartitionByRange(tasks, "key", "id").sortWithinPartitions("key", "id").withColumn("task", F.spark_partition_id())

    def block(number: int, part: pa.Table) -> pa.RecordBatch:
        ids, labels, flags = (part.column(c).to_numpy() for c in ("id", "label", "anchor"))
        raw = b"".join(part.column("vector").to_pylist())
        vectors = space.matrix(raw) if space.dims else np.zeros((len(ids), 0))
        own = np.flatnonzero(flags)
        score = vectors[own] @ vectors.T
        score[np.arange(len(own)), own] = np.iinfo(np.int64).min if score.dtype == np.int64 else -np.inf
        floors = np.full(len(own), -np.inf)
        for k, at in enumerate(own):
            same = score[k][labels == labels[at]]
            if len(same) > n_positives:
                floors[k] = np.partition(same, -n_positives)[-n_positives]
        return pa.RecordBatch.from_arrays([
            pa.array([number]), *(pa.array([x], pa.binary()) for x in (
                ids.astype("<i8").tobytes(), labels.astype("<i4").tobytes(), raw, own.astype("<i8").tobytes(), floors.tobytes(),
                vectors.min(axis=0).astype("<i4").tobytes(), vectors.max(axis=0).astype("<i4").tobytes(), np.unique(labels).astype("<i4").tobytes(),
            ))
        ], names=[f.split()[0] for f in BLOCK.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, k, task = [], 0, 0, None
        for batch in batches:
            while len(batch):
                task = batch.column("task")[0].as_py()
                part = batch.slice(0, BLOCK_ROWS - n)
                batch = batch.slice(len(part))
                waiting.append(part)
                n += len(part)
                if n == BLOCK_ROWS:
                    yield block((task << 32) + k, pa.Table.from_batches(waiting))
                    waiting, n, k = [], 0, k + 1
        if n:
            yield block((task << 32) + k, pa.Table.from_batches(waiting))

    return materialize(dealt.drop("key").mapInArrow(pack, BLOCK), "blocks")


def _anchors(blocks: DataFrame, space: Space) -> DataFrame:
    """A row per anchor; its number tells its block and place."""
    width = 4 * space.dims

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                own = np.frombuffer(b["anchors"], "<i8")
                raw = b["vectors"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(b["block"] * PLACES + own), pa.array(np.frombuffer(b["ids"], "<i8")[own]), pa.array(np.frombuffer(b["labels"], "<i4")[own]),
                    pa.array([raw[k * width : (k + 1) * width] for k in own], pa.binary()), pa.array(np.frombuffer(b["floors"], "<f8")),
                ], names=[f.split()[0] for f in ANCHOR.split(", ")])

    return blocks.select("block", "ids", "labels", "vectors", "anchors", "floors").mapInArrow(pick, ANCHOR)


def _portions(anchors: DataFrame) -> DataFrame:
    """Anchors in groups. Columns of ANCHOR, and perhaps positives (id, score)."""
    with_positives = "positives" in anchors.columns

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), ANCHORS):
                part = batch.slice(start, ANCHORS)
                packed = [part.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes() for c, t in (("row", "<i8"), ("id", "<i8"), ("label", "<i4"))]
                positives = np.zeros((len(part), 0), "<i8")
                if with_positives:
                    lists = part.column("positives").to_pylist()
                    most = max(map(len, lists))
                    # score -1 stands for none; such a window is empty
                    positives = np.array([[(p["id"], p["score"]) for p in x] + [(0, -1)] * (most - len(x)) for x in lists], "<i8")
                packed += [b"".join(part.column("vector").to_pylist()), part.column("floor").to_numpy().astype("<f8").tobytes(), positives.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], names=[f.split()[0] for f in PORTION.split(", ")])

    return anchors.mapInArrow(group, PORTION)


class _Portion:
    """Some anchors, unpacked."""

    def __init__(self, row: dict, space: Space):
        self.rows, self.ids = np.frombuffer(row["rows"], "<i8"), np.frombuffer(row["ids"], "<i8")
        self.labels, self.floors = np.frombuffer(row["labels"], "<i4"), np.frombuffer(row["floors"], "<f8")
        self.vectors = space.matrix(row["vectors"]) if space.dims else np.zeros((len(self.rows), 0))
        self.positives = np.frombuffer(row["positives"], "<i8").reshape(len(self.rows), -1, 2)

    def packed(self, chosen: np.ndarray) -> list[bytes]:
        columns = (self.rows, self.ids, self.labels, self.vectors.astype("<i4"), self.floors, self.positives)
        return [np.ascontiguousarray(c[chosen]).tobytes() for c in columns]


def _windows(positives: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each window: least% and most% of the positive's, as whole numbers."""
    score = positives[:, :, 1]
    low, high = -(-least * score // 100), most * score // 100
    return np.where(score < 0, 1, low), np.where(score < 0, 0, high)  # a window under 0 is empty


def choose_blocks(portions: DataFrame, blocks: DataFrame, space: Space, window: tuple[int, int] | None) -> DataFrame:
    """The blocks that anchors have to read, with those anchors: for their positives, or for the negatives in their windows."""
    slices = -(-space.rows // (BLOCK_ROWS * ZONES)) or 1
    zones = blocks.select(F.pmod(F.xxhash64("block"), F.lit(slices)).alias("slice"), F.struct("block", "low", "high", "zone_labels").alias("zone"))
    zones = zones.groupBy("slice").agg(F.collect_list("zone").alias("zones"))  # about ZONES each
    asked = portions.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                portion, zones = _Portion(row, space), row["zones"]
                low, high = (np.array([np.frombuffer(z[c], "<i4") for z in zones]).reshape(len(zones), space.dims) for c in ("low", "high"))
                least, greatest = _bounds(portion.vectors, low, high)
                if window:
                    start, end = _windows(portion.positives, *window)
                    needed = np.zeros(least.shape, bool)
                    for k in range(start.shape[1]):
                        met = (greatest >= start[:, k, None]) & (least <= end[:, k, None])
                        needed |= met & (start[:, k] <= end[:, k])[:, None]
                else:
                    needed = greatest >= portion.floors[:, None]
                for j, zone in enumerate(zones):
                    labels = np.frombuffer(zone["zone_labels"], "<i4")
                    fitting = (portion.labels != labels[0]) if window and len(labels) == 1 else np.ones(len(portion.labels), bool) if window else np.isin(portion.labels, labels)
                    chosen = np.flatnonzero(needed[:, j] & fitting)
                    if len(chosen):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([zone["block"]]), *(pa.array([x], pa.binary()) for x in portion.packed(chosen))],
                            names=[f.split()[0] for f in CHOSEN.split(", ")],
                        )

    return asked.join(zones, "slice").mapInArrow(choose, CHOSEN)


class _Best:
    """The best candidates of each (anchor, place) a task has seen, and the score one has to reach."""

    def __init__(self, most: int):
        self.most, self.parts, self.n, self.floors = most, [], 0, {}

    def floor(self, rows: np.ndarray, places: int) -> np.ndarray:
        get = self.floors.get
        return np.array([[get((r, p), -np.inf) for p in range(places)] for r in rows.tolist()]).reshape(len(rows), places)

    def add(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n > KEPT:
            columns = self.reduced()
            self.parts, self.n = [columns], len(columns[0])
            if self.n > KEPT // 2:
                yield from self.out(columns)
                self.parts, self.n, self.floors = [], 0, {}

    def reduced(self) -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        row, place, _, _, _, its_row, ids, score = columns
        order = np.lexsort((its_row, ids, -score, place, row))
        row, place = row[order], place[order]
        starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (place[1:] != place[:-1])))
        nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        self.floors |= {(int(row[k]), int(place[k])): float(score[order[k]]) for k in np.flatnonzero(nth == self.most - 1)}
        return [c[order[nth < self.most]] for c in columns]

    def out(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(columns[0]), 50_000):
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 50_000], t) for c, t in zip(columns, types)], names=[f.split()[0] for f in BEST.split(", ")])


def _read(chosen: DataFrame, blocks: DataFrame, space: Space, most: int, window: tuple[int, int] | None) -> DataFrame:
    """The best rows of the chosen blocks: the first `most` for each anchor, or for each of its windows."""
    candidates = blocks.select("block", *[F.col(c).alias(f"block_{c}") for c in ("ids", "labels", "vectors", "low", "high")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(most)
        for batch in batches:
            for row in batch.to_pylist():
                portion = _Portion(row, space)
                ids, labels = np.frombuffer(row["block_ids"], "<i8"), np.frombuffer(row["block_labels"], "<i4")
                numbers = row["block"] * PLACES + np.arange(len(ids))
                zone = [np.frombuffer(row[f"block_{c}"], "<i4").reshape(1, space.dims) for c in ("low", "high")]
                if window:
                    start, end = _windows(portion.positives, *window)
                    start = np.maximum(start, best.floor(portion.rows, start.shape[1]))
                    start = np.where(start > end, np.inf, start)
                    wanted = start.min(axis=1, initial=np.inf)
                else:
                    start = end = None
                    wanted = np.maximum(portion.floors, best.floor(portion.rows, 1)[:, 0])
                # what other blocks gave may have ruled this one out
                left = np.flatnonzero(_bounds(portion.vectors, *zone)[1][:, 0] >= wanted)
                if not len(left):
                    continue
                vectors = space.matrix(row["block_vectors"]) if space.dims else np.zeros((len(ids), 0))
                score = portion.vectors[left] @ vectors.T
                same = portion.labels[left, None] == labels
                if window:
                    a, c = np.nonzero(~same & (score >= wanted[left, None]))
                    places = range(start.shape[1])
                else:
                    a, c = np.nonzero(same & (score >= wanted[left, None]) & (portion.rows[left, None] != numbers))
                    places = [0]
                found = score[a, c].astype(np.int64)
                a = left[a]
                for p in places:
                    fits = (found >= start[a, p]) & (found <= end[a, p]) if window else np.ones(len(a), bool)
                    at, to = a[fits], c[fits]
                    positive = portion.positives[at, p] if window else np.zeros((len(at), 2), np.int64)
                    yield from best.add([
                        portion.rows[at], np.full(len(at), p), portion.ids[at], positive[:, 0], positive[:, 1], numbers[to], ids[to], found[fits],
                    ])
        if best.n:
            yield from best.out(best.reduced())

    found = chosen.join(candidates, "block").mapInArrow(read, BEST)
    first = Window.partitionBy("row", "place").orderBy(F.desc("score"), "id", "its_row")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= most)


def mine(
    df: DataFrame, row_id: Column, label: Column, vector: Column, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, window: tuple[int, int] = (80, 100)
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, by rank for each anchor and positive.

    `window`: per cent of the positive's score that a negative has at least and at most.
    """
    rows = df.filter(takes_part(row_id, label, vector)).select(
        row_id.cast("long").alias("id"), label.cast("int").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), components(vector).alias("c")
    )
    space = _space(rows)
    blocks = write_blocks(rows, space, n_positives)
    anchors = materialize(_anchors(blocks, space), "anchors")
    chosen = choose_blocks(_portions(anchors), blocks, space, None)
    positives = _read(chosen, blocks, space, n_positives, None)
    of_anchor = F.sort_array(F.collect_list(F.struct("rank", "id", "score")))  # n_positives at most
    positives = materialize(positives.groupBy(F.col("row").alias("its_anchor")).agg(of_anchor.alias("positives")), "positives")
    asking = anchors.join(positives, F.col("row") == F.col("its_anchor")).drop("its_anchor")
    chosen = choose_blocks(_portions(asking), blocks, space, window)
    return _read(chosen, blocks, space, n_negatives, window).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
