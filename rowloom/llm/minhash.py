"""Near duplicates on word shingles: SuperMinHash signatures, banding, verification, components.

A text's set holds its distinct shingles of `size` words (lower-cased A-Z); a text of fewer words is one
shingle. Two texts are linked if the Jaccard similarity of their sets is at least `percent` / 100.

1. Texts with equal sets form a class; only classes go on.
2. Signatures are cut into bands of BAND slots; classes with an equal band share a bucket. There are so many
   bands that a link at the least similarity misses all buckets with probability MISS; closer ones less.
3. Every class of a bucket is compared with the bucket's first one, on full sets.
4. Buckets that still hold several components are compared further: all classes outside a bucket's
   largest component with all others, in tasks of at most CHUNK by CHUNK texts. Links are found whole, but texts
   already connected are not compared again, and pairs never leave the task unless they are links.
5. Links make components; a component is named by its least id.

NULL and empty texts and texts without words have no set and are linked with nothing. Rows with
equal id and text are told apart by nothing and get the same component. NULL ids do not name a
component unless it has no other. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import row_key
from rowloom.llm.components import components
from rowloom.llm.superminhash import mix, signatures
from rowloom.sources.shared import materialize

BAND = 4
MISS = 1e-5
#: Texts on either side of a comparing task.
CHUNK = 512
#: Words a task remembers with their hashes; a full memory is emptied.
REMEMBERED = 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    # bytes split on ASCII white space and lower-case A-Z only
    found = (text or "").encode().lower().split()
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    width = min(size, len(h))
    out = mix(h[: len(h) - width + 1] + np.uint64(width))
    for k in range(1, width):
        out = mix(out + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def slots_for(percent: int) -> int:
    """Slots of a signature for links of that similarity."""
    return BAND * math.ceil(math.log(MISS) / math.log(1 - min(percent / 100, 0.999) ** BAND))


def _signed(texts: list[str | None], size: int, slots: int) -> tuple[list[int], list[bytes | None], list[list[int]]]:
    sets = [shingles(t, size) for t in texts]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    table = signatures(np.concatenate(sets), owner, len(sets), slots)
    bands = mix(table[:, ::BAND] + np.arange(slots // BAND, dtype=np.uint64))
    for k in range(1, BAND):
        bands = mix(bands + table[:, k::BAND])
    names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    return [len(s) for s in sets], names, bands.view(np.int64).tolist()


def _sign(size: int, slots: int, at_once: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                n, names, bands = _signed(part.column("text").to_pylist(), size, slots)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "key", "n_shingles", "set_id", "bands"],
                )

    return run


def _linked(ones: np.ndarray, others: np.ndarray, shared: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (ones + others - shared)


def _with_pivot(size: int, percent: int):
    """Rows sorted by group with the pivot first: the rows whose set is linked with the pivot's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = None
        for batch in batches:
            found = []
            for is_pivot, name, of, text in zip(*(batch.column(c).to_pylist() for c in ("is_pivot", "set_id", "pivot", "text"))):
                if is_pivot:
                    pivot = shingles(text, size)
                    continue
                own = shingles(text, size)
                common = len(np.intersect1d(own, pivot, assume_unique=True))
                if _linked(len(own), len(pivot), common, percent):
                    found.append((name, of))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


class _Outside:
    """The classes outside a bucket's largest component, as an index from shingles to classes."""

    def __init__(self):
        self.names: list[bytes] = []
        self.roots: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.parents: dict[bytes, bytes] = {}

    def root(self, label: bytes) -> bytes:
        while (up := self.parents.get(label, label)) != label:
            label = up
        return label

    def close(self) -> None:
        every = np.concatenate(self.sets)
        owner = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
        order = np.argsort(every, kind="stable")
        self.owner, self.sizes = owner[order], np.array([len(s) for s in self.sets])
        self.hashes, self.starts = np.unique(every[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(every))

    def links(self, name: bytes, label: bytes, own: np.ndarray, percent: int) -> list[bytes]:
        """Classes that are linked with a set and not connected with it yet; connects them."""
        mine = self.root(label)
        if all(self.root(r) == mine for r in self.roots):
            return []
        at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        at = at[self.hashes[at] == own]
        hits = np.concatenate([self.owner[s:e] for s, e in zip(self.starts[at], self.ends[at])]) if len(at) else np.zeros(0, np.int64)
        shared = np.bincount(hits, minlength=len(self.sets))
        out = []
        for k in np.flatnonzero(_linked(self.sizes, len(own), shared, percent) & (shared > 0)):
            theirs = self.root(self.roots[k])
            if theirs != self.root(label):
                self.parents[theirs] = self.root(label)
                out.append(self.names[k])
        return out


def _across(size: int, percent: int):
    """Rows sorted by task, the outside classes first: links between components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, outside, closed = None, _Outside(), False
        for batch in batches:
            found = []
            columns = ("bucket", "i", "j", "outside", "set_id", "label", "text")
            for bucket, i, j, is_outside, name, label, text in zip(*(batch.column(c).to_pylist() for c in columns)):
                if task != (bucket, i, j):
                    task, outside, closed = (bucket, i, j), _Outside(), False
                own = shingles(text, size)
                if is_outside:
                    outside.names.append(name)
                    outside.roots.append(label)
                    outside.sets.append(own)
                    continue
                if not outside.names:
                    continue
                if not closed:
                    outside.close()
                    closed = True
                found += [(name, other) for other in outside.links(name, label, own, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


def _confirm_pivots(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among pairs (set_id, pivot); a pivot with many partners is dealt out to several tasks."""
    groups = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / CHUNK).alias("parts"))
    dealt = pairs.join(groups, "pivot").withColumn("part", F.pmod(F.xxhash64("set_id"), "parts")).drop("parts")
    members = dealt.join(texts, "set_id").select("pivot", "part", F.lit(False).alias("is_pivot"), "set_id", "text")
    named = texts.withColumnRenamed("set_id", "pivot")
    pivots = dealt.select("pivot", "part").distinct().join(named, "pivot").select("pivot", "part", F.lit(True).alias("is_pivot"), F.col("pivot").alias("set_id"), "text")
    rows = pivots.unionByName(members).repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.col("is_pivot").desc())
    return rows.mapInArrow(_with_pivot(size, percent), "a binary, b binary")


def _confirm_across(members: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the components that a bucket holds after the first comparison."""
    labelled = members.join(labels, members["set_id"] == labels["node"], "left").select("bucket", "set_id", F.coalesce("root", "set_id").alias("label"))
    parts = materialize(labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("h")), "parts")
    open_ = (
        parts.groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.count("*").alias("labels"), F.max(F.struct("n", "label")).alias("largest"), F.sum("h").alias("h"))
        .filter("labels > 1 and n > 2")
        # buckets of the same classes need looking at once
        .groupBy("n", "h", F.col("largest.label").alias("largest"), F.col("largest.n").alias("most"))
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "largest", F.ceil(F.col("n") / CHUNK).alias("js"), F.ceil((F.col("n") - F.col("most")) / CHUNK).alias("is"))
    )
    rows = labelled.join(open_, "bucket").join(texts, "set_id")
    place = F.xxhash64("set_id")
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    every = rows.withColumn("j", F.pmod(place, "js")).withColumn("i", up_to(F.col("is"))).withColumn("outside", F.lit(False))
    outside = rows.filter("label != largest").withColumn("i", F.pmod(place, "is")).withColumn("j", up_to(F.col("js"))).withColumn("outside", F.lit(True))
    columns = ("bucket", "i", "j", "outside", "set_id", "label", "text")
    tasks = every.select(*columns).unionByName(outside.select(*columns))
    dealt = tasks.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", F.col("outside").desc())
    return dealt.mapInArrow(_across(size, percent), "a binary, b binary")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, key, n_shingles, component_id, first.

    `key` is document_key of the row; `first` marks the row (or equal rows) that stands for its
    component: the least id, NULLs last, then the least key. Rows without a set are all first.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("key", document_key("doc_id", "text"))
    signed = materialize(
        docs.mapInArrow(
            _sign(size, slots_for(percent)),
            f"doc_id {dict(docs.dtypes)['doc_id']}, key struct<k1:bigint,k2:bigint>, n_shingles long, set_id binary, bands array<long>",
        ),
        "signed",
    )
    classes = materialize(
        signed.filter("n_shingles > 0")
        .groupBy("set_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first"), F.first("bands").alias("bands")),
        "classes",
    )
    banded = classes.select("set_id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("set_id").alias("pivot"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = materialize(banded.join(shared, "bucket"), "members")

    wanted = members.select("set_id").distinct().join(classes, "set_id").select("set_id", F.col("first.key").alias("its_key"))
    texts = docs.join(wanted, docs["key"] == wanted["its_key"]).select("set_id", "text").dropDuplicates(["set_id"])
    texts = materialize(texts, "texts")
    pairs = materialize(members.filter("set_id != pivot").select("set_id", "pivot").distinct(), "pairs")
    links = materialize(_confirm_pivots(pairs, texts, size, percent), "links")
    more = _confirm_across(members, materialize(components(links), "labels"), texts, size, percent)
    labels = materialize(components(links.unionByName(more)), "labels")

    named = classes.join(labels, classes["set_id"] == labels["node"], "left").select("set_id", F.coalesce("root", "set_id").alias("root"), "first")
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    named = named.select("set_id", "root").join(firsts, "root").select("set_id", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("first_key"))
    result = signed.drop("bands").join(named, "set_id", "left")
    alone = F.col("n_shingles") == 0
    return result.select(
        "doc_id", "key", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("key") == F.col("first_key"))).alias("first"),
    )


def document_key(doc_id: str, text: str):
    return row_key(F.col(doc_id), F.col(text))


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of df that stand for their component, one of equal rows; rows without a set all stay."""
    found = near_duplicates(df, doc_id, text, size, percent).filter("first").groupBy("key").agg(F.first("n_shingles").alias("n"))
    rows = df.select(document_key(doc_id, text).alias("key"), F.struct(*df.columns).alias("row")).join(found, "key")
    alone = rows.filter("n = 0").select("row.*")
    return rows.filter("n > 0").dropDuplicates(["key"]).select("row.*").unionByName(alone)
