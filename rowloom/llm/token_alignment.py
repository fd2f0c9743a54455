"""Which tokens of two vocabularies stand for the same bytes, over a whole corpus.

A text is encoded by a byte-level vocabulary (A, with a space before the text) and by a sentencepiece model (B, which puts that
space there itself). Byte offsets at which a token of A and one of B both end cut the text into groups; every token of A
in a group is linked with every token of B in it. The count of a pair of ids is the number of documents (rows) in which
it is linked.

Texts are cut where no token of either vocabulary can reach across, and workers remember how they have aligned a cut.

First pass: tasks align their documents and hand on their distinct pairs with the number of documents, summed up in the task.
The distinct pairs are dealt by their A id into shards and each shard gets a minimal perfect hash; counts are dense
vectors indexed by it, a vector per part of a shard, summed up in a tree. Slots keep their keys, and a
key that is not its slot's is an error. Second pass: documents are aligned again and look up their pairs: HEAD_PAIRS pairs at most,
those of most documents, are handed to the tasks under a hash of their own; a pair that is not the one of its slot is looked
up by a join with the other counts. Those pairs stand in few documents each, so no key of that join is hot.

Texts that are NULL or empty, or that either vocabulary does not give back byte by byte, have no tokens: zeros, and '' for
their groups. Groups may be of any size; ids that repeat in a large one are counted, not paired out. Repeated rows are
documents of their own. An empty table gives an empty result. Columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rowloom.llm.byte_level import ByteLevel
from rowloom.llm.common import fresh
from rowloom.llm.minimal_hash import MinimalHash, verified
from rowloom.sources.shared import materialize

MARK = "▁"  # stands for a space inside pieces

#: Characters of text that are aligned at a time, and of a run of cuts that is encoded as one text.
TEXT_AT_ONCE = 1 << 20
RUN = 1 << 13
#: Cuts that a worker remembers, about 400 bytes each.
REMEMBERED = 400_000
#: Links of a group from which on its ids are counted before they are paired.
LARGE_GROUP = 1 << 12
#: Pairs that a task sums up before it hands them on.
PAIRS_AT_ONCE = 1 << 21
#: Pairs of a shard, about; rows of partial counts that one task fills into a vector.
SHARD_PAIRS = 1 << 19
PART_ROWS = 1 << 22
#: Slots that travel together, and vectors that are summed up at a time.
CHUNK = 1 << 16
FAN_IN = 16
#: Pairs handed to all tasks, 17 bytes each and two bits for the hash.
HEAD_PAIRS = 1 << 20

_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
DIGEST = ", ".join(f"{name} long" for name in _SUMS) + ", groups_sha256 string"


@dataclass
class Links:
    """Aligned cuts: all links, in the order of the cuts, and where each cut's begin."""

    pairs: np.ndarray  # a * |B| + b
    times: np.ndarray  # how often the pair is linked there
    starts: np.ndarray  # first link of each cut, and the end
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]


def _per_part(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts."""
    before = np.concatenate([[0], np.cumsum(values)])
    return before[starts[1:]] - before[starts[:-1]]


class Aligner:
    """Both vocabularies, with the bytes of their tokens.

    Where a character that is not white space stands before a space, no token of A goes on, and none of B if no piece has
    a space behind another character; so texts are cut there and equal cuts are aligned once.
    """

    def __init__(self, file_a: str, model_b: bytes):
        self.a = ByteLevel(file_a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.size_b = self.b.get_piece_size()
        self.mark, self.bytes_b = self.b.piece_to_id(MARK), []
        for i, piece in enumerate(self.b.id_to_piece(list(range(self.size_b)))):
            special = self.b.is_control(i) or self.b.is_unknown(i)
            self.bytes_b.append(b"" if special else bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode())
        self.lengths_b = np.array([len(t) for t in self.bytes_b], np.int64)
        crossing = any(b" " in t.lstrip(b" ") for t in self.bytes_b)
        self.cuts = (lambda text: [text]) if crossing else re.compile(r"(?<=\S)(?= )").split
        # a token's number with what stands behind it: A "," or "|", B "," or ";" or nothing
        size_a = len(self.a.lengths)
        self.written = np.array([f"{i}{sep}" for i in range(size_a) for sep in ",|"] + [f"{i}{sep}" for i in range(self.size_b) for sep in (",", ";", "")], object)
        self.written_b = 2 * size_a

    def _encode_b(self, parts: list[str]) -> list[list[int] | None]:
        """Ids of texts that start with a space, which the model puts there; None where they do not give the text back."""
        found = self.b.encode([p[1:] for p in parts], num_threads=1)
        found = [[self.mark] if p == " " else ids for p, ids in zip(parts, found)]
        return [ids if b"".join(map(self.bytes_b.__getitem__, ids)) == p.encode() else None for p, ids in zip(parts, found)]

    def encode(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all cuts, one after the other, and which of the cuts have any.

        Cuts that end in no white space are encoded many at a time: the next one starts with a space.
        """
        runs: list[list[int]] = []
        size = TEXT_AT_ONCE
        for k, cut in enumerate(cuts):
            alone = cut[-1].isspace()
            if size >= RUN or alone:
                runs.append([])
                size = 0
            runs[-1].append(k)
            size += RUN if alone else len(cut)
        texts = ["".join([cuts[k] for k in run]) for run in runs]
        of_b, there = self._encode_b(texts), np.ones(len(cuts), bool)
        for r in [r for r, ids in enumerate(of_b) if ids is None]:
            single = self._encode_b([cuts[k] for k in runs[r]])
            there[[k for k, ids in zip(runs[r], single) if ids is None]] = False
            of_b[r] = [i for ids in single for i in ids or []]
            texts[r] = "".join([cuts[k] for k in runs[r] if there[k]])
        of_a = [self.a.encode_plain(t) for t in texts]
        nothing = [np.zeros(0, np.int64)]
        return np.concatenate(nothing + of_a).astype(np.int64), np.concatenate(nothing + [np.array(ids, np.int64) for ids in of_b]), there

    def align(self, cuts: list[str], write: bool = True) -> Links:
        """Links of cuts, and perhaps their groups as text. A cut that a vocabulary does not give back has no tokens."""
        a, b, there = self.encode(cuts)
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.lengths_b[b])
        ends = np.cumsum([len(c.encode()) if t else 0 for c, t in zip(cuts, there)])
        upto_a, upto_b = (np.searchsorted(e, ends, "right") for e in (ends_a, ends_b))
        n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        # tokens are never empty, so ends rise, and every cut ends on both sides
        closes_a, closes_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        if not (np.isin(ends[ends > 0], ends_a[closes_a]).all()):
            raise ValueError("a token reaches over a cut")
        of_a, of_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        in_a, in_b = np.bincount(of_a), np.bincount(of_b)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        closed = np.concatenate([[0], np.cumsum(closes_a)])[upto_a]
        pairs, times, size = self._linked(a, b, in_a, in_b, first_a, first_b)
        starts = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], closed])]
        groups = self._written(a, b, of_a, of_b, closes_b, in_a, first_a, first_b, n_a, n_b) if write else [""] * len(cuts)
        return Links(pairs, times, starts, n_a, n_b, np.diff(closed, prepend=0), groups)

    def _linked(self, a, b, in_a, in_b, first_a, first_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs, how often each is linked, and how many entries each group has."""
        size = in_a * in_b
        large = np.flatnonzero(size > LARGE_GROUP)
        counted = {}
        for g in large:
            ids_a, times_a = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            ids_b, times_b = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            counted[g] = (np.add.outer(ids_a * self.size_b, ids_b).ravel(), np.multiply.outer(times_a, times_b).ravel())
            size[g] = len(counted[g][0])
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        plain = size.copy()
        plain[large] = 0
        group = np.repeat(np.arange(len(size)), plain)
        nth = np.arange(len(group)) - (np.cumsum(plain) - plain)[group]
        own = a[first_a[group] + nth // in_b[group]] * self.size_b + b[first_b[group] + nth % in_b[group]]
        if not len(large):
            return own, np.ones(total, np.int64), size
        pairs, times = np.empty(total, np.int64), np.ones(total, np.int64)
        pairs[(ends - size)[group] + nth] = own
        for g, (p, t) in counted.items():
            pairs[ends[g] - size[g] : ends[g]], times[ends[g] - size[g] : ends[g]] = p, t
        return pairs, times, size

    def _written(self, a, b, of_a, of_b, closes_b, in_a, first_a, first_b, n_a, n_b) -> list[str]:
        """Groups of each cut as text: ids of A, a bar, ids of B."""
        last_a = np.append(of_a[1:] != of_a[:-1], True) if len(a) else np.zeros(0, bool)
        behind_b = closes_b.astype(np.int64)
        behind_b[np.cumsum(n_b)[n_b > 0] - 1] = 2
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + first_b[of_a]] = 2 * a + last_a
        codes[np.arange(len(b)) + (first_a + in_a)[of_b]] = self.written_b + 3 * b + behind_b
        words, ends = self.written[codes].tolist(), np.cumsum(n_a + n_b).tolist()
        return ["".join(words[start:end]) for start, end in zip([0, *ends], ends)]


class Memory:
    """Cuts that a worker has aligned, with what follows from each; a full memory is emptied."""

    def __init__(self, aligner: Aligner, head: dict | None = None):
        self.aligner, self.head = aligner, head
        self.hashed = MinimalHash(head["sizes"], head["levels"]) if head else None
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.groups: list[str] = []
        self.sums = np.zeros((len(_SUMS), 0), np.int64)
        self.starts = np.zeros(1, np.int64)
        self.pairs = self.times = np.zeros(0, np.int64)
        self.tail = np.zeros(0, bool)

    def _learn(self, cuts: list[str]) -> None:
        # the first bytes of a cut tell nothing of the others, so any order will do
        cuts = sorted(cuts, key=lambda c: c[-1].isspace())
        self.places.update(zip(cuts, range(len(self.places), len(self.places) + len(cuts))))
        found = self.aligner.align(cuts, write=self.head is not None)
        links, best, docs, tail = _per_part(found.times, found.starts), [0] * len(cuts), [0] * len(cuts), np.zeros(len(found.pairs), bool)
        if self.head is not None:
            slots = self.hashed.slots(found.pairs)
            there = verified(slots, self.head["keys"], found.pairs)
            n, is_best = np.zeros(len(slots), np.int64), np.zeros(len(slots), bool)
            n[there], is_best[there], tail = self.head["docs"][slots[there]], self.head["best"][slots[there]], ~there
            best, docs = _per_part(found.times * is_best, found.starts), _per_part(found.times * n, found.starts)
        self.sums = np.hstack([self.sums, np.array([found.n_a, found.n_b, found.n_groups, links, best, docs])])
        self.starts = np.concatenate([self.starts, self.starts[-1] + found.starts[1:]])
        self.pairs, self.times = np.concatenate([self.pairs, found.pairs]), np.concatenate([self.times, found.times])
        self.tail = np.concatenate([self.tail, tail])
        self.groups += found.groups

    def cut(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the texts' cuts, and where each text's begin; a text with a cut that has no tokens has none at all."""
        if len(self.places) > REMEMBERED:
            self.clear()
        cuts = [self.aligner.cuts(" " + t) if t else [] for t in texts]
        if new := {c for of_text in cuts for c in of_text if c not in self.places}:
            self._learn(list(new))
        places = np.array([p for of_text in cuts for p in map(self.places.__getitem__, of_text)], np.int64)
        sizes = np.array([len(of_text) for of_text in cuts], np.int64)
        row = np.repeat(np.arange(len(texts)), sizes)
        lost = np.zeros(len(texts), bool)
        lost[row[self.sums[0, places] == 0]] = True
        if lost.any():
            places, sizes = places[~lost[row]], np.where(lost, 0, sizes)
        return places, np.concatenate([[0], np.cumsum(sizes)])

    def links(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All links of some cuts, as places among the memory's, and the number of each cut's."""
        sizes = self.starts[places + 1] - self.starts[places]
        first = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.starts[places] - first, sizes), sizes


_MEMORIES: dict[tuple[int, int], Memory] = {}


def _memory(files: tuple[str, bytes], head: dict | None = None) -> Memory:
    """One per worker process, kept from task to task."""
    key = (hash(files), id(head))
    if key not in _MEMORIES:
        _MEMORIES.clear()
        _MEMORIES[key] = Memory(Aligner(*files), head)
    return _MEMORIES[key]


def _portions(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts some at a time, with the number of the first."""
    start, size, waiting = 0, 0, []
    for k, t in enumerate(texts):
        waiting.append(t.as_py())
        size += len(waiting[-1] or "")
        if size >= TEXT_AT_ONCE:
            yield start, waiting
            start, size, waiting = k + 1, 0, []
    if waiting:
        yield start, waiting


def _vocabularies(df: DataFrame, vocabulary_a: str, vocabulary_b: str):
    with open(vocabulary_a, encoding="utf-8") as a, open(vocabulary_b, "rb") as b:
        return df.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def _summed(pairs: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, np.concatenate(docs))
    return keys, total


def partial_counts(df: DataFrame, text: str, files) -> DataFrame:
    """(pair, docs): documents of a task in which a pair is linked. A pair may come from several tasks, and more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, pairs, docs, n = _memory(files.value), [], [], 0

        def out(keys: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(keys), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array(keys[k : k + CHUNK]), pa.array(total[k : k + CHUNK])], names=["pair", "docs"])

        for batch in batches:
            for _, texts in _portions(batch.column(0)):
                places, starts = memory.cut(texts)
                # once per document: its cuts, then their pairs
                held = len(memory.groups)
                once = np.unique(np.repeat(np.arange(len(texts)), np.diff(starts)) * held + places)
                at, sizes = memory.links(once % held)
                span = len(memory.aligner.a.lengths) * memory.aligner.size_b
                keys, times = np.unique(np.unique(np.repeat(once // held, sizes) * span + memory.pairs[at]) % span, return_counts=True)
                pairs.append(keys)
                docs.append(times)
                n += len(keys)
                if n > PAIRS_AT_ONCE:
                    keys, times = _summed(pairs, docs)
                    pairs, docs, n = [keys], [times], len(keys)
                    if n > PAIRS_AT_ONCE // 2:
                        yield from out(keys, times)
                        pairs, docs, n = [], [], 0
        if pairs:
            yield from out(*_summed(pairs, docs))

    return df.select(text).mapInArrow(count, "pair long, docs long")


def _longs(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), np.int64)


def _hash(key: tuple, shard: pa.Table) -> pa.Table:
    keys = np.sort(shard.column("pair").to_numpy())
    made = MinimalHash.of(keys)
    return pa.table({
        "shard": pa.array([key[0].as_py()], pa.int32()), "sizes": pa.array([made.sizes], pa.list_(pa.int64())), "levels": pa.array([made.levels], pa.list_(pa.binary())),
        "keys": [made.ordered(keys).tobytes()],
    })


def _fill(key: tuple, rows: pa.Table, index: pa.Table) -> pa.Table:
    """The dense vector of a part's counts, in chunks."""
    made = MinimalHash(index.column("sizes")[0].as_py(), index.column("levels")[0].as_py())
    keys, own = rows.column("pair").to_numpy(), _longs(index.column("keys")[0])
    at = made.slots(keys)
    if not verified(at, own, keys).all():
        raise ValueError("a pair is not in its shard's hash")
    vector = np.zeros(made.n, np.int64)
    np.add.at(vector, at, rows.column("docs").to_numpy())
    chunks = range(0, made.n, CHUNK)
    shard, part = key[0].as_py(), key[1].as_py()
    return pa.table({
        "shard": pa.array([shard] * len(chunks), pa.int32()), "chunk": pa.array([c // CHUNK for c in chunks], pa.int32()),
        "part": pa.array([part] * len(chunks), pa.int32()), "vector": pa.array([vector[c : c + CHUNK].tobytes() for c in chunks], pa.binary()),
    })


def _add(key: tuple, rows: pa.Table) -> pa.Table:
    vectors = rows.column("vector")
    total = _longs(vectors[0]).copy()
    for v in vectors[1:]:
        total += _longs(v)
    shard, chunk, part = (k.as_py() for k in key)
    return pa.table({
        "shard": pa.array([shard], pa.int32()), "chunk": pa.array([chunk], pa.int32()), "part": pa.array([part], pa.int32()),
        "vector": pa.array([total.tobytes()], pa.binary()),
    })


def _tell(size_b: int):
    """Pairs of a shard by slot, with their counts, and whether it is the highest of their A id."""

    def tell(key: tuple, vectors: pa.Table, index: pa.Table) -> pa.Table:
        keys = _longs(index.column("keys")[0])
        order = np.argsort(vectors.column("chunk").to_numpy())
        docs = np.concatenate([_longs(vectors.column("vector")[int(k)]) for k in order])
        if len(docs) != len(keys) or (docs < 1).any():
            raise ValueError("a slot has no count")
        ids, of = np.unique(keys // size_b, return_inverse=True)
        highest = np.zeros(len(ids), np.int64)
        np.maximum.at(highest, of, docs)
        return pa.table({"pair": keys, "docs": docs, "best": docs == highest[of]})

    return tell


def pair_counts(partial: DataFrame, size_b: int) -> DataFrame:
    """(pair, docs, best) of all pairs, written. partial: a written table (pair, docs)."""
    distinct = materialize(partial.select("pair").distinct(), "pairs")
    n_pairs, n_rows = distinct.count(), partial.count()
    shards = -(-n_pairs // SHARD_PAIRS) or 1
    # an A id has |B| pairs at most, so no shard outgrows a task
    shard = F.pmod(F.xxhash64(F.floor(F.col("pair") / size_b)), F.lit(shards)).cast("int").alias("shard")
    index = materialize(
        distinct.select("pair", shard).groupBy("shard").applyInArrow(_hash, "shard int, sizes array<long>, levels array<binary>, keys binary"), "hashes"
    )
    parts = -(-n_rows // (shards * PART_ROWS)) or 1
    dealt = partial.select("pair", "docs", shard, F.pmod(F.xxhash64("pair", "docs"), F.lit(parts)).cast("int").alias("part"))
    everywhere = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    vector = "shard int, chunk int, part int, vector binary"
    # a part without rows gives zeros
    vectors = dealt.groupBy("shard", "part").cogroup(everywhere.groupBy("shard", "part")).applyInArrow(_fill, vector)
    while parts > 1:
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("shard", "chunk", "part").applyInArrow(_add, vector)
        parts = -(-parts // FAN_IN)
    told = vectors.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_tell(size_b), "pair long, docs long, best boolean")
    return materialize(told, "counts")


def head(counts: DataFrame, most: int = HEAD_PAIRS) -> tuple[int, dict]:
    """Documents from which on pairs are in the head, and the head itself: `most` pairs at most."""
    power = F.floor(F.log2("docs")).cast("int")
    sizes = sorted(counts.groupBy(power.alias("power")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["power"])  # 63 at most
    least, n = 1 << 62, 0
    for r in sizes:
        n += r["n"]
        if n > most:
            break
        least = 1 << r["power"]
    rows = counts.filter(F.col("docs") >= least).toArrow() if least < 1 << 62 else None  # HEAD_PAIRS rows at most
    pairs, docs, best = ((rows.column(c).to_numpy() for c in ("pair", "docs", "best")) if rows is not None else (np.zeros(0, t) for t in (np.int64, np.int64, bool)))
    made = MinimalHash.of(pairs)
    at = made.slots(pairs)
    kept = {"sizes": made.sizes, "levels": made.levels}
    for name, values in (("keys", pairs), ("docs", docs), ("best", best)):
        kept[name] = np.empty_like(values)
        kept[name][at] = values
    return least, kept


def _looked_up(df: DataFrame, text: str, files, known, carried: list[str]) -> DataFrame:
    """Rows with their digest, and the pairs that the head lacks (tail_pairs, tail_times)."""
    names = [f.name for f in StructType.fromDDL(DIGEST).fields]
    schema = StructType([StructField(c, df.schema[c].dataType) for c in carried] + StructType.fromDDL(f"{DIGEST}, tail_pairs array<long>, tail_times array<long>").fields)
    at = fresh(df, "text_to_align")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(files.value, known.value)
        for batch in batches:
            kept = batch.select(carried)
            for start, texts in _portions(batch.column(at)):
                places, starts = memory.cut(texts)
                sums = [_per_part(values, starts) for values in memory.sums[:, places]]
                groups = [";".join(map(memory.groups.__getitem__, places[a:b].tolist())) for a, b in zip(starts, starts[1:])]
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                links, sizes = memory.links(places)
                absent = memory.tail[links]
                ends = np.cumsum(np.concatenate([[0], _per_part(absent, np.concatenate([[0], np.cumsum(sizes)])[starts])])).astype(np.int32)
                tails = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[links[absent]])) for x in (memory.pairs, memory.times)]
                own = [*map(pa.array, sums), pa.array(digests)]
                yield pa.RecordBatch.from_arrays([*kept.slice(start, len(texts)).columns, *own, *tails], names=[f.name for f in schema.fields])

    return df.select(*[F.col(c) for c in carried], F.col(text).alias(at)).mapInArrow(look, schema)


def align_documents(df: DataFrame, text: str, vocabulary_a: str, vocabulary_b: str, head_pairs: int = HEAD_PAIRS) -> tuple[DataFrame, DataFrame]:
    """df without its text but with a digest of its alignment, and the table of counts (a, b, docs, best) it was made with."""
    names = [f.name for f in StructType.fromDDL(DIGEST).fields] + ["tail_pairs", "tail_times"]
    carried = [c for c in df.columns if c != text and c not in names]
    files = _vocabularies(df, vocabulary_a, vocabulary_b)
    size_b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_b).get_piece_size()
    counts = pair_counts(materialize(partial_counts(df, text, files), "partial"), size_b)
    least, table = head(counts, head_pairs)
    aligned = _looked_up(df, text, files, df.sparkSession.sparkContext.broadcast(table), carried)
    others = counts.filter(F.col("docs") < least)
    row = fresh(df, "row")
    # the number is written with the row, so it stays the row's
    aligned = materialize(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    if not others.isEmpty():
        tail = aligned.select(row, F.explode(F.arrays_zip("tail_pairs", "tail_times")).alias("t")).select(row, "t.*")
        more = tail.join(others, F.col("tail_pairs") == F.col("pair")).groupBy(row).agg(
            F.sum(F.when(F.col("best"), F.col("tail_times")).otherwise(0)).alias("more_best"), F.sum(F.col("tail_times") * F.col("docs")).alias("more_docs")
        )
        more = more.withColumnRenamed(row, "its_row")
        aligned = aligned.join(more, aligned[row] == more["its_row"], "left")
        aligned = aligned.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        aligned = aligned.withColumn("count_sum", F.col("count_sum") + F.coalesce("more_docs", F.lit(0)))
    pairs = counts.select(F.floor(F.col("pair") / size_b).cast("int").alias("a"), (F.col("pair") % size_b).cast("int").alias("b"), "docs", "best")
    return aligned.select(*[F.col(c) for c in carried], *names[:-2]), pairs
