"""Deduplication of lines that are equal or a few edits apart, by a deletion-neighbourhood join and shared segments.

A line stays where it stands first (least id, NULLs last, then a hash of the text, then the line's place) and
goes everywhere else. A line's first standing goes too if a line within the edit bound (characters put in, taken
out or changed) stands earlier; whether that one stays does not matter. The bound of two lines grows with
the shorter one: an edit, and another for every `chars_per_edit` characters, up to `most_edits` (1: one edit at
every length). Lines under MIN_CHARS characters have no near lines: one edit makes too much of them. Equal lines go at any
length, if they have a word; lines of white space alone stay.

Deletion variants (the line without one of its characters, and the line itself) meet as hashed keys:
two lines of a length are one change apart if they agree without the same place, and a line is one
insertion from another if it is one of its variants. Only the earliest line of a key matters to the others, so
groups are never paired out. What meets is verified by its edit distance.

Before, lines that can have no such partner are set aside, without loss: one edit leaves the first or
the second half of a line as it is, so a line that shares neither half (cut for its own length and for one less) with
any other line needs no variants.

Two and more edits: the shorter line is cut into one segment more than it may have edits, so one segment is found
unchanged in the longer line, at most as many places away as edits lie before it and behind it. Lines
meet by such segments; first all of a segment with its earliest line, which leaves the lines that have no partner so
far. Where a segment has more lines, those are compared with its other earlier ones inside tasks, a part of PART lines with another
at a time, up to a line's first partner: pairs are never rows. Letter counts tell most lines apart before they are compared.

NULL and empty texts have no lines to remove. Rows with equal id and text are one document and treated alike. An
empty table gives an empty result. A text keeps its other lines in order; columns named like the counts are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import WORD, fresh, let, row_hash, row_key
from rowloom.sources.shared import materialize

MIN_CHARS = 20
#: Characters that allow another edit, and the most edits, where the bound grows.
CHARS_PER_EDIT = 100
MOST_EDITS = 3
#: Rows of lines that may be broadcast, 40 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Lines of a segment that are compared with others at a time.
PART = 512
#: Variants that a task hands on at a time.
AT_ONCE = 200_000

_PRIMES = ((2147483647, 1000003), (2147483629, 1000033))


class _Powers:
    """Powers of the hash bases, as many as the longest line so far needs, and their inverses."""

    def __init__(self):
        self.tables = [np.ones(1, np.uint64) for _ in _PRIMES]
        self.inverses = [np.uint64(pow(base, -1, prime)) for prime, base in _PRIMES]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) < n:
            for k, (prime, base) in enumerate(_PRIMES):
                t = self.tables[k]
                factor = np.uint64(pow(base, len(t), prime))
                self.tables[k] = np.concatenate([t, t * factor % np.uint64(prime)])
        return [t[:n] for t in self.tables]


_POWERS = _Powers()


def variants(line: str) -> np.ndarray:
    """Hashes of the line without each of its characters, then of the line itself."""
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    n, out = len(points), np.zeros(len(points) + 1, np.uint64)
    for (prime, _), powers, inverse in zip(_PRIMES, _POWERS.upto(n), _POWERS.inverses):
        prime = np.uint64(prime)
        before = np.zeros(n + 1, np.uint64)
        before[1:] = np.cumsum(points * powers % prime) % prime
        behind = (before[n] + prime - before[1:]) % prime
        hashed = np.append((before[:n] + behind * inverse) % prime, before[n])
        out = (out << np.uint64(31)) | hashed
    return out.view(np.int64)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, place, first): place -1 stands for the line itself."""
    for batch in batches:
        firsts, lines = batch.column("first"), batch.column("line").to_pylist()
        waiting, size, start = [], 0, 0
        for k, line in enumerate(lines):
            waiting.append(variants(line))
            size += len(waiting[-1])
            if size > AT_ONCE or k == len(lines) - 1:
                lengths = [len(v) for v in waiting]
                places = np.concatenate([np.append(np.arange(m - 1), -1) for m in lengths])
                rows = np.repeat(np.arange(start, k + 1), lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(waiting)), pa.array(places), firsts.take(pa.array(rows))], names=["key", "place", "first"]
                )
                waiting, size, start = [], 0, k + 1


def _halves(line: Column) -> Column:
    """Hashes of the first and second half as cut for the line's own length and for one character less."""
    n = F.char_length(line)
    cuts = []
    for short in (0, 1):
        m = n - short
        half = F.floor(m / 2).cast("int")
        cuts.append(row_hash(m, F.substring(line, F.lit(1), half), seed=31))
        cuts.append(row_hash(m, F.substring(line, n - (m - half) + 1, m - half), seed=32))
    return F.array(*cuts)


def _lines(docs: DataFrame) -> DataFrame:
    """Lines that have a word, with their place: key, doc_id, at, line."""
    found = docs.select("key", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return found.filter(F.col("line").rlike(WORD))


def _line_id(line: Column) -> Column:
    return row_key(line)


def _small(df: DataFrame) -> DataFrame:
    """For a written table: broadcast if its counted rows are few, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """first, line of the chosen lines (line_id, first)."""
    places = _small(chosen.select(F.col("line_id").alias("its_id"), "first"))
    texts = _lines(docs).withColumn("line_id", _line_id(F.col("line")))
    texts = texts.join(places, (texts["line_id"] == places["its_id"]) & (texts["key"] == places["first.key"]) & (texts["at"] == places["first.at"]))
    return materialize(texts.select("first", "line").dropDuplicates(["first"]), "texts")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (first, partner) with their lines a and b."""
    one = texts.select("first", F.col("line").alias("a"))
    two = texts.select(F.col("first").alias("partner"), F.col("line").alias("b"))
    return pairs.join(one, "first").join(two, "partner")


def edit_bound(n: Column, most_edits: int, chars_per_edit: int) -> Column:
    """Edits that a line of n characters may be from an equal or longer one."""
    return F.least(F.lit(most_edits), (F.lit(1) + F.floor(n / chars_per_edit)).cast("int"))


def _segments(line: Column, most_edits: int, chars_per_edit: int) -> Column:
    """Keys by which a line meets others at two or more edits: (key, own), own for the segments of its own cut.

    As the longer line it has a key for each place where a segment of a line `less` characters shorter may be found.
    """
    wanted = [
        (edits, less, i, shift)
        for edits in range(2, most_edits + 1)
        for less in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1)
    ]
    names = ("edits", "less", "i", "shift")
    wanted = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, w)]) for w in wanted])

    def key(w: Column, m: Column) -> Column:
        n = m - w["less"]
        start = F.floor(w["i"] * n / (w["edits"] + 1)).cast("int")
        end = F.floor((w["i"] + 1) * n / (w["edits"] + 1)).cast("int")
        segment = F.substring(line, start + w["shift"] + 1, end - start)
        return F.struct(row_hash(n, w["i"], segment, seed=33).alias("key"), ((w["less"] == 0) & (w["shift"] == 0)).alias("own"))

    def keys(m: Column) -> Column:
        fitting = F.filter(wanted, lambda w: edit_bound(m - w["less"], most_edits, chars_per_edit) == w["edits"])
        return F.transform(fitting, lambda w: key(w, m))

    return let(F.char_length(line), keys)


def _apart(a: str, b: str, most: int) -> bool:
    """Whether more than `most` edits lie between two texts: for each number of edits, how far every diagonal gets."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return True
    reached = {0: -1}
    for edits in range(most + 1):
        here = {}
        for d in range(-edits, edits + 1):
            i = max(reached.get(d, -2) + (edits > 0), reached.get(d - 1, -2), reached.get(d + 1, -2) + 1) if edits else 0
            if i < 0 or i > n or i + d > m or i + d < 0:
                continue
            step = 64
            while step:  # equal characters from here on, in strides
                while i + step <= n and i + d + step <= m and a[i : i + step] == b[i + d : i + d + step]:
                    i += step
                step >>= 1
            if i == n and i + d == m:
                return False
            here[d] = i
        reached = here
    return True


def _letters(lines: list[str]) -> np.ndarray:
    """How often characters stand in each line, dealt to 32 classes; an edit changes two counts by one."""
    out = np.zeros((len(lines), 32), np.int16)
    for k, line in enumerate(lines):
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        out[k] = np.minimum(np.bincount(points % 31, minlength=32), 30_000)
    return out


def _compared(bound):
    """Lines of a part (asking) against those of another (earlier ones): `first` of those that have a partner.

    Rows come sorted by segment and the two parts, those that are asked first.
    """

    def order(place: dict) -> tuple:
        return place["unknown"], place["doc_id"], place["key"]["k1"], place["key"]["k2"], place["at"]

    def settle(rows: list[dict]) -> list[dict]:
        asked, asking = ([r for r in rows if r["asking"] == flag] for flag in (False, True))
        if not asked or not asking:
            return []
        asked.sort(key=lambda r: order(r["first"]))
        letters, sizes, own = _letters([r["line"] for r in asked]), np.array([len(r["line"]) for r in asked]), np.array([r["own"] for r in asked])
        ranks, found = [order(r["first"]) for r in asked], []
        for r, mine in zip(asking, _letters([r["line"] for r in asking])):
            earlier = bisect_left(ranks, order(r["first"]))
            bounds = bound(np.minimum(sizes[:earlier], len(r["line"])))
            fits = np.abs(letters[:earlier] - mine).sum(axis=1, dtype=np.int32) <= 2 * bounds
            fits &= (np.abs(sizes[:earlier] - len(r["line"])) <= bounds) & (own[:earlier] | r["own"])
            if any(not _apart(r["line"], asked[k]["line"], int(bounds[k])) for k in np.flatnonzero(fits)):
                found.append(r["first"])
        return found

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            found, kind = [], batch.schema.field("first").type
            for row in batch.to_pylist():
                if (at := (row["segment"], row["part"], row["other"])) != group:
                    found += settle(rows)
                    group, rows = at, []
                rows.append(row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, kind)], names=["first"])
        if rows and (found := settle(rows)):
            yield pa.RecordBatch.from_arrays([pa.array(found, kind)], names=["first"])

    return compare


def far_lines(docs: DataFrame, firsts: DataFrame, most_edits: int, chars_per_edit: int) -> DataFrame:
    """`first` of all lines with an earlier line within their bound, where that is two or more."""
    long = _lines(docs).filter((F.char_length("line") >= MIN_CHARS) & (edit_bound(F.char_length("line"), most_edits, chars_per_edit) > 1))
    # keys are made twice, which costs less than to write them: few are shared
    keys = long.select(_line_id(F.col("line")).alias("line_id"), F.explode(_segments(F.col("line"), most_edits, chars_per_edit)).alias("s"))
    keys = keys.select("line_id", F.col("s.key").alias("segment"), "s.own")
    one = F.col("line_id.k1")
    # combined before they are shuffled, so a segment that very many lines have lies in no task
    shared = keys.groupBy("segment").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.max("own").alias("own")).filter("low < high and own")
    shared = _small(materialize(shared.select("segment"), "shared"))
    members = keys.join(shared, "segment").groupBy("segment", "line_id").agg(F.max("own").alias("own"))
    members = materialize(members.join(firsts.select("line_id", "first"), "line_id"), "members_of_segments")
    texts = _texts(docs, materialize(members.select("line_id", "first").distinct(), "chosen"))
    sizes = materialize(members.groupBy("segment").agg(F.count("*").alias("n"), F.min("first").alias("earliest")), "segments")
    members = materialize(members.drop("line_id").join(sizes, "segment"), "members")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        bound = edit_bound(F.least(F.char_length("a"), F.char_length("b")), most_edits, chars_per_edit)
        apart = F.levenshtein("a", "b", most_edits)
        return materialize(_with_texts(pairs.distinct(), texts).filter((apart >= 0) & (apart <= bound)).select("first").distinct(), name)

    found = verified(members.filter("earliest < first").select("first", F.col("earliest").alias("partner")), "by_earliest")
    # where a segment has two lines, they have met
    more = members.filter("n > 2").withColumn("parts", F.ceil(F.col("n") / PART).cast("int"))
    more = more.withColumn("own_part", F.pmod(F.xxhash64("first"), F.col("parts")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asking = more.join(found, "first", "left_anti").filter("earliest < first")
    asking = asking.select("segment", "first", "own", F.lit(True).alias("asking"), F.col("own_part").alias("part"), others.alias("other"))
    asked = more.filter("earliest < first").select("segment", "first", "own", F.lit(False).alias("asking"), others.alias("part"), F.col("own_part").alias("other"))
    # a segment in which no line is left asks for none
    asked = asked.join(materialize(asking.select("segment").distinct(), "open"), "segment", "left_semi")
    met = asking.unionByName(asked).join(texts, "first")
    met = met.repartition("segment", "part", "other").sortWithinPartitions("segment", "part", "other", "asking")

    def bound(n: np.ndarray) -> np.ndarray:
        return np.minimum(most_edits, 1 + n // chars_per_edit)

    compared = met.select("segment", "part", "other", "asking", "first", "own", "line").mapInArrow(_compared(bound), f"first {dict(texts.dtypes)['first']}")
    return found.unionByName(materialize(compared, "by_others").distinct())


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """`first` of all lines with an earlier line one edit apart. firsts: line_id, first, halves of distinct lines."""
    halves = firsts.filter("n_chars >= {}".format(MIN_CHARS)).select("line_id", "first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    chosen = materialize(halves.join(shared, "half").select("line_id", "first").distinct(), "chosen")
    texts = _texts(docs, chosen)

    emitted = texts.mapInArrow(_emit, f"key long, place long, first {dict(texts.dtypes)['first']}")
    of_key, of_place = Window.partitionBy("key"), Window.partitionBy("key", "place")
    itself = F.col("place") == -1
    met = emitted.select(
        "first",
        itself.alias("itself"),
        F.min(F.when(itself, F.col("first"))).over(of_key).alias("whole"),
        F.min(F.when(~itself, F.col("first"))).over(of_key).alias("longer"),
        F.min("first").over(of_place).alias("changed"),
    )
    partner = F.when(F.col("itself"), F.col("longer")).otherwise(F.least("whole", "changed"))
    pairs = met.select("first", partner.alias("partner")).filter("partner < first").distinct()
    return _with_texts(pairs, texts).filter(F.levenshtein("a", "b", 1) >= 0).select("first").distinct()


def removals(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", most_edits: int = 1, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """Lines to remove per document: key (document_key), gone (their places), n_exact, n_near."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("key", document_key("doc_id", "text"))
    id_type = dict(docs.dtypes)["doc_id"]
    place = F.struct(
        F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit(0).cast(id_type)).alias("doc_id"), F.col("key").alias("key"), F.col("at").alias("at")
    )
    standing = _lines(docs).select(place.alias("place"), _line_id(F.col("line")).alias("line_id"), _halves(F.col("line")).alias("halves"), F.char_length("line").alias("n_chars"))
    standing = materialize(standing, "lines")
    firsts = materialize(
        standing.groupBy("line_id").agg(F.min("place").alias("first"), F.first("halves").alias("halves"), F.first("n_chars").alias("n_chars"), F.count("*").alias("n")), "firsts"
    )
    near = near_lines(docs, firsts)
    if most_edits > 1:
        near = near.unionByName(far_lines(docs, firsts, most_edits, chars_per_edit)).distinct()
    near = materialize(near, "near").withColumn("near", F.lit(True))
    # lines that stand once and have no near line are not looked up
    again = firsts.join(near, "first", "left").filter("n > 1 or near").select("line_id", "first", F.coalesce("near", F.lit(False)).alias("near"))
    again = materialize(again, "again")
    gone = standing.join(again, "line_id").withColumn("exact", F.col("place") != F.col("first")).filter("exact or near")
    return materialize(
        gone.select("place.key", "place.at", "exact")
        .distinct()
        .groupBy("key")
        .agg(
            F.collect_list("at").alias("gone"),
            F.count(F.when(F.col("exact"), 1)).alias("n_exact"),
            F.count(F.when(~F.col("exact"), 1)).alias("n_near"),
        ),
        "gone",
    )


def document_key(doc_id: str, text: str) -> Column:
    return row_key(F.col(doc_id), F.coalesce(text, F.lit("")))


def _without(text: Column, gone: Column) -> Column:
    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), text).otherwise(let(F.split(text, "\n"), kept))


def dedup_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", most_edits: int = 1, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """df with the lines taken out of `text`, and n_exact and n_near, the numbers of lines taken."""
    gone = removals(df, doc_id, text, most_edits, chars_per_edit)
    key, its_key, places = fresh(df, "key"), fresh(df, "its_key"), fresh(df, "places")
    df = df.drop("n_exact", "n_near")
    gone = gone.select(F.col("key").alias(its_key), F.col("gone").alias(places), "n_exact", "n_near")
    rows = df.withColumn(key, document_key(doc_id, text))
    rows = rows.join(gone, rows[key] == gone[its_key], "left")
    return rows.withColumn(text, _without(F.col(text), F.col(places))).drop(key, its_key, places).na.fill(0, ["n_exact", "n_near"])
