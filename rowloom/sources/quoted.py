"""Quoted text in many tasks: records that may hold line breaks, out of files that are read in blocks.

A line is inside a quoted cell if an odd number of quotes stands before it. A first pass counts the quotes of every
block of the files; their parities, put together in file order, tell how each block begins. In the second pass every block
cuts its lines into records by itself. A record that runs on into the next blocks is handed over in pieces, the only text
that is shuffled. Records without text in any cell are left out; the others are numbered in their block as they come.

Lines end with a line feed, or a carriage return and a line feed; quotes in cells are doubled.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rowloom.functions.text import SPACES
from rowloom.sources.shared import materialize

WHOLE, HEAD, REST = 0, 1, 2      # a record; one that is still open at its block's end; what is missing of such a one

_STATE = "file string, block long, quotes int, records_outside long, records_inside long"
_PIECE = "file string, block long, nr long, part int, piece long, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array, np.ndarray]]:
    """The lines of each block in a batch: file, block, lines, whether a line has an odd number of quotes."""
    file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    codes = file.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(block) != 0)) + 1
    odd = pc.count_substring(batch.column("value"), '"').to_numpy() & 1
    for start, end in zip([0, *cuts], [*cuts, len(batch)]):
        if end > start:
            yield file.dictionary[int(codes[start])].as_py(), int(block[start]), batch.column("value").slice(start, end - start), odd[start:end]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: the parity of its quotes, and how many records start in it if it begins outside or inside a cell."""
    seen: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for file, block, lines, odd in _runs(batch):
            state = seen.setdefault((file, block), [0, 0, 0])
            before = (state[0] + np.cumsum(odd) - odd) & 1
            inside = int(before.sum())
            state[0] = (state[0] + int(odd.sum())) & 1
            state[1] += len(lines) - inside
            state[2] += inside
    if seen:
        files, blocks = zip(*seen)
        quotes, outside, inside = zip(*seen.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(files), pa.array(blocks, pa.int64()), pa.array(quotes, pa.int32()), pa.array(outside, pa.int64()), pa.array(inside, pa.int64())],
            names=["file", "block", "quotes", "records_outside", "records_inside"],
        )


def block_states(lines: DataFrame) -> DataFrame:
    """file, block, inside (how it begins), owner (the block of the record it goes on with); a row per block of the files."""
    counted = materialize(lines.mapInArrow(_count, _STATE), "quotes")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = counted.withColumn("inside", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    starts = F.when(F.col("inside") == 0, F.col("records_outside")).otherwise(F.col("records_inside"))
    return states.select("file", "block", "inside", F.last(F.when(starts > 0, F.col("block")), ignorenulls=True).over(before).alias("owner"))


def _cut(separator: str):
    blank = SPACES + separator + '"\n\r'

    def empty(record: str) -> bool:
        if record.strip(blank):
            return False
        return '"' not in record or not any(cell.strip(SPACES) for row in csv.reader([record], delimiter=separator) for cell in row)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, nr, waiting, owner = None, 0, 0, None, 0
        out: list[tuple] = []

        def give(part: int, last: bool = False) -> None:
            """What waits is a record, or the piece of one that starts or ends in another block."""
            nonlocal nr, waiting
            record = "\n".join(waiting)
            if record.endswith("\r") and (part == WHOLE or last):
                record = record[:-1]
            if part == REST:
                out.append((at[0], owner, None, REST, at[1], record))
            elif part == HEAD or not empty(record):
                out.append((*at, nr, part, at[1], record))
                nr += 1
            waiting = None

        def close() -> None:
            """At a block's end."""
            if waiting is not None:
                give(REST if nr < 0 else HEAD if inside else WHOLE, last=not inside)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in _PIECE.split(", ")])

        for batch in batches:
            begins, owners, k = batch.column("inside"), batch.column("owner"), 0
            for file, block, lines, odd in _runs(batch):
                if at != (file, block):
                    close()
                    at, inside, owner = (file, block), begins[k].as_py(), owners[k].as_py()
                    nr, waiting = (-1, []) if inside else (0, None)
                k += len(lines)
                starts = np.flatnonzero((inside + np.cumsum(odd) - odd) & 1 == 0).tolist()
                texts = lines.to_pylist()
                if waiting is not None:
                    waiting += texts[: starts[0]] if starts else texts
                    if starts:
                        give(REST if nr < 0 else WHOLE, last=True)
                if starts:
                    nr = max(nr, 0)
                    for a, b in zip(starts, starts[1:]):
                        waiting = texts[a:b]
                        give(WHOLE)
                    waiting = texts[starts[-1] :]
                inside = (inside + int(odd.sum())) & 1
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    return cut


def read_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """file, block, nr (0, 1, ... in the block), record: the filled records of all files. The text is read twice, and not shuffled."""
    lines = _lines(spark, path)
    # one row per block of the files: the driver lists as many splits for the scan itself
    states = F.broadcast(block_states(lines))
    begun = lines.join(states, ["file", "block"])
    pieces = begun.select("file", "block", "inside", "owner", "value").mapInArrow(_cut(separator), _PIECE)
    open_ = pieces.where(F.col("part") != WHOLE)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("part", "piece", "record"))), lambda p: p["record"])
    joined = open_.groupBy("file", "block").agg(F.max("nr").alias("nr"), F.array_join(ordered, "\n").alias("record"))
    return pieces.where(F.col("part") == WHOLE).select("file", "block", "nr", "record").unionByName(joined)


def numbered_cells(records: DataFrame, options: dict[str, str], width: int, header: bool, start: int) -> DataFrame:
    """The cells _c0, _c1, ... of the records and their number in file order (__nr), written; without each file's first one if that is a header."""
    schema = ", ".join(f"_c{i} string" for i in range(width))
    cells = F.from_csv("record", schema, {k: str(v) for k, v in options.items()})
    # a generator, for a record is to be parsed once and not once for every cell that is asked for
    rows = records.select("file", "block", "nr", F.inline(F.array(cells)))
    # what was put together from pieces may turn out blank
    filled = F.exists(F.array(*[f"_c{i}" for i in range(width)]), lambda c: F.trim(c, F.lit(SPACES)) != "")
    rows = materialize(rows.where(F.coalesce(filled, F.lit(False))), "records")
    counts = rows.groupBy("file", "block").agg(F.count("*").alias("n"))
    in_order, of_file = Window.orderBy("file", "block"), Window.partitionBy("file").orderBy("block")
    counts = counts.withColumn("headers", F.when(F.row_number().over(of_file) == 1, 1).otherwise(0) if header else F.lit(0))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # one narrow row per block, as in the file listing
    shifts = counts.select(
        "file", "block", "headers", (F.lit(start) + F.coalesce(F.sum(F.col("n") - F.col("headers")).over(before), F.lit(0)) - F.col("headers")).alias("shift")
    )
    placed = rows.join(materialize(shifts, "shifts"), ["file", "block"]).where(F.col("nr") >= F.col("headers"))
    return placed.select(*[f"_c{i}" for i in range(width)], (F.col("nr") + F.col("shift")).cast("long").alias("__nr"))
