"""Reading spreadsheets and their exports: every cell is text, the first row names columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowloom import fixed_values as fv
from rowloom.functions.hashing import row_hash
from rowloom.functions.slug import normalize_headers
from rowloom.functions.text import is_blank, normalize_numeric_string, quoted, strip
from rowloom.sources import quoted as records
from rowloom.sources.shared import materialize

# CSV as sheets export it: quotes are doubled, cells may hold line breaks.  Spark's reader cannot split such
# files; they are cut into records by `quoted`.  Machine-made ones without line breaks may be read with multiLine=False.
SHEET_CSV = {"escape": '"', "multiLine": True}


def drop_blank_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Without rows that have no text in any cell."""
    return df.where(_filled([F.col(quoted(c)) for c in columns or df.columns]))


def _filled(cells: list[Column]) -> Column:
    """Whether any cell has text: one expression, however wide the sheet is."""
    return F.exists(F.array(*cells), lambda c: ~is_blank(c)) if cells else F.lit(False)


def with_row_index(df: DataFrame, start: int = fv.FIRST_DATA_ROW, name: str = "_row_index") -> DataFrame:
    """Numbers the rows of a file scan (possibly filtered) in file order, from `start` on.

    Only counts per input block are shuffled: each row knows its place in its task, and a
    block's first number is the sum of the counts of the blocks before it.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__place"),
    )
    block = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__file", "__block")
        .agg(F.count("*").alias("n"), F.min("__place").alias("first"))
        # one narrow row per input block, as in the file listing
        .select("__file", "__block", (F.lit(start) + F.coalesce(F.sum("n").over(block), F.lit(0)) - F.col("first")).alias("__shift"))
    )
    # written, so that Spark knows its size and decides on the join by that
    offsets = materialize(offsets, "offsets")
    numbered = placed.join(offsets, ["__file", "__block"])
    return numbered.select(*[quoted(c) for c in df.columns], (F.col("__place") + F.col("__shift")).alias(name))


def is_header_row(cells: Column) -> Column:
    """True for a row of cells that has all header marks, in any case and order."""
    plain = F.transform(F.filter(cells, lambda c: c != ""), lambda c: F.lower(strip(c)))
    marks = F.array(*[F.lit(m) for m in fv.HEADER_MARKS])
    return F.size(F.array_intersect(plain, marks)) == len(fv.HEADER_MARKS)


def find_header(rows: DataFrame, cells: str = "cells", position: str = "ord",
                scan_rows: int = fv.HEADER_SCAN_ROWS) -> DataFrame:
    """The last header row among the first rows: one row (position, cells), or none.

    `position` counts from 1.
    """
    head = rows.where((F.col(position) <= scan_rows) & is_header_row(F.col(cells)))
    last = F.max_by(F.struct(position, cells), F.col(position))
    return head.agg(last.alias("h")).where("h IS NOT NULL").select("h.*")


def align_cells(rows: DataFrame, names: list[str], cells: str = "cells", keep: tuple[str, ...] = ()) -> DataFrame:
    """Cell arrays as columns: short rows filled with NULL, long ones cut."""
    return rows.select(*keep, *[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_tabular(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    table: str = "",
    mapping: dict[str, str] | None = None,
    header: str = "first",
    **options: str,
) -> DataFrame:
    """All cells as text under normalised names, blank rows left out, plus `_row_index`.

    header="auto" (CSV, one file per sheet) looks for the header among the first rows and
    skips all rows up to it.  Rows shorter than the header are filled with NULL, longer ones
    cut to its length.
    """
    reader = spark.read.format(fmt).options(**(SHEET_CSV | options if fmt == "csv" else options))
    separator = str(options.get("sep", options.get("delimiter", ",")))
    if fmt == "csv" and not options.keys() - {"sep", "delimiter"} and len(separator) == 1:
        # sheets: files of any size are cut into records by many tasks, and parsed once
        if header == "auto":
            names, rows_above = _scan_header(reader, path, separator)
        else:
            names, rows_above = list(reader.option("header", False).load(path).first() or []), 0
        if names:
            found = records.numbered_cells(
                records.read_records(spark, path, separator), SHEET_CSV | options, len(names), header != "auto", fv.FIRST_DATA_ROW - rows_above
            )
            return found.where(F.col("__nr") >= fv.FIRST_DATA_ROW).toDF(*normalize_headers(names, table, mapping), "_row_index")
    if header == "auto":
        names, rows_above = _scan_header(reader, path, separator)
        raw = reader.schema(_text_schema(len(names))).load(path)
        rows = with_row_index(drop_blank_rows(raw), start=fv.FIRST_DATA_ROW - rows_above)
        rows = rows.where(F.col("_row_index") >= fv.FIRST_DATA_ROW)
    else:
        names = None
        if fmt == "csv":
            # Spark renames repeated headers, so they are read as a row and given up as names
            names = list(reader.option("header", False).load(path).first() or [])
            reader = reader.option("header", True).schema(_text_schema(len(names))) if names else reader
        elif fmt == "json":
            reader = reader.option("primitivesAsString", True)
        raw = reader.load(path)
        fields = raw.columns
        names = names or fields
        text = [F.col(quoted(c)).cast("string").alias(f"_c{i}") for i, c in enumerate(fields)]
        filled = _filled([F.col(quoted(c)).cast("string") for c in fields])
        rows = with_row_index(raw.where(filled)).select(*text, "_row_index")
    return rows.toDF(*normalize_headers(names, table, mapping), "_row_index")


def _text_schema(width: int) -> str:
    return ", ".join(f"_c{i} string" for i in range(width))


def _first_rows(reader, path: str, separator: str) -> list:
    """The first rows (cells, whether a header, whether filled), as wide as the widest of them needs."""
    width, raw = 1024, "__raw"
    while True:
        # rows of another width are handed over raw, too, which tells how wide they are at most
        schema = f"{_text_schema(width)}, {raw} string"
        rows = reader.option("columnNameOfCorruptRecord", raw).schema(schema).load(path).limit(fv.HEADER_SCAN_ROWS)
        cells = F.array(*[c for c in rows.columns if c != raw])
        head = rows.select(
            cells.alias("cells"), is_header_row(cells).alias("header"), F.exists(cells, lambda c: ~is_blank(c)).alias("filled"), raw
        ).collect()                                        # at most HEADER_SCAN_ROWS rows
        widest = max((row[raw].count(separator) + 1 for row in head if row[raw]), default=0)
        if widest <= width:
            return head
        width = widest


def _scan_header(reader, path: str, separator: str) -> tuple[list[str], int]:
    """Header cells, and how many non-blank rows there are down to the header."""
    head = _first_rows(reader, path, separator)
    found = [i for i, row in enumerate(head) if row["header"]]
    if not found:
        raise ValueError(f"no header row with {', '.join(fv.HEADER_MARKS)} in {path}")
    names = head[found[-1]]["cells"]
    width = max(i + 1 for i, c in enumerate(names) if c)
    return names[:width], sum(row["filled"] for row in head[: found[-1] + 1])


def last_modified(spark: SparkSession, path: str) -> datetime | None:
    """When the newest file of a source was written; file contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.max("modificationTime").alias("at")).first()["at"]


def is_modified(spark: SparkSession, path: str, seen: datetime | None) -> bool:
    """Whether a source has changed since `seen`; True where either time is unknown."""
    at = last_modified(spark, path)
    return at is None or seen is None or at > seen


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, modified_at) of a source's files; their contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified_at"))


def file_changes(files: DataFrame, noted: DataFrame) -> DataFrame:
    """(file, change) of what differs from the files noted before: `added`, `removed`, or `replaced`.

    A file is replaced if its length or time differs, also where the new one is older or shorter.
    """
    here = files.select("file", F.struct("length", "modified_at").alias("__now"))
    before = noted.select("file", F.struct("length", "modified_at").alias("__then"))
    change = F.when(F.col("__then").isNull(), "added").when(F.col("__now").isNull(), "removed").otherwise("replaced")
    differing = here.join(before, "file", "full_outer").where(~F.col("__now").eqNullSafe(F.col("__then")))
    return differing.select("file", change.alias("change"))


def prepare_rows(df: DataFrame, columns: list[str], numeric: list[str] | None = None) -> DataFrame:
    """Cells ready for staging, with `__row_hash`; other columns stay.

    `numeric` lists the number columns to normalise.  None normalises every column, which
    also takes the inner spaces out of names: only for tables that were filled that way.
    """
    numbers, types = set(columns if numeric is None else numeric), dict(df.dtypes)
    cells = {c: normalize_numeric_string(F.col(quoted(c))) for c in columns if c in numbers}
    cells |= {c: F.col(quoted(c)).cast("string") for c in columns if c not in numbers and types[c] != "string"}
    rest = [quoted(c) for c in df.columns if c not in columns]
    # one projection for the cells and one for the hash: each cell is cleaned once
    cleaned = df.select(*[cells[c].alias(c) if c in cells else quoted(c) for c in columns], *rest)
    return cleaned.withColumn("__row_hash", row_hash(columns))


def to_staging(df: DataFrame, columns: list[str], loaded_at: Column, numeric: list[str] | None = None) -> DataFrame:
    """The staging layout: text columns, `_row_index`, `__row_hash`, `_loaded_at`."""
    return prepare_rows(df, columns, numeric).select(
        *columns, F.col("_row_index").cast("long"), "__row_hash", loaded_at.alias("_loaded_at")
    )
