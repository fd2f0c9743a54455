"""Cells whose text a typed column cannot hold, so that they become 0, NULL or a default: counted per column.

Blank cells lose nothing. The counts are one aggregate over the staged rows and the columns in question: exact, also where tasks
are repeated, with one row per task to shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.functions.text import blank_to_null, quoted


def lost(cell: Column, read: Column) -> Column:
    """Whether a cell has text of which reading it (NULL where it cannot be read) leaves nothing."""
    return F.coalesce(blank_to_null(cell.cast("string")).isNotNull() & read.isNull(), F.lit(False))


def loss_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """(column_name, lost_cells), a row for each flagged column, also for those that lose nothing."""
    if not flags:
        return df.sparkSession.createDataFrame([], "column_name string, lost_cells bigint")
    counted = df.agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(quoted(name)).alias("lost_cells")) for name in flags]
    return counted.select(F.inline(F.array(*pairs)))
