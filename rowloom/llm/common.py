"""Small pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once per row.

    Spark may copy an expression to every place that refers to it, inside a lambda once per
    element; an element of an array is computed before the lambda sees it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_hash(*columns: Column, seed: int = 0) -> Column:
    """64 bits over columns, NULLs told apart from values."""
    return F.xxhash64(F.lit(seed), *[part for c in columns for part in (c.isNull(), c)])


def row_key(*columns: Column) -> Column:
    """128 bits over columns, never NULL: a key for joins that stands for the columns' values."""
    return F.struct(row_hash(*columns, seed=1).alias("k1"), row_hash(*columns, seed=2).alias("k2"))


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as many times as the column says (none at 0), the column dropped.

    Counts may be huge: rows are multiplied in two steps, so no array is longer than their root or 10,000.
    """
    step = 10_000
    block, one = fresh(df, "block"), fresh(df, "one")
    blocks = F.sequence(F.lit(0).cast("long"), ((F.col(times) - 1) / step).cast("long"))
    left = F.least(F.lit(step).cast("long"), F.col(times) - F.col(block) * step)
    return (
        df.filter(F.col(times) > 0)
        .withColumn(block, F.explode(blocks))
        .withColumn(one, F.explode(F.sequence(F.lit(1).cast("long"), left)))
        .drop(block, one, times)
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same(left: Column, right: Column) -> Column:
    """Equality for joins in which NULL meets NULL."""
    return left.eqNullSafe(right)
