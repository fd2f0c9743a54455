"""Sharding by extendible hashing.

Rows are hashed to bits. A directory starts as one shard for all rows; a shard above the byte limit is split
on the next bit, and only such shards are, until every one fits. The directory maps prefixes of bits to
shards: no shard's prefix is a prefix of another's.

The first 60 bits are of the row's key, so rows of a key stay together as long as they fit. Rows of one
key that exceed the limit are told apart by 60 more bits, of the row's number in the input. A single
row above the limit is a shard of its own. NULL keys hash like empty ones, NULL sizes count 0. An
empty table gives an empty result. Repeated rows are rows of the same key.

Bytes are summed for STEP bits at a time: a round reads only rows of shards still too large, and there
are as many rounds as the deepest shard has steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import fresh
from rowloom.sources.shared import materialize

STEP = 12
_HALF = 60


def _hash_bits(text: Column) -> Column:
    return F.lpad(F.conv(F.substring(F.md5(text), 1, _HALF // 4), 16, 2), _HALF, "0")


def bits(key: str) -> Column:
    """The 120 bits of a row as text; not to be moved behind a shuffle, as the row's number is part of it."""
    key = F.coalesce(F.col(key).cast("string"), F.lit(""))
    number = F.monotonically_increasing_id().cast("string")
    return F.concat(_hash_bits(key), _hash_bits(F.concat(key, F.lit("\x1f"), number)))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The shards of rows (bits, n_bytes): shard (its prefix), shard_bytes, shard_rows."""
    leaves, depth, parents = [], 0, None
    size, count = F.sum("n_bytes").alias("b"), F.count("*").alias("n")
    while True:
        reached = min(depth + STEP, 2 * _HALF)
        part = rows
        if parents is not None:
            part = rows.join(parents.select("prefix"), F.substring("bits", 1, depth) == F.col("prefix"), "left_semi")
        cells = part.groupBy(F.substring("bits", 1, reached).alias("cell")).agg(size, count)
        depths = F.explode(F.sequence(F.lit(depth if parents is None else depth + 1), F.lit(reached)))
        sums = (
            cells.withColumn("depth", depths)
            .groupBy(F.expr("substring(cell, 1, depth)").alias("prefix"))
            .agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        )
        nodes = materialize(sums, "nodes")
        large = (F.col("b") > limit) & (F.col("n") > 1) & (F.char_length("prefix") < 2 * _HALF)
        if parents is None:
            leaves.append(nodes.filter((F.col("prefix") == "") & ~large))
        split = nodes.filter(large & (F.char_length("prefix") < reached)).select("prefix")
        if parents is not None:
            split = split.unionByName(parents.select("prefix"))
        halves = split.select(F.explode(F.array(F.concat("prefix", F.lit("0")), F.concat("prefix", F.lit("1")))).alias("prefix"))
        # a half without rows is a shard too: the directory has an answer for every hash
        leaves.append(halves.join(nodes, "prefix", "left").na.fill(0, ["b", "n"]).filter(~large))
        parents = nodes.filter(large & (F.char_length("prefix") == reached)) if reached < 2 * _HALF else None
        if parents is None or parents.isEmpty():
            found = reduce(DataFrame.unionByName, leaves)
            return found.select(F.col("prefix").alias("shard"), F.col("b").alias("shard_bytes"), F.col("n").alias("shard_rows"))
        depth = reached


def look_up(rows: DataFrame, shards: DataFrame, bits: str = "bits") -> DataFrame:
    """Adds shard, shard_bytes and shard_rows to rows that have bits."""
    # at most 121 depths
    depths = sorted(r[0] for r in shards.select(F.char_length("shard")).distinct().collect())
    prefix = fresh(rows, "prefix")
    ways = F.array(*(F.substring(bits, 1, d) if d else F.lit("") for d in depths)) if depths else F.array().cast("array<string>")
    return rows.withColumn(prefix, F.explode(ways)).join(shards, F.col(prefix) == shards["shard"]).drop(prefix)


def assign_shards(df: DataFrame, limit: int, key: str = "doc_id", size: Column | None = None, text: str = "text") -> DataFrame:
    """Adds shard (prefix bits), shard_bytes and shard_rows to a table read from files.

    `size` is a row's bytes; the length of `text` unless given. Columns of those names are replaced.
    """
    if limit < 1:
        raise ValueError("the limit must be at least 1 byte")
    size = F.octet_length(text) if size is None else size
    bits_name, size_name = fresh(df, "bits"), fresh(df, "n_bytes")
    df = df.drop("shard", "shard_bytes", "shard_rows").withColumns({bits_name: bits(key), size_name: F.coalesce(size, F.lit(0)).cast("long")})
    narrow = materialize(df.select(F.col(bits_name).alias("bits"), F.col(size_name).alias("n_bytes")), "rows")
    shards = materialize(directory(narrow, limit), "directory")
    return look_up(df, shards, bits_name).drop(bits_name, size_name)


def write_shards(assigned: DataFrame, path: str) -> None:
    """Writes one folder per shard; a shard fits a task by its limit."""
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)
