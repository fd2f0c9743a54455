import hashlib
from collections import Counter

from pyspark.sql import functions as F

from rowloom.llm.sharding import assign_shards, write_shards


def bits_of(key):
    h = hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()
    return bin(int(h[:15], 16))[2:].zfill(60)


def expected(sizes, limit):
    """Splits while a shard is too large: {key: prefix} for keys that occur once."""
    def split(prefix, keys):
        if sum(sizes[k] for k in keys) <= limit or len(keys) == 1:
            return {k: prefix for k in keys}
        out = {}
        for bit in "01":
            half = [k for k in keys if bits_of(k).startswith(prefix + bit)]
            out |= split(prefix + bit, half) if half else {}
        return out

    return split("", list(sizes))


def test_splits_only_what_is_too_large(spark, tmp_path):
    sizes = {k: (k * 37) % 101 + (5000 if k == 77 else 0) for k in range(2000)}
    df = spark.createDataFrame([(k, "x" * n) for k, n in sizes.items()], "doc_id long, text string")
    df.write.parquet(str(tmp_path / "in"))
    got = assign_shards(spark.read.parquet(str(tmp_path / "in")), 1000)
    rows = got.collect()
    assert {r.doc_id: r.shard for r in rows} == expected(sizes, 1000)
    totals = Counter()
    for r in rows:
        totals[r.shard] += len(r.text)
    assert all(r.shard_bytes == totals[r.shard] for r in rows)
    assert all(r.shard_bytes <= 1000 or r.shard_rows == 1 for r in rows)
    write_shards(got, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2000


def test_one_key_with_most_rows_is_split(spark, tmp_path):
    spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.lit("y" * 10).alias("text")).write.parquet(str(tmp_path / "in"))
    rows = assign_shards(spark.read.parquet(str(tmp_path / "in")), 500).collect()
    assert len(rows) == 3000 and max(r.shard_bytes for r in rows) <= 500
    assert max(Counter(r.shard for r in rows).values()) <= 50


def test_awkward_and_empty(awkward, empty, tmp_path):
    awkward.write.parquet(str(tmp_path / "in"))
    got = assign_shards(awkward.sparkSession.read.parquet(str(tmp_path / "in")), 1 << 20)
    assert got.count() == awkward.count() and set(got.columns) >= set(awkward.columns)
    assert {r.shard for r in got.select("shard").collect()} == {""}
    assert assign_shards(empty, 10).count() == 0
