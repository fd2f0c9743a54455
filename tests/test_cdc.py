"""Snapshot diff and apply, with repeated, missing and hot keys."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowloom.functions.hashing import row_hash
from rowloom.operators import cdc
from rowloom.sources.tabular import prepare_rows, to_staging

def now():
    return F.lit(datetime(2024, 1, 1))


def source(spark, rows):
    return spark.createDataFrame([(*r, i + 2) for i, r in enumerate(rows)], "id string, __row_hash string, _row_index long")


def target(spark, pairs):
    return spark.createDataFrame([(*p, i + 2) for i, p in enumerate(pairs)], "id string, __row_hash string, _row_index long")


def stats(diff):
    return cdc.cdc_stats(diff).first().asDict()


def test_insert_update_unchanged(spark):
    diff = cdc.cdc_diff(source(spark, [("3", "hash_new"), ("1", "hash_updated"), ("2", "hash_stable")]),
                        target(spark, [("1", "hash_old"), ("2", "hash_stable")]), "id")
    assert stats(diff) == {"inserted": 1, "updated": 1, "deleted": 0, "unchanged": 1}


def test_delete(spark):
    diff = cdc.cdc_diff(source(spark, []), target(spark, [("99", "some_hash")]), "id")
    assert [(r.action, r.id) for r in diff.collect()] == [("DELETE", "99")]


def test_repeats_blanks_and_unhashed_rows(spark):
    diff = cdc.cdc_diff(source(spark, [("1", "a"), ("1", "b"), ("", "c"), (None, "d"), ("5", "e")]),
                        target(spark, [("1", "a"), ("5", ""), (None, "x")]), "id")
    assert sorted((r.action, r.id, r["__row_hash"]) for r in diff.collect()) == [
        ("INSERT", "1", "b"), ("INSERT", "5", "e"), ("UNCHANGED", "1", "a")]


def test_repeats_as_error(spark):
    with pytest.raises(Exception, match="repeats"):
        cdc.cdc_diff(source(spark, [("1", "a"), ("1", "b")]), target(spark, []), "id", on_duplicate="error").collect()


def test_missing_key_column(spark):
    with pytest.raises(ValueError, match="no column"):
        cdc.cdc_diff(source(spark, [("1", "a")]).drop("id"), target(spark, []), "id")


def _random_rows(rnd, n, keys):
    return [(str(k), f"n{rnd.randint(0, 3)}", str(rnd.randint(0, 2))) for k in rnd.sample(range(keys), n)]


@pytest.mark.parametrize("seed", range(3))
def test_apply_gives_the_source(spark, seed):
    rnd = random.Random(seed)
    cols = ["id", "name", "summa"]

    def staged(rows):
        df = spark.createDataFrame([(*r, i + 2) for i, r in enumerate(rows)], "id string, name string, summa string, _row_index long")
        return to_staging(df, cols, now(), numeric=["summa"])

    src, tgt = staged(_random_rows(rnd, 60, 100)), staged(_random_rows(rnd, 50, 100))
    diff = cdc.cdc_diff(src, tgt, "id").cache()
    out = cdc.cdc_apply(tgt, diff, "id", cols, now())
    want = sorted(tuple(r) for r in src.select("id", "name", "summa", "__row_hash").collect())
    assert sorted(tuple(r) for r in out.select("id", "name", "summa", "__row_hash").collect()) == want
    assert out.columns == tgt.columns


def test_updates_keep_place_and_load_time(spark):
    cols = ["id", "name"]
    old, new = F.lit(datetime(2020, 1, 1)), F.lit(datetime(2024, 1, 1))
    tgt = to_staging(spark.createDataFrame([("1", "a", 2), ("2", "b", 3), ("2", "b", 4)], "id string, name string, _row_index long"), cols, old, numeric=[])
    src = prepare_rows(spark.createDataFrame([("9", "z", 2), ("1", "A", 3), ("2", "B", 4)], "id string, name string, _row_index long"), cols, numeric=[])
    out = cdc.cdc_apply(tgt, cdc.cdc_diff(src, tgt, "id"), "id", cols, new)
    got = sorted((r.id, r.name, r._row_index, r._loaded_at.year) for r in out.collect())
    # both stored rows of key 2 change together
    assert got == [("1", "A", 2, 2020), ("2", "B", 3, 2020), ("2", "B", 4, 2020), ("9", "z", 2, 2024)]


def test_hot_key_is_spread(spark):
    """A third of the rows share one key: exact counts, and no task gets them all."""
    n = 30000
    src = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("string").alias("v"), (F.col("id") + 2).alias("_row_index"),
    ).withColumn("__row_hash", row_hash(["id", "v"]))
    tgt = src.where("id <> 'hot'").limit(1000).unionByName(src.where("v = '0'"))
    diff = cdc.cdc_diff(src, tgt, "id")
    assert stats(diff) == {"inserted": n - 1001, "updated": 0, "deleted": 0, "unchanged": 1001}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in cdc.cdc_diff(src, tgt, "id").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < n / 4
