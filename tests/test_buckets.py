"""Tables in buckets: what a load writes, what it leaves, and what goes with a version."""

import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowloom.operators import cdc, merge, quality
from rowloom.plans.run import apply_changes
from rowloom.sources import buckets, sinks
from rowloom.sources.shared import shared_folder

NOW = datetime(2024, 5, 1)


@pytest.fixture
def place(spark):
    name = f"b_{uuid.uuid4().hex}"
    yield name, shared_folder(spark)
    sinks.drop_table(spark, name)


def shown(spark, name):
    layout = buckets.buckets_of(spark, sinks.shown_version(spark, name))
    return buckets.places(spark, layout)


def files(root, name):
    path = Path(root.removeprefix("file:")) / name
    return list(path.rglob("*.parquet")) if path.exists() else []


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def rows(df):
    return sorted(((r["k"], r["v"]) for r in df.collect()), key=str)


def test_one_changed_row_writes_one_bucket(spark, place):
    name, root = place
    sinks.replace_in_buckets(table(spark, [(f"k{i}", i) for i in range(500)]), name, "k", 16, root)
    assert spark.table(name).columns == ["k", "v"] and spark.table(name).count() == 500
    before = shown(spark, name)
    assert sorted(before) == list(range(16))
    change = table(spark, [("k7", -7)])
    done = sinks.change_buckets(spark, name, change.select("k"),
                                lambda part: part.join(change.select("k"), "k", "left_anti").unionByName(change))
    after = shown(spark, name)
    assert done == sinks.Rewritten(1, 16) and sum(before[b] != after[b] for b in before) == 1
    assert rows(spark.table(name)) == sorted([(f"k{i}", -7 if i == 7 else i) for i in range(500)], key=str)
    # the version before still has its rows
    assert rows(spark.table(f"{name}_backup")) == sorted([(f"k{i}", i) for i in range(500)], key=str)
    # no keys, no version
    assert sinks.change_buckets(spark, name, change.select("k").limit(0), lambda part: part) == sinks.Rewritten(0, 16)
    assert shown(spark, name) == after


def test_only_hit_buckets_are_read(spark, place):
    name, root = place
    sinks.replace_in_buckets(table(spark, [(f"k{i}", i) for i in range(200)]), name, "k", 8, root)
    seen = []

    def change(part):
        seen.append({f.rpartition("/")[0].rpartition("/")[2] for f in part.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]})
        return part

    keys = table(spark, [("k1", 0), ("k1", 1)]).select("k")
    sinks.change_buckets(spark, name, keys, change)
    wanted = buckets.hit(keys, buckets.Buckets("k", 8, ""))
    assert seen == [{f"{buckets.BUCKET}={b}" for b in wanted}] and len(wanted) == 1


def test_files_go_with_the_last_version_that_shows_them(spark, place):
    name, root = place
    sinks.replace_in_buckets(table(spark, [(f"k{i}", i) for i in range(100)]), name, "k", 4, root)
    for n in range(4):
        change = table(spark, [("k1", 1000 + n)])
        sinks.change_buckets(spark, name, change.select("k"), lambda part: part.where("k <> 'k1'").unionByName(change))
        assert spark.table(name).count() == 100 and spark.table(name).where("k = 'k1'").first()["v"] == 1000 + n
    # two versions are left, which share three of four buckets
    assert len(set(shown(spark, name).values())) == 4
    data = {f.parent for f in files(root, name) if f.parent.name.startswith(buckets.BUCKET)}
    assert len(data) == 5
    sinks.replace_table(table(spark, [("x", 1)]), name, root)
    assert spark.table(f"{name}_backup").count() == 100
    sinks.drop_table(spark, name)
    assert not files(root, name)


def test_only_changed_buckets_are_counted_again(spark, place, monkeypatch):
    name, root = place
    many = [(f"k{i}", i) for i in range(100)] + [(f"k{i}", -i) for i in range(0, 100, 5)] + [("hot", i) for i in range(200)] + [(None, 1), (None, 2)]
    sinks.replace_in_buckets(table(spark, many), name, "k", 16, root)

    def full():
        return rows(quality.duplicate_keys(spark.table(name), ["k"]).select("k", F.col("cnt").alias("v")))

    def noted():
        return rows(sinks.repeated_keys(spark, name, "k").select("k", F.col("cnt").alias("v")))

    assert noted() == full() and len(full()) == 21
    counted = []
    count = buckets._count_keys
    monkeypatch.setattr(buckets, "_count_keys", lambda spark, version, layout, before, changed: counted.append(changed) or count(spark, version, layout, before, changed))
    change = table(spark, [("k3", 7)])
    sinks.change_buckets(spark, name, change.select("k"), lambda part: part.unionByName(change))
    assert counted == [buckets.hit(change.select("k"), buckets.Buckets("k", 16, ""))] and noted() == full() and len(full()) == 22
    gone = table(spark, [("hot", 0), ("k5", 0)]).select("k")
    sinks.change_buckets(spark, name, gone, lambda part: part.join(gone, "k", "left_anti"))
    assert noted() == full() and len(full()) == 20
    layout = buckets.buckets_of(spark, sinks.shown_version(spark, name))
    assert buckets.repeated(spark, layout).where("key IS NULL").first()["cnt"] == 2
    # another key is not told by these notes, nor is a table without buckets
    assert sinks.repeated_keys(spark, name, "v") is None
    sinks.replace_table(table(spark, many), name, root)
    assert sinks.repeated_keys(spark, name, "k") is None


def test_issues_out_of_the_notes(spark, place):
    name, root = place
    sinks.replace_in_buckets(table(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)]), name, "k", 4, root)
    df = spark.table(name)
    found = quality.table_issues(df, name, "k", ["k"], sinks.repeated_keys(spark, name, "k"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, quality.table_issues(df, name, "k", ["k"]).collect()))


def test_a_version_that_was_never_counted(spark, place):
    """Tables that were loaded before there were such notes are counted whole by the next load."""
    name, root = place
    sinks.replace_in_buckets(table(spark, [("a", 1), ("a", 2), ("b", 3)]), name, "k", 8, root)
    layout = buckets.buckets_of(spark, sinks.shown_version(spark, name))
    path, fs = buckets._fs(spark, f"{layout.folder}/repeated")
    fs.delete(path, True)
    assert sinks.repeated_keys(spark, name, "k") is None
    change = table(spark, [("b", 4)])
    sinks.change_buckets(spark, name, change.select("k"), lambda part: part.unionByName(change))
    assert rows(sinks.repeated_keys(spark, name, "k").select("k", F.col("cnt").alias("v"))) == [("a", 2), ("b", 2)]


def test_nulls_hot_keys_and_emptied_buckets(spark, place):
    name, root = place
    many = [("hot", i) for i in range(300)] + [(None, 1), (None, 2), ("", 3)]
    sinks.replace_in_buckets(table(spark, many), name, "k", 4, root)
    assert rows(spark.table(name)) == sorted(many, key=str)
    sinks.change_buckets(spark, name, table(spark, [("hot", 0)]).select("k"), lambda part: part.where("k IS NULL OR k <> 'hot'"))
    assert rows(spark.table(name)) == sorted([(None, 1), (None, 2), ("", 3)], key=str)
    sinks.replace_in_buckets(table(spark, []), name, "k", 4, root)
    assert spark.table(name).count() == 0 and spark.table(name).columns == ["k", "v"]
    sinks.change_buckets(spark, name, table(spark, [("a", 1)]).select("k"), lambda part: part.unionByName(table(spark, [("a", 1)])))
    assert rows(spark.table(name)) == [("a", 1)]


def test_rows_for_other_buckets_are_refused(spark, place):
    name, root = place
    sinks.replace_in_buckets(table(spark, [(f"k{i}", i) for i in range(50)]), name, "k", 16, root)
    before = shown(spark, name)
    stray = next(f"s{i}" for i in range(99)
                 if buckets.hit(table(spark, [(f"s{i}", 0)]).select("k"), buckets.Buckets("k", 16, "")) !=
                 buckets.hit(table(spark, [("k1", 0)]).select("k"), buckets.Buckets("k", 16, "")))
    with pytest.raises(ValueError, match="not to be changed"):
        sinks.change_buckets(spark, name, table(spark, [("k1", 0)]).select("k"), lambda part: part.unionByName(table(spark, [(stray, 1)])))
    assert shown(spark, name) == before and spark.table(name).count() == 50
    sinks.replace_table(table(spark, [("a", 1)]), f"{name}_plain", root)
    with pytest.raises(ValueError, match="not kept in buckets"):
        sinks.change_buckets(spark, f"{name}_plain", table(spark, [("a", 1)]).select("k"), lambda part: part)
    sinks.drop_table(spark, f"{name}_plain")


def test_a_load_that_stops_half_way(spark, place, monkeypatch):
    name, root = place
    sinks.replace_in_buckets(table(spark, [(f"k{i}", i) for i in range(40)]), name, "k", 4, root)
    change = table(spark, [("k1", -1)])

    def put(part):
        return part.where("k <> 'k1'").unionByName(change)

    monkeypatch.setattr(sinks, "_show", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        sinks.change_buckets(spark, name, change.select("k"), put)
    monkeypatch.undo()
    assert spark.table(name).count() == 40 and spark.table(name).where("v = -1").count() == 0
    sinks.change_buckets(spark, name, change.select("k"), put)
    assert spark.table(name).where("v = -1").count() == 1 and spark.table(f"{name}_backup").count() == 40
    assert spark.sql(f"SHOW TABLES LIKE '{name}__*'").count() == 2


def staged(spark, values):
    return spark.createDataFrame([(k, v, i, f"h{v}") for i, (k, v) in enumerate(values)], "k string, v int, _row_index long, __row_hash string")


def test_snapshot_in_buckets_equals_the_whole_table(spark, place):
    name, root = place
    old = [(f"k{i}", i) for i in range(120)]
    new = [(f"k{i}", i + 1000 if i % 40 == 0 else i) for i in range(2, 122)]
    before, after = staged(spark, old).withColumn("_loaded_at", F.lit(NOW)), staged(spark, new)
    sinks.replace_in_buckets(before, name, "k", 64, root)
    places = shown(spark, name)
    figures = apply_changes(spark.table(name), after, name, "k", ["k", "v"], F.lit(NOW), root)
    assert (figures["inserted"], figures["updated"], figures["deleted"]) == (2, 2, 2)
    diff = cdc.cdc_diff(after, before, "k")
    assert rows(spark.table(name)) == rows(cdc.cdc_apply(before, diff, "k", ["k", "v"], F.lit(NOW)))
    now = shown(spark, name)
    assert 0 < sum(places.get(b) != now.get(b) for b in set(places) | set(now)) <= 6


def test_upsert_in_buckets_equals_the_whole_table(spark, place):
    name, root = place
    target = table(spark, [(f"k{i}", i) for i in range(60)] + [(None, 5)])
    source = table(spark, [("k3", -3), ("new", 1)])
    sinks.replace_in_buckets(target, name, "k", 32, root)
    done = sinks.change_buckets(spark, name, source.select("k"), lambda part: merge.upsert(part, source, "k", F.lit(NOW)))
    assert done.buckets <= 2 and rows(spark.table(name)) == rows(merge.upsert(target, source, "k", F.lit(NOW)))


def test_in_the_warehouse_of_another_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stg_buckets")
    name = "stg_buckets.sales"
    sinks.replace_in_buckets(table(spark, [(f"k{i}", i) for i in range(30)]), name, "k", 4)
    change = table(spark, [("k1", -1)])
    assert sinks.change_buckets(spark, name, change.select("k"), lambda part: part.where("k <> 'k1'").unionByName(change)).buckets == 1
    assert spark.table(name).count() == 30 and spark.table(name).where("v = -1").count() == 1
    sinks.drop_table(spark, name)
    assert spark.sql("SHOW TABLES IN stg_buckets").isEmpty()
    spark.sql("DROP DATABASE stg_buckets")
