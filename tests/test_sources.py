"""Reading sheets, numbering rows, writing and swapping tables."""

import os
import random
import time
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowloom import fixed_values as fv
from rowloom.sources import layout, sinks, versions as versions_of
from rowloom.sources.shared import materialize, shared_folder
from rowloom.sources.tabular import (
    align_cells, drop_blank_rows, file_changes, find_header, is_modified, last_modified, prepare_rows, read_tabular, source_files,
    to_staging, with_row_index,
)


def test_csv_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Дата,Сумма руб.,Дата,updated_at\n01.12.25,5,x,t\n , ,,\n02.12.25\n03.12.25,7,y,t,extra\n", "utf-8")
    rows = read_tabular(spark, str(tmp_path / "s.csv"), mapping={"updated_at": "sheet_updated_at"})
    assert rows.columns == ["data", "summa_rub", "data_1", "sheet_updated_at", "_row_index"]
    assert [tuple(r) for r in rows.orderBy("_row_index").collect()] == [
        ("01.12.25", "5", "x", "t", 2), ("02.12.25", None, None, None, 3), ("03.12.25", "7", "y", "t", 4)]


def test_header_in_the_sheet(spark, tmp_path):
    lines = ["Отчёт,,", "record_id,content_hash,created_at,updated_at,updated_by,old", "", " , ,",
             "Record_ID ,content_hash,created_at,updated_at,UPDATED_BY,Клиент", "1,h,c,u,b,Иванов,лишнее", "2,h", ",,,,,"] + [
             f"{i},h,c,u,b,К{i}" for i in range(3, 2000)]
    (tmp_path / "s.csv").write_text("\n".join(lines), "utf-8")
    rows = read_tabular(spark, str(tmp_path / "s.csv"), header="auto", mapping={"content_hash": "sheet_content_hash"})
    assert rows.columns == ["record_id", "sheet_content_hash", "created_at", "updated_at", "updated_by", "klient", "_row_index"]
    got = rows.orderBy("_row_index").collect()
    assert [tuple(r) for r in got[:3]] == [("1", "h", "c", "u", "b", "Иванов", 2), ("2", "h", None, None, None, None, 3), ("3", "h", "c", "u", "b", "К3", 4)]
    assert [r._row_index for r in got] == list(range(2, len(got) + 2)) and len(got) == 1999
    (tmp_path / "n.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no header row"):
        read_tabular(spark, str(tmp_path / "n.csv"), header="auto")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_row_numbers_follow_the_files(spark, tmp_path, fmt):
    """Several files in several splits each: numbers run on in file order."""
    path = str(tmp_path / fmt)
    n = 20000
    writer = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("x" * 20).alias("v")).repartitionByRange(4, F.col("k").cast("long"))
    writer = writer.sortWithinPartitions(F.col("k").cast("long")).write.option("header", True).option("parquet.block.size", 20000)
    writer.format(fmt).save(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        # files without line breaks in cells may be split
        rows = read_tabular(spark, path, fmt, **({"multiLine": False} if fmt == "csv" else {}))
        # text files are cut into several splits each
        assert rows.rdd.getNumPartitions() > (3 if fmt == "parquet" else 4)
        bad = rows.where(F.col("k").cast("long") + 2 != F.col("_row_index")).count()
        assert (rows.count(), bad) == (n, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_filtered_rows_are_numbered_without_gaps(spark, tmp_path):
    spark.range(1000).coalesce(3).write.parquet(str(tmp_path / "p"))
    rows = with_row_index(spark.read.parquet(str(tmp_path / "p")).where("id % 3 = 0"))
    got = sorted(r._row_index for r in rows.collect())
    assert got == list(range(2, 336))


def test_cells_and_header(spark):
    raw = spark.createDataFrame([(1, ["x"]), (2, ["updated_by", "record_id", "content_hash", "created_at", " Updated_At "]), (3, ["a", "b"])],
                                "ord long, cells array<string>")
    assert find_header(raw).first().ord == 2
    assert find_header(raw, scan_rows=1).count() == 0
    rows = align_cells(raw.where("ord = 3"), ["p", "q", "r"])
    assert tuple(rows.first()) == ("a", "b", None)
    blank = spark.createDataFrame([("", " \xa0"), (None, "x")], "a string, b string")
    assert drop_blank_rows(blank).count() == 1


def test_prepare_row(spark):
    df = spark.createDataFrame([("1", " Item ", "1 250,50 руб.")], "a string, b string, c string")
    row = prepare_rows(df, ["a", "b", "c"]).first()
    assert (row.a, row.b, row.c, len(row["__row_hash"])) == ("1", "Item", "1250.50", 32)
    assert prepare_rows(df, ["a", "b", "c"], numeric=["c"]).first().b == " Item "


def test_staging_layout(spark):
    df = spark.createDataFrame([(7, 1.5, 2)], "a int, b double, _row_index int")
    out = to_staging(df, ["a", "b"], F.lit(datetime(2024, 1, 1)), numeric=[])
    assert out.dtypes == [("a", "string"), ("b", "string"), ("_row_index", "bigint"), ("__row_hash", "string"), ("_loaded_at", "timestamp")]


def test_gate(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a\n1\n")
    path = str(tmp_path / "s.csv")
    at = last_modified(spark, path)
    assert is_modified(spark, path, None) and not is_modified(spark, path, at)
    assert is_modified(spark, path, at - timedelta(seconds=5))


def test_changes_of_files(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text(f"{name}\n1\n")
    noted = materialize(source_files(spark, str(tmp_path)))

    def changes():
        return sorted((r["file"].rpartition("/")[2], r["change"]) for r in file_changes(source_files(spark, str(tmp_path)), noted).collect())

    assert changes() == []
    old = (tmp_path / "a.csv").stat().st_mtime - 500
    os.utime(tmp_path / "a.csv", (old, old))
    (tmp_path / "b.csv").rename(tmp_path / "d.csv")
    assert changes() == [("a.csv", "replaced"), ("b.csv", "removed"), ("d.csv", "added")]
    assert file_changes(noted, noted.limit(0)).where("change = 'added'").count() == 3
    assert file_changes(noted.limit(0), noted).where("change = 'removed'").count() == 3


def test_conform(spark):
    df = spark.createDataFrame([("k", "5", "x", None)], "legacy_id string, quantity string, full_price string, cash string")
    row = layout.conform(df, layout.SALES, F.lit(datetime(2024, 1, 1))).first()
    assert (row.quantity, float(row.full_price), float(row.cash), row.is_deleted, row.comment) == (5, 0, 0, False, None)
    assert row.created_at == row.updated_at == datetime(2024, 1, 1) and row.deleted_at is None


def test_swap_guards(spark):
    name, root = f"t_{uuid.uuid4().hex}", shared_folder(spark)
    ten = spark.range(10).withColumn("h", F.lit("same"))
    assert sinks.swap_load(spark, ten, name, "id", "h", root=root) == sinks.Swap(True, "", 10, 1)
    assert not sinks.swap_load(spark, spark.range(7), name, "id", root=root).done
    assert not sinks.swap_load(spark, ten.unionByName(ten), name, "id", root=root).done
    assert not sinks.swap_load(spark, spark.range(0), name, "id", root=root).done
    assert spark.table(name).count() == 10 and versions(spark, name) == 1
    # the new version may read the one it replaces
    assert sinks.swap_load(spark, spark.table(name).where("id < 8").select("id"), name, "id", root=root).done
    assert (spark.table(name).count(), spark.table(f"{name}_backup").count()) == (8, 10)
    assert sinks.swap_load(spark, spark.range(1), name, "id", force=True, root=root).done
    # the live version and the one before, and no files of others
    assert versions(spark, name) == 2 and len(folders(root, name)) == 2
    sinks.drop_table(spark, name)
    assert versions(spark, name) == 0 and not folders(root, name)


def versions(spark, name):
    return spark.sql(f"SHOW TABLES LIKE '{name}__*'").count()


def folders(root, name):
    path = Path(root.removeprefix("file:")) / name
    return [p for p in path.iterdir()] if path.exists() else []


@pytest.mark.parametrize("step", ["stage_version", "_show"])
def test_a_swap_that_stops_half_way(spark, monkeypatch, step):
    """The table keeps its rows under its name, and the next load clears what was left."""
    name, root = f"t_{uuid.uuid4().hex}", shared_folder(spark)
    sinks.replace_table(spark.range(3), name, root)
    real = getattr(sinks, step)

    def broken(*args):
        real(*args) if step == "stage_version" else None
        raise RuntimeError("stopped")

    monkeypatch.setattr(sinks, step, broken)
    with pytest.raises(RuntimeError):
        sinks.replace_table(spark.range(5), name, root)
    monkeypatch.undo()
    assert spark.table(name).count() == 3 and versions(spark, name) == 2
    sinks.replace_table(spark.table(name).where("id > 0"), name, root)
    assert spark.table(name).count() == 2 and spark.table(f"{name}_backup").count() == 3
    assert versions(spark, name) == 2 and len(folders(root, name)) == 2


def test_a_plain_table_becomes_the_first_version(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.range(4).write.saveAsTable(name)
    sinks.replace_table(spark.table(name).where("id > 1"), name)
    assert spark.table(name).count() == 2 and spark.table(f"{name}_backup").count() == 4


def test_cells_of_sheets(spark, tmp_path):
    """Quotes, commas, line breaks and blanks at the ends, read and written."""
    cells = ['Иванов "Ваня" И.', 'a, "b", c', "two\nlines", " blanks ", "plain"]
    text = "k,v\n" + "".join('{},"{}"\n'.format(i, c.replace('"', '""')) for i, c in enumerate(cells))
    (tmp_path / "s.csv").write_text(text, "utf-8")
    rows = read_tabular(spark, str(tmp_path / "s.csv")).orderBy("_row_index").collect()
    assert [r.v for r in rows] == cells and [r._row_index for r in rows] == [2, 3, 4, 5, 6]
    sinks.export_mart(spark.createDataFrame(list(enumerate(cells)), "k int, v string").coalesce(1), str(tmp_path / "m"))
    (part,) = (tmp_path / "m").glob("part-*")
    assert part.read_text("utf-8") == 'k,v\n0,"Иванов ""Ваня"" И."\n1,"a, ""b"", c"\n2,"two\nlines"\n3, blanks \n4,plain\n'


@pytest.mark.parametrize("width", [750, 2000])
def test_wide_sheets(spark, tmp_path, width):
    names = ["record_id", "content_hash", "created_at", "updated_at", "updated_by"] + [f"c{i}" for i in range(5, width)]
    lines = [",".join(names), ",".join(f"x{i}" for i in range(width)), "," * (width - 1), "," * (width - 1) + "end"]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    for header in ("first", "auto"):
        rows = read_tabular(spark, str(tmp_path / "s.csv"), header=header, mapping={"updated_at": "u"}).orderBy("_row_index").collect()
        assert len(rows[0]) == width + 1 and [r._row_index for r in rows] == [2, 3]
        assert rows[0][f"c{width - 1}"] == f"x{width - 1}" and rows[1][f"c{width - 1}"] == "end"
    assert drop_blank_rows(spark.createDataFrame([[None] * 500, ["", *["x"] * 499]], ", ".join(f"c{i} string" for i in range(500)))).count() == 1


def test_expire_needs_a_managed_table(spark):
    name = f"d_{uuid.uuid4().hex}"
    dump = sinks.raw_dump(spark.createDataFrame([("a",)], "x string"), "s", "t", F.lit(datetime(2024, 1, 1)))
    sinks.append_table(dump, name, shared_folder(spark), by=("extracted_on",))
    with pytest.raises(ValueError, match="own the files"):
        sinks.expire_dumps(spark, name, datetime(2024, 6, 1))


def test_expire_dumps(spark):
    name = f"d_{uuid.uuid4().hex}"
    base = datetime(2024, 3, 31, 12)
    for days in (0, 29, 30, 31, 45):
        at = base - timedelta(days=days)
        rows = spark.createDataFrame([("a",), ("b",)], "x string")
        sinks.append_table(sinks.raw_dump(rows, "s", "t", F.lit(at)), name, by=("extracted_on",))
    late = sinks.raw_dump(spark.createDataFrame([("c",)], "x string"), "s", "t", F.lit(base - timedelta(days=30, hours=3)))
    sinks.append_table(late, name, by=("extracted_on",))
    assert sinks.expire_dumps(spark, name, base) == 5
    left = spark.table(name)
    assert left.count() == 6 and left.agg(F.min("extracted_at")).first()[0] == base - timedelta(days=30)
    assert sinks.expire_dumps(spark, name, base) == 0


@pytest.mark.parametrize("zone", ["Asia/Yekaterinburg", "America/New_York", "UTC"])
def test_expire_dumps_in_other_zones(spark, monkeypatch, zone):
    """The day of the cut is told in the zone of the rows' days, wherever the driver is."""
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        name = f"d_{uuid.uuid4().hex}"
        as_of = datetime(2024, 1, 31, 2)
        hours = (-5, -1, 1, 5, 30)
        rows = spark.createDataFrame([(str(h), as_of - timedelta(days=30) + timedelta(hours=h)) for h in hours], "x string, at timestamp")
        sinks.append_table(sinks.raw_dump(rows, "s", "t", F.col("at"), ["x"]), name, by=("extracted_on",))
        assert sinks.expire_dumps(spark, name, as_of) == 2
        assert sorted(r.data for r in spark.table(name).collect()) == ['{"x":"1"}', '{"x":"30"}', '{"x":"5"}']
        spark.sql(f"DROP TABLE {name}")
    finally:
        monkeypatch.undo()
        time.tzset()


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("a", None, datetime(2024, 1, 2, 3, 4), 5)], "s string, n string, t timestamp, i int")
    assert sinks.export_mart(df, str(tmp_path / "m"))
    assert not sinks.export_mart(df.where("false"), str(tmp_path / "m"))
    back = spark.read.option("header", True).csv(str(tmp_path / "m")).first()
    assert tuple(back) == ("a", None, "02.01.2024 03:04", "5")


def test_shared_folder(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    df = materialize(spark.range(5))
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().toString()


def test_tables_of_others_are_left_alone(spark):
    """Names that look like versions, and a loaded table whose own versions do."""
    name, root = f"t_{uuid.uuid4().hex}", shared_folder(spark)
    foreign = [f"{name}__archive_2023", f"{name}__{'0' * 32}"]
    for other in foreign:
        spark.range(7).write.saveAsTable(other)
    sinks.replace_table(spark.range(2), f"{name}__x", root)
    for n in (3, 4, 5):
        sinks.replace_table(spark.range(n), name, root)
    assert [spark.table(t).count() for t in (*foreign, f"{name}__x", name, f"{name}_backup")] == [7, 7, 2, 5, 4]
    sinks.drop_table(spark, name)
    assert [spark.table(t).count() for t in (*foreign, f"{name}__x")] == [7, 7, 2]
    sinks.drop_table(spark, f"{name}__x")
    for other in foreign:
        spark.sql(f"DROP TABLE {other}")


def test_concurrent_loads_and_readers(spark):
    name, root = f"t_{uuid.uuid4().hex}", shared_folder(spark)
    sinks.replace_table(spark.range(3), name, root)
    registry = versions_of.Registry(spark, name)
    with registry.holder() as holder, sinks.reading(spark, name) as first:
        before = sinks.shown_version(spark, name)
        staged = sinks.stage_version(spark.range(9), name, root, holder)
        for n in (4, 5, 6):
            sinks.replace_table(spark.range(n), name, root)
        # neither the version that is being read nor the one that is being loaded went
        assert first.count() == 3 and spark.table(staged).count() == 9
        with pytest.raises(versions_of.ConcurrentLoad, match="meanwhile"):
            sinks.swap_in(spark, name, staged, before)
        assert spark.table(name).count() == 6
    with registry.lock(), pytest.raises(versions_of.ConcurrentLoad, match="just being"):
        sinks.replace_table(spark.range(1), name, root)
    sinks.replace_table(spark.range(7), name, root)
    assert versions(spark, name) == 2 and len(registry.owned()) == 2


def test_leases_of_other_sessions_expire(spark, monkeypatch):
    name, root = f"t_{uuid.uuid4().hex}", shared_folder(spark)
    sinks.replace_table(spark.range(3), name, root)
    crashed = sinks.stage_version(spark.range(9), name, root, "other-application.1")
    sinks.replace_table(spark.range(4), name, root)
    assert spark.table(crashed).count() == 9
    monkeypatch.setattr(versions_of.time, "time", lambda now=time.time: now() + versions_of.LEASE_SECONDS + 9)
    sinks.replace_table(spark.range(5), name, root)
    assert not spark.catalog.tableExists(crashed) and versions(spark, name) == 2


def _by_reader(spark, path, sep=","):
    """What Spark's own reader makes of a sheet, without rows that have no text, in file order."""
    raw = spark.read.options(escape='"', multiLine=True, header=False, sep=sep).schema(", ".join(f"_c{i} string" for i in range(3))).csv(path)
    return [tuple(r) for r in raw.collect() if any(c and c.strip() for c in r)]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_quoted_files_are_split(spark, tmp_path, seed, ends):
    """Cells with line breaks, quotes and separators over blocks of a few bytes: each record once, in order."""
    chance = random.Random(seed)
    path = tmp_path / "sheets"
    path.mkdir()
    expected = []
    for k in range(3):
        rows = [["k", "v", "w"]]
        for i in range(150):
            cell = "".join(chance.choice(["a", "b ", '""', ",", "\n", "é😀", "x" * 30]) for _ in range(chance.choice([0, 1, 3, 12])))
            rows.append([f"{k}-{i}", f'"{cell}"', chance.choice(["", "z", '" "', '""""'])] if chance.random() < 0.85 else chance.choice([["", " ", '" "'], ["", '"\n"', ""], [""]]))
        (path / f"{k}.csv").write_text(ends.join(",".join(r) for r in rows), "utf-8", newline="")
        expected += _by_reader(spark, str(path / f"{k}.csv"))[1:]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_tabular(spark, str(path)).orderBy("_row_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r)[:3] for r in rows] == expected
    assert [r[3] for r in rows] == list(range(2, len(expected) + 2))


def test_a_cell_over_many_blocks(spark, tmp_path):
    lines = "\n".join(f"line {i} of a long cell" for i in range(400))
    (tmp_path / "s.csv").write_text(f'a,b\n1,"{lines}"\n2,end\n3,"open', "utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = [tuple(r) for r in read_tabular(spark, str(tmp_path / "s.csv")).orderBy("_row_index").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got[:2] == [("1", lines, 2), ("2", "end", 3)] and got[2][0] == "3"


@pytest.mark.parametrize("sep", [",", ";", "\t"])
def test_wide_sheets_of_any_separator(spark, tmp_path, sep):
    marks = [*fv.HEADER_MARKS]
    names = marks + [f"c{i}" for i in range(2000 - len(marks))]
    rows = [["Title"], names, [str(i) for i in range(2000)]]
    (tmp_path / "s.csv").write_text("\n".join(sep.join(r) for r in rows), "utf-8")
    found = read_tabular(spark, str(tmp_path / "s.csv"), header="auto", sep=sep)
    assert len(found.columns) == 2001 and tuple(found.first()) == (*map(str, range(2000)), 2)
