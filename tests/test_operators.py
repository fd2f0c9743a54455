"""Merge, soft delete, quality, ledgers, marts on small tables."""

import random
import uuid as uuids
from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from rowloom import fixed_values as fv
from rowloom.operators import ledger, merge, quality
from rowloom.plans import marts, transforms
from rowloom.sources import layout


def at(day, month=1, hour=0):
    return datetime(2024, month, day, hour)


def test_first_per_key_cuts_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, n int")
    out = merge.first_per_key(df, ["k"], ["n"])
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 5)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_lookup_takes_the_smallest_id(spark):
    rows = spark.createDataFrame([("Ann",), ("Bob",), (None,)], "who string")
    names = spark.createDataFrame([("Ann", "2"), ("Ann", "1"), (None, "0")], "name string, id string")
    inner = merge.lookup_by_name(rows, F.col("who"), names, "name", "id", "client_id")
    assert [tuple(r) for r in inner.collect()] == [("Ann", "1")]
    left = merge.lookup_by_name(rows, F.col("who"), names, "name", "id", "client_id", how="left")
    assert left.count() == 3


def test_upsert(spark):
    t = spark.createDataFrame(
        [("1", "old", "keep", True, at(1), at(1), at(1)), ("2", "b", "k2", False, None, at(1), at(1)), (None, "n", "k3", False, None, at(1), at(1))],
        "legacy_id string, name string, age string, is_deleted boolean, deleted_at timestamp, created_at timestamp, updated_at timestamp")
    s = spark.createDataFrame([("1", None), ("3", "new")], "legacy_id string, name string")
    out = {r.legacy_id: r for r in merge.upsert(t, s, "legacy_id", F.lit(at(9))).collect()}
    assert len(out) == 4
    # matched: overwritten even by NULL, alive again, created_at and other columns kept
    assert (out["1"].name, out["1"].age, out["1"].is_deleted, out["1"].deleted_at, out["1"].created_at, out["1"].updated_at) == \
        (None, "keep", False, None, at(1), at(9))
    assert out["2"].updated_at == at(1) and out[None].name == "n"
    assert (out["3"].name, out["3"].age, out["3"].is_deleted, out["3"].created_at) == ("new", None, False, at(9))


def test_history_wins_over_current(spark):
    cur = spark.createDataFrame([("1", "cur"), ("2", "cur")], "legacy_id string, source string")
    hst = spark.createDataFrame([("1", "hst")], "legacy_id string, source string")
    empty = spark.createDataFrame([], "legacy_id string, source string, is_deleted boolean, created_at timestamp")
    out = transforms.merge_current_then_history(empty, cur, hst, F.lit(at(1)))
    assert sorted((r.legacy_id, r.source) for r in out.collect()) == [("1", "hst"), ("2", "cur")]
    assert transforms.merge_current_then_history(empty, None, None, F.lit(at(1))) is empty


def test_insert_absent(spark):
    have = spark.createDataFrame([("a",)], "k string")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2)], "k string, n int")
    assert [tuple(r) for r in merge.insert_absent(have, new, "k").collect()] == [("b", 2)]


def test_soft_delete(spark):
    core = spark.createDataFrame(
        [("1", "h1", "cur", False, "s"), ("2", "gone", "cur", False, "s"), ("3", None, "cur", False, "s"), ("4", "h1", "hst", False, "s"),
         ("5", "gone", "cur", True, "s"), ("6", "gone", "else", False, "s")],
        "legacy_id string, row_hash string, source string, is_deleted boolean, status string").withColumn("deleted_at", F.lit(None).cast("timestamp"))
    staged = merge.staged_hashes(("cur", spark.createDataFrame([("h1",), (None,)], "__row_hash string")), ("hst", spark.createDataFrame([("x",)], "__row_hash string")))
    out = merge.soft_delete(core, staged, F.lit(at(5)), sources=["cur", "hst"])
    assert sorted(r.legacy_id for r in out.where("just_deleted").collect()) == ["2", "4"]
    assert {r.source: r.deleted for r in merge.soft_delete_counts(out).collect()} == {"cur": 1, "hst": 1, "else": 0}
    every = merge.soft_delete(core, staged, F.lit(at(5)), status="deleted")
    assert {r.legacy_id: r.status for r in every.where("just_deleted").collect()} == {"2": "deleted", "6": "deleted"}
    assert every.where("just_deleted AND deleted_at IS NULL").count() == 0


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, None), (None, "y")], "k string, v string")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    assert quality.duplicate_keys(df, ["k"], skip_null=False).count() == 2
    assert quality.duplicate_hash_count(df, "v").first()[0] == 1
    assert {r.column_name: r.null_count for r in quality.null_counts(df, ["k", "v"]).collect()} == {"k": 2, "v": 2}


@pytest.mark.parametrize(("average", "threshold"), [(99.0, 0.5), (100.0, 0.5), (5050.0, 0.3), (10000.0, 0.1), (20000.0, 0.1)])
def test_anomaly_threshold(spark, average, threshold):
    got = spark.range(1).select(quality.anomaly_threshold(F.lit(average))).first()[0]
    assert got == pytest.approx(threshold)


def test_volume_anomalies(spark):
    stats = spark.createDataFrame([(f"r{i}", "stg.t_cur", 1000 if i > 1 else 1, at(i + 1)) for i in range(7)] + [("r9", "stg.other", 5, at(1))],
                                  "run_id string, table_name string, rows_extracted long, created_at timestamp")
    now = spark.createDataFrame([("stg.t_cur", 1600), ("stg.other", 0), ("stg.fresh", 4)], "table_name string, rows long")
    tables = ["stg.t_cur", "stg.other", "stg.fresh"]
    row = quality.volume_anomalies(now, stats, tables).collect()
    assert [(r.table_name, r.avg_rows, r.runs, r.is_anomaly) for r in row] == [("stg.t_cur", 1000.0, 5, True)]
    assert "1600 строк, среднее за 5 запусков — 1000.0 (отклонение 60.0%, порог 46%)" in quality.volume_issues(quality.volume_anomalies(now, stats, tables)).first().message
    assert quality.volume_anomalies(now, stats, tables, exclude_run="r6").first().avg_rows == pytest.approx((4 * 1000 + 1) / 5)


def test_issue_summary(spark):
    df = spark.createDataFrame([("1", None), ("1", "x")], "id string, d string")
    issues = quality.table_issues(df, "t", "id", ["d", "no_such"])
    s = quality.issue_summary(issues).first()
    assert (s.has_critical_issues, s.issue_count, s.not_shown) == (True, 2, 0)
    none = quality.issue_summary(issues.where("false")).first()
    assert (none.has_critical_issues, none.issue_count) == (False, 0)


def test_run_ledger(spark):
    ev = spark.createDataFrame(
        [("a", at(1), "running", "cdc", None, None), ("a", at(1), "success", "cdc", at(1, hour=1), 5), ("b", at(2), "running", "cdc", None, None)],
        "run_id string, started_at timestamp, status string, mode string, finished_at timestamp, total_rows_synced long")
    state = {r.run_id: (r.status, r.total_rows_synced) for r in ledger.run_state(ev).collect()}
    assert state == {"a": ("success", 5), "b": ("running", None)}
    runs = ledger.run_state(ev).withColumn("duration_seconds", F.lit(1.45).cast("decimal(10,2)"))
    k = ledger.run_kpis(runs).first()
    assert (k.total_runs, k.successful, k.failed, k.success_rate, k.total_rows) == (2, 1, 0, 50.0, 5)
    assert [r.duration for r in ledger.run_labels(runs).collect()] == ["1.4s", "1.4s"]
    assert ledger.recent_runs(runs, 1).first().run_id == "b"
    assert ledger.run_kpis(runs.where("false")).first().success_rate == 0.0


def test_scope(spark):
    df = spark.createDataFrame([("stg.sales_cur",), ("stg.sales_hst",), ("stg.rates",), ("stg.price_reference",)], "t string")

    def tables(scope):
        return {r.t for r in df.where(ledger.in_scope(F.col("t"), scope)).collect()}

    assert tables("current") == {"stg.sales_cur"}
    assert tables("historical") == {"stg.sales_hst", "stg.rates", "stg.price_reference"}
    assert len(tables("all")) == 4


def test_retention(spark):
    df = spark.createDataFrame([(at(1),), (at(20),), (None,)], "t timestamp")
    kept, gone = ledger.retention(df, "t", F.lit(at(31)), 20)
    assert kept.count() == 2 and gone.first().deleted == 1


def test_balances(spark):
    clients = spark.createDataFrame([("1", "Ann", "p", "s", False), ("2", "Bob", "p", "s", False), ("3", "Cid", "p", "s", True), ("4", "Dan", "p", "s", False)],
                                    "legacy_id string, name string, phone string, status string, is_deleted boolean")
    sales = spark.createDataFrame([("1", "8 занятий", 2, 10, False), ("1", "Разовое", 1, 5, False), ("1", "16", 1, 1, True), ("3", "4", 1, 1, False)],
                                  "client_id string, product_name string, quantity int, p int, is_deleted boolean").withColumn("final_price", F.col("p").cast("decimal(18,2)"))
    sched = spark.createDataFrame([("1", "Посетили", False), ("2", "Пропуск", False), ("2", "Отмена", False), ("4", "Посетили", True)],
                                  "client_id string, status string, is_deleted boolean")
    mart = marts.client_balances(clients, marts.client_purchases(sales), marts.client_usage(sched), F.lit(at(1)))
    assert mart.columns == list(fv.BALANCE_COLUMNS.values())
    assert [(r["Клиент"], r["Куплено"], r["Использовано"], r["Остаток"], float(r["Оплачено"])) for r in mart.collect()] == [
        ("Bob", 0, 1, -1, 0), ("Ann", 17, 1, 16, 15)]
    units = spark.createDataFrame([("8 занятий", 10), ("Разовое", 1)], "name string, units_per_item int")
    assert {r.client_id: r.units_bought for r in marts.purchases_by_lookup(sales, units).collect()} == {"1": 21, "3": 1}


def test_unified_customers(spark):
    t = spark.createDataFrame([(1, "ann", "+7 (900) 1"), (2, "bob", None), (3, "cid", "123"), (4, "dan", "7 999 000")], "id long, username string, phone string")
    c = spark.createDataFrame([("c1", "Ann", "79001"), ("c2", "Eve", None), ("c3", "Two", "123"), ("c4", "Ann2", "7-9001")], "legacy_id string, name string, phone string")
    t, c = t.withColumn("updated_at", F.lit(at(2))), c.withColumn("updated_at", F.lit(at(1)))
    got = sorted((r.id, r.tg_user_id, r.lifecycle_stage) for r in marts.unified_customers(t, c).collect())
    uid = lambda n: str(uuids.uuid5(uuids.NAMESPACE_URL, f"tg:{n}"))
    assert got == sorted([("c1", 1, "client"), ("c4", 1, "client"), (uid(2), 2, "guest"), (uid(3), 3, "warm_lead"), (uid(4), 4, "warm_lead"),
                          ("c2", None, "client"), ("c3", None, "client")], key=lambda r: (r[0],))


def test_layouts_parse(spark):
    for ddl in (layout.CLIENTS, layout.SALES, layout.SCHEDULE, layout.EXPENSES, layout.EMPLOYEES, layout.PRODUCTS, layout.EXPENSE_CATEGORIES,
                layout.RUNS, layout.TABLE_STATS, layout.VALIDATION_LOG):
        assert layout.conform(spark.range(1), ddl, F.lit(at(1))).count() == 1


@pytest.mark.parametrize("by_source,seed", [(True, 1), (False, 2), (True, 3)])
def test_upsert_and_delete_in_one_join(spark, by_source, seed):
    """The same rows as an upsert and then a soft delete: NULL keys and hashes, other sources, rows deleted before, hashes of several rows."""
    rng = random.Random(seed)
    track = "legacy_id string, row_hash string, source string, is_deleted boolean, deleted_at timestamp, status string, created_at timestamp, updated_at timestamp"
    hashes = [None, *(f"h{i}" for i in range(8))]
    core = spark.createDataFrame(
        [(rng.choice([None, f"k{i}"]) if i % 9 == 0 else f"k{i}", rng.choice(hashes), rng.choice(["cur", "hst", "else", None]),
          rng.choice([True, False, False, None]), None, rng.choice(["vip", None]), at(1), at(1)) for i in range(120)], track)
    staged = spark.createDataFrame([(rng.choice(["cur", "hst"]), h) for h in rng.choices(hashes[1:], k=6)], "source string, row_hash string")
    sheet = staged.distinct().withColumn("n", F.row_number().over(Window.orderBy("source", "row_hash")))
    rows = sheet.select(F.concat(F.lit("k"), F.col("n") * 25).alias("legacy_id"), "row_hash", "source", F.lit("new").alias("status"))
    now, sources = F.lit(at(5)), ["cur", "hst"] if by_source else None
    one = merge.upsert_and_delete(core, rows, "legacy_id", now, staged, sources, "deleted", only=["cur", "hst"])
    two = merge.soft_delete(merge.upsert(core, rows, "legacy_id", now), staged, now, sources, "deleted", only=["cur", "hst"]).drop("just_deleted")
    listed = lambda df: sorted(df.collect(), key=str)                                      # noqa: E731
    assert listed(one) == listed(two) and one.where("status = 'deleted'").count() > 0
    nothing = merge.upsert_and_delete(core.limit(0), rows.limit(0), "legacy_id", now, staged.limit(0), sources, "deleted")
    assert nothing.isEmpty()
