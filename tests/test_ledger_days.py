"""The ledger's state per day: parts merge into the whole, and reports from it equal those from the history."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rowloom.operators import ledger, ledger_days, quality
from rowloom.plans import run as plan
from rowloom.sources import sinks
from rowloom.sources.shared import shared_folder

SCHEMA = ("run_id string, table_name string, rows_extracted bigint, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, "
          "validation_errors bigint, duration_ms bigint, created_at timestamp")
TABLES = ["stg.sales", "stg.clients", "stg.unknown"]


def loads(n, seed=1):
    r, start = random.Random(seed), datetime(2024, 1, 1)
    out = []
    for i in range(n):
        # a third of all loads are of one table on one day, many at the same moment
        at = start if i % 3 == 0 else start + timedelta(hours=r.randrange(120))
        name = "stg.sales" if i % 3 == 0 else r.choice(["stg.sales", "old.sales", "stg.clients", None])
        count = r.choice([None, 0, r.randrange(9000)])
        out.append((f"r{i:04}", name, count, r.randrange(9), r.randrange(9), 1, r.randrange(3), r.randrange(5000), None if i % 17 == 1 else at))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_parts_merge_into_the_whole(spark):
    all_rows = loads(240)
    whole = spark.createDataFrame(all_rows, SCHEMA)
    parts = [ledger_days.daily_state(spark.createDataFrame(all_rows[k::4], SCHEMA)) for k in range(4)]
    empty = ledger_days.daily_state(whole.limit(0))
    expected = rows(ledger_days.daily_state(whole))
    assert rows(ledger_days.merge_states(*parts, empty)) == expected
    assert rows(ledger_days.merge_states(parts[3], ledger_days.merge_states(parts[1], parts[0]), parts[2])) == expected
    assert rows(empty) == [] and ledger_days.covers(empty, whole.limit(0))
    assert ledger_days.covers(ledger_days.merge_states(*parts), whole) and not ledger_days.covers(parts[0], whole)


def test_against_python(spark):
    all_rows = loads(150, seed=2)
    found = {(r["table_name"], r["day"]): r for r in ledger_days.daily_state(spark.createDataFrame(all_rows, SCHEMA)).collect()}
    groups = {}
    for row in all_rows:
        day = row[8] and row[8].replace(hour=0)
        groups.setdefault((row[1], day), []).append(row)
    assert set(found) == set(groups)
    for key, members in groups.items():
        state = found[key]
        counts = [m[2] for m in members if m[2] is not None]
        assert state["runs"] == len(members) and state["rows_extracted"] == (sum(counts) if counts else None)
        assert state["duration_ms"] == sum(m[7] for m in members)
        members.sort(key=lambda m: (m[8] or datetime.min, m[0]), reverse=True)
        assert [e["run_id"] for e in state["newest"]] == [m[0] for m in members[:5]]


def test_reports_equal_those_from_the_history(spark):
    whole = spark.createDataFrame(loads(240, seed=3), SCHEMA)
    state = ledger_days.daily_state(whole)
    kept = ("base", "run_id", "table_name", "rows_extracted", "created_at")
    assert rows(quality.last_stats(ledger_days.newest_loads(state), TABLES).select(*kept)) == rows(quality.last_stats(whole, TABLES).select(*kept))
    now = spark.createDataFrame([("stg.sales", 5000), ("stg.clients", 1), ("stg.unknown", 7)], "table_name string, rows bigint")
    assert rows(quality.volume_anomalies(now, ledger_days.newest_loads(state), TABLES)) == rows(quality.volume_anomalies(now, whole, TABLES))
    assert rows(ledger.error_trend(ledger_days.by_day(state))) == rows(ledger.error_trend(whole))
    named = whole.where("table_name IS NOT NULL")
    assert rows(ledger_days.totals(ledger_days.daily_state(named))) == rows(ledger.run_totals(named))


def test_a_days_loads_are_cut_before_the_shuffle(spark):
    whole = spark.createDataFrame(loads(30), SCHEMA)
    assert "WindowGroupLimit" in ledger_days.daily_state(whole)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    name = uuid.uuid4().hex
    yield plan.Settings(root=shared_folder(spark), stats_table=f"stats_{name}", days_table=f"days_{name}")
    sinks.drop_table(spark, f"days_{name}")
    spark.sql(f"DROP TABLE IF EXISTS stats_{name}")


def test_runs_keep_it(spark, settings, monkeypatch):
    def load(part):
        stats = spark.createDataFrame(part, SCHEMA)
        sinks.append_table(stats, settings.stats_table, settings.root)
        plan.book_days(spark, settings, stats)

    def expected():
        return rows(ledger_days.daily_state(spark.table(settings.stats_table)))

    all_rows = loads(60, seed=4)
    load(all_rows[:20])
    load(all_rows[20:30])
    assert rows(spark.table(settings.days_table)) == expected()
    # only the run's own rows are read, the ledger's are counted
    seen = []
    daily = ledger_days.daily_state
    monkeypatch.setattr(ledger_days, "daily_state", lambda df, *a: seen.append(df.count()) or daily(df, *a))
    load(all_rows[30:40])
    assert seen == [10]
    # a run that stopped before it came to the state: the next one makes it anew
    sinks.append_table(spark.createDataFrame(all_rows[40:50], SCHEMA), settings.stats_table, settings.root)
    assert plan.newest_loads(spark, settings).count() == 50
    load(all_rows[50:])
    assert seen[1:] == [10, 60]
    monkeypatch.undo()
    assert rows(spark.table(settings.days_table)) == expected()
    assert set(plan.newest_loads(spark, settings).columns) == {"table_name", "created_at", "run_id", "rows_extracted"}


def test_another_run_came_first(spark, settings, monkeypatch):
    stats = spark.createDataFrame(loads(5), SCHEMA)
    sinks.append_table(stats, settings.stats_table, settings.root)

    def lost(*_):
        raise sinks.ConcurrentLoad("replaced meanwhile")

    monkeypatch.setattr(sinks, "replace_table", lost)
    plan.book_days(spark, settings, stats)
    monkeypatch.undo()
    # the ledger itself is read as long as the state is not there
    assert plan.newest_loads(spark, settings).agg(F.count("*")).first()[0] == 5
