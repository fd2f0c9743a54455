"""A load ledger's state per table and day, so that checks and reports need not read its history again.

A row has a day of a table: how many loads, their sums, and the newest of them.  The states of any parts of a ledger
merge into the state of all of it, in any order, so a run adds its own rows and nothing else.  The state grows with
tables and days, not with loads.  Loads without a time or a table name are a group of their own; an empty ledger has an
empty state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from rowloom import fixed_values as fv

SUMS = ("rows_extracted", "rows_inserted", "rows_updated", "rows_deleted", "validation_errors", "duration_ms")
_DAY = ("table_name", "day")
_LOAD = ("created_at", "run_id", "rows_extracted")


def _state(sums: DataFrame, loads: DataFrame, n: int) -> DataFrame:
    """The state out of partial sums and of loads among which are the newest n of each day."""
    newest_first = Window.partitionBy(*_DAY).orderBy(F.desc("created_at"), F.desc("run_id"))
    # Spark cuts every task's loads to n a day before they are shuffled
    kept = loads.withColumn("__n", F.row_number().over(newest_first)).where(F.col("__n") <= n)
    newest = kept.groupBy(*_DAY).agg(F.sort_array(F.collect_list(F.struct(*_LOAD)), asc=False).alias("newest"))
    # put together by a group rather than a join: NULLs are a day like others
    return sums.unionByName(newest, allowMissingColumns=True).groupBy(*_DAY).agg(
        F.sum("runs").alias("runs"), *[F.sum(c).alias(c) for c in SUMS], F.first("newest", ignorenulls=True).alias("newest")
    )


def daily_state(stats: DataFrame, n: int = fv.HISTORY_RUNS) -> DataFrame:
    """The state of a ledger or of a part of it: (table_name, day, runs, sums, newest)."""
    rows = stats.withColumn("day", F.date_trunc("day", "created_at"))
    sums = rows.groupBy(*_DAY).agg(F.count("*").alias("runs"), *[F.sum(c).alias(c) for c in SUMS])
    return _state(sums, rows.select(*_DAY, *_LOAD), n)


def merge_states(*states: DataFrame, n: int = fv.HISTORY_RUNS) -> DataFrame:
    """The state of a ledger from those of its parts."""
    parts = reduce(DataFrame.unionByName, states)
    return _state(parts.drop("newest"), parts.select(*_DAY, F.inline("newest")), n)


def newest_loads(state: DataFrame) -> DataFrame:
    """The newest loads of each day, as rows of the ledger: what `quality.last_stats` and `volume_anomalies` ask for."""
    return state.select("table_name", F.inline("newest"))


def by_day(state: DataFrame) -> DataFrame:
    """The days as rows of a ledger with one load a day, as `ledger.error_trend` reads it."""
    return state.drop("newest").withColumnRenamed("day", "created_at")


def totals(state: DataFrame) -> DataFrame:
    """What `ledger.run_totals` gives for all loads."""
    return state.rollup("table_name").agg(
        F.sum("runs").alias("tables_processed"),
        F.sum("rows_extracted").alias("extracted"),
        F.sum("rows_inserted").alias("inserted"),
        F.sum("rows_updated").alias("updated"),
        F.sum("rows_deleted").alias("deleted"),
        F.sum("validation_errors").alias("errors"),
        (F.sum("rows_inserted") + F.sum("rows_updated")).alias("rows_synced"),
        (F.sum("duration_ms") / 1000).alias("duration_s"),
    )


def covers(state: DataFrame, stats: DataFrame) -> bool:
    """Whether a state has as many loads as its ledger; the ledger's rows are counted, no column is read."""
    return state.agg(F.coalesce(F.sum("runs"), F.lit(0))).first()[0] == stats.count()
