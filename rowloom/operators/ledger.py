"""Run ledgers: state, totals, trends, retention.  Ledgers are append-only tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowloom import fixed_values as fv


def run_state(events: DataFrame) -> DataFrame:
    """The present state of each run: its start, and its finish if it has one.

    A run is appended once as `running` and once when it is over; finished rows win.
    """
    finished = F.col("status") != "running"
    fields = [c for c in events.columns if c not in ("run_id", "started_at", "mode")]
    last = F.max_by(F.struct(*fields), F.struct(finished.cast("int"), F.coalesce("finished_at", "started_at")))
    return (
        events.groupBy("run_id")
        .agg(F.min("started_at").alias("started_at"), F.max("mode").alias("mode"), last.alias("last"))
        .select("run_id", "started_at", "mode", *[F.col(f"last.{c}").alias(c) for c in fields])
    )


def recent_runs(runs: DataFrame, n: int = fv.API_RUNS) -> DataFrame:
    """The last n runs, newest first."""
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def runs_since(runs: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Runs of the last days, newest first."""
    window = runs.where(F.col("started_at") > as_of - F.make_dt_interval(days=F.lit(days)))
    return window.orderBy(F.desc("started_at"), F.desc("run_id"))


def run_labels(runs: DataFrame, hours: int = fv.LOCAL_HOURS) -> DataFrame:
    """Adds local start time, chart label and duration text."""
    local = F.col("started_at") + F.make_dt_interval(hours=F.lit(hours))
    # ties go to the even digit, as in the reports so far
    seconds = F.bround(F.col("duration_seconds"), 1).cast("double")
    return runs.withColumns(
        {
            "started_local": F.date_format(local, "yyyy-MM-dd HH:mm"),
            "label": F.date_format(local, "MM/dd HH:mm"),
            "duration": F.when(seconds.isNull(), "—").otherwise(F.format_string("%.1fs", seconds)),
        }
    )


def run_kpis(runs: DataFrame) -> DataFrame:
    """One row: runs, successes, failures, success rate in percent, rows, mean duration."""
    total, ok = F.count("*"), F.count_if(F.col("status") == "success")
    return runs.agg(
        total.alias("total_runs"),
        ok.alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.when(total > 0, ok / total * 100).otherwise(0.0).alias("success_rate"),
        F.coalesce(F.sum("total_rows_synced"), F.lit(0)).alias("total_rows"),
        F.avg(F.col("duration_seconds").cast("double")).alias("avg_duration"),
    )


def runs_by_day(runs: DataFrame, hours: int = fv.LOCAL_HOURS) -> DataFrame:
    """Runs per local day and status."""
    day = F.to_date(F.col("started_at") + F.make_dt_interval(hours=F.lit(hours)))
    return runs.groupBy(day.alias("day"), "status").agg(F.count("*").alias("runs"))


def run_totals(stats: DataFrame) -> DataFrame:
    """Totals of one run or several: a line per table and a total line (table_name NULL)."""
    synced = F.col("rows_inserted") + F.col("rows_updated")
    return stats.rollup("table_name").agg(
        F.count("*").alias("tables_processed"),
        F.sum("rows_extracted").alias("extracted"),
        F.sum("rows_inserted").alias("inserted"),
        F.sum("rows_updated").alias("updated"),
        F.sum("rows_deleted").alias("deleted"),
        F.sum("validation_errors").alias("errors"),
        F.sum(synced).alias("rows_synced"),
        (F.sum("duration_ms") / 1000).alias("duration_s"),
    )


def in_scope(table: Column, scope: str = "all") -> Column:
    """Whether a table belongs to a run's scope: all, current or historical."""
    history = table.endswith("_hst")
    reference = table.contains("rates") | table.contains("price_reference")
    if scope == "current":
        return ~history & ~reference
    if scope == "historical":
        return history | reference
    return F.lit(True)


def error_breakdown(log: DataFrame, like: str | None = None, n: int = 10) -> DataFrame:
    """The most frequent kinds of validation errors, optionally of tables like a pattern."""
    rows = log if like is None else log.where(F.col("table_name").like(like))
    return (
        rows.groupBy("table_name", "column_name", "error_type")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "table_name", "column_name", "error_type")
        .limit(n)
    )


def product_profile(sales: DataFrame, n: int = 50) -> DataFrame:
    """How often each product is sold in each quantity."""
    return (
        sales.where(~F.col("is_deleted"))
        .groupBy("product_name", "quantity")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "product_name", "quantity")
        .limit(n)
    )


def error_trend(stats: DataFrame) -> DataFrame:
    """Share of rows with errors per day and table, newest day first."""
    rate = F.sum("validation_errors").cast("double") / F.nullif(F.sum("rows_extracted"), F.lit(0))
    return (
        stats.groupBy(F.date_trunc("day", "created_at").alias("day"), "table_name")
        .agg(rate.alias("error_rate"))
        .orderBy(F.desc("day"), "table_name")
    )


def retention(df: DataFrame, time_column: str, as_of: Column, days: int = fv.RETENTION_DAYS) -> tuple[DataFrame, DataFrame]:
    """(rows kept, one row with the number of rows that go).  Rows without a time stay."""
    old = F.col(time_column) < as_of - F.make_dt_interval(days=F.lit(days))
    kept = df.where(~F.coalesce(old, F.lit(False)))
    return kept, df.where(old).agg(F.count("*").alias("deleted"))


def purge_today(log: DataFrame, as_of: Column) -> DataFrame:
    """The log without what was written since the midnight before `as_of`."""
    return log.where(F.col("created_at") < F.date_trunc("day", as_of))


def purge_unqualified(ledger: DataFrame) -> DataFrame:
    """Ledger rows whose table name has a schema."""
    return ledger.where(F.col("table_name").like("%.%"))


def sample_filled(df: DataFrame, any_of: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """The first few rows that have one of the given cells filled."""
    some = F.coalesce(*[F.col(c).cast("string") for c in any_of]).isNotNull()
    return df.where(some).orderBy(*order).limit(n)
