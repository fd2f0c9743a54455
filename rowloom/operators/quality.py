"""Data-quality checks on staged tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom import fixed_values as fv


def duplicate_keys(df: DataFrame, key: Sequence[str], skip_null: bool = True) -> DataFrame:
    """Keys that occur more than once, with their count."""
    rows = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])) if skip_null else df
    return rows.groupBy(*key).agg(F.count("*").alias("cnt")).where("cnt > 1")


def duplicate_hash_count(df: DataFrame, hash_col: str) -> DataFrame:
    """One row: how many hashes occur more than once."""
    return duplicate_keys(df, [hash_col], skip_null=False).agg(F.count("*").alias("duplicate_hashes"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for several columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count")) for i, c in enumerate(columns)]
    return counts.select(F.inline(F.array(*pairs)))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows, size_mb): row counts, and the size that goes with 50 bytes a cell."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"),
            "rows",
            (F.col("rows") * (len(df.columns) * fv.CELL_BYTES) / (1024 * 1024)).alias("size_mb"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def cross_source_duplicates(
    sources: Mapping[str, DataFrame], column: str, hash_col: str = "__row_hash", n: int = 20
) -> DataFrame:
    """The value and hash pairs that occur most often over all sources.

    `sources` says how often in which source ('sales_cur:2,sales_hst:1'): counts travel, not
    one list entry per row, so a pair may make up any part of the tables.
    """
    per_source = reduce(
        DataFrame.unionByName,
        [
            df.groupBy(F.col(column).alias("val"), F.col(hash_col).alias("row_hash"))
            .agg(F.count("*").alias("n"))
            .withColumn("source", F.lit(name))
            for name, df in sources.items()
        ],
    )
    listed = F.array_sort(F.collect_list(F.concat_ws(":", "source", F.col("n").cast("string"))))
    return (
        per_source.groupBy("val", "row_hash")
        .agg(F.sum("n").alias("cnt"), F.array_join(listed, ",").alias("sources"))
        .where("cnt > 1")
        .orderBy(F.desc("cnt"), F.col("val").asc_nulls_last(), F.col("row_hash").asc_nulls_last())
        .limit(n)
    )


def last_stats(stats: DataFrame, tables: Sequence[str], n: int = fv.HISTORY_RUNS,
               exclude_run: str | None = None) -> DataFrame:
    """The newest n ledger rows of each table, matched by the end of the ledger's name."""
    bases = F.array(*[F.lit(t.split(".")[-1]) for t in tables])
    rows = stats if exclude_run is None else stats.where(F.col("run_id") != exclude_run)
    hits = rows.withColumn("base", F.explode(F.filter(bases, lambda b: F.col("table_name").endswith(b))))
    w = Window.partitionBy("base").orderBy(F.desc("created_at"), F.desc("run_id"))
    return hits.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def anomaly_threshold(average: Column) -> Column:
    """Allowed deviation: wide for small tables, narrow for large ones, linear between."""
    slope = (fv.LARGE_THRESHOLD - fv.SMALL_THRESHOLD) / (fv.LARGE_TABLE_ROWS - fv.SMALL_TABLE_ROWS)
    return (
        F.when(average < fv.SMALL_TABLE_ROWS, fv.SMALL_THRESHOLD)
        .when(average > fv.LARGE_TABLE_ROWS, fv.LARGE_THRESHOLD)
        .otherwise(F.lit(fv.SMALL_THRESHOLD) + (average - fv.SMALL_TABLE_ROWS) * slope)
    )


def volume_anomalies(
    current: DataFrame, stats: DataFrame, tables: Sequence[str], exclude_run: str | None = None
) -> DataFrame:
    """Tables whose row count (table_name, rows) is off the mean of their last runs.

    Gives every compared table with `is_anomaly`; tables without history or rows are left out.
    """
    history = last_stats(stats, tables, exclude_run=exclude_run).groupBy("base").agg(
        F.avg("rows_extracted").alias("avg_rows"), F.count("*").alias("runs")
    )
    now = current.where(F.col("rows") > 0).withColumn("base", F.substring_index("table_name", ".", -1))
    return (
        now.join(history, "base")
        .where("avg_rows > 0")
        .select(
            "table_name",
            "rows",
            "avg_rows",
            "runs",
            (F.abs(F.col("rows") - F.col("avg_rows")) / F.col("avg_rows")).alias("deviation"),
            anomaly_threshold(F.col("avg_rows")).alias("threshold"),
        )
        .withColumn("is_anomaly", F.col("deviation") > F.col("threshold"))
    )


def _issue(table: Column, kind: str, message: Column, severity: str) -> list[Column]:
    return [
        table.alias("table_name"),
        F.lit(kind).alias("issue_type"),
        message.alias("message"),
        F.lit(severity).alias("severity"),
    ]


def table_issues(df: DataFrame, table: str, pk: str, critical: Sequence[str] = (), repeated: DataFrame | None = None) -> DataFrame:
    """Issues of one table: repeated keys (critical) and NULLs in critical columns (warnings).

    `repeated` has the keys that occur more than once, if they are known already.
    """
    dups = (duplicate_keys(df, [pk]) if repeated is None else repeated).agg(F.count("*").alias("n")).where("n > 0")
    name = F.lit(table)
    issues = dups.select(
        *_issue(name, "DUPLICATES",
                F.concat(F.lit("Обнаружено "), "n", F.lit(f" дубликатов по ключу {pk}")), "critical")
    )
    checked = [c for c in critical if c in df.columns]      # a missing column is passed over
    if checked:
        found = null_counts(df, checked).where("null_count > 0")
        text = F.concat(F.lit("Обнаружено "), "null_count", F.lit(" пустых значений в колонке '"), "column_name", F.lit("'"))
        issues = issues.unionByName(found.select(*_issue(name, "NULL_VALUES", text, "warning")))
    return issues


def volume_issues(anomalies: DataFrame) -> DataFrame:
    percent = F.format_string("%.1f%%", F.bround(F.col("deviation") * 100, 1))
    text = F.concat(
        F.lit("Аномалия объема: получено "), "rows", F.lit(" строк, среднее за "), "runs", F.lit(" запусков — "),
        F.format_string("%.1f", F.bround("avg_rows", 1)), F.lit(" (отклонение "), percent, F.lit(", порог "),
        F.format_string("%.0f%%", F.bround(F.col("threshold") * 100, 0)), F.lit(")"),
    )
    return anomalies.where("is_anomaly").select(*_issue(F.col("table_name"), "VOLUME_ANOMALY", text, "warning"))


def issue_summary(issues: DataFrame) -> DataFrame:
    """One row: any critical issue, how many issues, how many the report leaves out."""
    n = F.count("*")
    return issues.agg(
        F.coalesce(F.bool_or(F.col("severity") == "critical"), F.lit(False)).alias("has_critical_issues"),
        n.alias("issue_count"),
        F.greatest(n - fv.SAMPLE_ISSUES, F.lit(0)).alias("not_shown"),
    )


def first_issues(issues: DataFrame, n: int = fv.SAMPLE_ISSUES) -> DataFrame:
    return issues.orderBy("severity", "table_name", "issue_type", "message").limit(n)
