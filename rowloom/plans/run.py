"""A whole run: load the sources, check them, transform, expire, export, and keep the books."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowloom import fixed_values as fv
from rowloom.operators import cdc, ledger_days, losses, merge, quality, validate as checks
from rowloom.plans import marts, transforms
from rowloom.session import configure
from rowloom.sources import layout, sinks
from rowloom.sources.buckets import buckets_of
from rowloom.sources.contracts import Contract, contract_for, contract_projection
from rowloom.sources.shared import materialize
from rowloom.sources.tabular import file_changes, last_modified, read_tabular, source_files, to_staging

log = logging.getLogger(__name__)

PARTIAL = "partial"              # status of a run in which some sources or transforms failed


@dataclass(frozen=True)
class Source:
    """One sheet: where it is, the staging table it fills, and how."""

    table: str
    path: str
    fmt: str = "csv"
    pk: str = "__row_hash"
    mode: str = "upsert"                      # or "replace"
    header: str = "first"                     # or "auto"
    mapping: dict[str, str] | None = None
    critical: tuple[str, ...] = ()            # columns that should not be NULL
    numeric: tuple[str, ...] | None = ()      # number columns; None: all, as older tables have it
    buckets: int = 0                          # keep the table in so many buckets by pk; 0: write it whole
    seen: datetime | None = None              # skip if not modified since; else what the last load has noted


@dataclass
class Settings:
    """What a run needs to know besides its sources.

    `root` is a shared folder for the tables' files (None: the catalog's warehouse).  Raw dumps
    always go to the warehouse, where dropping a day also frees its files.
    """

    sources: Sequence[Source] = ()
    root: str | None = None
    export_path: str | None = None
    contracts: dict[str, Contract] | None = None
    scope: str = "all"
    full_refresh: bool = False
    dry_run: bool = False
    skip_load: bool = False
    skip_transform: bool = False
    run_exports: bool = True
    check_modified: bool = False
    schedule_year: int = fv.DEFAULT_SCHEDULE_YEAR
    now: datetime | None = None
    raw_table: str = "raw.sheets_dump"
    log_table: str = "ops.validation_logs"
    max_errors: int = fv.MAX_ERRORS           # a source with more is not loaded
    max_errors_per_row: int = fv.MAX_ERRORS_PER_ROW
    staging: str = "stg_gsheets"              # where the transforms look for staged sheets
    runs_table: str = "ops.elt_runs"
    stats_table: str = "ops.elt_table_stats"
    days_table: str = "ops.elt_table_days"    # the state of stats_table per table and day
    state_table: str = "ops.source_state"     # how new each source was when it was loaded
    files_table: str = "ops.source_files"     # the files each source had when it was loaded
    losses_table: str = "ops.cell_losses"     # cells of each run that became 0, NULL or a default
    sources_at_once: int = 4                  # sources loaded side by side
    seed: bool = True                         # add what the lookup tables always hold
    extra: list[tuple[str, Callable[[SparkSession], DataFrame]]] = field(default_factory=list)


class QualityFailed(RuntimeError):
    """The loaded tables have critical issues."""


def in_scope(table: str, scope: str) -> bool:
    history = table.endswith("_hst")
    reference = "rates" in table or "price_reference" in table
    return {"current": not history and not reference, "historical": history or reference}.get(scope, True)


def sync_table(spark: SparkSession, source: Source, run_id: str, s: Settings, now: Column) -> dict[str, Any]:
    """Read, dump, check, diff and apply one source; its figures for the ledger.

    The sheet is read once: the rows are kept in the shared folder for the steps that follow.
    """
    started = time.monotonic()
    figures = {"table": source.table, "status": "skipped", "extracted": 0, "inserted": 0, "updated": 0, "deleted": 0,
               "unchanged": 0, "errors": 0}
    # asked for before reading: what is written meanwhile is newer
    modified = last_modified(spark, source.path) if s.check_modified else None
    files = materialize(source_files(spark, source.path), "files") if s.check_modified else None
    if modified is not None and not _is_new(spark, source, s, modified, files):
        return figures
    rows = materialize(
        read_tabular(spark, source.path, source.fmt, source.table.split(".")[-1], source.mapping, source.header), "sheet"
    )
    if rows.isEmpty():
        return figures                        # an empty extract deletes nothing
    columns = [c for c in rows.columns if c != "_row_index"]
    if not s.dry_run:
        dump = sinks.raw_dump(rows, source.path, source.table, now, columns)
        sinks.append_table(dump, s.raw_table, by=("extracted_on",))

    try:
        contract = contract_for(source.table, s.contracts)
    except FileNotFoundError:
        log.warning("no contract for %s: all columns are kept, nothing is checked", source.table)
        contract = None
    kept = contract_projection(columns, contract, source.mapping, source.pk)
    if contract is not None:
        known = contract_projection(columns, contract, source.mapping)
        checked = checks.validate(rows.select(*known, "_row_index"), contract)
        summary = checks.error_thresholds(checks.validation_summary(checked), s.max_errors, s.max_errors_per_row).first()
        figures["extracted"], figures["errors"] = summary["total_rows"], summary["total_errors"]
        if summary["total_errors"] and not s.dry_run:
            index = F.col("_row_index") - fv.FIRST_DATA_ROW
            sinks.append_table(checks.validation_log(checked, run_id, source.table, index, now), s.log_table, s.root)
        checks.require_thresholds(summary, source.table)
    else:
        figures["extracted"] = rows.count()

    staged = to_staging(rows, kept, now, list(source.numeric) if source.numeric is not None else None)
    exists = spark.catalog.tableExists(source.table)
    if not s.dry_run and (s.full_refresh or source.mode == "replace" or not exists):
        if source.buckets:
            sinks.replace_in_buckets(staged, source.table, source.pk, source.buckets, s.root)
        else:
            sinks.replace_table(staged, source.table, s.root)
        figures |= {"status": "full_refresh", "inserted": figures["extracted"]}
    else:
        target = spark.table(source.table) if exists else staged.limit(0)
        figures |= apply_changes(target, staged, source.table, source.pk, kept, now, s.root, s.dry_run)
        figures["status"] = "dry_run" if s.dry_run else "cdc"
    if modified is not None and not s.dry_run:
        state = spark.createDataFrame([(source.table, modified, run_id)], "table_name string, modified_at timestamp, run_id string")
        sinks.append_table(state, s.state_table, s.root)
        noted = files.select(F.lit(source.table).alias("table_name"), "file", "length", "modified_at", F.lit(run_id).alias("run_id"),
                             F.current_timestamp().alias("noted_at"))
        sinks.append_table(noted, s.files_table, s.root)
    return figures | {"duration_ms": int((time.monotonic() - started) * 1000)}


def _is_new(spark: SparkSession, source: Source, s: Settings, modified: datetime, files: DataFrame) -> bool:
    """Whether a source has changed since `seen` or, without that, since its last load.

    A load notes all files, so one that is removed, or replaced by an older one, is a change too.
    """
    if source.seen is not None:
        return modified > source.seen
    if not spark.catalog.tableExists(s.files_table):
        return True
    notes = spark.table(s.files_table).where(F.col("table_name") == source.table)
    last = notes.agg(F.max("noted_at").alias("at")).first()["at"]
    return last is None or not file_changes(files, notes.where(F.col("noted_at") == F.lit(last))).isEmpty()


def apply_changes(target: DataFrame, staged: DataFrame, table: str, pk: str, columns: Sequence[str], now: Column,
                  root: str | None = None, dry_run: bool = False) -> dict[str, int]:
    """Brings a table up to its snapshot; inserted, updated, deleted and unchanged rows.

    Only changed rows are written out in between, and a table without any is not rewritten.  Of a table that is
    kept in buckets by `pk`, only the buckets with changed rows are.
    """
    diff = cdc.cdc_diff(staged, target, pk)
    if dry_run:
        return cdc.cdc_stats(diff).first().asDict()
    changed = materialize(diff.where(F.col("action") != cdc.UNCHANGED), "changed")
    figures = cdc.cdc_stats(changed).first().asDict()
    keyed = staged.where(F.col(pk).isNotNull() & (F.col(pk).cast("string") != "")).count()
    figures["unchanged"] = keyed - figures["inserted"] - figures["updated"]
    if figures["inserted"] + figures["updated"] + figures["deleted"]:
        layout = buckets_of(target.sparkSession, sinks.shown_version(target.sparkSession, table))
        if layout and layout.key == pk:
            sinks.change_buckets(target.sparkSession, table, changed.select(pk), lambda part: cdc.cdc_apply(part, changed, pk, columns, now))
        else:
            sinks.replace_table(cdc.cdc_apply(target, changed, pk, columns, now), table, root)
    return figures


def load_phase(spark: SparkSession, run_id: str, s: Settings, now: Column, failed: dict[str, str]) -> list[dict[str, Any]]:
    """All sources in scope, some at a time; one that fails is noted in `failed` and does not stop the others.

    Each table has a scheduler pool of its own, so a large sheet does not hold up small ones where the session
    schedules fairly.  Sources of one table go one after the other.  The ledger is written here, once.
    """
    by_table: dict[str, list[Source]] = {}
    for source in s.sources:
        if in_scope(source.table, s.scope):
            by_table.setdefault(source.table.lower(), []).append(source)

    def load(sources: list[Source]) -> list[tuple[Source, dict[str, Any] | Exception]]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", sources[0].table)
        results: list[tuple[Source, dict[str, Any] | Exception]] = []
        for source in sources:
            try:
                results.append((source, sync_table(spark, source, run_id, s, now)))
            except Exception as e:
                log.exception("%s could not be loaded", source.table)
                results.append((source, e))
        return results

    with ThreadPoolExecutor(max_workers=max(1, s.sources_at_once)) as threads:
        # wrapped one by one: each has its own copy of this thread's properties
        going = [threads.submit(inheritable_thread_target(spark)(load), sources) for sources in by_table.values()]
        results = [pair for one in going for pair in one.result()]
    failed |= {source.table: str(found) for source, found in results if isinstance(found, Exception)}
    done = [found for _, found in results if isinstance(found, dict) and found["status"] != "skipped"]
    if done and not s.dry_run:
        stats = spark.createDataFrame(
            [(run_id, f["table"], f["extracted"], f["inserted"], f["updated"], f["deleted"], f["unchanged"], f["errors"],
              f["duration_ms"]) for f in done],
            "run_id string, table_name string, rows_extracted bigint, rows_inserted bigint, rows_updated bigint, "
            "rows_deleted bigint, rows_unchanged bigint, validation_errors bigint, duration_ms bigint",
        )
        stats = layout.conform(stats, layout.TABLE_STATS, now)
        sinks.append_table(stats, s.stats_table, s.root)
        book_days(spark, s, stats)
    return done


def book_days(spark: SparkSession, s: Settings, stats: DataFrame) -> None:
    """Merges a run's rows of the ledger, already appended, into its state per day.

    The history is read only if the state has not all of it: at first, and after a run that stopped in between or lost
    its turn to another.
    """
    booked, state = spark.table(s.stats_table), None
    if spark.catalog.tableExists(s.days_table):
        merged = materialize(ledger_days.merge_states(spark.table(s.days_table), ledger_days.daily_state(stats)), "days")
        state = merged if ledger_days.covers(merged, booked) else None
    try:
        sinks.replace_table(ledger_days.daily_state(booked) if state is None else state, s.days_table, s.root)
    except sinks.ConcurrentLoad:
        log.warning("%s has been replaced meanwhile; the next run makes it anew", s.days_table)


def newest_loads(spark: SparkSession, s: Settings) -> DataFrame:
    """Rows of the ledger with the newest loads of all tables: out of the state, or all if that lacks some."""
    booked = spark.table(s.stats_table)
    if spark.catalog.tableExists(s.days_table) and ledger_days.covers(state := spark.table(s.days_table), booked):
        return ledger_days.newest_loads(state)
    return booked.select("table_name", "created_at", "run_id", "rows_extracted")


def quality_issues(spark: SparkSession, s: Settings) -> DataFrame | None:
    """Issues of the staged tables in scope."""
    sources = [x for x in s.sources if in_scope(x.table, s.scope) and spark.catalog.tableExists(x.table)]
    if not sources:
        return None
    tables = {x.table: spark.table(x.table) for x in sources}
    found = [quality.table_issues(tables[x.table], x.table, x.pk, x.critical, sinks.repeated_keys(spark, x.table, x.pk))
             for x in sources if x.pk in tables[x.table].columns]
    if spark.catalog.tableExists(s.stats_table):
        counts = quality.row_counts(tables)
        found.append(quality.volume_issues(quality.volume_anomalies(counts, newest_loads(spark, s), list(tables))))
    issues = found[0]
    for more in found[1:]:
        issues = issues.unionByName(more)
    return issues


def _table(spark: SparkSession, name: str, schema: str) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else layout.empty(spark, schema)


def _staged(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def transform_phase(spark: SparkSession, s: Settings, now: Column, failed: dict[str, str]) -> int:
    """Clients, then schedule and sales, which look clients up; each with its soft delete.

    A transform that fails, or whose sheets or tables have failed before, leaves its table as
    it was and is noted in `failed`; how many succeeded.
    """
    stg = {n: _staged(spark, f"{s.staging}.{n}") for n in
           ("clients_cur", "clients_hst", "sales_cur", "sales_hst", "trainings_cur", "trainings_hst")}

    def clients() -> DataFrame:
        parts = [None if stg[n] is None else transforms.clients_rows(stg[n], h)
                 for n, h in (("clients_cur", False), ("clients_hst", True))]
        return _merged(_table(spark, "core.clients", layout.CLIENTS), parts, ("clients_cur", "clients_hst"), by_source=False, status="deleted")

    def schedule() -> DataFrame:
        people = _table(spark, "lookups.employees", layout.EMPLOYEES)
        known = spark.table("core.clients")
        parts = [None if stg[n] is None else transforms.schedule_rows(stg[n], known, people, now, h, s.schedule_year)
                 for n, h in (("trainings_cur", False), ("trainings_hst", True))]
        merged = _merged(_table(spark, "core.schedule", layout.SCHEDULE), parts, ("trainings_cur", "trainings_hst"))
        return sinks.clustered(merged, "date", "legacy_id")

    def sales() -> DataFrame:
        known = spark.table("core.clients")
        parts = [None if stg[n] is None else transforms.sales_rows(stg[n], known, now, h)
                 for n, h in (("sales_cur", False), ("sales_hst", True))]
        merged = _merged(_table(spark, "core.sales", layout.SALES), parts, ("sales_cur", "sales_hst"))
        return sinks.clustered(merged, "date", "legacy_id")

    def _merged(core: DataFrame, parts: list[DataFrame | None], names: tuple[str, ...], by_source: bool = True,
                status: str | None = None) -> DataFrame:
        present = [(n, stg[n]) for n in names if stg[n] is not None]
        if not present:
            return core
        staged = [n for n, _ in present]
        return merge.upsert_and_delete(core, transforms.history_over_current(*parts), "legacy_id", now, merge.staged_rows(*present),
                                       staged if by_source else None, status, only=staged)

    def balances() -> DataFrame:
        return marts.client_balances(
            spark.table("core.clients"), marts.client_purchases(spark.table("core.sales")),
            marts.client_usage(spark.table("core.schedule")), now,
        )

    def sheets(*names: str) -> set[str]:
        return {f"{s.staging}.{n}" for n in names}

    steps = [
        ("core.clients", clients, sheets("clients_cur", "clients_hst")),
        ("core.schedule", schedule, sheets("trainings_cur", "trainings_hst") | {"core.clients"}),
        ("core.sales", sales, sheets("sales_cur", "sales_hst") | {"core.clients"}),
        ("analytics.v_client_balances", balances, {"core.clients", "core.schedule", "core.sales"}),
    ]
    steps += [(name, lambda make=make: make(spark), set()) for name, make in s.extra]
    done = 0
    for name, make, needs in steps:
        if lacking := sorted(needs & set(failed)):
            failed[name] = f"not built: {', '.join(lacking)} failed"
            continue
        try:
            sinks.replace_table(make(), name, s.root)
            done += 1
        except Exception as e:
            log.exception("%s could not be built", name)
            failed[name] = str(e)
    return done


def book_losses(spark: SparkSession, run_id: str, s: Settings, now: Column) -> int:
    """Notes, per staged sheet and column, how many cells the transforms cannot read; their sum."""
    found = None
    for name in ("clients_cur", "clients_hst", "sales_cur", "sales_hst", "trainings_cur", "trainings_hst"):
        staged = _staged(spark, f"{s.staging}.{name}")
        if staged is None:
            continue
        counts = losses.loss_counts(staged, transforms.lost_cells(name, staged.columns, s.schedule_year)).where("lost_cells > 0")
        counts = counts.withColumn("table_name", F.lit(f"{s.staging}.{name}"))
        found = counts if found is None else found.unionByName(counts)
    if found is None:
        return 0
    found = materialize(layout.conform(found.withColumn("run_id", F.lit(run_id)), layout.CELL_LOSSES, now), "losses")
    sinks.append_table(found, s.losses_table, s.root)
    return found.agg(F.coalesce(F.sum("lost_cells"), F.lit(0))).first()[0]


def add_seeds(spark: SparkSession, s: Settings, now: Column) -> None:
    """Adds the rows that the lookup tables always hold and lack so far."""
    for table, form, rows, columns, key in (
        ("lookups.employees", layout.EMPLOYEES, fv.SEED_EMPLOYEES, "full_name string, role string, aliases array<string>", "full_name"),
        ("lookups.expense_categories", layout.EXPENSE_CATEGORIES, fv.SEED_EXPENSE_CATEGORIES, "name string, aliases array<string>", "name"),
    ):
        fresh = transforms.seed_lookup(_table(spark, table, form), list(rows), columns, key).withColumn("id", F.md5(key))
        fresh = materialize(layout.conform(fresh, form, now), "seeds")
        if not fresh.isEmpty():
            sinks.append_table(fresh, table, s.root)


def add_employees(spark: SparkSession, s: Settings, now: Column) -> None:
    """Adds the names in the training sheets that the employee table lacks."""
    named = [(df, c) for n, c in (("trainings_cur", "sotrudnik"), ("trainings_hst", "employee"))
             if (df := _staged(spark, f"{s.staging}.{n}")) is not None and c in df.columns]
    if named:
        existing = _table(spark, "lookups.employees", layout.EMPLOYEES)
        fresh = transforms.new_employees(existing, *named).withColumn("id", F.md5("full_name"))
        fresh = materialize(layout.conform(fresh, layout.EMPLOYEES, now), "employees")
        sinks.append_table(fresh, "lookups.employees", s.root)


def run(spark: SparkSession, s: Settings) -> dict[str, Any]:
    """One run from the sources to the export; its totals.

    Sources and transforms that fail make it `partial`; totals and ledger name them.  Raises what stopped it, after the ledger has the failure.
    """
    configure(spark)
    for db in ("raw", s.staging, "core", "lookups", "analytics", "ops"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    run_id, started, clock = str(uuid.uuid4()), s.now or datetime.now(), time.monotonic()
    now = F.lit(started)
    failed: dict[str, str] = {}
    totals = {"run_id": run_id, "failed": failed, "tables_processed": 0, "total_rows_synced": 0, "validation_errors": 0}

    def book(status: str, **more: Any) -> None:
        event = {"run_id": run_id, "started_at": started, "status": status,
                 "mode": "full_refresh" if s.full_refresh else "cdc"} | more
        row = spark.createDataFrame([event], "run_id string, started_at timestamp, status string, mode string, "
                                    "tables_processed int, total_rows_synced bigint, validation_errors bigint, "
                                    "duration_seconds double, finished_at timestamp, error_message string")
        sinks.append_table(layout.conform(row, layout.RUNS, now, defaults={}, stamped=()), s.runs_table, s.root)

    book("running")
    status, error = "success", None
    try:
        if not s.skip_load:
            done = load_phase(spark, run_id, s, now, failed)
            totals["tables_processed"] = len(done)
            totals["total_rows_synced"] = sum(f["inserted"] + f["updated"] for f in done)
            totals["validation_errors"] = sum(f["errors"] for f in done)
            totals["tables"] = done
            issues = None if s.dry_run else quality_issues(spark, s)
            if issues is not None:
                issues = materialize(issues, "issues")
                totals["issues"] = [r.asDict() for r in quality.first_issues(issues).collect()]   # at most ten
                summary = quality.issue_summary(issues).first()
                totals["issue_count"] = summary["issue_count"]
                if summary["has_critical_issues"]:
                    raise QualityFailed("data quality check failed: critical issues found")
        if not s.skip_transform and not s.dry_run:
            if s.seed:
                add_seeds(spark, s, now)
            add_employees(spark, s, now)
            totals["transforms"] = transform_phase(spark, s, now, failed)
            totals["lost_cells"] = book_losses(spark, run_id, s, now)
        if s.run_exports and not s.dry_run:
            if spark.catalog.tableExists(s.raw_table):
                totals["dumps_expired"] = sinks.expire_dumps(spark, s.raw_table, started)
            if s.export_path and spark.catalog.tableExists("analytics.v_client_balances"):
                order = fv.BALANCE_COLUMNS
                mart = spark.table("analytics.v_client_balances")
                totals["exported"] = sinks.export_mart(mart.orderBy(order["left"], order["name"]), s.export_path)
        if failed:
            status, error = PARTIAL, "; ".join(f"{name}: {why}" for name, why in failed.items())
    except Exception as e:
        status, error = "failed", str(e)
        raise
    finally:
        finished = datetime.now() if s.now is None else s.now
        book(status, finished_at=finished, duration_seconds=round(time.monotonic() - clock, 2), error_message=error,
             **{k: totals[k] for k in ("tables_processed", "total_rows_synced", "validation_errors")})
        totals["status"] = status
    return totals
