"""Writing: full loads, appends, raw dumps, mart exports and guarded swaps."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowloom import fixed_values as fv
from rowloom.operators.ledger import retention
from rowloom.operators.quality import duplicate_hash_count, duplicate_keys
from rowloom.sources import buckets
from rowloom.sources.shared import materialize
from rowloom.sources.versions import ConcurrentLoad, Registry

log = logging.getLogger(__name__)

_APPENDS: dict[str, threading.Lock] = {}

# Cells as sheets write them: quotes doubled, blanks at the ends kept.
SHEET_CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def load_full(df: DataFrame, path: str) -> None:
    """Replaces a table's rows.  `df` must not read from `path`; use swap_load for that."""
    df.write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, by: str, key: str) -> DataFrame:
    """The rows in ranges of `by`, for a table that is asked for ranges of it: each file holds a short one, in order.

    Parquet's statistics then leave out what a filter on `by` does not ask for.  A value that very many rows have is
    spread over several files by `key`.
    """
    return df.repartitionByRange(F.col(by), F.col(key)).sortWithinPartitions(by, key)


def append_rows(df: DataFrame, path: str, truncate_first: bool = False) -> None:
    df.write.mode("overwrite" if truncate_first else "append").parquet(path)


def raw_dump(df: DataFrame, source_id: str, sheet: str, extracted_at: Column, columns: list[str] | None = None) -> DataFrame:
    """One JSON record per row, as read; written by append, partitioned by day."""
    record = F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(source_id).alias("spreadsheet_id"),
        F.lit(sheet).alias("sheet_name"),
        record.alias("data"),
        extracted_at.alias("extracted_at"),
        F.to_date(extracted_at).alias("extracted_on"),
    )


def append_raw_dump(dump: DataFrame, path: str) -> None:
    dump.write.mode("append").partitionBy("extracted_on").parquet(path)


def append_table(df: DataFrame, table: str, root: str | None = None, by: tuple[str, ...] = ()) -> None:
    """Appends to a catalog table, which is made on the first call.

    Threads of one driver take turns at a table: files of two appends that are committed at once share a scratch folder.
    """
    with _APPENDS.setdefault(table.lower(), threading.Lock()):
        if df.sparkSession.catalog.tableExists(table):
            df.select(*df.sparkSession.table(table).columns).write.insertInto(table)
            return
        writer = df.write.partitionBy(*by) if by else df.write
        if root:
            writer = writer.option("path", f"{root.rstrip('/')}/{table}")
        writer.saveAsTable(table)


def mart_cells(df: DataFrame) -> DataFrame:
    """A mart as export cells: timestamps as text, missing texts empty."""

    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            c = F.date_format(c, fv.EXPORT_TIMESTAMP)
        elif kind in ("string", "date"):
            c = F.coalesce(c.cast("string"), F.lit(""))
        return c.alias(name)

    return df.select(*[cell(name, kind) for name, kind in df.dtypes])


def export_mart(df: DataFrame, path: str) -> bool:
    """Writes a mart as CSV with header, in the mart's order; an empty one is left alone."""
    if df.isEmpty():
        log.warning("mart is empty, %s is left as it is", path)
        return False
    mart_cells(df).write.mode("overwrite").options(header=True, emptyValue="", **SHEET_CSV).csv(path)
    return True


@dataclass(frozen=True)
class Swap:
    done: bool
    reason: str
    rows: int
    duplicate_hashes: int = 0


_VERSION = "version"             # the property of a table's view that names the version it shows


def stage_version(df: DataFrame, table: str, root: str | None = None, holder: str | None = None) -> str:
    """Writes the next version of a table beside it; the version's name.

    `root` is a folder that all executors share; without it the catalog's warehouse holds the
    data.  The registry has the version before it is written, with a lease for the load that `holder` names.
    """
    version, registry = f"{table}__{uuid.uuid4().hex}", Registry(df.sparkSession, table)
    registry.own(version)
    if holder:
        registry.lease(version, holder)
    writer = df.write.mode("overwrite")
    if root:
        writer = writer.option("path", f"{root.rstrip('/')}/{table}/{version.rpartition('__')[2]}")
    writer.saveAsTable(version)
    return version


def shown_version(spark: SparkSession, view: str) -> str | None:
    """The version that a view shows."""
    if not spark.catalog.tableExists(view):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {view}").where(F.col("key") == _VERSION).collect()     # one row
    return rows[0]["value"] if rows else None


def _show(spark: SparkSession, view: str, version: str) -> None:
    cells = f"* EXCEPT ({buckets.BUCKET})" if buckets.buckets_of(spark, version) else "*"
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_VERSION}' = '{version}') AS SELECT {cells} FROM {version}")


def drop_version(spark: SparkSession, version: str) -> None:
    """Drops a version and its files, also those in a folder the catalog does not own.

    Of a version in buckets, those stay that other versions of the table share.
    """
    if layout := buckets.buckets_of(spark, version):
        owned = Registry(spark, version.rpartition("__")[0]).owned()
        others = [found for v in owned if v != version and (found := buckets.buckets_of(spark, v))]
        spark.sql(f"DROP TABLE {version}")
        buckets.drop_files(spark, layout, others)
        return
    place = spark.sql(f"DESCRIBE FORMATTED {version}").where("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE {version}")
    if place:
        path = spark._jvm.org.apache.hadoop.fs.Path(place["data_type"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_versions(spark: SparkSession, table: str) -> int:
    """Drops versions of the table's own that neither it nor its backup shows and no load or reader needs; how many.

    What counts is the registry: tables that other loads or users have made are left alone, whatever they are called.
    """
    registry = Registry(spark, table)
    used = {shown_version(spark, table), shown_version(spark, f"{table}_backup")} | registry.leased()
    free = [version for version in registry.owned() if version not in used]
    for version in free:
        if spark.catalog.tableExists(version):
            drop_version(spark, version)
        registry.disown(version)
    return len(free)


_ANY = "any"                     # swap_in() without asking what was shown before


def swap_in(spark: SparkSession, table: str, version: str, expected: str | None = _ANY) -> None:
    """Shows a staged version under a table's name; the one before stays as `<table>_backup`.

    A table is a view of its version, so one statement swaps it: at any time the name shows one
    whole version.  A plain table of that name becomes the first version.  With `expected`, the version the load has
    started from, a table that shows another one by now stays as it is (ConcurrentLoad).
    """
    registry = Registry(spark, table)
    with registry.lock():
        before = shown_version(spark, table)
        if expected not in (_ANY, before):
            raise ConcurrentLoad(f"{table} has been replaced meanwhile")
        if before is None and spark.catalog.tableExists(table):
            before = f"{table}__{uuid.uuid4().hex}"
            registry.own(before)
            spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
            _show(spark, table, before)
        if before:
            _show(spark, f"{table}_backup", before)
        _show(spark, table, version)
    free_versions(spark, table)


@contextmanager
def reading(spark: SparkSession, table: str) -> Iterator[DataFrame]:
    """The version a table shows now, kept from being dropped as long as it is read."""
    registry = Registry(spark, table)
    with registry.holder() as holder:
        version = shown_version(spark, table)
        if version:
            registry.lease(version, holder)
        yield spark.table(version or table)


def replace_table(df: DataFrame, table: str, root: str | None = None) -> None:
    """A new version of a table; `df` may read the present one."""
    spark = df.sparkSession
    with Registry(spark, table).holder() as holder:
        before = shown_version(spark, table)
        swap_in(spark, table, stage_version(df, table, root, holder), before)


@dataclass(frozen=True)
class Rewritten:
    """Buckets that a load has written, of all that the table is kept in."""

    buckets: int
    of: int


def _stage_buckets(df: DataFrame, table: str, layout: buckets.Buckets, holder: str, before: buckets.Buckets | None = None,
                   changed: list[int] | None = None) -> str:
    version, registry = f"{table}__{layout.folder.rpartition('/')[2]}", Registry(df.sparkSession, table)
    registry.own(version)
    registry.lease(version, holder)
    buckets.write_version(df, version, layout, before, changed)
    return version


def replace_in_buckets(df: DataFrame, table: str, key: str, n: int = buckets.BUCKETS, root: str | None = None) -> None:
    """A new version of a table, kept in `n` buckets by `key`; `df` may read the present one."""
    spark = df.sparkSession
    base = (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    with Registry(spark, table).holder() as holder:
        before = shown_version(spark, table)
        layout = buckets.Buckets(key, n, f"{base}/{table}/{uuid.uuid4().hex}")
        swap_in(spark, table, _stage_buckets(df, table, layout, holder), before)


def change_buckets(spark: SparkSession, table: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> Rewritten:
    """A new version in which only the buckets of `keys` (one column; repeats do no harm) are read and written again.

    `change` takes the table's rows in those buckets and returns what they become; it may change, drop and add rows of
    these keys.  Rows it adds to other buckets are refused (ValueError), and the table stays as it is.
    """
    registry = Registry(spark, table)
    with registry.holder() as holder:
        before = shown_version(spark, table)
        layout = buckets.buckets_of(spark, before)
        if layout is None:
            raise ValueError(f"{table} is not kept in buckets")
        registry.lease(before, holder)
        changed = buckets.hit(keys, layout)
        if changed:
            part = spark.table(before).where(F.col(buckets.BUCKET).isin(changed)).drop(buckets.BUCKET)
            fresh = buckets.Buckets(layout.key, layout.n, f"{layout.folder.rpartition('/')[0]}/{uuid.uuid4().hex}")
            swap_in(spark, table, _stage_buckets(change(part), table, fresh, holder, layout, changed), before)
    return Rewritten(len(changed), layout.n)


def repeated_keys(spark: SparkSession, table: str, key: str) -> DataFrame | None:
    """(key, cnt) of the keys that occur more than once in a table, as its version has them noted; None if it has not.

    For tables kept in buckets by that key: the table itself is not read.
    """
    layout = buckets.buckets_of(spark, shown_version(spark, table))
    found = buckets.repeated(spark, layout) if layout and layout.key == key else None
    return None if found is None else found.where("key IS NOT NULL AND cnt > 1").select(F.col("key").alias(key), "cnt")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drops a table that was loaded by versions, with its backup and all files."""
    for view in (table, f"{table}_backup"):
        spark.sql(f"DROP VIEW IF EXISTS {view}")
    free_versions(spark, table)


def swap_load(
    spark: SparkSession,
    new: DataFrame,
    table: str,
    pk: str,
    content_hash: str | None = None,
    min_ratio: float = fv.MIN_SWAP_RATIO,
    force: bool = False,
    root: str | None = None,
) -> Swap:
    """Replaces a table by a new version, if that holds up.

    The swap is refused if the new rows are fewer than `min_ratio` of the present ones
    (unless forced) or if `pk` repeats.  They are written and checked beside the table, so the
    live one is never half written.
    """
    with Registry(spark, table).holder() as holder:
        before = shown_version(spark, table)
        present = spark.table(table).count() if spark.catalog.tableExists(table) else 0
        version = stage_version(new, table, root, holder)
        loaded = spark.table(version)
        rows = loaded.count()
        reason = ""
        if rows == 0:
            reason = "no rows"
        elif rows < present * min_ratio and not force:
            reason = f"{rows} rows are under {min_ratio:.0%} of {present}"
        elif not duplicate_keys(loaded, [pk], skip_null=False).isEmpty():
            reason = f"duplicate {pk}"
        if reason:
            drop_version(spark, version)
            Registry(spark, table).disown(version)
            log.error("%s not replaced: %s", table, reason)
            return Swap(False, reason, rows)
        repeats = duplicate_hash_count(loaded, content_hash).first()[0] if content_hash else 0
        if repeats:
            log.warning("%s: %d repeated values of %s", table, repeats, content_hash)
        swap_in(spark, table, version, before)
        return Swap(True, "", rows, repeats)


def expire_dumps(spark: SparkSession, table: str, as_of: datetime, days: int = fv.RETENTION_DAYS) -> int:
    """Deletes raw dumps older than `days` from a managed table partitioned by day; how many.

    Whole days are dropped as partitions; only the day of the cut is rewritten.
    """
    if spark.catalog.getTable(table).tableType != "MANAGED":
        raise ValueError(f"the catalog does not own the files of {table}, so dropping days would leave them")
    dumps, at = spark.table(table), F.lit(as_of)
    # the day of the cut in the zone in which the rows' days were told
    cut = spark.range(1).select(F.to_date(at - F.make_dt_interval(days=F.lit(days)))).first()[0]
    kept, gone = retention(dumps, "extracted_at", at, days)
    deleted = gone.first()["deleted"]
    if not deleted:
        return 0
    last_day = materialize(kept.where(F.col("extracted_on") == F.lit(cut)).select(*dumps.columns), "last_day")
    keep_last_day = not last_day.isEmpty()
    if keep_last_day:
        cells = ", ".join(c for c in dumps.columns if c != "extracted_on")
        # names the partition, so that no other day can be touched
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (extracted_on = DATE'{cut}') SELECT {cells} FROM {{kept}}", kept=last_day
        )
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():          # one row per day
        day = row[0].split("=", 1)[1]
        if day < cut.isoformat() or (day == cut.isoformat() and not keep_last_day):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (extracted_on = '{day}')")
    return deleted
