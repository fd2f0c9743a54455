"""Contracts and validation, snapshot diff, merge into core tables, soft delete."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, functions as F

from harness import sqltext as q
from harness.clean import as_of, flat
from harness.fixtures import AS_OF_EVENTS, AS_OF_SALES, fixture, table
from rowloom import fixed_values as fv
from rowloom.functions.hashing import row_hash
from rowloom.operators import cdc, losses, merge, validate as v
from rowloom.plans import transforms
from rowloom.plans.run import apply_changes
from rowloom.sources import buckets, layout, sinks
from rowloom.sources.contracts import CONTRACTS, contract_for, contract_projection
from rowloom.sources.shared import materialize, shared_folder
from rowloom.sources.tabular import prepare_rows, to_staging

# ---------------------------------------------------------------- contracts and validation


def contract_project(spark, sf):
    """The historical sales sheet under its contract: extra columns go, mapped and key stay."""
    df = fixture(spark, sf, "sales_hst").select(
        F.col("record_id"), F.lit("x").alias("junk"), "date", "client_full", F.lit("y").alias("sheet_updated_at"),
        "product", F.col("_row_index").alias("n"), "quantity", "final_price",
    )
    kept = contract_projection(
        df.columns, contract_for("stg_gsheets.sales_hst"), {"updated_at": "sheet_updated_at"}, pk="record_id"
    )
    return df.select(*kept)


def _checked(spark, sf, name="sales_checked", entity="sales", compat=False):
    return v.validate(fixture(spark, sf, name), CONTRACTS[entity], compat)


def _error_rows(df: DataFrame) -> DataFrame:
    kinds = F.transform("errors", lambda e: F.concat_ws(":", e["column"], e["error_type"]))
    return df.groupBy(
        "is_blank", F.array_join(F.array_sort(kinds), ",").alias("errors"), F.lower(F.col("row_status")).alias("row_status")
    ).agg(F.count("*").alias("rows"), F.sum("row_index").alias("index_sum"))


def validate_rows(spark, sf):
    """Which errors rows of the sales sheet have, with the number of rows alike."""
    df = _checked(spark, sf)
    return _error_rows(df.withColumn("row_status", F.when(F.size("errors") == 0, "OK").otherwise("BAD")))


def validate_schedule(spark, sf):
    df = _checked(spark, sf, "schedule_checked", "schedule")
    return _error_rows(df.withColumn("row_status", F.when(F.size("errors") == 0, "OK").otherwise("BAD")))


def validate_compat(spark, sf):
    df = _checked(spark, sf, compat=True)
    return _error_rows(df.withColumn("row_status", F.when(F.size("errors") == 0, "OK").otherwise("BAD")))


def validate_summary(spark, sf):
    s = v.validation_summary(_checked(spark, sf), by=["product_type"])
    return s.withColumn("error_rate", F.round("error_rate", 6))


def error_thresholds(spark, sf):
    sales = v.validation_summary(_checked(spark, sf)).withColumn("sheet", F.lit("sales"))
    schedule = v.validation_summary(_checked(spark, sf, "schedule_checked", "schedule")).withColumn("sheet", F.lit("schedule"))
    return v.error_thresholds(sales.unionByName(schedule)).select(
        "sheet", "total_errors", "max_row_errors", "is_valid", "too_many_errors", "broken_rows"
    )


def validation_log(spark, sf):
    df = _checked(spark, sf, "schedule_checked", "schedule")
    return flat(v.validation_log(df, "run-1", "stg_gsheets.trainings_hst", F.col("row_index"), as_of(AS_OF_EVENTS)))


def first_errors(spark, sf):
    df = _checked(spark, sf, "schedule_checked", "schedule")
    log = v.validation_log(df, "run-1", "stg_gsheets.trainings_hst", F.col("row_index"), as_of(AS_OF_EVENTS))
    return v.first_errors(log).select("row_index", "column_name", "error_type")


def constraint_checks(spark, sf):
    o, li, e = (table(spark, sf, t) for t in ("orders", "lineitem", "events"))
    tall = F.col("l_extendedprice")
    shipped = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    parts = [
        v.check_unique(o, ["o_orderkey"]),
        v.check_unique(li, ["l_orderkey", "l_linenumber"]),
        v.check_reference(o.withColumn("ref", F.col("o_custkey") * 2), "ref", table(spark, sf, "customer"), "c_custkey"),
        v.check_rows(e, [v.not_null("props"), v.allowed("event_type", ["click", "view", "purchase"]),
                         v.max_length("event_type", 6), v.within("value", F.lit(0), F.lit(100))]),
        v.check_rows(shipped, [v.ordered("o_orderdate", "l_shipdate"),
                               v.Check("expire_limit", F.col("l_shipdate") <= F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")),
                               v.Check("price_cap", tall <= 100000)]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- snapshot diff

_SHEET = ["record_id", "klient", "status", "summa"]


def _stored(spark, sf):
    return to_staging(fixture(spark, sf, "orders_stored"), _SHEET, as_of("2024-01-01 00:00:00"), numeric=["summa"])


def _sheet(spark, sf):
    return prepare_rows(fixture(spark, sf, "orders_sheet"), _SHEET, numeric=["summa"])


def cdc_diff(spark, sf):
    diff = cdc.cdc_diff(_sheet(spark, sf), _stored(spark, sf), "record_id")
    return diff.select("action", "record_id", "klient", "status", "summa", F.col("_row_index").alias("row_index"),
                       F.col("__row_hash").alias("row_hash"))


def existing_state(spark, sf):
    """Key and hash of what is stored, one row per client: the last one counts."""
    stored = _stored(spark, sf).withColumn("__row_hash", F.when(F.col("status") == "P", "").otherwise(F.col("__row_hash")))
    return cdc.existing_state(stored, "klient").withColumnsRenamed({"__pk": "pk", "__old_hash": "old_hash"})


def cdc_stats(spark, sf):
    return cdc.cdc_stats(cdc.cdc_diff(_sheet(spark, sf), _stored(spark, sf), "record_id"))


def cdc_by_content(spark, sf):
    """The diff with the row hash as key: rows are inserted or deleted, never updated."""
    return cdc.cdc_stats(cdc.cdc_diff(_sheet(spark, sf), _stored(spark, sf), "__row_hash"))


def cdc_apply(spark, sf):
    stored = _stored(spark, sf)
    diff = materialize(cdc.cdc_diff(_sheet(spark, sf), stored, "record_id"), "diff")
    out = cdc.cdc_apply(stored, diff, "record_id", _SHEET, as_of("2024-02-02 00:00:00"))
    return flat(out).withColumnsRenamed({"_row_index": "row_index", "__row_hash": "row_hash", "_loaded_at": "loaded_at"})


def cdc_load(spark, sf):
    """A table brought up to the same snapshot again, and then to the next one; only the second rewrites it."""
    name = f"orders_{uuid.uuid4().hex}"
    now = as_of("2024-02-02 00:00:00")
    stored, sheet = _stored(spark, sf), _sheet(spark, sf)
    sinks.replace_table(stored, name, shared_folder(spark))
    done = []
    for step, rows in (("same", stored), ("next", sheet)):
        before = sinks.shown_version(spark, name)
        figures = apply_changes(spark.table(name), rows, name, "record_id", _SHEET, now, shared_folder(spark))
        done.append((step, *(figures[k] for k in ("inserted", "updated", "deleted", "unchanged")), sinks.shown_version(spark, name) != before))
    rows = spark.table(name).count()
    sinks.drop_table(spark, name)
    out = spark.createDataFrame(done, "step string, inserted long, updated long, deleted long, unchanged long, rewritten boolean")
    return out.withColumn("rows_after", F.lit(rows).cast("long"))


def cdc_buckets(spark, sf):
    """A table in buckets, brought up to a snapshot in which one order differs, then to the next sheet: rows and fate of each bucket."""
    name, n = f"orders_{uuid.uuid4().hex}", 64
    now, stored = as_of("2024-02-02 00:00:00"), _stored(spark, sf)
    first = stored.agg(F.min("record_id")).first()[0]
    one = fixture(spark, sf, "orders_stored").withColumn("status", F.when(F.col("record_id") == first, "X").otherwise(F.col("status")))
    one = to_staging(one, _SHEET, as_of("2024-01-01 00:00:00"), numeric=["summa"])
    sinks.replace_in_buckets(stored, name, "record_id", n, shared_folder(spark))
    out = None
    for step, rows in (("one", one), ("next", _sheet(spark, sf))):
        before = buckets.buckets_of(spark, sinks.shown_version(spark, name))
        apply_changes(spark.table(name), rows, name, "record_id", _SHEET, now)
        version = sinks.shown_version(spark, name)
        kept = buckets.manifest(spark, before).select("place", F.lit(False).alias("rewritten"))
        fate = buckets.manifest(spark, buckets.buckets_of(spark, version)).join(kept, "place", "left")
        found = spark.table(version).groupBy(F.col(buckets.BUCKET).alias("bucket")).agg(F.count("*").alias("rows"))
        found = found.join(fate, "bucket").select(F.lit(step).alias("step"), "bucket", "rows", F.coalesce("rewritten", F.lit(True)).alias("rewritten"))
        found = materialize(found, step)
        out = found if out is None else out.unionByName(found)
    sinks.drop_table(spark, name)
    return out


def cdc_duplicates(spark, sf):
    """A snapshot in which every client's key repeats once per order."""
    source = _sheet(spark, sf).select("klient", "summa", "_row_index", row_hash(["klient", "summa"]).alias("__row_hash"))
    target = _stored(spark, sf).select("klient", "summa", "_row_index", row_hash(["klient", "summa"]).alias("__row_hash"))
    diff = cdc.cdc_diff(source, target, "klient")
    return diff.groupBy("action").agg(F.count("*").alias("rows"), F.sum("_row_index").alias("index_sum"),
                                      F.countDistinct("klient").alias("keys"))


def dedupe_first(spark, sf):
    e = table(spark, sf, "events")
    one = merge.first_per_key(e, ["user_id", "event_type"], ["ts", "event_id"])
    return one.select("user_id", "event_type", "event_id", "value")


# ---------------------------------------------------------------- core tables

_CLIENT_CUR = ["record_id", "klient", "mobilnyy", "imya_rebenka", "data_rozhdeniya_rebenka", "tip"]
_CLIENT_HST = ["record_id", "client_full", "phone_mobile", "child_name", "child_birth_date", "product_type"]
_SALES_CUR = ["record_id", "data", "klient", "produkt", "tip", "kategoriya", "kolichestvo", "polnaya_stoimost", "skidka",
              "okonchatelnaya_stoimost", "nalichnye", "perevod", "terminal", "vdolg", "kommentariy", "admin", "trener"]
_SALES_HST = ["record_id", "date", "client_full", "product", "product_type", "product_category", "quantity", "full_price",
              "final_price"]
_TRAIN_CUR = ["record_id", "data", "nachalo", "konets", "status", "tip", "kategoriya", "kommentariy", "klient", "sotrudnik"]
_TRAIN_HST = ["record_id", "date", "start_time", "end_time", "status", "product_type", "product_category", "comment",
              "client_full", "employee"]
SHEETS = {"clients_cur": _CLIENT_CUR, "clients_hst": _CLIENT_HST, "sales_cur": _SALES_CUR, "sales_hst": _SALES_HST,
          "trainings_cur": _TRAIN_CUR, "trainings_hst": _TRAIN_HST}
LONG_AGO = "1999-01-01 00:00:00"


def staged(spark, sf, name):
    return prepare_rows(fixture(spark, sf, name), SHEETS[name], numeric=[])


def client_rows(spark, sf):
    return (transforms.clients_rows(staged(spark, sf, "clients_cur")),
            transforms.clients_rows(staged(spark, sf, "clients_hst"), history=True))


def core_clients(spark, sf):
    """The client table after a run: it held every second-rate client before, some deleted."""
    rows = fixture(spark, sf, "clients_cur").select(
        F.md5(F.concat(F.coalesce("klient", F.lit("")), F.coalesce("mobilnyy", F.lit("")))).alias("legacy_id"),
        F.lit("прежнее имя").alias("name"), F.col("mobilnyy").alias("phone"), F.lit("old").alias("status"),
        F.lit("12").alias("age"), (F.length("tip") * 10).cast("decimal(18,2)").alias("balance"),
        F.lit("0" * 32).alias("row_hash"), F.lit("clients_cur").alias("source"), (F.col("tip") == "FURNITURE").alias("is_deleted"),
        F.when(F.col("tip") == "FURNITURE", as_of("2000-01-01 00:00:00")).alias("deleted_at"), "tip", "klient",
    ).where("tip IN ('FURNITURE', 'BUILDING') AND trim(klient) <> ''")
    before = layout.conform(rows, layout.CLIENTS, as_of(LONG_AGO))
    current, history = client_rows(spark, sf)
    return transforms.merge_current_then_history(before, current, history, as_of(AS_OF_SALES))


def cell_losses(spark, sf):
    """Cells of all sheets that the transforms turn into 0, NULL or a default."""
    out = None
    for name in SHEETS:
        sheet = fixture(spark, sf, name)
        counts = losses.loss_counts(sheet, transforms.lost_cells(name, sheet.columns)).withColumn("sheet", F.lit(name))
        out = counts if out is None else out.unionByName(counts)
    return out


def conform_losses(spark, sf):
    """Cells of the sales sheet that its typed layout cannot hold."""
    o = fixture(spark, sf, "sales_hst").withColumnRenamed("record_id", "legacy_id")
    return losses.loss_counts(o, layout.misfits(o, layout.SALES))


def upsert_clients(spark, sf):
    return flat(core_clients(spark, sf))


def core_sales(spark, sf, clients):
    now = as_of(AS_OF_SALES)
    current, history = (staged(spark, sf, n) for n in ("sales_cur", "sales_hst"))
    again = transforms.sales_again(current, history)
    return transforms.merge_current_then_history(
        layout.empty(spark, layout.SALES),
        transforms.sales_rows(current, clients, now, again=again),
        transforms.sales_rows(history, clients, now, history=True, again=again),
        now,
    )


def core_schedule(spark, sf, clients):
    now = as_of(AS_OF_EVENTS)
    employees = fixture(spark, sf, "employees")
    current, history = (staged(spark, sf, n) for n in ("trainings_cur", "trainings_hst"))
    again = transforms.schedule_again(current, history)
    return transforms.merge_current_then_history(
        layout.empty(spark, layout.SCHEDULE),
        transforms.schedule_rows(current, clients, employees, now, year=2024, again=again),
        transforms.schedule_rows(history, clients, employees, now, history=True, again=again),
        now,
    )


def new_clients(spark, sf):
    """The client table as the first run on an empty warehouse fills it, written as in a run."""
    current, history = client_rows(spark, sf)
    merged = transforms.merge_current_then_history(layout.empty(spark, layout.CLIENTS), current, history, as_of(AS_OF_SALES))
    return materialize(merged, "clients")


def upsert_sales(spark, sf):
    return flat(core_sales(spark, sf, new_clients(spark, sf)))


def upsert_schedule(spark, sf):
    return flat(core_schedule(spark, sf, new_clients(spark, sf)))


def _deleted(spark, sf):
    """Order rows kept under two sources against what the sheets hold now."""
    core = _stored(spark, sf).select(
        F.col("record_id").alias("legacy_id"),
        F.when(F.col("status") == "P", None).otherwise(F.col("__row_hash")).alias("row_hash"),
        F.when(F.col("status") == "F", "sales_hst").when(F.col("status") == "O", "other").otherwise("sales_cur").alias("source"),
        (F.col("summa").cast("double") > 400000).alias("is_deleted"),
        F.lit(None).cast("timestamp").alias("deleted_at"), F.lit("active").alias("status"),
    )
    sheet = _sheet(spark, sf)
    return core, merge.staged_hashes(("sales_cur", sheet), ("sales_hst", sheet.where("status = 'F'")))


def soft_delete(spark, sf):
    core, hashes = _deleted(spark, sf)
    return flat(merge.soft_delete(core, hashes, as_of(AS_OF_SALES), sources=["sales_cur", "sales_hst"]))


def soft_delete_any_source(spark, sf):
    core, hashes = _deleted(spark, sf)
    return flat(merge.soft_delete(core, hashes, as_of(AS_OF_SALES), status="deleted"))


def soft_delete_absent(spark, sf):
    """One of two sheets was not staged: rows that came from it stay, whatever the other holds."""
    core, hashes = _deleted(spark, sf)
    marked = merge.soft_delete(core, hashes.where("source = 'sales_cur'"), as_of(AS_OF_SALES), status="deleted", only=["sales_cur"])
    return merge.soft_delete_counts(marked)


def soft_delete_counts(spark, sf):
    core, hashes = _deleted(spark, sf)
    return merge.soft_delete_counts(merge.soft_delete(core, hashes, as_of(AS_OF_SALES), sources=["sales_cur", "sales_hst"]))


def soft_delete_untouched(spark, sf):
    """Upsert and soft delete in one: sheet rows that are pending are staged, but not merged."""
    core, hashes = _deleted(spark, sf)
    sheet = _sheet(spark, sf).where("coalesce(record_id, '') <> '' AND status <> 'P'")
    rows = merge.first_per_key(
        sheet.select(F.col("record_id").alias("legacy_id"), F.col("__row_hash").alias("row_hash"), F.lit("sales_cur").alias("source"),
                     F.lit("active").alias("status"), "_row_index"), ["legacy_id"], ["_row_index", "row_hash"]).drop("_row_index")
    return flat(merge.upsert_and_delete(core, rows, "legacy_id", as_of(AS_OF_SALES), hashes, ["sales_cur", "sales_hst"], "deleted"))


def undelete(spark, sf):
    """Clients that were deleted, and came back with this run's sheets."""
    after = core_clients(spark, sf)
    return flat(after.where((F.col("created_at") < as_of(AS_OF_SALES)) & ~F.col("is_deleted"))
                .select("legacy_id", "name", "status", "balance", "deleted_at", "created_at", "updated_at"))


def distinct_employees(spark, sf):
    return merge.distinct_names((fixture(spark, sf, "trainings_cur"), "sotrudnik"), (fixture(spark, sf, "trainings_hst"), "employee"))


def insert_absent(spark, sf):
    return transforms.new_employees(
        fixture(spark, sf, "employees"), (fixture(spark, sf, "trainings_cur"), "sotrudnik"),
        (fixture(spark, sf, "trainings_hst"), "employee"),
    )


def seed_lookup(spark, sf):
    """Employee seeds next to the names in use, aliases as text."""
    from rowloom import fixed_values as fv

    names = fixture(spark, sf, "employees").select(F.when(F.col("role") == "admin", "Система").otherwise(F.col("full_name")).alias("full_name"))
    seeds = transforms.seed_lookup(names, list(fv.SEED_EMPLOYEES), "full_name string, role string, aliases array<string>", "full_name")
    out = seeds.select("full_name", "role", F.array_join("aliases", ",").alias("aliases"))
    return names.select("full_name", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("aliases")).unionByName(out)


QUERIES = {
    f.__name__: f
    for f in (contract_project, validate_rows, validate_schedule, validate_compat, validate_summary, error_thresholds,
              validation_log, first_errors, constraint_checks, cdc_diff, existing_state, cdc_stats, cdc_by_content, cdc_apply, cdc_load,
              cdc_buckets, cdc_duplicates,
              dedupe_first, cell_losses, conform_losses, upsert_clients, upsert_sales, upsert_schedule, soft_delete, soft_delete_any_source, soft_delete_absent,
              soft_delete_counts, soft_delete_untouched, undelete, distinct_employees, insert_absent, seed_lookup)
}

# ---------------------------------------------------------------- oracles

_BLANK = lambda c: f"(coalesce({q.strip(c)}, '') = '')"                                     # noqa: E731
_INT_OK = lambda c: rf"regexp_matches({c}, '^{q.WS}*[+-]?\d+(\.0+)?{q.WS}*$')"              # noqa: E731
_MONEY_OK = lambda c: rf"regexp_matches(replace(regexp_replace({c}, '[^\d,.-]', '', 'g'), ',', '.'), '{q.PLAIN}')"


def _date_ok(c, formats):
    plain = q.strip(f"regexp_replace({q.strip(c)}, '(?i)^[а-яa-z]{{2,3}}{q.WS}+', '')")
    return "(" + " OR ".join(f"regexp_matches({plain}, '{fv.DATE_SHAPES[f]}')" for f in formats) + ")"


_FORMATS = {name: next(formats for column, _, _, formats in rules if column == "date") for name, rules in fv.CONTRACTS.items() if name in ("sales", "schedule")}


def _sales_errors(compat=False):
    late = "date IS NOT NULL AND " if compat else ""
    seen = "quantity IS NOT NULL" if compat else f"NOT {_BLANK('quantity')}"
    return [
        ("client_full:MISSING_REQUIRED", _BLANK("client_full")),
        ("date:INVALID_DATE", f"NOT {_BLANK('date')} AND NOT {_date_ok('date', _FORMATS["sales"])}"),
        ("date:MISSING_REQUIRED", f"{late}{_BLANK('date')}"),
        ("final_price:INVALID_MONEY", f"NOT {_BLANK('final_price')} AND NOT {_MONEY_OK('final_price')}"),
        ("full_price:INVALID_MONEY", f"NOT {_BLANK('full_price')} AND NOT {_MONEY_OK('full_price')}"),
        ("product:MISSING_REQUIRED", _BLANK("product")),
        ("quantity:INVALID_INTEGER", f"{seen} AND NOT {_INT_OK('quantity')}"),
    ]


_TIME_OK = lambda c: f"regexp_matches({q.strip(c)}, '{fv.TIME_SHAPE}')"           # noqa: E731
_SCHEDULE_ERRORS = [
    ("date:INVALID_DATE", f"NOT {_BLANK('date')} AND NOT {_date_ok('date', _FORMATS["schedule"])}"),
    ("date:MISSING_REQUIRED", _BLANK("date")),
    ("end_time:INVALID_TIME", f"NOT {_BLANK('end_time')} AND NOT {_TIME_OK('end_time')}"),
    ("end_time:MISSING_REQUIRED", _BLANK("end_time")),
    ("start_time:INVALID_TIME", f"NOT {_BLANK('start_time')} AND NOT {_TIME_OK('start_time')}"),
    ("start_time:MISSING_REQUIRED", _BLANK("start_time")),
    ("status:MISSING_REQUIRED", _BLANK("status")),
]
_SALES_BLANK = f"({_BLANK('date')} AND {_BLANK('client_full')} AND {_BLANK('product')})"
_SCHEDULE_BLANK = f"({_BLANK('date')} AND {_BLANK('start_time')} AND {_BLANK('end_time')} AND {_BLANK('status')})"


def _checked_cte(fixture_name, errors, blank, name="checked"):
    listed = ", ".join(f"CASE WHEN NOT {blank} AND ({cond}) THEN '{kind}' END" for kind, cond in errors)
    return f"{name} AS (SELECT *, {blank} AS is_blank, [e FOR e IN [{listed}] IF e IS NOT NULL] AS errors FROM {fixture_name})"


def _by_errors(fixture_name, errors, blank):
    return q.with_fixtures(fixture_name, more=_checked_cte(fixture_name, errors, blank)) + """
        SELECT is_blank, array_to_string(errors, ',') AS errors, CASE WHEN len(errors) = 0 THEN 'ok' ELSE 'bad' END AS row_status,
          count(*) AS rows, CAST(sum(row_index) AS BIGINT) AS index_sum
        FROM checked GROUP BY ALL"""




def _message(kind: str, value: str) -> str:
    """A message as an SQL text, its gaps filled with expressions."""
    fillings = {"value": value, "column": "split_part(e, ':', 1)", "formats": q.quoted(str(list(_FORMATS["schedule"])))}
    parts = re.split(r"\{(\w+)\}", fv.MESSAGES[kind])
    return " || ".join(fillings[p] if k % 2 else q.quoted(p) for k, p in enumerate(parts) if p)


_MESSAGE = "CASE split_part(e, ':', 2) " + " ".join(
    f"WHEN '{kind}' THEN {_message(kind, value)}" for kind, value in (("MISSING_REQUIRED", "val"), ("INVALID_DATE", "date"), ("INVALID_TIME", "val"))
) + " END"
_LOG = q.with_fixtures("schedule_checked", more=_checked_cte("schedule_checked", _SCHEDULE_ERRORS, _SCHEDULE_BLANK) + """,
    e AS (SELECT *, unnest(errors) AS e FROM checked),
    log AS (SELECT *, CASE split_part(e, ':', 1) WHEN 'date' THEN date WHEN 'start_time' THEN start_time WHEN 'end_time' THEN end_time ELSE status END AS val FROM e)""")
_SUMMARY = """count(*) AS total_rows, count(*) FILTER (NOT is_blank AND len(errors) = 0) AS valid_rows,
    count(*) FILTER (is_blank) AS blank_rows, count(*) - count(*) FILTER (NOT is_blank AND len(errors) = 0) AS error_count,
    round((count(*) - count(*) FILTER (NOT is_blank AND len(errors) = 0)) / count(*), 6) AS error_rate,
    CAST(sum(len(errors)) AS BIGINT) AS total_errors, CAST(max(len(errors)) AS INTEGER) AS max_row_errors,
    sum(len(errors)) = 0 AS is_valid,
    (count(*) - count(*) FILTER (NOT is_blank AND len(errors) = 0)) > 100
      OR (count(*) - count(*) FILTER (NOT is_blank AND len(errors) = 0)) / count(*) > 0.02 AS over_threshold"""

_HASH = q.row_hash("record_id", "klient", "status", "summa")
_DIFF = q.with_fixtures("orders_stored", "orders_sheet", more=f"""
    stored AS (SELECT *, {_HASH} AS h FROM orders_stored),
    sheet AS (SELECT record_id, klient, status, {q.numeric_text('summa')} AS summa, _row_index FROM orders_sheet),
    hashed AS (SELECT *, {_HASH} AS h FROM sheet WHERE coalesce(record_id, '') <> ''),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY _row_index) AS occurrence FROM hashed),
    diff AS (
      SELECT CASE WHEN t.record_id IS NULL OR occurrence > 1 THEN 'INSERT' WHEN t.h = s.h THEN 'UNCHANGED' ELSE 'UPDATE' END AS action, s.*
      FROM ranked s LEFT JOIN stored t ON t.record_id = s.record_id
      UNION ALL SELECT 'DELETE', record_id, NULL, NULL, NULL, NULL, NULL, NULL FROM stored WHERE record_id NOT IN (SELECT record_id FROM hashed))""")
_COUNTS = """count(*) FILTER (action = 'INSERT') AS inserted, count(*) FILTER (action = 'UPDATE') AS updated,
    count(*) FILTER (action = 'DELETE') AS deleted, count(*) FILTER (action = 'UNCHANGED') AS unchanged"""


_BUCKET = "CAST(CAST('0x' || substr(md5(record_id), 1, 8) AS BIGINT) % 64 AS INTEGER)"
# the order that the first step has changed differs from the sheet's, unless the sheet has no longer got it
_CHANGED = "FROM diff WHERE action <> 'UNCHANGED' OR record_id = (SELECT min(record_id) FROM stored)"


def _bare_day(c: str) -> str:
    """What a cell without a year gives: its day in the schedule's year."""
    return rf"CASE WHEN NOT {q.has(c, q.ANY)} AND {q.has(c, '^[0-9]{2}[.][0-9]{2}[.]')} THEN try_strptime(left({c}, 6) || '{fv.DEFAULT_SCHEDULE_YEAR}', '%d.%m.%Y') END"


def _clock(c: str) -> str:
    found = f"regexp_extract(trim({c}), '^([0-9][0-9]?):([0-9][0-9])', {{}})"
    hour, minute = (f"try_cast({found.format(i)} AS INTEGER)" for i in (1, 2))
    return f"CASE WHEN {minute} < 60 AND ({hour} < 24 OR {hour} = 24 AND {minute} = 0) THEN 1 END"


def _born(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}}') THEN {q.found_date(c)} END"


_TYPED = [
    ("clients_cur", "data_rozhdeniya_rebenka", _born), ("clients_hst", "child_birth_date", _born),
    ("sales_cur", "data", q.found_date), ("sales_cur", "kolichestvo", q.whole), ("sales_cur", "polnaya_stoimost", q.amount), ("sales_cur", "skidka", q.amount),
    ("sales_cur", "okonchatelnaya_stoimost", q.amount), ("sales_cur", "nalichnye", q.amount), ("sales_cur", "perevod", q.amount),
    ("sales_cur", "terminal", q.amount), ("sales_cur", "vdolg", q.amount),
    ("sales_hst", "date", q.found_date), ("sales_hst", "quantity", q.whole), ("sales_hst", "full_price", q.amount), ("sales_hst", "final_price", q.amount),
    ("trainings_cur", "data", lambda c: f"coalesce({q.found_date(c)}, {_bare_day(c)})"), ("trainings_cur", "nachalo", _clock), ("trainings_cur", "konets", _clock),
    ("trainings_hst", "date", q.found_date), ("trainings_hst", "start_time", _clock), ("trainings_hst", "end_time", _clock),
]


def _dedupe(select: str, name: str) -> str:
    return f"""{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY legacy_id ORDER BY _row_index, row_hash) AS rn
        FROM ({select})) WHERE rn = 1)"""


def _sheet_hash(name: str, prefix: str = "") -> str:
    return q.row_hash(*[prefix + c for c in SHEETS[name]])


CLIENT_CTES = ",\n".join([
    _dedupe(f"""SELECT {q.legacy('klient', 'mobilnyy')} AS legacy_id, {_sheet_hash('clients_cur')} AS row_hash, 'clients_cur' AS source,
        coalesce({q.n('klient')}, 'Без имени') AS name, coalesce({q.n('mobilnyy')}, '+70000000000') AS phone, {q.n('imya_rebenka')} AS child_name,
        {q.birth_date('data_rozhdeniya_rebenka')} AS child_dob, {q.n('tip')} AS status, _row_index
        FROM clients_cur WHERE {q.n('klient')} IS NOT NULL""", "c_cur"),
    _dedupe(f"""SELECT {q.legacy('client_full', 'phone_mobile')} AS legacy_id, {_sheet_hash('clients_hst')} AS row_hash, 'clients_hst' AS source,
        coalesce({q.n('client_full')}, 'Без имени') AS name, coalesce({q.n('phone_mobile')}, '+70000000000') AS phone, {q.n('child_name')} AS child_name,
        {q.birth_date('child_birth_date')} AS child_dob, {q.n('product_type')} AS status, _row_index
        FROM clients_hst WHERE {q.n('client_full')} IS NOT NULL""", "c_hst"),
    # current first, then history over it
    """c_new AS (SELECT * FROM c_hst UNION ALL SELECT * FROM c_cur WHERE legacy_id NOT IN (SELECT legacy_id FROM c_hst))""",
    """names AS (SELECT name, min(legacy_id) AS id FROM c_new GROUP BY name)""",
])

_OLD_CLIENTS = """old AS (SELECT md5(coalesce(klient, '') || coalesce(mobilnyy, '')) AS legacy_id, 'прежнее имя' AS name, mobilnyy AS phone, 'old' AS status,
    '12' AS age, CAST(length(tip) * 10 AS DOUBLE) AS balance, repeat('0', 32) AS row_hash, 'clients_cur' AS source, tip = 'FURNITURE' AS is_deleted,
    CASE WHEN tip = 'FURNITURE' THEN '2000-01-01 00:00:00' END AS deleted_at
    FROM clients_cur WHERE tip IN ('FURNITURE', 'BUILDING') AND trim(klient) <> '')"""
_MERGED_CLIENTS = f"""merged AS (
    SELECT coalesce(s.legacy_id, t.legacy_id) AS legacy_id, CASE WHEN s.legacy_id IS NULL THEN t.name ELSE s.name END AS name,
      CASE WHEN s.legacy_id IS NULL THEN t.phone ELSE s.phone END AS phone, CASE WHEN s.legacy_id IS NULL THEN t.status ELSE s.status END AS status,
      s.child_name, {q.day('s.child_dob')} AS child_dob, t.age, t.balance,
      CASE WHEN t.legacy_id IS NOT NULL THEN 0.0::DOUBLE END AS debt, CASE WHEN t.legacy_id IS NOT NULL THEN 0.0::DOUBLE END AS spent,
      CASE WHEN s.legacy_id IS NULL THEN t.row_hash ELSE s.row_hash END AS row_hash, CASE WHEN s.legacy_id IS NULL THEN t.source ELSE s.source END AS source,
      CASE WHEN s.legacy_id IS NULL THEN t.is_deleted ELSE false END AS is_deleted, CASE WHEN s.legacy_id IS NULL THEN t.deleted_at END AS deleted_at,
      CASE WHEN t.legacy_id IS NULL THEN '{AS_OF_SALES}' ELSE '{LONG_AGO}' END AS created_at,
      CASE WHEN s.legacy_id IS NULL THEN '{LONG_AGO}' ELSE '{AS_OF_SALES}' END AS updated_at
    FROM c_new s FULL JOIN old t ON s.legacy_id = t.legacy_id)"""


def sales_ctes(as_of_: str = AS_OF_SALES) -> str:
    cur = f"""SELECT {q.legacy('data', 'klient', 'produkt', 'okonchatelnaya_stoimost')} AS legacy_id, {q.sales_date('data', as_of_)} AS date, id AS client_id,
        coalesce({q.n('produkt')}, 'Неизвестно') AS product_name, {q.n('tip')} AS type, {q.n('kategoriya')} AS category, {q.integer('kolichestvo')} AS quantity,
        {q.money('polnaya_stoimost')} AS full_price, {q.money('skidka')} AS discount, {q.money('okonchatelnaya_stoimost')} AS final_price,
        {q.money('nalichnye')} AS cash, {q.money('perevod')} AS transfer, {q.money('terminal')} AS terminal, {q.money('vdolg')} AS debt,
        {q.n('kommentariy')} AS comment, {q.n('admin')} AS admin, {q.n('trener')} AS trainer, {_sheet_hash('sales_cur')} AS row_hash,
        'sales_cur' AS source, _row_index FROM sales_cur JOIN names ON names.name = klient WHERE {q.n('produkt')} IS NOT NULL"""
    hst = f"""SELECT {q.legacy('date', 'client_full', 'product', 'final_price')} AS legacy_id, {q.sales_date('date', as_of_)} AS date, id AS client_id,
        coalesce({q.n('product')}, 'Неизвестно') AS product_name, {q.n('product_type')} AS type, {q.n('product_category')} AS category,
        {q.integer('quantity')} AS quantity, {q.money('full_price')} AS full_price, 0 AS discount, {q.money('final_price')} AS final_price, 0 AS cash,
        0 AS transfer, 0 AS terminal, 0 AS debt, NULL AS comment, NULL AS admin, NULL AS trainer, {_sheet_hash('sales_hst')} AS row_hash,
        'sales_hst' AS source, _row_index FROM sales_hst JOIN names ON names.name = client_full WHERE {q.n('product')} IS NOT NULL"""
    return ",\n".join([_dedupe(cur, "s_cur"), _dedupe(hst, "s_hst"),
                       "s_new AS (SELECT * FROM s_hst UNION ALL SELECT * FROM s_cur WHERE legacy_id NOT IN (SELECT legacy_id FROM s_hst))"])


def schedule_ctes(as_of_: str = AS_OF_EVENTS) -> str:
    cur = f"""SELECT {q.legacy('data', 'nachalo', 'klient')} AS legacy_id, {q.schedule_date('data', as_of_, 2024)} AS date,
        {q.clock('nachalo', '09:00')} AS start_time, {q.clock('konets', '09:30')} AS end_time, names.id AS client_id, e.id AS employee_id,
        coalesce({q.n('status')}, 'Свободно') AS status, {q.n('tip')} AS type, {q.n('kategoriya')} AS category, {q.n('kommentariy')} AS comment,
        {_sheet_hash('trainings_cur', 't.')} AS row_hash, 'trainings_cur' AS source, _row_index
        FROM trainings_cur t JOIN names ON names.name = klient LEFT JOIN employees e ON e.full_name = sotrudnik WHERE {q.n('data')} IS NOT NULL"""
    hst = f"""SELECT {q.legacy('date', 'start_time', 'client_full')} AS legacy_id, {q.schedule_date_hst('date', as_of_)} AS date,
        {q.clock('start_time', '09:00')} AS start_time, {q.clock('end_time', '09:30')} AS end_time, names.id AS client_id, e.id AS employee_id,
        coalesce({q.n('status')}, 'Свободно') AS status, {q.n('product_type')} AS type, {q.n('product_category')} AS category, {q.n('comment')} AS comment,
        {_sheet_hash('trainings_hst', 't.')} AS row_hash, 'trainings_hst' AS source, _row_index
        FROM trainings_hst t JOIN names ON names.name = client_full LEFT JOIN employees e ON e.full_name = employee WHERE {q.n('date')} IS NOT NULL"""
    return ",\n".join([_dedupe(cur, "t_cur"), _dedupe(hst, "t_hst"),
                       "t_new AS (SELECT * FROM t_hst UNION ALL SELECT * FROM t_cur WHERE legacy_id NOT IN (SELECT legacy_id FROM t_hst))"])


_TRACK = lambda now: f"row_hash, source, false AS is_deleted, CAST(NULL AS VARCHAR) AS deleted_at, '{now}' AS created_at, '{now}' AS updated_at"
_MONIES = ", ".join(f"{q.dbl(c)} AS {c}" for c in ("full_price", "discount", "final_price", "cash", "transfer", "terminal", "debt"))

_SOFT = q.with_fixtures("orders_stored", "orders_sheet", more=f"""
    stored AS (SELECT *, {_HASH} AS h FROM orders_stored),
    sheet AS (SELECT record_id, klient, status, {q.numeric_text('summa')} AS summa FROM orders_sheet),
    hashed AS (SELECT *, {_HASH} AS h FROM sheet),
    core AS (SELECT record_id AS legacy_id, CASE WHEN status = 'P' THEN NULL ELSE h END AS row_hash,
      CASE status WHEN 'F' THEN 'sales_hst' WHEN 'O' THEN 'other' ELSE 'sales_cur' END AS source, CAST(summa AS DOUBLE) > 400000 AS is_deleted FROM stored)""")
_GONE_BY_SOURCE = """(NOT is_deleted AND ((source = 'sales_cur' AND row_hash NOT IN (SELECT h FROM hashed))
    OR (source = 'sales_hst' AND row_hash NOT IN (SELECT h FROM hashed WHERE status = 'F'))))"""
_GONE_ANY = "(NOT is_deleted AND row_hash NOT IN (SELECT h FROM hashed))"


def _soft(gone: str, status: str) -> str:
    return _SOFT + f"""SELECT legacy_id, row_hash, source, is_deleted OR g AS is_deleted, CASE WHEN g THEN '{AS_OF_SALES}' END AS deleted_at,
        {status} AS status, g AS just_deleted FROM (SELECT *, coalesce({gone}, false) AS g FROM core)"""


ORACLE = {
    "contract_project": q.with_fixtures("sales_hst") + """
        SELECT date, client_full, 'y' AS sheet_updated_at, product, quantity, final_price, record_id FROM sales_hst""",
    "validate_rows": _by_errors("sales_checked", _sales_errors(), _SALES_BLANK),
    "validate_schedule": _by_errors("schedule_checked", _SCHEDULE_ERRORS, _SCHEDULE_BLANK),
    "validate_compat": _by_errors("sales_checked", _sales_errors(True), _SALES_BLANK),
    "validate_summary": q.with_fixtures("sales_checked", more=_checked_cte("sales_checked", _sales_errors(), _SALES_BLANK))
    + f"SELECT product_type, {_SUMMARY} FROM checked GROUP BY product_type",
    "error_thresholds": q.with_fixtures("sales_checked", "schedule_checked", more=_checked_cte("sales_checked", _sales_errors(), _SALES_BLANK)
                                        + "," + _checked_cte("schedule_checked", _SCHEDULE_ERRORS, _SCHEDULE_BLANK, "checked2"))
    + """SELECT sheet, CAST(sum(n) AS BIGINT) AS total_errors, CAST(max(n) AS INTEGER) AS max_row_errors, sum(n) = 0 AS is_valid,
          sum(n) > 100 AS too_many_errors, max(n) > 5 AS broken_rows
        FROM (SELECT 'sales' AS sheet, len(errors) AS n FROM checked UNION ALL SELECT 'schedule', len(errors) FROM checked2) GROUP BY sheet""",
    "validation_log": _LOG + f"""SELECT 'run-1' AS run_id, 'stg_gsheets.trainings_hst' AS table_name, row_index, split_part(e, ':', 1) AS column_name,
        left(coalesce(val, 'None'), 255) AS invalid_value, split_part(e, ':', 2) AS error_type, {_MESSAGE} AS message, '{AS_OF_EVENTS}' AS created_at FROM log""",
    "first_errors": _LOG + """SELECT row_index, split_part(e, ':', 1) AS column_name, split_part(e, ':', 2) AS error_type
        FROM log ORDER BY row_index, column_name, error_type LIMIT 5""",
    "constraint_checks": """
        WITH li AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT 'unique:o_orderkey' AS "constraint", count(*) - count(DISTINCT o_orderkey) AS violations FROM orders
        UNION ALL SELECT 'unique:l_orderkey,l_linenumber', count(*) - count(DISTINCT l_orderkey * 100 + l_linenumber) FROM lineitem
        UNION ALL SELECT 'reference:ref', count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey * 2)
        UNION ALL SELECT 'not_null:props', count(*) FROM events WHERE props IS NULL
        UNION ALL SELECT 'allowed:event_type', count(*) FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')
        UNION ALL SELECT 'max_length:event_type', count(*) FROM events WHERE length(event_type) > 6
        UNION ALL SELECT 'within:value', count(*) FROM events WHERE value < 0 OR value > 100
        UNION ALL SELECT 'ordered:o_orderdate<l_shipdate', count(*) FROM li WHERE o_orderdate >= l_shipdate
        UNION ALL SELECT 'expire_limit', count(*) FROM li WHERE l_shipdate > o_orderdate + INTERVAL 7 DAYS
        UNION ALL SELECT 'price_cap', count(*) FROM li WHERE l_extendedprice > 100000""",
    "cdc_diff": _DIFF + "SELECT action, record_id, klient, status, summa, _row_index AS row_index, h AS row_hash FROM diff",
    "existing_state": q.with_fixtures("orders_stored") + f"""
        SELECT klient AS pk, arg_max({_HASH}, _row_index) AS old_hash FROM orders_stored WHERE status <> 'P' GROUP BY klient""",
    "cdc_stats": _DIFF + f"SELECT {_COUNTS} FROM diff",
    "cdc_load": _DIFF.replace("WITH ", "WITH same AS (SELECT 'same' AS step, 0 AS inserted, 0 AS updated, 0 AS deleted, false AS rewritten),", 1) + f"""
        SELECT step, s.inserted, s.updated, s.deleted, (SELECT count(*) FROM orders_stored) AS unchanged, rewritten,
          (SELECT count(*) FROM diff WHERE action <> 'DELETE') AS rows_after FROM same s
        UNION ALL SELECT 'next', {_COUNTS.replace(' AS unchanged', '')}, true, count(*) FILTER (action <> 'DELETE') FROM diff""",
    "cdc_buckets": _DIFF + f"""
        SELECT 'one' AS step, {_BUCKET} AS bucket, count(*) AS rows, bool_or(record_id = (SELECT min(record_id) FROM stored)) AS rewritten
        FROM stored GROUP BY {_BUCKET}
        UNION ALL SELECT 'next', bucket, rows, bucket IN (SELECT {_BUCKET} FROM changed) FROM (
          SELECT {_BUCKET} AS bucket, count(*) AS rows FROM diff WHERE action <> 'DELETE' GROUP BY {_BUCKET})""".replace("FROM changed", _CHANGED),
    "cdc_by_content": q.with_fixtures("orders_stored", "orders_sheet", more=f"""
        stored AS (SELECT DISTINCT {_HASH} AS h FROM orders_stored),
        sheet AS (SELECT record_id, klient, status, {q.numeric_text('summa')} AS summa FROM orders_sheet),
        hashed AS (SELECT {_HASH} AS h, count(*) AS n FROM sheet GROUP BY ALL)""") + """
        SELECT CAST(sum(CASE WHEN t.h IS NULL THEN n ELSE n - 1 END) FILTER (s.h IS NOT NULL) AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated,
          count(*) FILTER (s.h IS NULL) AS deleted, count(*) FILTER (s.h IS NOT NULL AND t.h IS NOT NULL) AS unchanged
        FROM hashed s FULL JOIN stored t ON s.h = t.h""",
    "cdc_apply": _DIFF + """
        SELECT t.record_id, CASE WHEN u.record_id IS NULL THEN t.klient ELSE u.klient END AS klient,
          CASE WHEN u.record_id IS NULL THEN t.status ELSE u.status END AS status, CASE WHEN u.record_id IS NULL THEN t.summa ELSE u.summa END AS summa,
          t._row_index AS row_index, CASE WHEN u.record_id IS NULL THEN t.h ELSE u.h END AS row_hash, '2024-01-01 00:00:00' AS loaded_at
        FROM stored t LEFT JOIN (SELECT * FROM diff WHERE action = 'UPDATE') u ON u.record_id = t.record_id
        WHERE t.record_id NOT IN (SELECT record_id FROM diff WHERE action = 'DELETE')
        UNION ALL SELECT record_id, klient, status, summa, _row_index, h, '2024-02-02 00:00:00' FROM diff WHERE action = 'INSERT'""",
    "cdc_duplicates": q.with_fixtures("orders_stored", "orders_sheet", more=f"""
        stored AS (SELECT klient, arg_max({q.row_hash('klient', 'summa')}, _row_index) AS h FROM orders_stored GROUP BY klient),
        sheet AS (SELECT klient, {q.numeric_text('summa')} AS summa, _row_index FROM orders_sheet),
        ranked AS (SELECT *, {q.row_hash('klient', 'summa')} AS h, row_number() OVER (PARTITION BY klient ORDER BY _row_index) AS rn FROM sheet),
        diff AS (SELECT CASE WHEN t.klient IS NULL OR rn > 1 THEN 'INSERT' WHEN t.h = s.h THEN 'UNCHANGED' ELSE 'UPDATE' END AS action, s.klient, _row_index
          FROM ranked s LEFT JOIN stored t USING (klient)
          UNION ALL SELECT 'DELETE', klient, NULL FROM stored WHERE klient NOT IN (SELECT klient FROM sheet))""") + """
        SELECT action, count(*) AS rows, CAST(sum(_row_index) AS BIGINT) AS index_sum, count(DISTINCT klient) AS keys FROM diff GROUP BY action""",
    "dedupe_first": """SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, value FROM events ORDER BY user_id, event_type, ts, event_id""",
    "cell_losses": q.with_fixtures(*SHEETS) + " UNION ALL ".join(
        f"SELECT '{sheet}' AS sheet, '{c}' AS column_name, count(*) FILTER (trim({c}) <> '' AND {read(c)} IS NULL) AS lost_cells FROM {sheet}" for sheet, c, read in _TYPED),
    "conform_losses": q.with_fixtures("sales_hst") + """
        SELECT 'date' AS column_name, count(*) FILTER (NOT regexp_matches(date, '^[0-9]{4}-')) AS lost_cells FROM sales_hst
        UNION ALL SELECT 'quantity', count(*) FILTER (quantity = 'три') FROM sales_hst
        UNION ALL SELECT 'full_price', count(*) FROM sales_hst UNION ALL SELECT 'final_price', 0""",
    "upsert_clients": q.with_fixtures("clients_cur", "clients_hst", more=f"{CLIENT_CTES},\n{_OLD_CLIENTS},\n{_MERGED_CLIENTS}") + "SELECT * FROM merged",
    "upsert_sales": q.with_fixtures("clients_cur", "clients_hst", "sales_cur", "sales_hst", more=f"{CLIENT_CTES},\n{sales_ctes()}") + f"""
        SELECT legacy_id, {q.ts('date')} AS date, client_id, product_name, type, category, quantity, {_MONIES}, comment, admin, trainer, {_TRACK(AS_OF_SALES)}
        FROM s_new""",
    "upsert_schedule": q.with_fixtures("clients_cur", "clients_hst", "trainings_cur", "trainings_hst", "employees", more=f"{CLIENT_CTES},\n{schedule_ctes()}") + f"""
        SELECT legacy_id, {q.day('date')} AS date, start_time, end_time, client_id, employee_id, status, type, category, comment, {_TRACK(AS_OF_EVENTS)}
        FROM t_new""",
    "soft_delete": _soft(_GONE_BY_SOURCE, "'active'"),
    "soft_delete_any_source": _soft(_GONE_ANY, "CASE WHEN g THEN 'deleted' ELSE 'active' END"),
    "soft_delete_absent": _SOFT + """SELECT source, count(*) FILTER (source = 'sales_cur' AND coalesce(NOT is_deleted AND row_hash IS NOT NULL
        AND row_hash NOT IN (SELECT h FROM hashed), false)) AS deleted FROM core GROUP BY source""",
    "soft_delete_counts": _SOFT + f"SELECT source, count(*) FILTER (coalesce({_GONE_BY_SOURCE}, false)) AS deleted FROM core GROUP BY source",
    "soft_delete_untouched": _SOFT + f""",
        numbered AS (SELECT record_id, klient, status, {q.numeric_text('summa')} AS summa, _row_index FROM orders_sheet),
        merged AS (SELECT DISTINCT ON (record_id) record_id, {_HASH} AS h FROM numbered WHERE coalesce(record_id, '') <> '' AND status <> 'P'
          ORDER BY record_id, _row_index)
        SELECT coalesce(legacy_id, record_id) AS legacy_id, CASE WHEN record_id IS NULL THEN row_hash ELSE h END AS row_hash,
          CASE WHEN record_id IS NULL THEN source ELSE 'sales_cur' END AS source, record_id IS NULL AND (is_deleted OR g) AS is_deleted,
          CASE WHEN record_id IS NULL AND g THEN '{AS_OF_SALES}' END AS deleted_at, CASE WHEN record_id IS NULL AND g THEN 'deleted' ELSE 'active' END AS status
        FROM (SELECT *, coalesce({_GONE_BY_SOURCE}, false) AS g FROM core) FULL JOIN merged ON legacy_id = record_id""",
    "undelete": q.with_fixtures("clients_cur", "clients_hst", more=f"{CLIENT_CTES},\n{_OLD_CLIENTS},\n{_MERGED_CLIENTS}") + f"""
        SELECT legacy_id, name, status, balance, deleted_at, created_at, updated_at FROM merged WHERE created_at < '{AS_OF_SALES}' AND NOT is_deleted""",
    "distinct_employees": q.with_fixtures("trainings_cur", "trainings_hst") + """
        SELECT sotrudnik AS full_name FROM trainings_cur WHERE trim(sotrudnik) <> '' UNION SELECT employee FROM trainings_hst WHERE trim(employee) <> ''""",
    "insert_absent": q.with_fixtures("trainings_cur", "trainings_hst", "employees") + """
        SELECT full_name FROM (SELECT sotrudnik AS full_name FROM trainings_cur UNION SELECT employee FROM trainings_hst)
        WHERE trim(full_name) <> '' AND full_name NOT IN (SELECT full_name FROM employees)""",
    "seed_lookup": q.with_fixtures("employees") + """
        SELECT CASE WHEN role = 'admin' THEN 'Система' ELSE full_name END AS full_name, CAST(NULL AS VARCHAR) AS role, CAST(NULL AS VARCHAR) AS aliases FROM employees
        UNION ALL SELECT * FROM (VALUES ('Система', 'admin', 'System,скрипт'), ('Администратор', 'admin', 'Админ,Admin')) v
        WHERE col0 NOT IN (SELECT CASE WHEN role = 'admin' THEN 'Система' ELSE full_name END FROM employees)""",
}
