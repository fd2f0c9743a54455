"""Marts, customer identity, API views."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness import sqltext as q
from harness import sync
from harness.clean import as_of, flat
from harness.fixtures import AS_OF_EVENTS, AS_OF_SALES, fixture, table
from rowloom import fixed_values as fv
from rowloom.operators import ledger
from rowloom.plans import marts
from rowloom.sources.shared import shared_folder
from rowloom.sources.sinks import export_mart, mart_cells

NOW = "2024-02-01 08:30:00"


def client_balances(spark, sf):
    """The flagship: raw sheets -> core tables -> balance per client."""
    clients = sync.new_clients(spark, sf)
    sales = sync.core_sales(spark, sf, clients)
    schedule = sync.core_schedule(spark, sf, clients)
    return flat(marts.client_balances(clients, marts.client_purchases(sales), marts.client_usage(schedule), as_of(NOW)))


def _core(spark, sf):
    return tuple(fixture(spark, sf, n) for n in ("core_clients", "core_sales", "core_schedule"))


def _balances(spark, sf):
    clients, sales, schedule = _core(spark, sf)
    return marts.client_balances(clients, marts.client_purchases(sales), marts.client_usage(schedule), as_of(NOW))


def core_balances(spark, sf):
    return flat(_balances(spark, sf))


def client_purchases(spark, sf):
    return flat(marts.client_purchases(fixture(spark, sf, "core_sales")))


def client_usage(spark, sf):
    return marts.client_usage(fixture(spark, sf, "core_schedule"))


def balances_lookup(spark, sf):
    """Balances with the units of the product table instead of the product's name."""
    clients, sales, schedule = _core(spark, sf)
    bought = marts.purchases_by_lookup(sales, fixture(spark, sf, "products"))
    return flat(marts.client_balances(clients, bought, marts.client_usage(schedule), as_of(NOW)))


def balance_outliers(spark, sf):
    return flat(marts.balance_outliers(_balances(spark, sf), low=200, high=1500))


def mart_preview(spark, sf):
    """The first rows of the mart."""
    return flat(_balances(spark, sf).limit(5))


def _identities(spark, sf):
    return fixture(spark, sf, "messenger_users"), fixture(spark, sf, "core_clients")


def unified_customers(spark, sf):
    return flat(marts.unified_customers(*_identities(spark, sf)))


def unified_customers_known(spark, sf):
    """The placeholder phone taken for none."""
    return flat(marts.unified_customers(*_identities(spark, sf), skip_placeholder=True))


def phone_classes(spark, sf):
    return marts.phone_classes(*_identities(spark, sf))


def phone_members(spark, sf):
    return marts.phone_members(*_identities(spark, sf))


def latest_message(spark, sf):
    return marts.latest_messages(fixture(spark, sf, "messages"))


def api_sales(spark, sf):
    return flat(marts.api_sales(fixture(spark, sf, "core_sales"), as_of(AS_OF_SALES)))


def api_schedule(spark, sf):
    return flat(marts.api_schedule(fixture(spark, sf, "core_schedule"), as_of(AS_OF_EVENTS), days=10))


def api_clients(spark, sf):
    return flat(marts.api_clients(fixture(spark, sf, "core_clients")))


def api_lookups(spark, sf):
    """Active employees and active products."""
    people = marts.api_active(fixture(spark, sf, "employees")).select(F.lit("employee").alias("kind"), "id", F.col("full_name").alias("name"))
    goods = marts.api_active(fixture(spark, sf, "products")).select(F.lit("product").alias("kind"), "id", "name")
    return people.unionByName(goods)


def api_auth_events(spark, sf):
    return flat(marts.api_auth_events(table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")))


def api_status(spark, sf):
    return flat(ledger.recent_runs(fixture(spark, sf, "runs")))


def export(spark, sf):
    """The balance mart written as a sheet and read back: all cells are text."""
    path = f"{shared_folder(spark)}/mart"
    export_mart(_balances(spark, sf), path)
    return spark.read.option("header", True).csv(path).na.fill("")


def export_cells(spark, sf):
    """Export cells of the client table: times as dd.MM.yyyy HH:mm, missing texts empty."""
    return mart_cells(fixture(spark, sf, "core_clients"))


QUERIES = {
    f.__name__: f
    for f in (client_balances, core_balances, client_purchases, client_usage, balances_lookup, balance_outliers, mart_preview,
              unified_customers, unified_customers_known, phone_classes, phone_members, latest_message, api_sales, api_schedule, api_clients, api_lookups, api_auth_events, api_status)
} | {"export_mart": export, "export_cells": export_cells}

_UNITS = "CASE " + " ".join(f"WHEN contains(product_name, '{n}') THEN {n}" for n in fv.UNIT_MARKS) + " ELSE 1 END"
_USED = q.words(fv.USED_STATUSES)


def _mart(clients, sales, schedule, units=_UNITS):
    """Sales and visits as one list of movements per client, summed up once."""
    names = fv.BALANCE_COLUMNS
    return f"""
      movements AS (
        SELECT client_id, {units} * quantity AS plus, 0 AS minus, final_price AS money FROM {sales} WHERE NOT is_deleted
        UNION ALL SELECT client_id, 0, 1, 0 FROM {schedule} WHERE NOT is_deleted AND status IN ({_USED})),
      summed AS (
        SELECT client_id, sum(plus)::BIGINT AS plus, sum(minus)::BIGINT AS minus, sum(money) AS money FROM movements
        GROUP BY client_id HAVING sum(plus) > 0 OR sum(minus) > 0),
      mart AS (
        SELECT legacy_id, name AS "{names['name']}", phone AS "{names['phone']}", plus AS "{names['bought']}", minus AS "{names['used']}",
          plus - minus AS "{names['left']}", money::DOUBLE AS "{names['paid']}", status AS "{names['status']}", '{NOW}' AS "{names['updated']}"
        FROM summed JOIN {clients} c ON c.legacy_id = client_id AND NOT c.is_deleted)"""


_CORE = q.with_fixtures("core_clients", "core_sales", "core_schedule", more=_mart("core_clients", "core_sales", "core_schedule"))
_COLS = ", ".join(f'"{c}"' for c in fv.BALANCE_COLUMNS.values())
_SALES_COLS = ("product_name", "type", "category", "quantity", "comment", "client_id", "admin", "trainer")
_SALES_MONEY = ("full_price", "discount", "final_price", "cash", "transfer", "terminal", "debt")

_DIGITS = r"regexp_replace({}, '\D', '', 'g')"


def _unified(more: str = "true") -> str:
    """The identity view as one full join; `more` says which phones of users count."""
    return q.with_fixtures("messenger_users", "core_clients", more=f"""
        j AS (SELECT t.*, c.legacy_id, c.name, c.phone AS crm_phone, c.updated_at AS crm_updated,
          sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('tg:' || CAST(t.id AS VARCHAR))) AS h
        FROM messenger_users t FULL JOIN core_clients c
          ON {_DIGITS.format('t.phone')} = {_DIGITS.format('c.phone')} AND length(t.phone) > 5 AND {more})""") + f"""
        SELECT coalesce(legacy_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
            substr('89ab', 1 + (position(substr(h, 17, 1) IN '0123456789abcdef') - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)) AS id,
          name AS crm_name, crm_phone, username AS tg_username, phone AS tg_phone, id AS tg_user_id,
          CASE WHEN legacy_id IS NOT NULL THEN 'client' WHEN phone IS NOT NULL THEN 'warm_lead' ELSE 'guest' END AS lifecycle_stage,
          {q.ts('coalesce(crm_updated, updated_at)')} AS last_activity FROM j"""


ORACLE = {
    "client_balances": q.with_fixtures(
        "clients_cur", "clients_hst", "sales_cur", "sales_hst", "trainings_cur", "trainings_hst", "employees",
        more=f"{sync.CLIENT_CTES},\n{sync.sales_ctes()},\n{sync.schedule_ctes()},\n"
        "c AS (SELECT *, false AS is_deleted FROM c_new), s AS (SELECT *, false AS is_deleted FROM s_new), t AS (SELECT *, false AS is_deleted FROM t_new),"
        + _mart("c", "s", "t")) + f"SELECT {_COLS} FROM mart",
    "core_balances": _CORE + f"SELECT {_COLS} FROM mart",
    "client_purchases": q.with_fixtures("core_sales") + f"""
        SELECT client_id, CAST(sum({_UNITS} * quantity) AS BIGINT) AS units_bought, CAST(sum(final_price) AS DOUBLE) AS total_spent
        FROM core_sales WHERE NOT is_deleted GROUP BY client_id""",
    "client_usage": q.with_fixtures("core_schedule") + f"""
        SELECT client_id, count(*) AS units_used FROM core_schedule WHERE NOT is_deleted AND status IN ({_USED}) GROUP BY client_id""",
    "balances_lookup": q.with_fixtures("core_clients", "core_sales", "core_schedule", "products", more=
        """units AS (SELECT name, max(units_per_item) AS units FROM products GROUP BY name),
        sold AS (SELECT s.*, units FROM core_sales s LEFT JOIN units ON units.name = product_name),"""
        + _mart("core_clients", "sold", "core_schedule", units="coalesce(units, 1)")) + f"SELECT {_COLS} FROM mart",
    "balance_outliers": _CORE + f'SELECT {_COLS} FROM mart WHERE "Остаток" < 200 OR "Остаток" > 1500',
    "mart_preview": _CORE + f'SELECT {_COLS} FROM mart ORDER BY "Остаток", "Клиент" NULLS LAST, legacy_id LIMIT 5',
    "unified_customers": _unified(),
    "unified_customers_known": _unified(f"{_DIGITS.format('t.phone')} <> '70000000000'"),
    "phone_classes": q.with_fixtures("messenger_users", "core_clients") + f"""
        SELECT phone, count(*) FILTER (user) AS users, count(*) FILTER (NOT user) AS clients, count(*) FILTER (user) * count(*) FILTER (NOT user) AS pairs
        FROM (SELECT {_DIGITS.format('phone')} AS phone, true AS user FROM messenger_users WHERE length(phone) > 5
          UNION ALL SELECT {_DIGITS.format('phone')}, false FROM core_clients WHERE phone IS NOT NULL) GROUP BY phone""",
    "phone_members": q.with_fixtures("messenger_users", "core_clients") + f"""
        SELECT {_DIGITS.format('phone')} AS phone, 'user' AS side, CAST(id AS VARCHAR) AS id FROM messenger_users WHERE length(phone) > 5
        UNION ALL SELECT {_DIGITS.format('phone')}, 'client', legacy_id FROM core_clients WHERE phone IS NOT NULL""",
    "latest_message": "SELECT conv_id AS chat_id, max(turn) AS last_message_id FROM conversations GROUP BY conv_id",
    "api_sales": q.with_fixtures("core_sales") + f"""
        SELECT legacy_id AS id, {q.ts('date')} AS date, {', '.join(_SALES_COLS)}, {', '.join(q.dbl(c) + ' AS ' + c for c in _SALES_MONEY)}
        FROM core_sales WHERE NOT is_deleted AND date >= TIMESTAMP '{AS_OF_SALES}' - INTERVAL 90 DAYS""",
    "api_schedule": q.with_fixtures("core_schedule") + f"""
        SELECT legacy_id AS id, {q.day('date')} AS date, start_time, end_time, status, type, category, comment, client_id, employee_id
        FROM core_schedule WHERE NOT is_deleted AND date >= CAST(TIMESTAMP '{AS_OF_EVENTS}' AS DATE) - INTERVAL 10 DAYS""",
    "api_clients": q.with_fixtures("core_clients") + f"""
        SELECT legacy_id, name, phone, status, is_deleted, {q.ts('updated_at')} AS updated_at FROM core_clients WHERE NOT is_deleted""",
    "api_lookups": q.with_fixtures("employees", "products") + """
        SELECT 'employee' AS kind, id, full_name AS name FROM employees WHERE is_active UNION ALL SELECT 'product', id, name FROM products WHERE is_active""",
    "api_auth_events": "SELECT event_id, user_id, event_type, props FROM events",
    "api_status": q.with_fixtures("runs") + f"""
        SELECT run_id, {q.ts('started_at')} AS started_at, {q.ts('finished_at')} AS finished_at, status, mode, tables_processed, total_rows_synced,
          validation_errors, {q.dbl('duration_seconds')} AS duration_seconds, error_message FROM runs ORDER BY runs.started_at DESC, run_id DESC LIMIT 10""",
    "export_mart": _CORE + """
        SELECT coalesce("Клиент", '') AS "Клиент", coalesce("Телефон", '') AS "Телефон", CAST("Куплено" AS VARCHAR) AS "Куплено",
          CAST("Использовано" AS VARCHAR) AS "Использовано", CAST("Остаток" AS VARCHAR) AS "Остаток",
          CAST(CAST("Оплачено" AS DECIMAL(28,2)) AS VARCHAR) AS "Оплачено", "Статус", '01.02.2024 08:30' AS "Дата обновления" FROM mart""",
    "export_cells": q.with_fixtures("core_clients") + """
        SELECT legacy_id, coalesce(name, '') AS name, coalesce(phone, '') AS phone, coalesce(status, '') AS status, is_deleted,
          '01.01.2024 00:00' AS updated_at FROM core_clients""",
}
