"""Messy sheets derived from the given tables.

The derivations are plain SQL that Spark and DuckDB both run, `{name}` standing for a given
table, so operator and oracle start from the same rows.  Each one covers its whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# tables whose cells are cleaned in volume
CLEANED = ("orders", "lineitem", "events", "documents")

AS_OF_SALES = "2001-08-01 00:00:00"
AS_OF_EVENTS = "2024-01-31 12:00:00"


def dmy(c: str, sep: str = ".") -> str:
    return f"lpad(CAST(day({c}) AS STRING), 2, '0') || '{sep}' || lpad(CAST(month({c}) AS STRING), 2, '0') || '{sep}' || CAST(year({c}) AS STRING)"


def dm_(c: str) -> str:
    return f"lpad(CAST(day({c}) AS STRING), 2, '0') || '.' || lpad(CAST(month({c}) AS STRING), 2, '0') || '.'"


def dmyy(c: str) -> str:
    return f"{dm_(c)} || substr(CAST(year({c}) AS STRING), 3, 2)"


def iso(c: str) -> str:
    return f"CAST(year({c}) AS STRING) || '-' || lpad(CAST(month({c}) AS STRING), 2, '0') || '-' || lpad(CAST(day({c}) AS STRING), 2, '0')"


def cents(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS STRING)"


def person(c: str) -> str:
    return f"'Customer#' || lpad(CAST({c} AS STRING), 9, '0')"


def worker(c: str) -> str:
    return f"'Supplier#' || lpad(CAST({c} AS STRING), 9, '0')"


_PHONE = "'+7 (9' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || '0) ' || lpad(CAST(c_custkey AS STRING), 7, '0')"
_D = cents("o_totalprice")

FIXTURES = {
    # text cells of every shape, out of document texts and order amounts
    "text_cells": """
        SELECT doc_id, source, lang,
          CASE n_chars % 9
            WHEN 0 THEN '  ' || text || '  ' WHEN 1 THEN chr(9) || text || chr(160) || chr(10)
            WHEN 2 THEN ' NaN ' WHEN 3 THEN 'None' WHEN 4 THEN '' WHEN 5 THEN CAST(NULL AS STRING)
            WHEN 6 THEN replace(text, ' ', '  ') WHEN 7 THEN ' null' ELSE text END AS cell
        FROM {documents}""",
    "number_cells": f"""
        SELECT o_orderkey, o_orderpriority,
          CASE o_orderpriority
            WHEN '1-URGENT' THEN substr({_D}, 1, length({_D}) - 6) || chr(160) || replace(substr({_D}, length({_D}) - 5), '.', ',') || ' руб.'
            WHEN '2-HIGH' THEN ' ' || replace({_D}, '.', ',') || '$ '
            WHEN '3-MEDIUM' THEN '- ' || {_D}
            WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 'A-' || CAST(o_orderkey AS STRING)
              WHEN 'O' THEN CAST(o_orderkey AS STRING) || ' ШТ' ELSE '1 ' || CAST(o_custkey AS STRING) || ' р.' END
            ELSE CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'nan' ELSE CAST(o_custkey AS STRING) || 'e1' END END AS cell
        FROM {{orders}}""",
    "boolean_cells": """
        SELECT o_orderkey,
          CASE o_orderpriority WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN ' ДА ' WHEN 'O' THEN 'true' ELSE 'v' END
            WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN 'Нет' WHEN 'O' THEN 'FALSE' ELSE '0' END
            WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN 'y' WHEN 'O' THEN '1' ELSE 'Yes' END
            WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 'N' WHEN 'O' THEN 'n' ELSE ' False' END
            ELSE CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'maybe' ELSE CAST(NULL AS STRING) END END AS cell
        FROM {orders}""",
    "serial_cells": f"""
        SELECT o_orderkey,
          CASE o_orderpriority
            WHEN '1-URGENT' THEN CAST(35000 + o_custkey AS STRING) || CASE o_orderstatus WHEN 'F' THEN '.25' WHEN 'O' THEN '' ELSE '.5' END
            WHEN '2-HIGH' THEN ' ' || {dmy('o_orderdate')}
            WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN {dmyy('o_orderdate')}
              WHEN 'O' THEN {iso('o_orderdate')} ELSE {dmy('o_orderdate', '/')} END
            WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN '31.02.2024'
              WHEN 'O' THEN CAST(day(o_orderdate) AS STRING) || '.' || CAST(month(o_orderdate) AS STRING) || '.' || CAST(year(o_orderdate) AS STRING)
              ELSE '1d' END
            ELSE CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'abc' ELSE '15.03' END END AS cell
        FROM {{orders}}""",
    "date_cells": f"""
        SELECT o_orderkey,
          CASE o_orderpriority WHEN '1-URGENT' THEN {dmy('o_orderdate')} WHEN '2-HIGH' THEN 'пн ' || {dmyy('o_orderdate')}
            WHEN '3-MEDIUM' THEN {dm_('o_orderdate')}
            WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN {iso('o_orderdate')} WHEN 'O' THEN '31.02.1999' ELSE 'ср. ' || {dmy('o_orderdate')} END
            ELSE CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN CAST(NULL AS STRING) ELSE {dm_('o_orderdate')} || '75' END END AS cell
        FROM {{orders}}""",
    "time_cells": """
        SELECT event_id,
          CASE event_type WHEN 'view' THEN CAST(hour(ts) AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')
            WHEN 'click' THEN ' ' || lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') || ':30'
            WHEN 'signup' THEN CAST(hour(ts) + 10 AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')
            WHEN 'error' THEN 'утро' ELSE '' END AS cell
        FROM {events}""",
    # staged sheets (text columns and the row number in the sheet)
    "clients_cur": f"""
        SELECT CAST(c_custkey AS STRING) AS record_id,
          CASE WHEN c_nationkey = 3 THEN '  ' WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN c_name || ' ' ELSE c_name END AS klient,
          CASE WHEN c_nationkey = 5 THEN '' WHEN c_nationkey = 6 THEN CAST(NULL AS STRING) ELSE {_PHONE} END AS mobilnyy,
          CASE WHEN c_acctbal < 0 THEN '   ' ELSE 'Ребёнок "' || c_mktsegment || '" ' || chr(92) || ' ' || CAST(c_nationkey AS STRING) END AS imya_rebenka,
          CASE WHEN c_nationkey = 7 THEN '01.02.15' WHEN c_nationkey = 8 THEN CAST(NULL AS STRING)
            ELSE lpad(CAST(1 + c_custkey % 31 AS STRING), 2, '0') || '.' || lpad(CAST(1 + c_nationkey % 12 AS STRING), 2, '0') || '.' || CAST(2005 + c_custkey % 15 AS STRING) END AS data_rozhdeniya_rebenka,
          c_mktsegment AS tip, CAST(c_custkey + 2 AS BIGINT) AS _row_index
        FROM {{customer}}""",
    "clients_hst": f"""
        SELECT CAST(c_custkey AS STRING) AS record_id,
          CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(NULL AS STRING) ELSE c_name END AS client_full,
          CASE WHEN c_mktsegment = 'MACHINERY' THEN '8' || lpad(CAST(c_custkey AS STRING), 10, '0') WHEN c_nationkey = 6 THEN CAST(NULL AS STRING) ELSE {_PHONE} END AS phone_mobile,
          'H ' || CAST(c_nationkey AS STRING) AS child_name,
          lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || '.0' || CAST(1 + c_nationkey % 9 AS STRING) || '.' || CAST(2000 + c_custkey % 10 AS STRING) AS child_birth_date,
          'архив' AS product_type, CAST(c_custkey + 2 AS BIGINT) AS _row_index
        FROM {{customer}}""",
    "sales_cur": f"""
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS record_id,
          CASE WHEN l_returnflag = 'N' AND l_tax = 0 THEN 'n/a' WHEN l_linestatus = 'O' THEN {dmy('o_orderdate')} ELSE {dmyy('o_orderdate')} END AS data,
          {person('o_custkey')} AS klient,
          CASE l_linenumber WHEN 1 THEN 'Абонемент 8 занятий' WHEN 2 THEN 'Абонемент 4 занятия' WHEN 3 THEN 'Абонемент 12 занятий'
            WHEN 4 THEN 'Абонемент 16 занятий' WHEN 5 THEN ' Разовое занятие ' WHEN 6 THEN '  ' ELSE 'Пробное занятие' END AS produkt,
          l_returnflag AS tip, CASE WHEN l_linestatus = 'O' THEN ' ' ELSE 'дети' END AS kategoriya,
          CASE WHEN l_quantity > 45 THEN '' WHEN l_quantity > 40 THEN '1.5' ELSE ' ' || CAST(CAST(l_quantity AS INT) AS STRING) END AS kolichestvo,
          replace({cents('l_extendedprice')}, '.', ',') || ' руб.' AS polnaya_stoimost,
          CASE WHEN l_discount = 0 THEN '-' ELSE {cents('l_discount')} END AS skidka,
          {cents('l_extendedprice')} AS okonchatelnaya_stoimost,
          CASE WHEN l_returnflag = 'A' THEN {cents('l_extendedprice')} ELSE '' END AS nalichnye,
          CASE WHEN l_returnflag = 'R' THEN {cents('l_extendedprice')} ELSE CAST(NULL AS STRING) END AS perevod,
          CASE WHEN l_returnflag = 'N' THEN {cents('l_extendedprice')} ELSE 'нет' END AS terminal,
          '0' AS vdolg, CASE WHEN l_linenumber = 7 THEN 'подарок' ELSE '' END AS kommentariy,
          {worker('l_suppkey')} AS admin, CASE WHEN l_tax > 0.05 THEN {worker('l_suppkey')} ELSE CAST(NULL AS STRING) END AS trener,
          CAST(l_orderkey * 8 + l_linenumber + 2 AS BIGINT) AS _row_index
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "sales_hst": f"""
        SELECT CAST(o_orderkey AS STRING) AS record_id,
          CASE o_orderstatus WHEN 'F' THEN {dmy('o_orderdate')} WHEN 'O' THEN {dmyy('o_orderdate')} ELSE {iso('o_orderdate')} END AS date,
          {person('o_custkey')} AS client_full,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Абонемент 8 занятий' WHEN '2-HIGH' THEN 'Абонемент 12 занятий' WHEN '3-MEDIUM' THEN 'Разовое занятие'
            WHEN '4-NOT SPECIFIED' THEN 'Пробное занятие' ELSE '' END AS product,
          o_orderpriority AS product_type, o_orderstatus AS product_category,
          CASE o_orderstatus WHEN 'F' THEN '2' WHEN 'O' THEN '' ELSE 'три' END AS quantity,
          replace({_D}, '.', ',') || ' р.' AS full_price, {_D} AS final_price, CAST(o_orderkey + 2 AS BIGINT) AS _row_index
        FROM {{orders}}""",
    "trainings_cur": f"""
        SELECT CAST(event_id AS STRING) AS record_id,
          CASE event_type WHEN 'signup' THEN {dmyy('ts')} WHEN 'purchase' THEN {dmy('ts')} ELSE {dm_('ts')} END AS data,
          CASE WHEN event_type = 'error' THEN '' ELSE CAST(hour(ts) AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') END AS nachalo,
          CAST(hour(ts) + 1 AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') AS konets,
          CASE event_type WHEN 'view' THEN 'Посетили' WHEN 'purchase' THEN ' Посетили ' WHEN 'click' THEN 'Пропуск' WHEN 'signup' THEN ' ' ELSE 'Отмена' END AS status,
          event_type AS tip, '' AS kategoriya, props AS kommentariy,
          {person('user_id')} AS klient, {worker('user_id')} AS sotrudnik, CAST(event_id + 2 AS BIGINT) AS _row_index
        FROM {{events}}""",
    "trainings_hst": f"""
        SELECT CAST(o_orderkey AS STRING) AS record_id, {dmy('o_orderdate')} AS date,
          CASE o_orderpriority WHEN '1-URGENT' THEN '9:15' WHEN '2-HIGH' THEN '18:30' WHEN '3-MEDIUM' THEN '' WHEN '4-NOT SPECIFIED' THEN '25:10' ELSE '07:45:00' END AS start_time,
          CASE o_orderpriority WHEN '1-URGENT' THEN '10:15' WHEN '2-HIGH' THEN '24:00' ELSE CAST(NULL AS STRING) END AS end_time,
          CASE o_orderstatus WHEN 'F' THEN 'Посетили' WHEN 'O' THEN 'Пропуск' ELSE '' END AS status,
          o_orderpriority AS product_type, 'зал' AS product_category, '' AS comment,
          {person('o_custkey')} AS client_full, {worker('o_custkey')} AS employee, CAST(o_orderkey + 2 AS BIGINT) AS _row_index
        FROM {{orders}}""",
    "employees": """
        SELECT CAST(s_suppkey AS STRING) AS id, s_name AS full_name,
          CASE WHEN s_acctbal < 0 THEN 'admin' ELSE 'trainer' END AS role, s_acctbal >= 0 AS is_active
        FROM {supplier}""",
    "products": """
        SELECT CAST(p_partkey AS STRING) AS id, p_name AS name, p_type AS category,
          CAST(p_retailprice AS DECIMAL(18,2)) AS base_price, CAST(1 + p_size % 16 AS INT) AS units_per_item,
          p_size > 10 AS is_active
        FROM {part}""",
    # core tables in their final form, for the marts and views
    "core_clients": f"""
        SELECT md5(c_name) AS legacy_id, CASE WHEN c_nationkey = 3 THEN CAST(NULL AS STRING) ELSE c_name END AS name,
          CASE WHEN c_nationkey < 8 THEN '+70000000000' WHEN c_nationkey = 9 THEN CAST(NULL AS STRING) ELSE {_PHONE} END AS phone,
          c_mktsegment AS status, c_acctbal < -500 AS is_deleted,
          TIMESTAMP '2024-01-01 00:00:00' AS updated_at
        FROM {{customer}}""",
    "core_sales": f"""
        SELECT md5(CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)) AS legacy_id, CAST(o_orderdate AS TIMESTAMP) AS date,
          CASE l_linenumber WHEN 1 THEN 'Абонемент 8 занятий' WHEN 2 THEN 'Абонемент 4 занятия' WHEN 3 THEN 'Абонемент 12 занятий'
            WHEN 4 THEN 'Абонемент 16 занятий' WHEN 5 THEN 'Абонемент 18' ELSE p_name END AS product_name,
          l_returnflag AS type, l_linestatus AS category, CAST(l_quantity AS INT) AS quantity,
          CAST(l_extendedprice AS DECIMAL(18,2)) AS full_price, CAST(l_discount AS DECIMAL(18,2)) AS discount,
          CAST(l_extendedprice AS DECIMAL(18,2)) AS final_price,
          CAST(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS cash,
          CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS transfer,
          CAST(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS terminal,
          CAST(0 AS DECIMAL(18,2)) AS debt, CAST(NULL AS STRING) AS comment, md5({person('o_custkey')}) AS client_id,
          CASE WHEN l_tax > 0.06 THEN {worker('l_suppkey')} ELSE CAST(NULL AS STRING) END AS admin,
          CASE WHEN l_tax < 0.02 THEN {worker('l_suppkey')} ELSE CAST(NULL AS STRING) END AS trainer,
          l_returnflag = 'R' AND l_linestatus = 'F' AS is_deleted
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    "core_schedule": f"""
        SELECT md5(CAST(event_id AS STRING)) AS legacy_id, CAST(ts AS DATE) AS date,
          lpad(CAST(hour(ts) AS STRING), 2, '0') || ':00:00' AS start_time, lpad(CAST(hour(ts) AS STRING), 2, '0') || ':30:00' AS end_time,
          CASE event_type WHEN 'view' THEN 'Посетили' WHEN 'purchase' THEN 'Посетили' WHEN 'click' THEN 'Пропуск' WHEN 'signup' THEN 'Свободно' ELSE 'Отмена' END AS status,
          event_type AS type, CAST(NULL AS STRING) AS category, props AS comment, md5({person('user_id')}) AS client_id,
          CAST(user_id AS STRING) AS employee_id, value > 200 AS is_deleted
        FROM {{events}}""",
    "messenger_users": """
        SELECT s_suppkey AS id, CASE WHEN s_nationkey = 1 THEN CAST(NULL AS STRING) ELSE lower(s_name) END AS username,
          CASE WHEN s_nationkey = 2 THEN CAST(NULL AS STRING) WHEN s_nationkey = 3 THEN '123' WHEN s_nationkey = 4 THEN '7000 000 00 00'
            ELSE '79' || lpad(CAST(s_suppkey % 100 AS STRING), 2, '0') || '0' || lpad(CAST(s_suppkey AS STRING), 7, '0') END AS phone,
          TIMESTAMP '2024-01-02 00:00:00' AS updated_at
        FROM {supplier}""",
    "messages": "SELECT conv_id AS chat_id, turn AS telegram_id, text FROM {conversations}",
    # ledgers
    "runs": """
        SELECT CAST(event_id AS STRING) AS run_id, CAST(ts AS TIMESTAMP) AS started_at, CAST(ts AS TIMESTAMP) AS finished_at,
          CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS status,
          CASE WHEN event_type = 'view' THEN 'full_refresh' ELSE 'cdc' END AS mode,
          CAST(user_id % 9 AS INT) AS tables_processed, CAST(user_id * 3 AS BIGINT) AS total_rows_synced,
          CAST(user_id % 5 AS BIGINT) AS validation_errors,
          CASE WHEN event_type = 'signup' THEN CAST(NULL AS DECIMAL(10,2)) ELSE CAST(value AS DECIMAL(10,2)) END AS duration_seconds,
          CASE WHEN event_type = 'error' THEN props ELSE CAST(NULL AS STRING) END AS error_message
        FROM {events}""",
    "table_stats": """
        SELECT CAST(event_id AS STRING) AS run_id,
          CASE event_type WHEN 'view' THEN 'stg_gsheets.sales_cur' WHEN 'click' THEN 'stg_gsheets.sales_hst' WHEN 'signup' THEN 'stg_gsheets.trainings_cur'
            WHEN 'error' THEN 'clients_cur' ELSE 'stg_gsheets.price_reference' END AS table_name,
          CAST(floor(value * 100) AS BIGINT) AS rows_extracted, CAST(user_id AS BIGINT) AS rows_inserted, CAST(user_id % 7 AS BIGINT) AS rows_updated,
          CAST(user_id % 3 AS BIGINT) AS rows_deleted, CAST(user_id % 4 AS BIGINT) AS validation_errors,
          CAST(floor(value * 10) AS BIGINT) AS duration_ms, CAST(ts AS TIMESTAMP) AS created_at
        FROM {events}""",
    # snapshots of one table: what is stored, and the sheet as it is now
    "orders_stored": f"""
        SELECT CAST(o_orderkey AS STRING) AS record_id, {person('o_custkey')} AS klient,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'старый ' || o_orderstatus ELSE o_orderstatus END AS status,
          {_D} AS summa, CAST(o_orderkey + 2 AS BIGINT) AS _row_index
        FROM {{orders}} WHERE o_orderpriority <> '5-LOW'""",
    "orders_sheet": f"""
        SELECT CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN ' ' ELSE CAST(o_orderkey AS STRING) END AS record_id,
          {person('o_custkey')} AS klient, o_orderstatus AS status, replace({_D}, '.', ',') AS summa, CAST(o_orderkey + 2 AS BIGINT) AS _row_index
        FROM {{orders}} WHERE o_orderpriority <> '2-HIGH'
        UNION ALL
        SELECT CAST(o_orderkey AS STRING), {person('o_custkey')}, 'повтор', {_D}, CAST(o_orderkey + 1000000000 AS BIGINT)
        FROM {{orders}} WHERE o_orderstatus = 'F' AND o_orderpriority <> '2-HIGH'""",
    # a sheet with errors of every kind
    "sales_checked": f"""
        SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS row_index,
          CASE WHEN l_linenumber = 7 THEN CASE WHEN l_linestatus = 'O' THEN ' ' ELSE CAST(NULL AS STRING) END
            WHEN l_tax = 0.08 THEN '2025/12/01' WHEN l_tax = 0.07 THEN 'пн ' || {dmyy('l_shipdate')} WHEN l_tax = 0.06 THEN {iso('l_shipdate')} ELSE {dmy('l_shipdate')} END AS date,
          CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN '' WHEN l_discount = 0.1 THEN CAST(NULL AS STRING) ELSE {worker('l_suppkey')} END AS client_full,
          CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN CAST(NULL AS STRING) WHEN l_discount = 0.09 THEN '  ' ELSE 'P' || CAST(l_partkey AS STRING) END AS product,
          l_returnflag AS product_type, l_linestatus AS product_category,
          CASE WHEN l_quantity > 45 THEN 'пять' WHEN l_quantity > 40 THEN '' WHEN l_quantity > 35 THEN '5.00' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
          CASE WHEN l_returnflag = 'N' AND l_tax = 0 THEN 'дорого' WHEN l_returnflag = 'N' THEN '1,2,3' ELSE replace({cents('l_extendedprice')}, '.', ',') || ' руб' END AS full_price,
          {cents('l_extendedprice')} AS final_price
        FROM {{lineitem}}""",
    "schedule_checked": f"""
        SELECT event_id AS row_index,
          CASE event_type WHEN 'view' THEN {dm_('ts')} WHEN 'click' THEN {dmy('ts')} WHEN 'signup' THEN 'Пн ' || {dmyy('ts')} WHEN 'error' THEN {iso('ts')} ELSE '' END AS date,
          CASE event_type WHEN 'error' THEN 'утро' ELSE CAST(hour(ts) AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') END AS start_time,
          CASE event_type WHEN 'purchase' THEN CAST(NULL AS STRING) ELSE '12:00:00' END AS end_time,
          {worker('user_id')} AS employee, {person('user_id')} AS client_full,
          CASE event_type WHEN 'signup' THEN ' ' ELSE event_type END AS status,
          '' AS product_type, '' AS product_category, props AS comment
        FROM {{events}}""",
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores, in turn: the given tables are single files of one split.

    Of use to the timings only; real inputs come in as many splits as they have.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def cells(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose cells are to be cleaned: dealt out to all cores if it is small."""
    return spread(table(spark, sf_dir, name))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = FIXTURES[name]
    used = set(re.findall(r"\{(\w+)\}", sql))
    inputs = {t: table(spark, sf_dir, t) for t in used}
    # a large table that is joined goes to all cores by its key: to deal it out before would be one more shuffle
    small = {t for t, df in inputs.items() if len(used) == 1 or df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism}
    return spark.sql(sql, **{t: spread(df) if t in CLEANED and t in small else df for t, df in inputs.items()})


def fixture_sql(name: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", FIXTURES[name])
