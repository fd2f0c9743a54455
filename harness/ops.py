"""Data quality, ledgers, retention, loading and swapping."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from harness import sqltext as q
from harness.clean import as_of, flat
from harness.fixtures import AS_OF_EVENTS, cells, fixture, table
from rowloom import fixed_values as fv
from rowloom.functions.hashing import row_hash
from rowloom.operators import ledger, ledger_days, quality
from rowloom.sources import layout, sinks
from rowloom.sources.shared import materialize, shared_folder
from rowloom.sources.tabular import file_changes, is_modified, last_modified, read_tabular, source_files

_STAGED = ["stg_gsheets.sales_cur", "stg_gsheets.sales_hst", "stg_gsheets.trainings_cur", "stg_gsheets.clients_cur"]


def _docs(spark, sf):
    """Documents as two sources that share texts."""
    d = cells(spark, sf, "documents").select("source", "lang", row_hash(["text"]).alias("__row_hash"))
    e = cells(spark, sf, "events").select(F.col("event_type").alias("lang"), row_hash(["event_type", "user_id"]).alias("__row_hash"))
    return {"sales_cur": d.where("source < 'src5'").select("lang", "__row_hash"),
            "sales_hst": d.where("source >= 'src5'").select("lang", "__row_hash").unionByName(e)}


def dup_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def dup_hashes(spark, sf):
    return quality.duplicate_hash_count(cells(spark, sf, "documents").withColumn("h", row_hash(["text"])), "h")


def cross_source_dups(spark, sf):
    return quality.cross_source_duplicates(_docs(spark, sf), "lang")


def null_counts(spark, sf):
    return quality.null_counts(fixture(spark, sf, "clients_cur"), ["klient", "mobilnyy", "data_rozhdeniya_rebenka"])


def row_counts(spark, sf):
    tables = {t: table(spark, sf, t) for t in ("customer", "orders", "lineitem", "events")}
    return quality.row_counts(tables).withColumn("size_mb", F.round("size_mb", 6))


def last_stats(spark, sf):
    return flat(quality.last_stats(fixture(spark, sf, "table_stats"), _STAGED).select("base", "run_id", "table_name", "rows_extracted", "created_at"))


def _current(spark, sf):
    names = {"stg_gsheets.sales_cur": "orders", "stg_gsheets.sales_hst": "part", "stg_gsheets.trainings_cur": "events", "stg_gsheets.clients_cur": "customer"}
    return quality.row_counts({n: table(spark, sf, t) for n, t in names.items()})


def volume_anomaly(spark, sf):
    out = quality.volume_anomalies(_current(spark, sf), fixture(spark, sf, "table_stats"), _STAGED)
    return out.select("table_name", "rows", "runs", "is_anomaly", *[F.round(c, 6).alias(c) for c in ("avg_rows", "deviation", "threshold")])


def _issues(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("key", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    clients = fixture(spark, sf, "clients_cur")
    volume = quality.volume_anomalies(_current(spark, sf), fixture(spark, sf, "table_stats"), _STAGED)
    return (
        quality.table_issues(li, "stg_gsheets.sales_cur", "key", ["l_shipdate"])
        .unionByName(quality.table_issues(clients, "stg_gsheets.clients_cur", "record_id", ["mobilnyy", "data_rozhdeniya_rebenka", "no_such_column"]))
        .unionByName(quality.volume_issues(volume))
    )


def dq_issues(spark, sf):
    return quality.first_issues(_issues(spark, sf))


def dq_summary(spark, sf):
    return quality.issue_summary(_issues(spark, sf))


def dq_trend(spark, sf):
    return flat(ledger.error_trend(fixture(spark, sf, "table_stats")).withColumn("error_rate", F.round("error_rate", 6)))


def _days(spark, sf):
    """The ledger's state, merged from that of the mornings and that of all other loads."""
    stats = fixture(spark, sf, "table_stats")
    morning = F.coalesce(F.hour("created_at") < 12, F.lit(False))
    parts = [materialize(ledger_days.daily_state(stats.where(part)), "days") for part in (morning, ~morning)]
    return materialize(ledger_days.merge_states(*parts), "days")


def ledger_state(spark, sf):
    newest = F.array_join(F.transform("newest", lambda load: load["run_id"]), ",")
    return flat(_days(spark, sf).select("table_name", "day", "runs", *ledger_days.SUMS, newest.alias("newest")))


def volume_anomaly_state(spark, sf):
    out = quality.volume_anomalies(_current(spark, sf), ledger_days.newest_loads(_days(spark, sf)), _STAGED)
    return out.select("table_name", "rows", "runs", "is_anomaly", *[F.round(c, 6).alias(c) for c in ("avg_rows", "deviation", "threshold")])


def dq_trend_state(spark, sf):
    return flat(ledger.error_trend(ledger_days.by_day(_days(spark, sf))).withColumn("error_rate", F.round("error_rate", 6)))


def run_totals_state(spark, sf):
    return ledger_days.totals(_days(spark, sf)).withColumn("table_name", F.coalesce("table_name", F.lit("ИТОГО")))


def dup_keys_buckets(spark, sf):
    """Customers with several orders, as a table in buckets has them noted after its pending orders have gone."""
    name = f"orders_{uuid.uuid4().hex}"
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    sinks.replace_in_buckets(o, name, "o_custkey", 16, shared_folder(spark))
    pending = o.where("o_orderstatus = 'P'").select("o_custkey")
    sinks.change_buckets(spark, name, pending, lambda part: part.where("o_orderstatus <> 'P'"))
    found = materialize(sinks.repeated_keys(spark, name, "o_custkey"), "repeated")
    sinks.drop_table(spark, name)
    return found


def run_kpis(spark, sf):
    out = ledger.run_kpis(ledger.runs_since(fixture(spark, sf, "runs"), as_of(AS_OF_EVENTS), 20))
    return out.withColumns({c: F.round(c, 6) for c in ("success_rate", "avg_duration")})


def runs_by_day(spark, sf):
    return flat(ledger.runs_by_day(fixture(spark, sf, "runs")))


def runs_window(spark, sf):
    return flat(ledger.runs_since(fixture(spark, sf, "runs"), as_of(AS_OF_EVENTS), 7).select("run_id", "started_at", "status"))


def recent_runs(spark, sf):
    runs = ledger.run_labels(ledger.recent_runs(fixture(spark, sf, "runs"), 30))
    return runs.select("run_id", "started_local", "label", "duration", "status", "mode")


def run_totals(spark, sf):
    out = ledger.run_totals(fixture(spark, sf, "table_stats"))
    return out.withColumn("table_name", F.coalesce("table_name", F.lit("ИТОГО")))


def scope_tables(spark, sf):
    """Ledger rows and rows synced per scope."""
    s = fixture(spark, sf, "table_stats")
    parts = [
        s.where(ledger.in_scope(F.col("table_name"), scope)).agg(F.count("*").alias("runs"), F.sum("rows_inserted").alias("inserted"))
        .select(F.lit(scope).alias("scope"), "runs", "inserted")
        for scope in ("all", "current", "historical")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run_state(spark, sf):
    """Runs as start and finish events; runs still going have only the first."""
    runs = fixture(spark, sf, "runs")
    nothing = {c: F.lit(None).cast(k) for c, k in runs.dtypes
               if c in ("finished_at", "tables_processed", "total_rows_synced", "validation_errors", "duration_seconds", "error_message")}
    starts = runs.withColumns(nothing | {"status": F.lit("running")})
    return flat(ledger.run_state(starts.unionByName(runs.where("status <> 'running'"))))


def error_breakdown(spark, sf):
    from harness.sync import validation_log

    return ledger.error_breakdown(validation_log(spark, sf), like="%trainings%")


def product_profile(spark, sf):
    return ledger.product_profile(fixture(spark, sf, "core_sales"))


def sample_rows(spark, sf):
    s = ledger.sample_filled(fixture(spark, sf, "core_sales"), ["admin", "trainer"], ["client_id", "legacy_id", "admin", "trainer", "full_price"])
    return flat(s.select("legacy_id", "client_id", "admin", "trainer", "full_price"))


def retention(spark, sf):
    """What stays after thirty days are cut to ten, per table, and how much goes."""
    kept, gone = ledger.retention(fixture(spark, sf, "table_stats"), "created_at", as_of(AS_OF_EVENTS), days=10)
    rows = kept.groupBy("table_name").agg(F.count("*").alias("rows"))
    return rows.unionByName(gone.select(F.lit("deleted").alias("table_name"), F.col("deleted").alias("rows")))


def expire_dumps(spark, sf):
    """Events dumped by day, then cut to ten days: what is left of each day, and how many went."""
    name = f"dump_{uuid.uuid4().hex}"
    e = table(spark, sf, "events")
    sinks.append_table(sinks.raw_dump(e, "sheet-1", "events", F.col("ts"), ["event_id", "event_type"]), name, by=("extracted_on",))
    gone = sinks.expire_dumps(spark, name, as_of(AS_OF_EVENTS), days=10)
    left = materialize(spark.table(name).groupBy("extracted_on").agg(F.count("*").alias("rows")), "left")
    spark.sql(f"DROP TABLE {name}")
    return left.select(F.col("extracted_on").cast("string").alias("day"), "rows").unionByName(
        spark.range(1).select(F.lit("deleted").alias("day"), F.lit(gone).cast("long").alias("rows")))


def purge_logs(spark, sf):
    stats = fixture(spark, sf, "table_stats")
    today = ledger.purge_today(stats, as_of("2024-01-20 15:00:00")).agg(F.count("*").alias("n"), F.sum("rows_inserted").alias("s"))
    named = ledger.purge_unqualified(stats).agg(F.count("*").alias("n"), F.sum("rows_inserted").alias("s"))
    return today.withColumn("rule", F.lit("today")).unionByName(named.withColumn("rule", F.lit("unqualified")))


def raw_dump(spark, sf):
    """Records dumped as JSON, written by day, and read back by field."""
    o = fixture(spark, sf, "orders_stored")
    path = f"{shared_folder(spark)}/dump"
    sinks.append_raw_dump(sinks.raw_dump(o, "sheet-1", "stg_gsheets.orders", as_of(AS_OF_EVENTS), ["record_id", "klient", "status", "summa"]), path)
    back = spark.read.schema("spreadsheet_id string, sheet_name string, data string, extracted_at timestamp, extracted_on date").parquet(path)
    fields = F.from_json("data", "record_id string, klient string, status string, summa string")
    return flat(back.select("spreadsheet_id", "sheet_name", fields.alias("f"), "extracted_at", "extracted_on")
                .select("spreadsheet_id", "sheet_name", "f.*", "extracted_at", "extracted_on"))


def load_full(spark, sf):
    """A full load over an older one."""
    path = f"{shared_folder(spark)}/orders"
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sinks.load_full(o.where("o_orderstatus = 'P'"), path)
    sinks.load_full(o, path)
    return spark.read.schema(o.schema).parquet(path)


def load_append(spark, sf):
    path = f"{shared_folder(spark)}/events"
    e = table(spark, sf, "events").select("event_id", "event_type")
    sinks.append_rows(e, path)
    sinks.append_rows(e.where("event_type = 'view'"), path, truncate_first=True)
    sinks.append_rows(e.where("event_type <> 'error'"), path)
    back = spark.read.schema(e.schema).parquet(path)
    return back.groupBy("event_type").agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids"))


def swap_load(spark, sf):
    """Versions offered one after the other; the refused ones leave the table as it is."""
    name = f"orders_{uuid.uuid4().hex}"
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit("h").alias("content_hash"))
    short, twice = o.where("o_orderstatus = 'P'"), o.unionByName(o)
    offers = {"first": (o, False), "too_short": (short, False), "repeated": (twice, False), "forced": (o.where("o_orderstatus <> 'P'"), True)}
    done = {}
    for step, (rows, force) in offers.items():
        done[step] = sinks.swap_load(spark, rows, name, "o_orderkey", "content_hash", force=force, root=shared_folder(spark)).done
    history = F.lit(",".join(f"{step}:{swapped}" for step, swapped in done.items()).lower())

    def version(label: str, table_name: str):
        totals = spark.table(table_name).agg(F.count("*").alias("live_rows"), F.sum("o_orderkey").alias("key_sum"))
        return totals.select(F.lit(label).alias("version"), history.alias("history"), "live_rows", "key_sum")

    both = materialize(version("live", name).unionByName(version("backup", f"{name}_backup")), "versions")
    sinks.drop_table(spark, name)
    return both


def read_gate(spark, sf):
    """A source is read when it is newer than the last time it was seen."""
    path = f"{sf}/orders.parquet"
    at = last_modified(spark, path)
    seen = [("unseen", None), ("seen_before", at), ("seen_long_ago", at - timedelta(days=1))]
    rows = [table(spark, sf, "orders").where(F.lit(is_modified(spark, path, when))).agg(F.count("*").alias("rows")).withColumn("seen", F.lit(label))
            for label, when in seen]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def source_changes(spark, sf):
    """Orders as a source of several files, of which one is added, removed, or replaced by an older one since they were noted."""
    path = f"{shared_folder(spark)}/orders"
    o = table(spark, sf, "orders")
    o.write.partitionBy("o_orderstatus").parquet(path)
    status = F.regexp_extract("file", r"o_orderstatus=(\w)", 1)
    files = materialize(source_files(spark, f"{path}/*/*.parquet"), "files").withColumn("status", status)
    later = F.when(F.col("status") == "O", F.col("modified_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("modified_at"))
    cases = {
        "same": (files, files), "added": (files, files.where("status <> 'P'")), "removed": (files.where("status <> 'F'"), files),
        "older": (files, files.withColumn("modified_at", later)),
    }
    rows = o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("rows"))
    out = None
    for label, (here, noted) in cases.items():
        changes = file_changes(here, noted).select(F.lit(label).alias("step"), "change", status.alias("status")).distinct()
        out = changes if out is None else out.unionByName(changes)
    return out.join(rows, "status")


def read_sheet(spark, sf):
    """A sheet written as CSV and read as text: names normalised, blank rows gone, rows numbered."""
    path = f"{shared_folder(spark)}/sheet"
    o = table(spark, sf, "orders")
    s = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), None).otherwise(F.lit("x"))
    sheet = o.select(F.col("o_orderkey").alias("key"), *[F.when(s.isNotNull(), c).alias(n) for c, n in (
        (F.col("o_orderkey").cast("string"), "record_id"), (F.col("o_orderstatus"), "Статус заказа"),
        (F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "Сумма, руб."))])
    # blanked rows lie between the others
    sheet.repartitionByRange("key").sortWithinPartitions("key").drop("key").write.option("header", True).csv(path)
    return read_tabular(spark, path, "csv", mapping={"Статус заказа": "status"}, multiLine=False).withColumnRenamed("_row_index", "row_index")


def sheet_texts(spark, sf):
    """Whole texts, with quotes, commas and line breaks, written as sheet cells and read back."""
    path = f"{shared_folder(spark)}/texts"
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit(' "'), "text", F.lit('", "" ')).alias("text"), "lang")
    sinks.export_mart(d, path)
    back = read_tabular(spark, path, "csv")
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.char_length("text").cast("long").alias("chars"), "lang")


def header_auto(spark, sf):
    """A sheet whose header stands below a title and an older header."""
    path = f"{shared_folder(spark)}/sheet"
    marks = list(fv.HEADER_MARKS)
    rows = [(-4, ["Отчёт"]), (-3, [*marks, "old"]), (-2, [" "]), (-1, [m.upper() for m in marks] + ["Имя", "Сумма, руб."])]
    width = len(rows[-1][1])
    top = spark.createDataFrame([(n, *c, *[None] * (width - len(c))) for n, c in rows], "nr long, " + ", ".join(f"c{i} string" for i in range(width)))
    cells_ = [F.col("s_suppkey").cast("string"), F.lit("h"), F.lit("t1"), F.lit("t2"), F.lit("me"), F.col("s_name"), F.col("s_acctbal").cast("decimal(18,2)").cast("string")]
    body = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("nr"), *[c.alias(f"c{i}") for i, c in enumerate(cells_)])
    # a sheet is one file
    top.unionByName(body).repartition(1).sortWithinPartitions("nr").drop("nr").write.csv(path)
    read = read_tabular(spark, path, "csv", header="auto")
    return read.select("record_id", "content_hash", "created_at", "updated_by", "imya", "summa_rub", F.col("_row_index").alias("row_index"))


def conform(spark, sf):
    """Staged sales texts in the typed layout: misfits become NULL, then the default."""
    o = fixture(spark, sf, "sales_hst").select(
        F.col("record_id").alias("legacy_id"), F.col("date"), F.col("quantity"), F.col("final_price"), F.col("full_price"), F.lit("x").alias("unknown"),
    )
    out = layout.conform(o, layout.SALES, as_of(AS_OF_EVENTS))
    return flat(out.select("legacy_id", "date", "quantity", "final_price", "full_price", "cash", "comment", "is_deleted", "created_at", "deleted_at"))


QUERIES = {
    f.__name__: f
    for f in (dup_keys, dup_hashes, cross_source_dups, null_counts, row_counts, last_stats, volume_anomaly, dq_issues, dq_summary,
              dq_trend, ledger_state, volume_anomaly_state, dq_trend_state, run_totals_state, dup_keys_buckets, run_kpis, runs_by_day, runs_window, recent_runs, run_totals, scope_tables, run_state, error_breakdown,
              product_profile, sample_rows, retention, expire_dumps, purge_logs, raw_dump, load_full, load_append, swap_load, read_gate, source_changes,
              read_sheet, sheet_texts, header_auto, conform)
}

_SLOPE = (fv.LARGE_THRESHOLD - fv.SMALL_THRESHOLD) / (fv.LARGE_TABLE_ROWS - fv.SMALL_TABLE_ROWS)
_BASES = "(VALUES ('sales_cur'), ('sales_hst'), ('trainings_cur'), ('clients_cur')) b(base)"
_STATS = q.with_fixtures("table_stats", "clients_cur", more=f"""
    last AS (SELECT base, s.* FROM table_stats s JOIN {_BASES} ON s.table_name LIKE '%' || base
      QUALIFY row_number() OVER (PARTITION BY base ORDER BY created_at DESC, run_id DESC) <= 5),
    history AS (SELECT base, avg(rows_extracted) AS avg_rows, count(*) AS runs FROM last GROUP BY base),
    now AS (SELECT 'sales_cur' AS base, count(*) AS rows FROM orders UNION ALL SELECT 'sales_hst', count(*) FROM part
      UNION ALL SELECT 'trainings_cur', count(*) FROM events UNION ALL SELECT 'clients_cur', count(*) FROM customer),
    compared AS (SELECT 'stg_gsheets.' || base AS table_name, rows, runs, avg_rows, abs(rows - avg_rows) / avg_rows AS deviation,
      CASE WHEN avg_rows < 100 THEN 0.5 WHEN avg_rows > 10000 THEN 0.1 ELSE 0.5 + (avg_rows - 100) * ({_SLOPE!r}::DOUBLE) END AS threshold
      FROM now JOIN history USING (base) WHERE rows > 0 AND avg_rows > 0)""")
_ISSUES = _STATS + """,
    dup AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey * 8 + l_linenumber HAVING count(*) > 1)),
    issues AS (
      SELECT 'stg_gsheets.sales_cur' AS table_name, 'DUPLICATES' AS issue_type, 'Обнаружено ' || n || ' дубликатов по ключу key' AS message, 'critical' AS severity FROM dup WHERE n > 0
      UNION ALL SELECT 'stg_gsheets.clients_cur', 'NULL_VALUES', 'Обнаружено ' || n || ' пустых значений в колонке ''' || c || '''', 'warning'
        FROM (SELECT 'mobilnyy' AS c, count(*) AS n FROM clients_cur WHERE mobilnyy IS NULL UNION ALL
          SELECT 'data_rozhdeniya_rebenka', count(*) FROM clients_cur WHERE data_rozhdeniya_rebenka IS NULL) WHERE n > 0
      UNION ALL SELECT table_name, 'VOLUME_ANOMALY', 'Аномалия объема: получено ' || rows || ' строк, среднее за ' || runs || ' запусков — ' || printf('%.1f', round_even(avg_rows, 1))
          || ' (отклонение ' || printf('%.1f%%', round_even(deviation * 100, 1)) || ', порог ' || printf('%.0f%%', round_even(CAST(threshold AS DOUBLE) * 100, 0)) || ')', 'warning'
        FROM compared WHERE deviation > threshold)"""
_DOC_HASH = q.row_hash("text")
_RUN_COLS = f"""run_id, {q.ts('started_at')} AS started_at, {q.ts('finished_at')} AS finished_at, status, mode, tables_processed,
    total_rows_synced, validation_errors, {q.dbl('duration_seconds')} AS duration_seconds, error_message"""

ORACLE = {
    "dup_keys": "SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dup_hashes": f"SELECT count(*) AS duplicate_hashes FROM (SELECT {_DOC_HASH} AS h FROM documents GROUP BY h HAVING count(*) > 1)",
    "cross_source_dups": f"""
        WITH t AS (SELECT CASE WHEN source < 'src5' THEN 'sales_cur' ELSE 'sales_hst' END AS source, lang AS val, {_DOC_HASH} AS row_hash FROM documents
          UNION ALL SELECT 'sales_hst', event_type, {q.row_hash('event_type', 'CAST(user_id AS VARCHAR)')} FROM events),
        c AS (SELECT val, row_hash, source, count(*) AS n FROM t GROUP BY ALL)
        SELECT val, row_hash, CAST(sum(n) AS BIGINT) AS cnt, string_agg(source || ':' || n, ',' ORDER BY source) AS sources
        FROM c GROUP BY val, row_hash HAVING sum(n) > 1 ORDER BY cnt DESC, val, row_hash LIMIT 20""",
    "null_counts": q.with_fixtures("clients_cur") + """
        SELECT 'klient' AS column_name, count(*) FILTER (klient IS NULL) AS null_count FROM clients_cur
        UNION ALL SELECT 'mobilnyy', count(*) FILTER (mobilnyy IS NULL) FROM clients_cur
        UNION ALL SELECT 'data_rozhdeniya_rebenka', count(*) FILTER (data_rozhdeniya_rebenka IS NULL) FROM clients_cur""",
    "row_counts": """
        SELECT 'customer' AS table_name, count(*) AS rows, round(count(*) * 250 / 1048576.0::DOUBLE, 6) AS size_mb FROM customer
        UNION ALL SELECT 'orders', count(*), round(count(*) * 300 / 1048576.0::DOUBLE, 6) FROM orders
        UNION ALL SELECT 'lineitem', count(*), round(count(*) * 550 / 1048576.0::DOUBLE, 6) FROM lineitem
        UNION ALL SELECT 'events', count(*), round(count(*) * 300 / 1048576.0::DOUBLE, 6) FROM events""",
    "last_stats": _STATS + f"SELECT base, run_id, table_name, rows_extracted, {q.ts('created_at')} AS created_at FROM last",
    "volume_anomaly": _STATS + """
        SELECT table_name, rows, runs, deviation > threshold AS is_anomaly, round(avg_rows, 6) AS avg_rows, round(deviation, 6) AS deviation,
          round(CAST(threshold AS DOUBLE), 6) AS threshold FROM compared""",
    "ledger_state": q.with_fixtures("table_stats", more="""
        numbered AS (SELECT *, date_trunc('day', created_at) AS day,
          row_number() OVER (PARTITION BY table_name, date_trunc('day', created_at) ORDER BY created_at DESC, run_id DESC) AS n FROM table_stats)""") + f"""
        SELECT table_name, {q.ts('day')} AS day, count(*) AS runs, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ledger_days.SUMS)},
          string_agg(run_id, ',' ORDER BY created_at DESC, run_id DESC) FILTER (n <= 5) AS newest FROM numbered GROUP BY table_name, numbered.day""",
    "dup_keys_buckets": "SELECT o_custkey, count(*) AS cnt FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey HAVING count(*) > 1",
    "dq_issues": _ISSUES + "SELECT * FROM issues ORDER BY severity, table_name, issue_type, message LIMIT 10",
    "dq_summary": _ISSUES + """
        SELECT coalesce(bool_or(severity = 'critical'), false) AS has_critical_issues, count(*) AS issue_count,
          greatest(count(*) - 10, CAST(0 AS BIGINT)) AS not_shown FROM issues""",
    "dq_trend": q.with_fixtures("table_stats") + f"""
        SELECT {q.ts("date_trunc('day', created_at)")} AS day, table_name, round(CAST(sum(validation_errors) AS DOUBLE) / nullif(sum(rows_extracted), 0), 6) AS error_rate
        FROM table_stats GROUP BY ALL""",
    "run_kpis": q.with_fixtures("runs") + f"""
        SELECT count(*) AS total_runs, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
          round(count(*) FILTER (status = 'success') / count(*) * 100, 6) AS success_rate, CAST(sum(total_rows_synced) AS BIGINT) AS total_rows,
          round(avg(CAST(duration_seconds AS DOUBLE)), 6) AS avg_duration FROM runs WHERE started_at > TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 20 DAYS""",
    "runs_by_day": q.with_fixtures("runs") + f"""
        SELECT {q.day('started_at + INTERVAL 5 HOURS')} AS day, status, count(*) AS runs FROM runs GROUP BY ALL""",
    "runs_window": q.with_fixtures("runs") + f"""
        SELECT run_id, {q.ts('started_at')} AS started_at, status FROM runs WHERE runs.started_at > TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 7 DAYS""",
    "recent_runs": q.with_fixtures("runs") + """
        SELECT run_id, strftime(started_at + INTERVAL 5 HOURS, '%Y-%m-%d %H:%M') AS started_local, strftime(started_at + INTERVAL 5 HOURS, '%m/%d %H:%M') AS label,
          CASE WHEN duration_seconds IS NULL THEN '—' ELSE printf('%.1fs', round_even(CAST(duration_seconds AS DOUBLE), 1)) END AS duration, status, mode
        FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 30""",
    "run_totals": q.with_fixtures("table_stats") + """
        SELECT coalesce(table_name, 'ИТОГО') AS table_name, count(*) AS tables_processed, CAST(sum(rows_extracted) AS BIGINT) AS extracted,
          CAST(sum(rows_inserted) AS BIGINT) AS inserted, CAST(sum(rows_updated) AS BIGINT) AS updated, CAST(sum(rows_deleted) AS BIGINT) AS deleted,
          CAST(sum(validation_errors) AS BIGINT) AS errors, CAST(sum(rows_inserted + rows_updated) AS BIGINT) AS rows_synced, sum(duration_ms) / 1000 AS duration_s
        FROM table_stats GROUP BY ROLLUP (table_name)""",
    "scope_tables": q.with_fixtures("table_stats") + """
        SELECT 'all' AS scope, count(*) AS runs, CAST(sum(rows_inserted) AS BIGINT) AS inserted FROM table_stats
        UNION ALL SELECT 'current', count(*), CAST(sum(rows_inserted) AS BIGINT) FROM table_stats
          WHERE NOT (table_name LIKE '%\\_hst' ESCAPE '\\' OR table_name LIKE '%rates%' OR table_name LIKE '%price\\_reference%' ESCAPE '\\')
        UNION ALL SELECT 'historical', count(*), CAST(sum(rows_inserted) AS BIGINT) FROM table_stats
          WHERE table_name LIKE '%\\_hst' ESCAPE '\\' OR table_name LIKE '%rates%' OR table_name LIKE '%price\\_reference%' ESCAPE '\\'""",
    "run_state": q.with_fixtures("runs") + f"""
        SELECT * FROM (SELECT {_RUN_COLS} FROM runs WHERE status <> 'running'
          UNION ALL SELECT run_id, {q.ts('started_at')}, NULL, status, mode, NULL, NULL, NULL, NULL, NULL FROM runs WHERE status = 'running')""",
    "product_profile": q.with_fixtures("core_sales") + """
        SELECT product_name, quantity, count(*) AS occurrences FROM core_sales WHERE NOT is_deleted GROUP BY ALL
        ORDER BY occurrences DESC, product_name, quantity LIMIT 50""",
    "sample_rows": q.with_fixtures("core_sales") + """
        SELECT legacy_id, client_id, admin, trainer, CAST(full_price AS DOUBLE) AS full_price FROM core_sales WHERE admin IS NOT NULL OR trainer IS NOT NULL
        ORDER BY client_id, legacy_id, admin NULLS FIRST, trainer NULLS FIRST, core_sales.full_price LIMIT 5""",
    "retention": q.with_fixtures("table_stats") + f"""
        SELECT table_name, count(*) AS rows FROM table_stats WHERE created_at >= TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 10 DAYS GROUP BY table_name
        UNION ALL SELECT 'deleted', count(*) FROM table_stats WHERE created_at < TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 10 DAYS""",
    "expire_dumps": f"""
        SELECT {q.day('ts')} AS day, count(*) AS rows FROM events WHERE ts >= TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 10 DAYS GROUP BY 1
        UNION ALL SELECT 'deleted', count(*) FROM events WHERE ts < TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 10 DAYS""",
    "sheet_texts": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(' "' || text || '", "" ') AS text_md5, length(text) + 8 AS chars, lang FROM documents""",
    "header_auto": """
        SELECT CAST(s_suppkey AS VARCHAR) AS record_id, 'h' AS content_hash, 't1' AS created_at, 'me' AS updated_by, s_name AS imya,
          CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS summa_rub, row_number() OVER (ORDER BY s_suppkey) + 1 AS row_index FROM supplier""",
    "purge_logs": q.with_fixtures("table_stats") + """
        SELECT 'today' AS rule, count(*) AS n, CAST(sum(rows_inserted) AS BIGINT) AS s FROM table_stats WHERE created_at < TIMESTAMP '2024-01-20 00:00:00'
        UNION ALL SELECT 'unqualified', count(*), CAST(sum(rows_inserted) AS BIGINT) FROM table_stats WHERE contains(table_name, '.')""",
    "raw_dump": q.with_fixtures("orders_stored") + f"""
        SELECT 'sheet-1' AS spreadsheet_id, 'stg_gsheets.orders' AS sheet_name, record_id, klient, status, summa, '{AS_OF_EVENTS}' AS extracted_at,
          '{AS_OF_EVENTS[:10]}' AS extracted_on FROM orders_stored""",
    "load_full": "SELECT o_orderkey, o_orderstatus FROM orders",
    "load_append": """
        SELECT event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids
        FROM (SELECT * FROM events WHERE event_type = 'view' UNION ALL SELECT * FROM events WHERE event_type <> 'error') GROUP BY event_type""",
    "swap_load": """
        WITH h AS (SELECT 'first:true,too_short:false,repeated:false,forced:true' AS history)
        SELECT 'live' AS version, history, count(*) AS live_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders, h WHERE o_orderstatus <> 'P' GROUP BY history
        UNION ALL SELECT 'backup', history, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders, h GROUP BY history""",
    "read_gate": """
        SELECT count(*) AS rows, 'unseen' AS seen FROM orders UNION ALL SELECT 0, 'seen_before' UNION ALL SELECT count(*), 'seen_long_ago' FROM orders""",
    "source_changes": """
        SELECT step, change, status, count(*) AS rows FROM orders
        JOIN (VALUES ('added', 'added', 'P'), ('removed', 'removed', 'F'), ('older', 'replaced', 'O')) c(step, change, status) ON status = o_orderstatus GROUP BY ALL""",
    "read_sheet": """
        SELECT CAST(o_orderkey AS VARCHAR) AS record_id, o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS summa_rub,
          row_number() OVER (ORDER BY o_orderkey) + 1 AS row_index FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')""",
    "conform": q.with_fixtures("sales_hst") + rf"""
        SELECT record_id AS legacy_id, CASE WHEN regexp_matches(date, '^\d{{4}}') THEN date || ' 00:00:00' END AS date,
          CASE WHEN quantity = '2' THEN 2 ELSE 1 END AS quantity, CAST(final_price AS DOUBLE) AS final_price, 0.0::DOUBLE AS full_price, 0.0::DOUBLE AS cash,
          CAST(NULL AS VARCHAR) AS comment, false AS is_deleted, '{AS_OF_EVENTS}' AS created_at, CAST(NULL AS VARCHAR) AS deleted_at FROM sales_hst""",
}


def _error_breakdown_sql() -> str:
    from harness.sync import ORACLE as sync_oracle

    return f"""SELECT table_name, column_name, error_type, count(*) AS cnt FROM ({sync_oracle['validation_log']}) WHERE table_name LIKE '%trainings%'
        GROUP BY ALL ORDER BY cnt DESC, table_name, column_name, error_type LIMIT 10"""


ORACLE["error_breakdown"] = _error_breakdown_sql()
# the same reports, out of the ledger's state instead of its history
ORACLE |= {f"{name}_state": ORACLE[name] for name in ("volume_anomaly", "dq_trend", "run_totals")}
