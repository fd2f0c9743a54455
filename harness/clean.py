"""Cleaning of cells, hashes, headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harness import sqltext as q
from harness.fixtures import AS_OF_EVENTS, AS_OF_SALES, cells, fixture, table
from rowloom import fixed_values as fv
from rowloom.functions import dates, hashing, numbers, text
from rowloom.functions.columns import clean_columns
from rowloom.functions.slug import normalize_headers, slug
from rowloom.sources.tabular import (
    align_cells, drop_blank_rows, find_header, prepare_rows, to_staging, with_row_index,
)


def flat(df: DataFrame) -> DataFrame:
    """Columns in types that look the same from Spark and from DuckDB."""

    def one(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        return c.alias(name)

    return df.select(*[one(n, k) for n, k in df.dtypes])


def as_of(text_: str) -> Column:
    return F.to_timestamp(F.lit(text_))


def clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("cell")
    return fixture(spark, sf, "text_cells").select(
        "doc_id",
        F.md5(text.clean_string(c)).alias("clean_md5"),
        F.length(text.clean_string(c)).alias("clean_len"),
        F.md5(text.clean_text(c)).alias("text_md5"),
        F.md5(text.normalize_value(c)).alias("norm_md5"),
        text.blank_to_null(c).isNull().alias("is_null"),
        F.length(text.logged_value(c)).alias("logged_len"),
        F.md5(text.logged_value(c)).alias("logged_md5"),
    )


def clean_numeric_text(spark, sf):
    c = F.col("cell")
    return fixture(spark, sf, "number_cells").select(
        "o_orderkey",
        text.normalize_numeric_string(c).alias("as_text"),
        text.clean_numeric(c).alias("as_double"),
        text.digits_only(c).alias("digits"),
    )


def clean_booleans(spark, sf):
    c = F.col("cell")
    return fixture(spark, sf, "boolean_cells").select(
        "o_orderkey", text.normalize_boolean(c).alias("loose"), text.clean_boolean(c).alias("exact")
    )


def serial_dates(spark, sf):
    return flat(fixture(spark, sf, "serial_cells").select("o_orderkey", dates.serial_date(F.col("cell")).alias("at")))


def sheet_dates(spark, sf):
    c, now = F.col("cell"), as_of(AS_OF_SALES)
    today = F.to_date(now)
    return flat(
        fixture(spark, sf, "date_cells").select(
            "o_orderkey",
            dates.sales_date(c, now).alias("sale"),
            dates.sales_date(c, now, compat=True).alias("sale_compat"),
            dates.schedule_date(c, today).alias("current"),
            dates.schedule_date(c, today, compat=True).alias("current_compat"),
            dates.schedule_date_history(c, today).alias("history"),
            dates.birth_date(c).alias("born"),
            text.strip_weekday(text.strip(c)).alias("no_weekday"),
        )
    )


def sheet_times(spark, sf):
    c = F.col("cell")
    return fixture(spark, sf, "time_cells").select(
        "event_id", dates.clock_time(c, fv.DEFAULT_START).alias("start_time"), dates.clock_time(c, fv.DEFAULT_END).alias("end_time")
    )


def money_parse(spark, sf):
    return flat(
        fixture(spark, sf, "sales_cur").select(
            "record_id",
            numbers.money(F.col("polnaya_stoimost")).alias("full_price"),
            numbers.money(F.col("skidka")).alias("discount"),
            numbers.money(F.col("perevod")).alias("transfer"),
            numbers.money(F.col("terminal")).alias("terminal"),
            numbers.integer(F.col("kolichestvo")).alias("quantity"),
            numbers.units_in_name(F.col("produkt")).alias("units"),
        )
    )


def clean_rows_by_name(spark, sf):
    s = fixture(spark, sf, "serial_cells").withColumnRenamed("cell", "data_rozhdeniya")
    n = fixture(spark, sf, "number_cells").select("o_orderkey", F.col("cell").alias("summa"))
    b = fixture(spark, sf, "boolean_cells").select("o_orderkey", F.col("cell").alias("active"))
    rows = s.join(n, "o_orderkey").join(b, "o_orderkey").select(
        F.col("o_orderkey").alias("id"), "data_rozhdeniya", "summa", "active",
        F.concat(F.lit("  "), "summa", F.lit(" ")).alias("name"),
    )
    return flat(clean_columns(rows))


def slug_values(spark, sf):
    docs = cells(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), "text")
    parts = cells(spark, sf, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("key"),
        F.concat(F.col("p_size").cast("string"), F.lit(" Щётка/Ёж (№ Цифра-"), "p_name", F.lit(")")).alias("text"),
    )
    names = table(spark, sf, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("key"),
        F.when(F.col("n_regionkey") == 0, "").when(F.col("n_regionkey") == 1, "ъ.(,)").otherwise(F.col("n_name")).alias("text"),
    )
    rows = docs.unionByName(parts).unionByName(names)
    return rows.select("key", slug(F.col("text")).alias("s")).select("key", F.md5("s").alias("slug_md5"), F.substring("s", 1, 60).alias("slug_start"))


def row_hash(spark, sf):
    """The client sheet fingerprinted; all cells as text, and number cells normalised."""
    columns = ["record_id", "klient", "mobilnyy", "imya_rebenka", "data_rozhdeniya_rebenka", "tip"]
    df = fixture(spark, sf, "clients_cur")
    plain = prepare_rows(df, columns, numeric=[]).select("record_id", F.col("__row_hash").alias("plain_hash"))
    return plain.join(
        prepare_rows(df, columns, numeric=None).select(
            "record_id", F.col("__row_hash").alias("packed_hash"), F.col("klient").alias("packed_name")
        ),
        "record_id",
    )


def document_hashes(spark, sf):
    return cells(spark, sf, "documents").select(
        "doc_id", hashing.row_hash(["text", "lang", "source"]).alias("row_hash"),
        hashing.row_hash(["text", "lang", "source"], exclude=[1]).alias("without_lang"),
    )


def content_keys(spark, sf):
    c = F.col
    name = F.concat(F.lit("tg:"), c("o_orderkey").cast("string"))
    return fixture(spark, sf, "orders_sheet").withColumn("o_orderkey", c("record_id")).select(
        "_row_index",
        hashing.legacy_key(c("record_id"), c("klient"), F.nullif(c("status"), F.lit("O")), c("summa")).alias("legacy_id"),
        hashing.name_uuid(name).alias("uuid"),
    )


_LAYOUT = ("record_id", "content_hash", "created_at", "updated_at", "updated_by", "Клиент ФИО", "Клиент ФИО", "Сумма, руб.")


def header_align(spark, sf):
    """A headerless sheet: title rows, an old header, the header, ragged rows, blank rows."""
    header = F.array(*[F.lit(h) for h in _LAYOUT])
    shouted = F.array(*[F.lit(f" {h.upper()} ") for h in _LAYOUT])
    o = table(spark, sf, "orders")
    s = F.col("o_orderkey").cast("string")
    full = F.array(s, F.md5(s), F.lit("2024"), F.lit(" "), F.lit(""), F.concat(F.lit("c"), F.col("o_custkey").cast("string")),
                    F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("лишнее"))
    width = F.when(F.col("o_orderstatus") == "P", 6).when(F.col("o_orderstatus") == "F", 8).otherwise(9)
    blank = F.array(F.lit(" "), F.lit(None).cast("string"))
    data = o.select(
        (F.col("o_orderkey") + 6).alias("ord"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), blank)
        .otherwise(F.slice(full, F.lit(1), width)).alias("cells"),
    )
    region = table(spark, sf, "region")
    top = region.select(
        (F.col("r_regionkey") + 1).cast("long").alias("ord"),
        F.when(F.col("r_regionkey") == 2, shouted).when(F.col("r_regionkey") == 4, header)
        .otherwise(F.array("r_name", F.lit("record_id"))).alias("cells"),
    )
    raw = top.unionByName(data)
    found = find_header(raw).first()
    names = normalize_headers(found["cells"], mapping={"content_hash": "sheet_content_hash"})
    rows = align_cells(raw.where(F.col("ord") > found["ord"]), names, keep=("ord",))
    return drop_blank_rows(rows, names)


def row_numbers(spark, sf):
    """Sheet row numbers in file order, and the staging layout."""
    rows = with_row_index(table(spark, sf, "orders"))
    staged = to_staging(rows, ["o_orderkey", "o_orderstatus"], as_of(AS_OF_EVENTS), numeric=[])
    return flat(staged).withColumnsRenamed({"__row_hash": "row_hash", "_loaded_at": "loaded_at", "_row_index": "row_index"})


QUERIES = {
    f.__name__: f
    for f in (clean_strings, clean_numeric_text, clean_booleans, serial_dates, sheet_dates, sheet_times, money_parse,
              clean_rows_by_name, slug_values, row_hash, document_hashes, content_keys, header_align, row_numbers)
}

_NAMES_SQL = ("sheet_content_hash", "created_at", "updated_at", "updated_by", "klient_fio", "klient_fio_1", "summa_rub")

ORACLE = {
    "clean_strings": q.with_fixtures("text_cells") + f"""
        SELECT doc_id, md5({q.cleaned('cell')}) AS clean_md5, CAST(length({q.cleaned('cell')}) AS INTEGER) AS clean_len,
          md5({q.text('cell')}) AS text_md5, md5({q.norm('cell')}) AS norm_md5, {q.n('cell')} IS NULL AS is_null,
          CAST(length(left(coalesce(cell, 'None'), 255)) AS INTEGER) AS logged_len, md5(left(coalesce(cell, 'None'), 255)) AS logged_md5
        FROM text_cells""",
    "clean_numeric_text": q.with_fixtures("number_cells") + rf"""
        SELECT o_orderkey, {q.numeric_text('cell')} AS as_text, {q.numeric('cell')} AS as_double,
          regexp_replace(cell, '\D', '', 'g') AS digits FROM number_cells""",
    "clean_booleans": q.with_fixtures("boolean_cells") + f"""
        SELECT o_orderkey, CASE WHEN lower({q.cleaned('cell')}) IN ('true','1','yes','да','v') THEN true
            WHEN lower({q.cleaned('cell')}) IN ('false','0','no','нет') THEN false END AS loose,
          {q.boolean_exact('cell')} AS exact FROM boolean_cells""",
    "serial_dates": q.with_fixtures("serial_cells") + f"SELECT o_orderkey, {q.ts(q.serial('cell'))} AS \"at\" FROM serial_cells",
    "sheet_dates": q.with_fixtures("date_cells") + f"""
        SELECT o_orderkey, {q.ts(q.sales_date('cell', AS_OF_SALES))} AS sale, {q.ts(q.sales_date('cell', AS_OF_SALES, True))} AS sale_compat,
          {q.day(q.schedule_date('cell', AS_OF_SALES))} AS "current", {q.day(q.schedule_date('cell', AS_OF_SALES, compat=True))} AS current_compat,
          {q.day(q.schedule_date_hst('cell', AS_OF_SALES))} AS history, {q.day(q.birth_date('cell'))} AS born,
          {q.strip("regexp_replace(" + q.strip('cell') + ", '(?i)^[а-яa-z]{2,3}" + q.WS + "+', '')")} AS no_weekday
        FROM date_cells""",
    "sheet_times": q.with_fixtures("time_cells") + f"""
        SELECT event_id, {q.clock('cell', '09:00')} AS start_time, {q.clock('cell', '09:30')} AS end_time FROM time_cells""",
    "money_parse": q.with_fixtures("sales_cur") + f"""
        SELECT record_id, {q.dbl(q.money('polnaya_stoimost'))} AS full_price, {q.dbl(q.money('skidka'))} AS discount,
          {q.dbl(q.money('perevod'))} AS transfer, {q.dbl(q.money('terminal'))} AS terminal, {q.integer('kolichestvo')} AS quantity,
          CASE WHEN produkt LIKE '%8%' THEN 8 WHEN produkt LIKE '%4%' THEN 4 WHEN produkt LIKE '%12%' THEN 12
            WHEN produkt LIKE '%16%' THEN 16 ELSE 1 END AS units
        FROM sales_cur""",
    "clean_rows_by_name": q.with_fixtures("serial_cells", "number_cells", "boolean_cells") + f"""
        SELECT s.o_orderkey AS id, {q.ts(q.serial('s.cell'))} AS data_rozhdeniya, {q.numeric('n.cell')} AS summa,
          {q.boolean_exact('b.cell')} AS active, {q.text("('  ' || n.cell || ' ')")} AS name
        FROM serial_cells s JOIN number_cells n USING (o_orderkey) JOIN boolean_cells b USING (o_orderkey)""",
    "slug_values": f"""
        WITH t AS (SELECT 'd' || doc_id AS key, text FROM documents
          UNION ALL SELECT 'p' || p_partkey, p_size || ' Щётка/Ёж (№ Цифра-' || p_name || ')' FROM part
          UNION ALL SELECT 'n' || n_nationkey, CASE n_regionkey WHEN 0 THEN '' WHEN 1 THEN 'ъ.(,)' ELSE n_name END FROM nation)
        SELECT key, md5({q.slug('text')}) AS slug_md5, left({q.slug('text')}, 60) AS slug_start FROM t""",
    "row_hash": q.with_fixtures("clients_cur") + f"""
        SELECT record_id, {q.row_hash('record_id', 'klient', 'mobilnyy', 'imya_rebenka', 'data_rozhdeniya_rebenka', 'tip')} AS plain_hash,
          {q.row_hash(*[q.numeric_text(c) for c in ('record_id', 'klient', 'mobilnyy', 'imya_rebenka', 'data_rozhdeniya_rebenka', 'tip')])} AS packed_hash,
          {q.numeric_text('klient')} AS packed_name FROM clients_cur""",
    "document_hashes": f"""
        SELECT doc_id, {q.row_hash('text', 'lang', 'source')} AS row_hash, {q.row_hash('text', 'source')} AS without_lang FROM documents""",
    "content_keys": q.with_fixtures("orders_sheet") + f"""
        SELECT _row_index, {q.legacy('record_id', 'klient', "nullif(status, 'O')", 'summa')} AS legacy_id,
          substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
          substr('89ab', 1 + (position(substr(h, 17, 1) IN '0123456789abcdef') - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid
        FROM (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('tg:' || record_id)) AS h FROM orders_sheet)""",
    "header_align": """
        SELECT o_orderkey + 6 AS ord, CAST(o_orderkey AS VARCHAR) AS record_id, md5(CAST(o_orderkey AS VARCHAR)) AS sheet_content_hash,
          '2024' AS created_at, ' ' AS updated_at, '' AS updated_by, 'c' || o_custkey AS klient_fio,
          CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS klient_fio_1,
          CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS summa_rub
        FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')""",
    "row_numbers": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderkey + 2 AS row_index,
          {q.row_hash('CAST(o_orderkey AS VARCHAR)', 'o_orderstatus')} AS row_hash, '{AS_OF_EVENTS}' AS loaded_at FROM orders""",
}
