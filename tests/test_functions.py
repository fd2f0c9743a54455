"""Single cells: the literal cases of the reference behaviour."""

import hashlib
import json
import random
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rowloom import fixed_values as fv
from rowloom.functions import dates, hashing, numbers, text
from rowloom.functions.columns import clean_columns, column_kind
from rowloom.functions.slug import normalize_headers, slug, slugify

NBSP = "\xa0"


def apply(spark, fn, values, dtype="string"):
    """fn over a column of values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clean_string(spark):
    assert apply(spark, text.clean_string, ["  hello  ", "nan", "", None, "NULL", "None", "nanny"]) == \
        ["hello", None, None, None, None, None, "nanny"]


def test_normalize_numeric_string(spark):
    values = [f"1{NBSP}000,50", " 2 500 ", "12,3", " - 1 234,56 ", "1 250,50 руб.", "100$", "5 ШТ", "01.12.", "Иванов Иван", "A-12"]
    assert apply(spark, text.normalize_numeric_string, values) == \
        ["1000.50", "2500", "12.3", "-1234.56", "1250.50", "100", "5", "01.", "ИвановИван", "A-12"]


def test_normalize_boolean(spark):
    assert apply(spark, text.normalize_boolean, ["Да", "1", "true", "Нет", "0", "unknown"]) == [True, True, True, False, False, None]


def test_normalize_value(spark):
    assert apply(spark, text.normalize_value, [None, "", "  hello  ", "hello    world", "a\x1c b"]) == ["", "", "hello", "hello world", "a b"]


def test_serial_date(spark):
    got = apply(spark, dates.serial_date, [None, "", "44197", "15.03.2024", "44197.5", "15.03.24", "2024-03-05", "5/3/2024", "31.02.2024", "x", "1d"])
    assert got == [None, None, datetime(2021, 1, 1), datetime(2024, 3, 15), datetime(2021, 1, 1, 12), datetime(2024, 3, 15),
                   datetime(2024, 3, 5), datetime(2024, 3, 5), None, None, None]


def test_clean_numeric(spark):
    assert apply(spark, text.clean_numeric, [None, "", "42", "3.14", "1 000", f"1{NBSP}000", "3,14", "abc", "1d", "nan"]) == \
        [None, None, 42.0, 3.14, 1000.0, 1000.0, 3.14, None, None, None]


def test_clean_boolean(spark):
    assert apply(spark, text.clean_boolean, ["TRUE", "True", "1", "да", "FALSE", "0", "нет", None, "maybe", "Да"]) == \
        [True, True, True, True, False, False, False, None, None, None]


def test_clean_text(spark):
    assert apply(spark, text.clean_text, [None, "  hello  ", "", "nan", "None", "NAN"]) == [None, "hello", None, None, None, "NAN"]


def test_is_blank_and_strip(spark):
    assert apply(spark, text.is_blank, [None, "", f" \t\n{NBSP}\x1f", "x", " x "]) == [True, True, True, False, False]
    assert apply(spark, text.strip, [f"{NBSP} a b\x85", "　"]) == ["a b", ""]


def test_column_kinds():
    assert [column_kind(c) for c in ("data", "created_date", "data_rozhdeniya")] == ["date"] * 3
    assert [column_kind(c) for c in ("summa", "polnaya_stoimost", "kolichestvo")] == ["numeric"] * 3
    assert [column_kind(c) for c in ("name", "id", "active", "__row_hash")] == ["text", "service", "boolean", "service"]


def test_clean_row(spark):
    df = spark.createDataFrame([("15.03.2024", "1 000", "TRUE", "  John  ")], "data string, summa string, active string, name string")
    row = clean_columns(df).first()
    assert tuple(row) == (datetime(2024, 3, 15), 1000.0, True, "John")
    assert clean_columns(df, {"summa": "text"}).first().summa == "1 000"


def test_clean_row_typed_inputs(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2), 5.5, 1)], "data timestamp, summa double, active int")
    assert tuple(clean_columns(df).first()) == (datetime(2024, 1, 2), 5.5, True)


def test_money(spark):
    got = apply(spark, numbers.money, ["1 250,50 руб.", "-1000", "", None, "abc", "1.2.3", "0.05", "1500 р."])
    assert [float(x) for x in got] == [1250.5, -1000, 0, 0, 0, 0, 0.05, 1500]


def test_integer_and_units(spark):
    assert apply(spark, numbers.integer, [" 5 ", "+7", "1.5", "", None, "x"]) == [5, 7, 1, 1, 1, 1]
    names = ["Абонемент 8", "Абонемент 4", "12 занятий", "16 занятий", "18 штук", "14", "24", "Разовое"]
    assert apply(spark, numbers.units_in_name, names) == [8, 4, 12, 16, 8, 4, 4, 1]


def test_sales_date(spark):
    now = F.lit(datetime(2030, 1, 1))
    values = ["15.03.2024", "15.03.24", "01.02.75", "x 05.06.2023 y", "2024-03-15", None, "31.02.2024"]
    assert apply(spark, lambda c: dates.sales_date(c, now), values) == [
        datetime(2024, 3, 15), datetime(2024, 3, 15), datetime(1975, 2, 1), datetime(2023, 6, 5), datetime(2030, 1, 1),
        datetime(2030, 1, 1), None]
    assert apply(spark, lambda c: dates.sales_date(c, now, compat=True), ["15.03.2024"]) == [datetime(2020, 3, 15)]


def test_schedule_date(spark):
    today = F.lit(date(2030, 1, 1))
    values = ["15.03.", "15.03.2024", "15.03.24", "", "15.03.x"]
    assert apply(spark, lambda c: dates.schedule_date(c, today), values) == [
        date(2025, 3, 15), date(2024, 3, 15), date(2024, 3, 15), date(2030, 1, 1), date(2025, 3, 15)]
    assert apply(spark, lambda c: dates.schedule_date(c, today, compat=True), ["15.03.", "15.03.2024", "15.03.24"]) == [
        date(2025, 3, 15), date(2024, 3, 15), date(2420, 3, 15)]
    assert apply(spark, lambda c: dates.schedule_date_history(c, today, compat=True), ["15.03.2024", "15.03.2024 ", "x"]) == [
        date(2024, 3, 15), date(2020, 3, 15), date(2030, 1, 1)]


def test_birth_date_and_clock(spark):
    assert apply(spark, dates.birth_date, ["01.02.2015", "01.02.15", " 01.02.2015", None]) == [date(2015, 2, 1), None, None, None]
    got = apply(spark, lambda c: dates.clock_time(c, "09:30"), ["9:05", " 18:30:15", "утро", None, "25:00", "24:00"])
    assert got == ["09:05:00", "18:30:00", "09:30:00", "09:30:00", None, "24:00:00"]


def test_weekday(spark):
    assert apply(spark, text.strip_weekday, ["пн 01.12.25", "Пн 01.12.25", "ср. 01.12.25", "пон\xa001.12.25", "01.12.25"]) == \
        ["01.12.25", "01.12.25", "ср. 01.12.25", "01.12.25", "01.12.25"]


def test_logged_value(spark):
    assert apply(spark, text.logged_value, [None, "x" * 300, "ok"]) == ["None", "x" * 255, "ok"]


@pytest.mark.parametrize(("header", "name"), [
    ("Клиент ФИО", "klient_fio"), ("Полная стоимость, руб.", "polnaya_stoimost_rub"), ("1-й взнос", "col_1_y_vznos"),
    ("", "col_unknown"), (None, "col_unknown"), ("№", "col_unnamed"), ("Щётка / Ёж", "schyotka_yozh"), ("a__b", "a_b")])
def test_slug(spark, header, name):
    assert slugify(header) == name
    assert apply(spark, slug, [header]) == [name]


def test_slug_of_odd_texts(spark):
    odd = [" -/", "a. ,-(b)", "_1", "Ё_№_ъЬ_Щи", "日本 2-3", "x\ny\tz", "-a--_/b-", "^&*$", "\\[x]", "АБВ-абв", "ЪЬ", "_", "٣ 4", "a№_№b", "9"]
    assert apply(spark, slug, odd) == [slugify(x) for x in odd]


def test_slug_goes_through_a_text_once(spark):
    """Each pass over the text stands in the plan once, also if the slug is used twice."""
    text = spark.range(1).select(F.concat(F.lit("Ы "), F.col("id").cast("string")).alias("v"))
    plan = text.select(slug(F.col("v")).alias("s")).select(F.md5("s"), F.substring("s", 1, 9))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 4 and plan.count("translate(") == 1


def test_headers():
    assert normalize_headers(["Дата", "Дата", "updated_at", "x", "Дата 1"], mapping={"updated_at": "sheet_updated_at"}) == \
        ["data", "data_1", "sheet_updated_at", "x", "data_1_1"]
    assert normalize_headers(["a", "b"], table="rates") == ["col_0", "col_1"]


def _python_hash(cells):
    plain = ["" if c is None else " ".join(c.split()) for c in cells]
    return hashlib.md5(json.dumps(plain, ensure_ascii=False).encode()).hexdigest()


def test_row_hash_equals_json_md5(spark):
    rnd = random.Random(7)
    parts = ["a", "Ж", " ", "  ", "\t", "\n", NBSP, '"', "\\", "\x00", "\x01", "\x08", "\x0e", "\x1b", "\x1c", "\x7f", "😀", "€", "\\u000e", "中", "\x85"]
    rows = [tuple(None if rnd.random() < 0.1 else "".join(rnd.choices(parts, k=rnd.randint(0, 7))) for _ in range(3)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = df.select("a", "b", "c", hashing.row_hash(["a", "b", "c"]).alias("h"), hashing.row_hash([F.col("a"), F.col("b"), F.col("c")], exclude=[1]).alias("x"))
    for r in out.collect():
        assert r.h == _python_hash((r.a, r.b, r.c))
        assert r.x == _python_hash((r.a, r.c))


def test_keys(spark):
    df = spark.createDataFrame([("Иван", None, 42)], "a string, b string, n long")
    key, uid = df.select(hashing.legacy_key(F.col("a"), F.col("b")), hashing.name_uuid(F.concat(F.lit("tg:"), F.col("n").cast("string")))).first()
    assert key == hashlib.md5("Иван".encode()).hexdigest()
    assert uid == str(uuid.uuid5(uuid.NAMESPACE_URL, "tg:42"))


def test_fixed_values_are_plain():
    assert fv.UNIT_MARKS == (8, 4, 12, 16)
    assert set(fv.CONTRACTS) == set(fv.UNIQUE_KEYS)
