"""Contracts: literal cases, summaries, thresholds, the log, constraints."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rowloom.operators import validate as v
from rowloom.sources.contracts import CONTRACTS, Contract, Rule, contract_for, contract_projection

SALES = Contract("sales", (
    Rule("дата", "date", True), Rule("клиент", "string", True), Rule("продукт"), Rule("количество", "integer"),
    Rule("полная_стоимость", "money"), Rule("комментарий")))
SCHEDULE = Contract("schedule", (Rule("дата", "date"), Rule("начало", "time"), Rule("конец", "time"), Rule("клиент"), Rule("статус")))


def errors(spark, contract, row, compat=False):
    schema = ", ".join(f"`{k}` string" for k in row)
    out = v.validate(spark.createDataFrame([tuple(row.values())], schema), contract, compat).first()
    return [(e["column"], e["error_type"]) for e in out["errors"]]


GOOD = {"дата": "01.12.25", "клиент": "Иванов", "продукт": "x"}


@pytest.mark.parametrize(("change", "found"), [
    ({}, []),
    ({"дата": "01.12.25", "клиент": "   "}, [("клиент", "MISSING_REQUIRED")]),
    ({"клиент": None}, [("клиент", "MISSING_REQUIRED")]),
    ({"клиент": "   \t\n   "}, [("клиент", "MISSING_REQUIRED")]),
    ({"количество": "5"}, []), ({"количество": " 5.0 "}, []), ({"количество": ""}, []),
    ({"количество": "пять"}, [("количество", "INVALID_INTEGER")]),
    ({"полная_стоимость": "дорого"}, [("полная_стоимость", "INVALID_MONEY")]),
    ({"полная_стоимость": "1.2.3"}, [("полная_стоимость", "INVALID_MONEY")]),
    ({"дата": "2025/12/01"}, [("дата", "INVALID_DATE")]),
])
def test_rules(spark, change, found):
    assert errors(spark, SALES, GOOD | change) == found


@pytest.mark.parametrize("value", ["1000", "1 000", "1000.50", "1 000,50", "1000 руб", "1 500 р.", "-1000"])
def test_money_forms(spark, value):
    assert errors(spark, SALES, GOOD | {"полная_стоимость": value}) == []


@pytest.mark.parametrize("value", ["01.12.25", "15.06.24", "31.12.99", "пн 01.12.25", "01.12.", "01.12", "2025-12-01"])
def test_date_forms(spark, value):
    assert errors(spark, SALES, GOOD | {"дата": value}) == []


@pytest.mark.parametrize(("value", "found"), [
    ("09:00", []), ("9:30", []), ("12:00:00", []), ("23:59", []), ("утро", [("начало", "INVALID_TIME")])])
def test_times(spark, value, found):
    contract = Contract("s", (Rule("дата", "date", True), Rule("начало", "time")))
    assert errors(spark, contract, {"дата": "01.12.25", "начало": value}) == found


def test_all_required_blank_is_a_blank_row(spark):
    out = v.validate(spark.createDataFrame([("", "   ", "x")], "`дата` string, `клиент` string, `продукт` string"), SALES).first()
    assert out.is_blank and out["errors"] == []
    # no required column at all: every row is blank
    assert v.validate(spark.createDataFrame([("a",)], "`клиент` string"), SCHEDULE).first().is_blank


def test_slug_names_and_renamed_column(spark):
    assert errors(spark, SALES, {"data": "01.12.25", "klient": "И", "produkt": "x", "kolichestvo": "5"}) == []
    assert errors(spark, SALES, {"data": "01.12.25", "pokupatel": "И"}) == [("клиент", "MISSING_REQUIRED")]


def test_compat(spark):
    assert errors(spark, SALES, GOOD | {"количество": ""}, compat=True) == [("количество", "INVALID_INTEGER")]
    assert errors(spark, SALES, GOOD | {"дата": None}, compat=True) == []
    assert errors(spark, SALES, GOOD | {"дата": None}) == [("дата", "MISSING_REQUIRED")]


def _three(spark):
    rows = [("01.12.25", "a", "1"), ("плохо", "b", "x"), ("", "", "1"), ("02.12.25", "c", "2")]
    return v.validate(spark.createDataFrame(rows, "`дата` string, `клиент` string, `количество` string"), SALES)


def test_summary_and_log(spark):
    s = v.validation_summary(_three(spark)).first()
    assert (s.total_rows, s.valid_rows, s.blank_rows, s.error_count, s.total_errors, s.max_row_errors) == (4, 2, 1, 2, 2, 2)
    assert s.error_rate == 0.5 and not s.is_valid and s.over_threshold
    indexed = _three(spark).withColumn("i", F.when(F.col("клиент") == "b", 1).otherwise(0))
    log = v.validation_log(indexed, "r", "t", F.col("i"), F.lit(datetime(2024, 1, 1)))
    got = sorted((r.row_index, r.column_name, r.error_type, r.invalid_value) for r in log.collect())
    assert got == [(1, "дата", "INVALID_DATE", "плохо"), (1, "количество", "INVALID_INTEGER", "x")]
    assert {r.message for r in log.collect()} >= {"Дата 'плохо' не соответствует формату None"}
    assert v.first_errors(log, 1).count() == 1
    assert v.valid_rows(_three(spark)).count() == 2


def test_empty_summary(spark):
    s = v.validation_summary(_three(spark).where("false")).first()
    assert (s.total_rows, s.error_rate, s.is_valid, s.over_threshold) == (0, 0.0, True, False)


def test_thresholds(spark):
    base = v.error_thresholds(v.validation_summary(_three(spark)), max_errors=1).first()
    with pytest.raises(v.ValidationFailed):
        v.require_thresholds(base, "t")
    v.require_thresholds(v.error_thresholds(v.validation_summary(_three(spark))).first(), "t")


def test_contract_lookup_and_projection():
    assert contract_for("stg_gsheets.trainings_hst").entity == "schedule"
    assert contract_for("sales_cur") is CONTRACTS["sales"]
    with pytest.raises(FileNotFoundError):
        contract_for("stg_gsheets.unknown")
    c = Contract("t", (Rule("name"), Rule("date_val", "date")))
    assert contract_projection(["name", "junk_col", "date_val"], c) == ["name", "date_val"]
    assert contract_projection(["record_id", "name", "m"], c, {"M": "m"}, "record_id") == ["name", "m", "record_id"]
    assert contract_projection(["x", "y"], c) == ["x", "y"]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", date(2024, 1, 1), date(2024, 1, 2)), (1, "zzz", date(2024, 1, 3), date(2024, 1, 2)), (None, None, None, None)],
                               "id int, s string, a date, b date")
    got = {r.constraint: r.violations for r in v.check_rows(df, [
        v.not_null("id"), v.allowed("s", ["a"]), v.ordered("a", "b"), v.max_length("s", 2)]).collect()}
    assert got == {"not_null:id": 1, "allowed:s": 1, "ordered:a<b": 1, "max_length:s": 1}
    assert v.check_unique(df, ["id"]).first().violations == 1
    parent = spark.createDataFrame([(2,)], "k int")
    assert v.check_reference(df, "id", parent, "k").first().violations == 2
