"""Staged sheets -> rows for the core tables.

Ids are the content keys (`legacy_id`); of several staged rows with one key the first by
row number counts, so results do not depend on the order in which tasks run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rowloom import fixed_values as fv
from rowloom.functions import dates
from rowloom.functions.hashing import legacy_key
from rowloom.functions.numbers import MONEY, amount, integer, money, whole
from rowloom.functions.text import blank_to, blank_to_null
from rowloom.operators.losses import lost
from rowloom.operators.merge import distinct_names, first_per_key, hashes_again, insert_absent, lookup_by_name, upsert

_ORDER = ("_row_index", "row_hash")
# whether another row may have a row's id
_AGAIN = "__again"


def _one_per_key(df: DataFrame) -> DataFrame:
    return first_per_key(df, ["legacy_id"], _ORDER).drop("_row_index")


def _rows_per_key(wanted: DataFrame, key: Column, rows: Callable[[DataFrame], DataFrame], again: DataFrame | None) -> DataFrame:
    """One of the `rows` made of the wanted ones per id, which is `key`; `again` as of sales_again() and schedule_again().

    Wide rows whose ids no other row has need not meet by id: they are taken as they are, and only the others go through
    a window. Which those are is marked, for history_over_current().
    """
    if again is None:
        return _one_per_key(rows(wanted))
    found, may_repeat = F.broadcast(again), F.xxhash64(key) == F.col("hash")
    once = rows(wanted.join(found, may_repeat, "left_anti")).drop("_row_index")
    more = _one_per_key(rows(wanted.join(found, may_repeat, "left_semi")))
    return once.withColumn(_AGAIN, F.lit(False)).unionByName(more.withColumn(_AGAIN, F.lit(True)))


def clients_rows(staged: DataFrame, history: bool = False) -> DataFrame:
    """Client sheets: clients_cur, or clients_hst with history=True."""
    c = F.col
    name, phone, child, born, status = (
        (c("client_full"), c("phone_mobile"), c("child_name"), c("child_birth_date"), c("product_type"))
        if history
        else (c("klient"), c("mobilnyy"), c("imya_rebenka"), c("data_rozhdeniya_rebenka"), c("tip"))
    )
    return _one_per_key(
        staged.where(blank_to_null(name).isNotNull()).select(
            legacy_key(name, phone).alias("legacy_id"),
            c("__row_hash").alias("row_hash"),
            F.lit("clients_hst" if history else "clients_cur").alias("source"),
            blank_to(name, fv.NO_NAME).alias("name"),
            blank_to(phone, fv.NO_PHONE).alias("phone"),
            blank_to_null(child).alias("child_name"),
            dates.birth_date(born).alias("child_dob"),
            blank_to_null(status).alias("status"),
            "_row_index",
        )
    )


def _sales_cells(history: bool) -> tuple[Column, ...]:
    """Day, client, product and final price, of which a sale's id is made."""
    names = ("date", "client_full", "product", "final_price") if history else ("data", "klient", "produkt", "okonchatelnaya_stoimost")
    return tuple(map(F.col, names))


def _sold(staged: DataFrame, history: bool) -> DataFrame:
    return staged.where(blank_to_null(_sales_cells(history)[2]).isNotNull())


def sales_again(current: DataFrame | None, history: DataFrame | None) -> DataFrame | None:
    """hashes_again() of the ids in both sales sheets."""
    return hashes_again(*[
        _sold(staged, old).select(legacy_key(*_sales_cells(old))) for staged, old in ((current, False), (history, True)) if staged is not None
    ])


def sales_rows(staged: DataFrame, clients: DataFrame, as_of: Column, history: bool = False, compat: bool = False,
               again: DataFrame | None = None) -> DataFrame:
    """Sales sheets: sales_cur, or sales_hst (fewer columns) with history=True.

    Rows without a product or without a known client are left out.  With `again`, of sales_again(), the result is for
    history_over_current() and merge_current_then_history(), of both sheets or of one.
    """
    c = F.col
    day, client, product, final = _sales_cells(history)
    none, zero = F.lit(None).cast("string"), F.lit(0).cast(MONEY)
    common = {
        "legacy_id": legacy_key(day, client, product, final),
        "row_hash": c("__row_hash"),
        "source": F.lit("sales_hst" if history else "sales_cur"),
        "date": dates.sales_date(day, as_of, compat),
        "product_name": blank_to(product, fv.NO_PRODUCT),
        "final_price": money(final),
        "client_id": c("client_id"),
        "_row_index": c("_row_index"),
    }
    if history:
        rest = {
            "type": blank_to_null(c("product_type")),
            "category": blank_to_null(c("product_category")),
            "quantity": integer(c("quantity")),
            "full_price": money(c("full_price")),
            **{n: zero for n in ("discount", "cash", "transfer", "terminal", "debt")},
            **{n: none for n in ("comment", "admin", "trainer")},
        }
    else:
        rest = {
            "type": blank_to_null(c("tip")),
            "category": blank_to_null(c("kategoriya")),
            "quantity": integer(c("kolichestvo")),
            "full_price": money(c("polnaya_stoimost")),
            "discount": money(c("skidka")),
            "cash": money(c("nalichnye")),
            "transfer": money(c("perevod")),
            "terminal": money(c("s.terminal")),
            "debt": money(c("vdolg")),
            "comment": blank_to_null(c("kommentariy")),
            "admin": blank_to_null(c("s.admin")),
            "trainer": blank_to_null(c("trener")),
        }

    def rows(wanted: DataFrame) -> DataFrame:
        known = lookup_by_name(wanted.alias("s"), client, clients, "name", "legacy_id", "client_id")
        return known.select(*[v.alias(k) for k, v in (common | rest).items()])

    return _rows_per_key(_sold(staged, history), legacy_key(day, client, product, final), rows, again)


def _schedule_cells(history: bool) -> tuple[Column, ...]:
    """Day, start and client, of which a training's id is made."""
    return tuple(map(F.col, ("date", "start_time", "client_full") if history else ("data", "nachalo", "klient")))


def _held(staged: DataFrame, history: bool) -> DataFrame:
    return staged.where(blank_to_null(_schedule_cells(history)[0]).isNotNull())


def schedule_again(current: DataFrame | None, history: DataFrame | None) -> DataFrame | None:
    """hashes_again() of the ids in both training sheets."""
    return hashes_again(*[
        _held(staged, old).select(legacy_key(*_schedule_cells(old))) for staged, old in ((current, False), (history, True)) if staged is not None
    ])


def schedule_rows(
    staged: DataFrame,
    clients: DataFrame,
    employees: DataFrame,
    as_of: Column,
    history: bool = False,
    year: int = fv.DEFAULT_SCHEDULE_YEAR,
    compat: bool = False,
    again: DataFrame | None = None,
) -> DataFrame:
    """Training sheets: trainings_cur, or trainings_hst with history=True.

    Rows without a date or without a known client are left out; the employee may be unknown.  `again`, of
    schedule_again(), as in sales_rows().
    """
    c = F.col
    day, start, client = _schedule_cells(history)
    end, employee = (c(n) for n in (("end_time", "employee") if history else ("konets", "sotrudnik")))
    kind, category, comment = (
        c(n) for n in (
            ("product_type", "product_category", "comment") if history else ("tip", "kategoriya", "kommentariy")
        )
    )
    today = F.to_date(as_of)
    date = (
        dates.schedule_date_history(day, today, compat) if history
        else dates.schedule_date(day, today, year, compat)
    )

    def rows(wanted: DataFrame) -> DataFrame:
        known = lookup_by_name(wanted, client, clients, "name", "legacy_id", "client_id")
        known = lookup_by_name(known, employee, employees, "full_name", "id", "employee_id", how="left")
        return known.select(
            legacy_key(day, start, client).alias("legacy_id"),
            c("__row_hash").alias("row_hash"),
            F.lit("trainings_hst" if history else "trainings_cur").alias("source"),
            date.alias("date"),
            dates.clock_time(start, fv.DEFAULT_START).alias("start_time"),
            dates.clock_time(end, fv.DEFAULT_END).alias("end_time"),
            blank_to(c("status"), fv.FREE_SLOT).alias("status"),
            blank_to_null(kind).alias("type"),
            blank_to_null(category).alias("category"),
            blank_to_null(comment).alias("comment"),
            "client_id",
            "employee_id",
            "_row_index",
        )

    return _rows_per_key(_held(staged, history), legacy_key(day, start, client), rows, again)


def lost_cells(sheet: str, columns: list[str], year: int = fv.DEFAULT_SCHEDULE_YEAR, compat: bool = False) -> dict[str, Column]:
    """For each typed column of a staged sheet that is there: whether the transforms lose the cell's text to 0, NULL or a default."""
    no_time, no_day = F.lit(None).cast("timestamp"), F.lit(None).cast("date")
    readings = {"money": amount, "whole": whole, "born": dates.birth_date, "clock": lambda c: dates.clock_time(c, ""),
                "sold": lambda c: dates.sales_date(c, no_time, compat),
                "held": lambda c: dates.schedule_date(c, no_day, year, compat),
                "was_held": lambda c: dates.schedule_date_history(c, no_day, compat)}
    typed = {
        "clients_cur": {"born": ["data_rozhdeniya_rebenka"]},
        "clients_hst": {"born": ["child_birth_date"]},
        "sales_cur": {"sold": ["data"], "whole": ["kolichestvo"],
                      "money": ["polnaya_stoimost", "skidka", "okonchatelnaya_stoimost", "nalichnye", "perevod", "terminal", "vdolg"]},
        "sales_hst": {"sold": ["date"], "whole": ["quantity"], "money": ["full_price", "final_price"]},
        "trainings_cur": {"held": ["data"], "clock": ["nachalo", "konets"]},
        "trainings_hst": {"was_held": ["date"], "clock": ["start_time", "end_time"]},
    }[sheet]
    return {c: lost(F.col(c), readings[kind](F.col(c))) for kind, names in typed.items() for c in names if c in columns}


def history_over_current(current: DataFrame | None, history: DataFrame | None) -> DataFrame | None:
    """The rows of both, one per key: on equal keys history wins."""
    if current is None or history is None:
        one = history if current is None else current
        return one if one is None else one.drop(_AGAIN)
    ranked = current.withColumn("__rank", F.lit(1)).unionByName(history.withColumn("__rank", F.lit(0)))
    if _AGAIN not in ranked.columns:
        return first_per_key(ranked, ["legacy_id"], ["__rank"]).drop("__rank")
    more = first_per_key(ranked.where(F.col(_AGAIN)), ["legacy_id"], ["__rank"])
    return ranked.where(~F.col(_AGAIN)).unionByName(more).drop("__rank", _AGAIN)


def merge_current_then_history(target: DataFrame, current: DataFrame | None, history: DataFrame | None, now: Column) -> DataFrame:
    """Upserts the current rows, then the historical ones: on equal keys history wins.

    The two are combined by key first, so the target is joined once.
    """
    rows = history_over_current(current, history)
    return target if rows is None else upsert(target, rows, "legacy_id", now)


def new_employees(existing: DataFrame, *trainings: tuple[DataFrame, str]) -> DataFrame:
    """Names in the training sheets that the employee table lacks."""
    return insert_absent(existing, distinct_names(*trainings), "full_name")


def seed_lookup(existing: DataFrame, rows: list[tuple], columns: str, key: str) -> DataFrame:
    """Seed rows (a short fixed list) that a lookup table lacks; to be appended."""
    return insert_absent(existing, existing.sparkSession.createDataFrame(rows, columns), key)
