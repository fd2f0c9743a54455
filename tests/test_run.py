"""Whole runs on a small set of sheets, twice, with changes in between."""

import os
import threading
from datetime import datetime, timedelta

import pytest

from rowloom.operators.ledger import run_state
from rowloom.plans import run as running
from rowloom.plans.run import QualityFailed, Settings, Source, run
from rowloom.sources import sinks
from rowloom.sources.contracts import Contract, Rule

CUR_SALES = Contract("sales", (
    Rule("data", "date", True), Rule("klient", "string", True), Rule("produkt", "string", True), Rule("tip"), Rule("kategoriya"),
    Rule("kolichestvo", "integer"), Rule("polnaya_stoimost", "money"), Rule("skidka", "money"), Rule("okonchatelnaya_stoimost", "money"),
    Rule("nalichnye", "money"), Rule("perevod", "money"), Rule("terminal"), Rule("vdolg"), Rule("kommentariy"), Rule("admin"), Rule("trener")))
CLIENTS = Contract("clients", (Rule("klient", "string", True), Rule("mobilnyy"), Rule("imya_rebenka"), Rule("data_rozhdeniya_rebenka"), Rule("tip")))
TRAININGS = Contract("schedule", (Rule("data", "date", True), Rule("nachalo", "time"), Rule("konets", "time"), Rule("klient"), Rule("sotrudnik"),
                                  Rule("status"), Rule("tip"), Rule("kategoriya"), Rule("kommentariy")))
CONTRACTS = {"sales": CUR_SALES, "clients": CLIENTS, "schedule": TRAININGS}


def write(path, header, rows):
    path.write_text("\n".join([",".join(header), *(",".join(r) for r in rows)]), "utf-8")


def sheets(folder, clients, sales, trainings):
    write(folder / "clients.csv", ["record_id", "Клиент", "Мобильный", "Имя ребенка", "Дата рождения ребенка", "Тип"], clients)
    write(folder / "sales.csv", ["record_id", "Дата", "Клиент", "Продукт", "Тип", "Категория", "Количество", "Полная стоимость", "Скидка",
                                 "Окончательная стоимость", "Наличные", "Перевод", "Терминал", "Вдолг", "Комментарий", "Админ", "Тренер"], sales)
    write(folder / "trainings.csv", ["record_id", "Дата", "Начало", "Конец", "Статус", "Тип", "Категория", "Комментарий", "Клиент", "Сотрудник"], trainings)


def sale(i, day, who, what, price):
    return [str(i), day, who, what, "", "", "1", price, "", price, price, "", "", "", "", "", ""]


def settings(folder, now, **more):
    def src(n, name):
        return Source(f"stg_gsheets.{n}", str(folder / f"{name}.csv"), pk="record_id", numeric=("polnaya_stoimost",) if "sales" in n else ())

    more.setdefault("export_path", str(folder / "mart"))
    return Settings(sources=[src("clients_cur", "clients"), src("sales_cur", "sales"), src("trainings_cur", "trainings")],
                    contracts=CONTRACTS, now=now, schedule_year=2024, **more)


@pytest.fixture
def clean_catalog(spark):
    yield
    for db in ("raw", "stg_gsheets", "core", "lookups", "analytics", "ops"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_two_runs(spark, tmp_path, clean_catalog):
    day1 = datetime(2024, 5, 1, 6)
    sheets(tmp_path,
           [["1", "Анна", "+7 900", "Оля", "01.02.2015", "vip"], ["2", "Борис", "", "", "", ""], ["3", "Вера", "+7 901", "", "весной", ""]],
           [sale(1, "01.04.24", "Анна", "Абонемент 8 занятий", "1 000 руб."), sale(2, "02.04.24", "Борис", "Разовое", "200"), sale(3, "03.04.24", "Нет такого", "Разовое", "1")],
           [["1", "05.04.", "9:00", "10:00", "Посетили", "", "", "", "Анна", "Тренер"], ["2", "06.04.", "9:00", "10:00", "Отмена", "", "", "", "Борис", "Тренер"]])
    first = run(spark, settings(tmp_path, day1))
    assert (first["status"], first["tables_processed"], first["total_rows_synced"], first["transforms"], first["exported"]) == ("success", 3, 8, 4, True)
    assert first["issue_count"] == 0
    balances = {r["Клиент"]: (r["Куплено"], r["Использовано"], r["Остаток"]) for r in spark.table("analytics.v_client_balances").collect()}
    assert balances == {"Анна": (8, 1, 7), "Борис": (1, 0, 1)}
    assert {r.full_name for r in spark.table("lookups.employees").collect()} == {"Тренер", "Система", "Администратор"}
    assert {r.name for r in spark.table("lookups.expense_categories").collect()} == {"Аренда", "Зарплата", "Материалы"}
    assert spark.table("core.schedule").where("employee_id IS NOT NULL").count() == 2

    # Борис's sale is corrected, Вера leaves, a new sale comes, a training goes
    day2 = day1 + timedelta(days=40)
    sheets(tmp_path,
           [["1", "Анна", "+7 900", "Оля", "01.02.2015", "vip"], ["2", "Борис", "", "", "", ""]],
           [sale(1, "01.04.24", "Анна", "Абонемент 8 занятий", "1 000 руб."), sale(2, "02.04.24", "Борис", "Абонемент 4 занятия", "800"), sale(4, "09.04.24", "Анна", "Разовое", "1")],
           [["1", "05.04.", "9:00", "10:00", "Посетили", "", "", "", "Анна", "Тренер"]])
    dry = run(spark, settings(tmp_path, day2, dry_run=True))
    assert dry["total_rows_synced"] == 2 and spark.table("stg_gsheets.sales_cur").where("record_id = '4'").isEmpty()
    second = run(spark, settings(tmp_path, day2))
    figures = {t["table"]: (t["inserted"], t["updated"], t["deleted"], t["unchanged"]) for t in second["tables"]}
    assert figures == {"stg_gsheets.clients_cur": (0, 0, 1, 2), "stg_gsheets.sales_cur": (1, 1, 1, 1), "stg_gsheets.trainings_cur": (0, 0, 1, 1)}
    assert second["dumps_expired"] == 8
    # Вера's birthday could not be read; Вера is gone since
    assert (first["lost_cells"], second["lost_cells"]) == (1, 0)
    lost = spark.table("ops.cell_losses").collect()
    assert [(r.run_id, r.table_name, r.column_name, r.lost_cells) for r in lost] == [(first["run_id"], "stg_gsheets.clients_cur", "data_rozhdeniya_rebenka", 1)]
    balances = {r["Клиент"]: (r["Куплено"], r["Использовано"], r["Остаток"]) for r in spark.table("analytics.v_client_balances").collect()}
    assert balances == {"Анна": (9, 1, 8), "Борис": (4, 0, 4)}
    gone = {r.name: r.status for r in spark.table("core.clients").where("is_deleted").collect()}
    assert gone == {"Вера": "deleted"}
    ledger = sorted((r.status, r.mode) for r in spark.table("ops.elt_runs").collect())
    assert ledger == [("running", "cdc")] * 3 + [("success", "cdc")] * 3
    assert spark.table("ops.elt_table_stats").count() == 6
    assert spark.table("lookups.employees").count() == spark.table("lookups.expense_categories").count() == 3


def test_unmodified_sheets_are_passed_over(spark, tmp_path, clean_catalog):
    day = datetime(2024, 5, 1, 6)
    people = [["1", "Анна", "+7 900", "", "", ""]]
    sheets(tmp_path, people, [sale(1, "01.04.24", "Анна", "Разовое", "1")], [["1", "05.04.", "9:00", "10:00", "Посетили", "", "", "", "Анна", "Тренер"]])
    gate = {"check_modified": True, "skip_transform": True, "run_exports": False}
    assert run(spark, settings(tmp_path, day, **gate))["tables_processed"] == 3
    assert run(spark, settings(tmp_path, day, **gate))["tables_processed"] == 0
    later = (tmp_path / "sales.csv").stat().st_mtime + 60
    os.utime(tmp_path / "sales.csv", (later, later))
    assert [t["table"] for t in run(spark, settings(tmp_path, day, **gate))["tables"]] == ["stg_gsheets.sales_cur"]
    assert run(spark, settings(tmp_path, day, **gate))["tables_processed"] == 0
    assert spark.table("ops.source_state").count() == 4
    # an older file in its place is a change as well, and so is one of another length at the same time
    os.utime(tmp_path / "sales.csv", (later - 9000, later - 9000))
    assert [t["table"] for t in run(spark, settings(tmp_path, day, **gate))["tables"]] == ["stg_gsheets.sales_cur"]
    assert run(spark, settings(tmp_path, day, **gate))["tables_processed"] == 0
    with open(tmp_path / "sales.csv", "a", encoding="utf-8") as f:
        f.write("\n")
    os.utime(tmp_path / "sales.csv", (later - 9000, later - 9000))
    assert [t["table"] for t in run(spark, settings(tmp_path, day, **gate))["tables"]] == ["stg_gsheets.sales_cur"]


def test_bad_sheets(spark, tmp_path, clean_catalog):
    day = datetime(2024, 5, 1)
    # repeated record ids are critical; a sheet with too many errors is left out
    sheets(tmp_path, [["1", "Анна", "", "", "", ""], ["1", "Борис", "", "", "", ""]],
           [sale(i, "плохо", "Анна", "x", "дорого") for i in range(60)], [["", "", "", "", "", "", "", "", "", ""]])
    with pytest.raises(QualityFailed):
        run(spark, settings(tmp_path, day))
    assert spark.catalog.tableExists("stg_gsheets.clients_cur")
    assert not spark.catalog.tableExists("stg_gsheets.sales_cur") and not spark.catalog.tableExists("stg_gsheets.trainings_cur")
    # per row: the date and the three amounts filled
    assert spark.table("ops.validation_logs").count() == 60 * 4
    assert sorted(r.status for r in spark.table("ops.elt_runs").collect()) == ["failed", "running"]


def test_a_broken_source_makes_the_run_partial(spark, tmp_path, clean_catalog):
    day = datetime(2024, 5, 1, 6)
    people = [["1", "Анна", "+7 900", "Оля", "01.02.2015", "vip"], ["2", "Борис", "", "", "", ""]]
    sales = [sale(1, "01.04.24", "Анна", "Абонемент 8 занятий", "1 000 руб.")]
    visits = [["1", "05.04.", "9:00", "10:00", "Посетили", "", "", "", "Анна", "Тренер"]]
    sheets(tmp_path, people, sales, visits)
    assert run(spark, settings(tmp_path, day))["status"] == "success"
    # nothing has changed: no staged table is rewritten
    before = {n: sinks.shown_version(spark, f"stg_gsheets.{n}") for n in ("clients_cur", "sales_cur", "trainings_cur")}
    again = run(spark, settings(tmp_path, day))
    assert again["total_rows_synced"] == 0 and before == {n: sinks.shown_version(spark, f"stg_gsheets.{n}") for n in before}

    sheets(tmp_path, people, [sale(i, "плохо", "Анна", "x", "дорого") for i in range(60)], visits)
    third = run(spark, settings(tmp_path, day))
    assert third["status"] == "partial" and third["transforms"] == 2
    assert list(third["failed"]) == ["stg_gsheets.sales_cur", "core.sales", "analytics.v_client_balances"]
    state = run_state(spark.table("ops.elt_runs")).where("status = 'partial'").first()
    assert "stg_gsheets.sales_cur" in state.error_message and "core.sales: not built" in state.error_message
    assert spark.table("core.sales").where("NOT is_deleted").count() == 1
    # with other limits the same sheet loads
    assert run(spark, settings(tmp_path, day, max_errors=1000))["failed"] == {}


def test_a_sheet_that_is_not_staged_deletes_nothing(spark, tmp_path, clean_catalog):
    day = datetime(2024, 5, 1, 6)
    sheets(tmp_path, [["1", "Анна", "+7 900", "", "", ""], ["2", "Борис", "", "", "", ""]], [sale(1, "01.04.24", "Анна", "Разовое", "1")],
           [["1", "05.04.", "9:00", "10:00", "Посетили", "", "", "", "Анна", "Тренер"]])
    (tmp_path / "old.csv").write_text("client_full,phone_mobile,child_name,child_birth_date,product_type\nГалина,+7 955,,,\n", "utf-8")
    s = settings(tmp_path, day)
    old = Source("stg_gsheets.clients_hst", str(tmp_path / "old.csv"))
    s.sources = [*s.sources, old]
    assert run(spark, s)["failed"] == {}
    sinks.drop_table(spark, "stg_gsheets.clients_hst")
    sheets(tmp_path, [["1", "Анна", "+7 900", "", "", ""]], [sale(1, "01.04.24", "Анна", "Разовое", "1")],
           [["1", "05.04.", "9:00", "10:00", "Посетили", "", "", "", "Анна", "Тренер"]])
    run(spark, settings(tmp_path, day))
    assert {r.name for r in spark.table("core.clients").where("is_deleted").collect()} == {"Борис"}
    assert {r.name for r in spark.table("core.clients").where("NOT is_deleted").collect()} == {"Анна", "Галина"}


def test_sources_are_loaded_side_by_side(spark, tmp_path, clean_catalog, monkeypatch):
    """Each source waits until another one is being loaded; one failure stays its own, and the ledger has the others."""
    both, pools, load = threading.Barrier(2, timeout=120), {}, running.sync_table

    def met(session, source, *rest):
        pools[source.table] = session.sparkContext.getLocalProperty("spark.scheduler.pool")
        both.wait()
        if source.table.endswith("sales_cur"):
            raise ValueError("no such sheet")
        return load(session, source, *rest)

    sheets(tmp_path, [["1", "Анна", "+7 900", "", "", ""]], [sale(1, "01.04.24", "Анна", "Разовое", "1")],
           [["1", "05.04.", "9:00", "10:00", "Посетили", "", "", "", "Анна", "Тренер"]])
    s = settings(tmp_path, datetime(2024, 5, 1, 6), sources_at_once=2, skip_transform=True, run_exports=False)
    s.sources = s.sources[:2]
    monkeypatch.setattr(running, "sync_table", met)
    totals = run(spark, s)
    assert pools == {x.table: x.table for x in s.sources}
    assert totals["failed"] == {"stg_gsheets.sales_cur": "no such sheet"} and totals["status"] == "partial"
    assert [(r.table_name, r.rows_extracted) for r in spark.table("ops.elt_table_stats").collect()] == [("stg_gsheets.clients_cur", 1)]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_sources_side_by_side_as_one_after_the_other(spark, tmp_path, clean_catalog):
    """All sources append to the same dump and log, and two of them fill one table in turn."""
    def of(n):
        return [[str(i), f"имя {i}", "", "", "", ""] for i in range(n)]

    for k in range(6):
        write(tmp_path / f"c{k}.csv", ["record_id", "Клиент", "Мобильный", "Имя ребенка", "Дата рождения ребенка", "Тип"], of(k + 1) + [["x", "", "", "", "", ""]])
    sources = [Source(f"stg_gsheets.clients_{k}", str(tmp_path / f"c{k}.csv"), pk="record_id") for k in range(5)]
    sources.append(Source("stg_gsheets.clients_0", str(tmp_path / "c5.csv"), pk="record_id"))
    found = []
    for n in (1, 6):
        s = Settings(sources=sources, contracts=CONTRACTS, now=datetime(2024, 5, 1, 6), skip_transform=True, run_exports=False, sources_at_once=n)
        totals = run(spark, s)
        figures = sorted((t["table"], t["status"], t["extracted"], t["inserted"], t["deleted"], t["errors"]) for t in totals["tables"])
        logs = spark.table("ops.validation_logs").where(f"run_id = '{totals['run_id']}'").count() if spark.catalog.tableExists("ops.validation_logs") else 0
        found.append((figures, spark.table("raw.sheets_dump").count(), logs, spark.table("stg_gsheets.clients_0").count()))
        for x in sources[:5]:
            sinks.drop_table(spark, x.table)
        spark.sql("DROP TABLE raw.sheets_dump")
    assert found[0] == found[1] and found[0][1] == sum(k + 2 for k in range(6)) and found[0][3] == 7
