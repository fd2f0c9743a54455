"""Cells that typed columns cannot hold."""

from rowloom.operators.losses import loss_counts
from rowloom.plans import transforms
from rowloom.sources import layout


def counts(df, flags):
    return {r["column_name"]: r["lost_cells"] for r in loss_counts(df, flags).collect()}


def test_sales_cells(spark):
    rows = [("01.02.2024", "2", "1 250,50 руб.", "-"), ("когда-то", "два", "даром", "5"), ("31.02.2024", "1.5", "", None), (None, " ", "  ", "1-2"), ("", None, None, "")]
    df = spark.createDataFrame(rows, "data string, kolichestvo string, okonchatelnaya_stoimost string, skidka string")
    flags = transforms.lost_cells("sales_cur", df.columns)
    assert set(flags) == set(df.columns)
    assert counts(df, flags) == {"data": 2, "kolichestvo": 2, "okonchatelnaya_stoimost": 1, "skidka": 2}
    assert counts(df.limit(0), flags) == dict.fromkeys(flags, 0)
    assert counts(df, {}) == {}


def test_training_and_client_cells(spark):
    df = spark.createDataFrame([("05.04.", "9:00", "25:10"), ("05.04.24", "", None), ("завтра", "рано", "24:00"), (" ", " ", "24:01")], "data string, nachalo string, konets string")
    assert counts(df, transforms.lost_cells("trainings_cur", df.columns)) == {"data": 1, "nachalo": 1, "konets": 2}
    born = spark.createDataFrame([("01.02.2015",), ("01.02.15",), ("",), (None,), ("30.02.2015",)], "child_birth_date string")
    assert counts(born, transforms.lost_cells("clients_hst", born.columns)) == {"child_birth_date": 2}


def test_layout_cells(spark):
    df = spark.createDataFrame([("k", "5", "x", 1), ("l", "", "3.50", 2), ("m", "five", None, 3)], "legacy_id string, quantity string, full_price string, other int")
    assert counts(df, layout.misfits(df, layout.SALES)) == {"quantity": 1, "full_price": 1}
