"""Cleaning a whole table by what its column names say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowloom import fixed_values as fv
from rowloom.functions.dates import serial_date
from rowloom.functions.text import clean_boolean, clean_numeric, clean_text

_CLEANERS = {
    "service": lambda c: c,
    "date": serial_date,
    "numeric": clean_numeric,
    "boolean": clean_boolean,
    "text": clean_text,
}


def column_kind(name: str) -> str:
    """service, date, numeric, boolean or text; the first that fits, in this order."""
    lower = name.lower()
    if name in fv.SERVICE_COLUMNS:
        return "service"
    if any(word in lower for word in fv.DATE_KEYWORDS):
        return "date"
    if any(word in lower for word in fv.NUMERIC_KEYWORDS):
        return "numeric"
    return "boolean" if name in fv.BOOLEAN_COLUMNS else "text"


def clean_columns(df: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """Every column cleaned by its kind; `kinds` overrides the kind of single columns."""
    types = dict(df.dtypes)

    def cleaned(name: str) -> Column:
        kind = (kinds or {}).get(name) or column_kind(name)
        if kind == "date" and types[name] in ("timestamp", "timestamp_ntz"):
            return F.col(name)
        c = F.col(name)
        if kind == "boolean" and types[name] not in ("string", "boolean"):
            c = F.when(c == 1, "1").when(c == 0, "0")
        return _CLEANERS[kind](c).alias(name)

    return df.select(*[cleaned(name) for name in df.columns])
