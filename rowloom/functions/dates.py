"""Dates and times out of text cells.

Years are put together as text ('70'..'99' are 19xx, the rest 20xx): the engines' own
two-digit pivots differ.  Dates that are not in the calendar are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowloom import fixed_values as fv
from rowloom.functions.text import NUMBER, strip

_LONG, _SHORT = r"\d{2}\.\d{2}\.\d{4}", r"\d{2}\.\d{2}\.\d{2}"
_ANY = r"\d{2}\.\d{2}\.(?:\d{4}|\d{2})"


def _century(yy: Column, pivot: int = 70) -> Column:
    return F.concat(F.when(yy >= str(pivot), "19").otherwise("20"), yy)


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.concat(y, F.lit("-"), m, F.lit("-"), d).try_cast("date")


def _find(c: Column, pattern: str) -> Column:
    """The first match, '' if there is none or no cell."""
    return F.coalesce(F.regexp_extract(c, pattern, 0), F.lit(""))


def _read(found: Column) -> Column:
    """A found dd.MM.yyyy or dd.MM.yy as a date."""
    year = F.when(F.length(found) == 10, F.substring(found, 7, 4)).otherwise(_century(F.substring(found, 7, 2)))
    return _date(year, F.substring(found, 4, 2), F.substring(found, 1, 2))


def serial_date(c: Column) -> Column:
    """A sheet's serial day number, or one of its four date spellings, as a timestamp."""
    s = strip(c.cast("string"))
    serial = F.when(s.rlike(NUMBER), s.try_cast("double"))
    micros = F.rint((serial - fv.SERIAL_UNIX_DAY) * F.lit(86400e6))
    in_range = micros.between(-62135596800e6, 253402300799e6)     # years 1 to 9999
    from_serial = F.timestamp_micros(F.when(in_range, micros).cast("long"))

    def spelled(pattern: str, y: int, m: int, d: int, short_year: bool = False) -> Column:
        part = [F.regexp_extract(s, pattern, i) for i in (1, 2, 3)]
        year = _century(part[y], pivot=69) if short_year else part[y]
        return _date(year, F.lpad(part[m], 2, "0"), F.lpad(part[d], 2, "0"))

    from_text = F.coalesce(
        spelled(r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", 2, 1, 0),
        spelled(r"^(\d{1,2})\.(\d{1,2})\.(\d{2})$", 2, 1, 0, short_year=True),
        spelled(r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 0, 1, 2),
        spelled(r"^(\d{1,2})/(\d{1,2})/(\d{4})$", 2, 1, 0),
    )
    return F.coalesce(from_serial, from_text.cast("timestamp"))


def sales_date(c: Column, as_of: Column, compat: bool = False) -> Column:
    """The first dd.MM.yyyy or dd.MM.yy in the cell; `as_of` for cells with neither.

    compat=True cuts the year after two digits, so that 15.03.2024 becomes 2020-03-15, as in
    tables filled by the older loader.
    """
    found = _find(c, _SHORT if compat else _ANY)
    return F.when(found != "", _read(found).cast("timestamp")).otherwise(as_of)


def schedule_date(c: Column, as_of: Column, year: int = fv.DEFAULT_SCHEDULE_YEAR, compat: bool = False) -> Column:
    """Current sheet: dd.MM.yyyy or dd.MM.yy, else a leading 'dd.MM.' in `year`.

    compat=True appends `year` to whatever starts with 'dd.MM.' and reads four digits.
    """
    found = _find(c, _SHORT if compat else _ANY)
    day_month = _find(c, r"^\d{2}\.\d{2}\.")
    in_year = _read(F.concat(day_month, F.lit(str(year))))
    if compat:
        glued = _read(_find(F.concat(c, F.lit(str(year))), "^" + _LONG))
        return F.when(day_month != "", glued).when(found != "", _read(found)).otherwise(as_of)
    return F.when(found != "", _read(found)).when(day_month != "", in_year).otherwise(as_of)


def schedule_date_history(c: Column, as_of: Column, compat: bool = False) -> Column:
    """Historical sheet: dd.MM.yyyy or dd.MM.yy; compat wants the long form to fill the cell."""
    found = _find(c, f"^{_LONG}$|{_SHORT}" if compat else _ANY)
    return F.when(found != "", _read(found)).otherwise(as_of)


def birth_date(c: Column) -> Column:
    return _read(F.when(c.rlike(f"^{_LONG}$"), c))


def clock_time(c: Column, default: str) -> Column:
    """'H:mm' at the start of the cell as 'HH:mm:ss' text; NULL past 24:00."""
    found = F.nullif(F.regexp_extract(F.trim(c), r"^\d{1,2}:\d{2}", 0), F.lit(""))
    hm = F.lpad(F.coalesce(found, F.lit(default)), 5, "0")
    return F.when(hm.rlike(r"^([01]\d|2[0-3]):[0-5]\d$|^24:00$"), F.concat(hm, F.lit(":00")))
