"""Numbers out of text cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from rowloom import fixed_values as fv
from rowloom.functions.text import blank_to_null

MONEY = "decimal(18,2)"


def amount(c: Column, dtype: str = MONEY) -> Column:
    """The amount in a cell ('1 250,50 руб.'); NULL where there is none."""
    kept = F.replace(F.regexp_replace(c, "[^0-9,.-]+", ""), F.lit(","), F.lit("."))
    # points at the end are what is left of a currency mark such as 'р.'
    return F.rtrim(kept, F.lit(".")).try_cast(dtype)


def money(c: Column, dtype: str = MONEY) -> Column:
    """The amount in a cell; 0 where there is none."""
    return F.coalesce(amount(c, dtype), F.lit(0).cast(dtype))


def whole(c: Column) -> Column:
    """The whole number in a cell; NULL where there is none."""
    s = blank_to_null(c)
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("int"))


def integer(c: Column, default: int = 1) -> Column:
    return F.coalesce(whole(c), F.lit(default))


def units_in_name(name: Column) -> Column:
    """Sessions in a package, read off its name; the marks are tried in their fixed order."""
    first, *rest = fv.UNIT_MARKS
    chain = reduce(
        lambda chain, n: chain.when(name.contains(str(n)), n),
        rest,
        F.when(name.contains(str(first)), first),
    )
    return chain.otherwise(1)
