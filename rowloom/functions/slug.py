"""Column names out of free-text headers, and the same mapping over data."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rowloom import fixed_values as fv

_TABLE = str.maketrans(fv.TRANSLIT)


def slugify(text: str | None) -> str:
    if not text:
        return "col_unknown"
    letters = re.sub("[^a-z0-9_]", "", str(text).lower().translate(_TABLE))
    name = re.sub("_+", "_", letters).strip("_")
    if not name:
        return "col_unnamed"
    return "col_" + name if name[0].isdigit() else name


def slug(c: Column) -> Column:
    """slugify() over a column.

    Every step stands in the expression once, so that long texts are gone through once; letters are
    spelled out only where there are any, and characters go by runs.
    """
    spelled = F.lower(c)
    letters = {k: v for k, v in fv.TRANSLIT.items() if k.isalpha()}
    one = {k: v for k, v in letters.items() if len(v) == 1}
    told = F.translate(spelled, "".join(one), "".join(one.values()))
    for letter, text in letters.items():
        if len(text) > 1:
            told = F.replace(told, F.lit(letter), F.lit(text))
    # a range, as long lists of characters are slow to look through
    spelled = F.when(c.rlike("[\u0400-\u04ff]"), told).otherwise(spelled)
    # what becomes an underscore stays for now, and all else that is not of a name goes
    gaps = "".join(re.escape(k) for k, v in fv.TRANSLIT.items() if v == "_")
    kept = F.regexp_replace(spelled, f"[^a-z0-9_{gaps}]+", "")
    s = F.trim(F.regexp_replace(kept, f"[_{gaps}]+", "_"), F.lit("_"))
    named = F.regexp_replace(F.regexp_replace(s, r"^\z", "col_unnamed"), "^(?=[0-9])", "col_")
    return F.when(F.coalesce(c == "", F.lit(True)), "col_unknown").otherwise(named)


def normalize_headers(
    headers: Sequence[str | None], table: str = "", mapping: dict[str, str] | None = None
) -> list[str]:
    """Unique column names for a header row: mapped by name first, else slugs.

    Repeats get _1, _2, ...; the `rates` sheet has positional names only.
    """
    if table == "rates":
        return [f"col_{i}" for i in range(len(headers))]
    names: list[str] = []
    for header in headers:
        base = (mapping or {}).get(header) or slugify(header)
        name, n = base, 0
        while name in names:
            n += 1
            name = f"{base}_{n}"
        names.append(name)
    return names
