"""Row fingerprints and name-based ids."""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rowloom import fixed_values as fv
from rowloom.functions.text import ODD, normalize_value, quoted

# Control characters that stay after white space is normalised, as JSON writes them.
_CONTROLS = {chr(i): f"\\u{i:04x}" for i in range(0x20) if not chr(i).isspace()} | {"\b": "\\b"}


def _swap(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda text, p: F.replace(text, F.lit(p[0]), F.lit(p[1])), pairs, c)


def _spell_controls(c: Column) -> Column:
    pairs = F.lit([f"{char}{spelled}" for char, spelled in _CONTROLS.items()])
    spelled = F.aggregate(pairs, c, lambda text, p: F.replace(text, F.substring(p, 1, 1), F.substring(p, 2, 6)))
    return F.when(c.rlike(r"[\x00-\x1f]"), spelled).otherwise(c)


def _cell(c: Column | str) -> Column:
    # names go through one expression text: wide sheets have many cells
    if isinstance(c, str):
        return F.expr(f"coalesce(cast({quoted(c)} AS string), '')")
    return F.coalesce(c.cast("string"), F.lit(""))


def row_hash(cols: Sequence[Column | str], exclude: Sequence[int] = ()) -> Column:
    """md5 over the normalised cells as a JSON list, in order; `exclude` lists positions to leave out.

    Most rows have no white space but single blanks.  One look at all cells together tells,
    and such rows are only trimmed and quoted.  Cells are joined by a line feed, which no
    normalised cell contains.
    """
    cells = [_cell(c) for i, c in enumerate(cols) if i not in set(exclude)]
    if not cells:
        return F.md5(F.lit("[]"))
    joined = F.concat_ws("\n", *cells)
    odd = F.concat_ws("", *cells).rlike(ODD) | joined.contains("  ")
    quotes = [("\\", "\\\\"), ('"', '\\"')]
    plain = _swap(F.trim(joined), [(" \n", "\n"), ("\n ", "\n"), *quotes])
    even = F.transform(F.array(*cells), lambda v: _spell_controls(_swap(normalize_value(v), quotes)))
    text = F.when(odd, F.array_join(even, "\n")).otherwise(plain)
    return F.md5(F.concat(F.lit('["'), F.replace(text, F.lit("\n"), F.lit('", "')), F.lit('"]')))


def legacy_key(*cols: Column) -> Column:
    """Key made of the content: md5 of the raw cells put together, NULL as ''."""
    return F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def name_uuid(name: Column, namespace: str = fv.URL_NAMESPACE) -> Column:
    """Version-5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "utf-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
