"""Pieces of DuckDB SQL the oracles are put together from."""

from __future__ import annotations

from harness.fixtures import fixture_sql
from rowloom import fixed_values as fv

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def with_fixtures(*names: str, more: str = "") -> str:
    parts = [f"{n} AS ({fixture_sql(n)})" for n in names]
    return "WITH " + ",\n".join(parts + ([more] if more else [])) + "\n"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(listed: tuple[str, ...]) -> str:
    return ", ".join(map(quoted, listed))


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def norm(c: str) -> str:
    return f"coalesce(trim(regexp_replace({c}, '{WS}+', ' ', 'g')), '')"


def cleaned(c: str) -> str:
    return f"(CASE WHEN lower({strip(c)}) IN ({words(fv.BLANK_WORDS)}) THEN NULL ELSE {strip(c)} END)"


def numeric_text(c: str) -> str:
    packed = f"replace(regexp_replace({cleaned(c)}, '{WS}+', '', 'g'), ',', '.')"
    return f"regexp_replace({packed}, '{fv.UNIT_SUFFIX}', '')"


def numeric(c: str) -> str:
    s = strip(f"replace(replace(replace({c}, chr(160), ''), ' ', ''), ',', '.')")
    return f"(CASE WHEN regexp_matches({s}, '{NUM}') THEN try_cast({s} AS DOUBLE) END)"


def boolean_exact(c: str) -> str:
    s = strip(c)
    return f"(CASE WHEN {s} IN ({words(fv.TRUE_WORDS_EXACT)}) THEN true WHEN {s} IN ({words(fv.FALSE_WORDS_EXACT)}) THEN false END)"


def text(c: str) -> str:
    return f"(CASE WHEN {strip(c)} IN ({words(fv.BLANK_WORDS_EXACT)}) THEN NULL ELSE {strip(c)} END)"


def row_hash(*cells: str) -> str:
    """Over cells given as SQL expressions."""
    escaped = [f"""replace(replace({norm(c)}, '\\', '\\\\'), '"', '\\"')""" for c in cells]
    return f"""md5('["' || concat_ws('", "', {', '.join(escaped)}) || '"]')"""


def legacy(*cells: str) -> str:
    return "md5(" + " || ".join(f"coalesce({c}, '')" for c in cells) + ")"


def n(c: str) -> str:
    return f"nullif(trim({c}), '')"


def amount(c: str) -> str:
    kept = rf"regexp_replace(replace(regexp_replace({c}, '[^0-9,.-]', '', 'g'), ',', '.'), '(\d)\.$', '\1')"
    return f"(CASE WHEN regexp_matches({kept}, '{PLAIN}') THEN try_cast({kept} AS DECIMAL(18,2)) END)"


def money(c: str) -> str:
    return f"coalesce({amount(c)}, 0)"


def whole(c: str) -> str:
    return rf"(CASE WHEN regexp_matches(trim({c}), '^[+-]?\d+$') THEN try_cast(trim({c}) AS INTEGER) END)"


def integer(c: str) -> str:
    return f"coalesce({whole(c)}, 1)"


def _full(found: str) -> str:
    return f"CAST(try_strptime({found}, '%d.%m.%Y') AS DATE)"


def _short(found: str, pivot: int = 70) -> str:
    century = f"CASE WHEN right({found}, 2) >= '{pivot}' THEN '19' ELSE '20' END"
    return f"CAST(try_strptime(left({found}, 6) || {century} || right({found}, 2), '%d.%m.%Y') AS DATE)"


def find(c: str, pattern: str) -> str:
    return f"regexp_extract({c}, '{pattern}')"


D4, D2 = r"\d{2}\.\d{2}\.\d{4}", r"\d{2}\.\d{2}\.\d{2}"


def has(c: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({c}, '{pattern}'), false)"


ANY = r"\d{2}\.\d{2}\.(?:\d{4}|\d{2})"


def _first(c: str) -> str:
    found = f"coalesce({find(c, ANY)}, '')"
    return f"WHEN length({found}) = 10 THEN {_full(found)} WHEN length({found}) = 8 THEN {_short(found)}"


def found_date(c: str) -> str:
    return f"(CASE {_first(c)} END)"


def sales_date(c: str, as_of: str, compat: bool = False) -> str:
    short = f"WHEN {has(c, D2)} THEN {_short(find(c, D2))}"
    now = f"CAST(TIMESTAMP '{as_of}' AS DATE)"
    # all instants used here are midnights
    return f"CAST(CASE {short if compat else _first(c)} ELSE {now} END AS TIMESTAMP)"


def schedule_date(c: str, as_of: str, year: int = 2025, compat: bool = False) -> str:
    bare, now = r"^\d{2}\.\d{2}\.", f"CAST(TIMESTAMP '{as_of}' AS DATE)"
    if compat:
        glued = f"left({c} || '{year}', 10)"
        return f"(CASE WHEN {has(c, bare)} THEN {_full(glued)} WHEN {has(c, D2)} THEN {_short(find(c, D2))} ELSE {now} END)"
    in_year = _full(f"left({c}, 6) || '{year}'")
    return f"(CASE {_first(c)} WHEN {has(c, bare)} THEN {in_year} ELSE {now} END)"


def schedule_date_hst(c: str, as_of: str) -> str:
    return f"(CASE {_first(c)} ELSE CAST(TIMESTAMP '{as_of}' AS DATE) END)"


def birth_date(c: str) -> str:
    return f"(CASE WHEN {has(c, '^' + D4 + '$')} THEN {_full(c)} END)"


def clock(c: str, default: str) -> str:
    found = rf"coalesce(nullif(regexp_extract(trim({c}), '^\d{{1,2}}:\d{{2}}'), ''), '{default}')"
    hh = f"CAST(split_part({found}, ':', 1) AS INTEGER)"
    mm = f"CAST(split_part({found}, ':', 2) AS INTEGER)"
    ok = f"({hh} < 24 AND {mm} < 60) OR ({hh} = 24 AND {mm} = 0)"
    return f"(CASE WHEN {ok} THEN lpad(CAST({hh} AS VARCHAR), 2, '0') || ':' || lpad(CAST({mm} AS VARCHAR), 2, '0') || ':00' END)"


def serial(c: str) -> str:
    s = strip(c)
    spelled = [
        (r"^\d{1,2}\.\d{1,2}\.\d{4}$", f"try_strptime({s}, '%d.%m.%Y')"),
        (r"^\d{1,2}\.\d{1,2}\.\d{2}$",
         f"try_strptime(left({s}, length({s}) - 2) || CASE WHEN right({s}, 2) >= '69' THEN '19' ELSE '20' END || right({s}, 2), '%d.%m.%Y')"),
        (r"^\d{4}-\d{1,2}-\d{1,2}$", f"try_strptime({s}, '%Y-%m-%d')"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", f"try_strptime({s}, '%d/%m/%Y')"),
    ]
    branches = " ".join(f"WHEN regexp_matches({s}, '{p}') THEN {e}" for p, e in spelled)
    return (f"(CASE WHEN regexp_matches({s}, '{NUM}') THEN "
            f"make_timestamp(CAST(round_even((CAST({s} AS DOUBLE) - 25569) * 86400000000.0, 0) AS BIGINT)) {branches} END)")


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def slug(c: str) -> str:
    s = f"lower({c})"
    for letter, spelled in fv.TRANSLIT.items():
        s = f"replace({s}, '{letter}', '{spelled}')"
    s = f"trim(regexp_replace(regexp_replace({s}, '[^a-z0-9_]', '', 'g'), '_+', '_', 'g'), '_')"
    return (f"(CASE WHEN coalesce({c}, '') = '' THEN 'col_unknown' WHEN {s} = '' THEN 'col_unnamed' "
            f"WHEN regexp_matches({s}, '^[0-9]') THEN 'col_' || {s} ELSE {s} END)")
