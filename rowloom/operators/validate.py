"""Checking rows against contracts and tables against constraints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rowloom import fixed_values as fv
from rowloom.functions.slug import slugify
from rowloom.functions.text import PLAIN_NUMBER, SPACE, is_blank, logged_value, strip, strip_weekday
from rowloom.sources.contracts import Contract, Rule

_ERROR = "struct<column:string,value:string,error_type:string,message:string>"


def _cell(rule: Rule, columns: Sequence[str]) -> Column | None:
    """The cell a rule speaks of: by name, else by slug; None if the table has neither."""
    names = [n for n in dict.fromkeys((rule.name, slugify(rule.name))) if n in columns]
    return F.coalesce(*[F.col(f"`{n}`").cast("string") for n in names]) if names else None


def _error(rule: Rule, value: Column, error_type: str) -> Column:
    before, _, after = fv.MESSAGES[error_type].replace("{column}", rule.name).replace(
        "{formats}", "None" if rule.formats is None else str(list(rule.formats))
    ).partition("{value}")
    has_value = "{value}" in fv.MESSAGES[error_type]
    message = F.concat(F.lit(before), value, F.lit(after)) if has_value else F.lit(before)
    return F.struct(
        F.lit(rule.name).alias("column"),
        value.alias("value"),
        F.lit(error_type).alias("error_type"),
        message.alias("message"),
    ).cast(_ERROR)


def _missing(rule: Rule, cell: Column | None, compat: bool) -> Column:
    if cell is None:
        return _error(rule, F.lit(None).cast("string"), "MISSING_REQUIRED")
    lacking = is_blank(cell)
    if compat and rule.type not in ("string", "integer"):
        lacking = cell.isNotNull() & lacking
    return F.when(lacking, _error(rule, cell, "MISSING_REQUIRED"))


def _bad_integer(rule: Rule, cell: Column, compat: bool) -> Column:
    fits = cell.rlike(rf"^{SPACE}*[+-]?\d+(\.0+)?{SPACE}*$")
    seen = cell.isNotNull() if compat else ~is_blank(cell)
    return F.when(seen & ~fits, _error(rule, cell, "INVALID_INTEGER"))


def _bad_money(cell: Column) -> Column:
    kept = F.replace(F.regexp_replace(cell, r"[^\d,.-]", ""), F.lit(","), F.lit("."))
    return ~kept.rlike(PLAIN_NUMBER)


def _bad_date(cell: Column, formats: Sequence[str] | None) -> Column:
    shapes = [fv.DATE_SHAPES[f] for f in (formats or fv.DATE_SHAPES) if f in fv.DATE_SHAPES]
    plain = strip_weekday(strip(cell))
    return ~reduce(lambda a, b: a | b, [plain.rlike(s) for s in shapes])


def _bad_shape(rule: Rule, cell: Column) -> Column | None:
    if rule.type == "money":
        return F.when(~is_blank(cell) & _bad_money(strip(cell)), _error(rule, cell, "INVALID_MONEY"))
    if rule.type == "date":
        return F.when(~is_blank(cell) & _bad_date(cell, rule.formats), _error(rule, cell, "INVALID_DATE"))
    if rule.type == "time":
        return F.when(~is_blank(cell) & ~strip(cell).rlike(fv.TIME_SHAPE), _error(rule, cell, "INVALID_TIME"))
    return None


def validate(df: DataFrame, contract: Contract, compat: bool = False) -> DataFrame:
    """Adds `is_blank` (all required cells blank: such rows are not checked) and `errors`.

    compat=True reports as the older loader did: a blank cell of an optional integer is an
    error, NULL in a required date, money or time cell is none.
    """
    cells = {r: _cell(r, df.columns) for r in contract.rules}
    required = [cells[r] for r in contract.required if cells[r] is not None]
    blank = F.forall(F.array(*required), is_blank) if required else F.lit(True)
    checks = [_missing(r, cells[r], compat) for r in contract.required]
    present = [(r, c) for r, c in cells.items() if c is not None]
    checks += [_bad_integer(r, c, compat) for r, c in present if r.type == "integer"]
    checks += [e for e in (_bad_shape(r, c) for r, c in present) if e is not None]
    none = F.array().cast(f"array<{_ERROR}>")
    errors = F.when(blank, none).otherwise(F.array_compact(F.array(*checks)) if checks else none)
    return df.withColumns({"is_blank": blank, "errors": errors})


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(~F.col("is_blank") & (F.size("errors") == 0)).drop("is_blank", "errors")


def validation_summary(validated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of a checked table (optionally per group), with the report's alert flag."""
    ok = ~F.col("is_blank") & (F.size("errors") == 0)
    totals = validated.groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        F.count_if(ok).alias("valid_rows"),
        F.count_if(F.col("is_blank")).alias("blank_rows"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("total_errors"),
        F.coalesce(F.max(F.size("errors")), F.lit(0)).alias("max_row_errors"),
    )
    bad = F.col("total_rows") - F.col("valid_rows")
    rate = F.when(F.col("total_rows") == 0, 0.0).otherwise(bad / F.col("total_rows"))
    return totals.select(
        *by,
        "total_rows",
        "valid_rows",
        "blank_rows",
        bad.alias("error_count"),
        rate.alias("error_rate"),
        "total_errors",
        "max_row_errors",
        (F.col("total_errors") == 0).alias("is_valid"),
        ((bad > fv.REPORT_BAD_ROWS) | (rate > fv.REPORT_ERROR_RATE)).alias("over_threshold"),
    )


def error_thresholds(
    summary: DataFrame, max_errors: int = fv.MAX_ERRORS, max_per_row: int = fv.MAX_ERRORS_PER_ROW
) -> DataFrame:
    """Adds the two reasons for which a load stops."""
    return summary.withColumns(
        {
            "too_many_errors": F.col("total_errors") > max_errors,
            "broken_rows": F.col("max_row_errors") > max_per_row,
        }
    )


class ValidationFailed(ValueError):
    """A table has more errors than a load may have."""


def require_thresholds(summary_row, table: str) -> None:
    """Raises for one row of error_thresholds() that is over a limit."""
    if summary_row["too_many_errors"]:
        raise ValidationFailed(f"{summary_row['total_errors']} errors in {table}")
    if summary_row["broken_rows"]:
        raise ValidationFailed(f"{table} has rows with {summary_row['max_row_errors']} errors; did its format change?")


def validation_log(validated: DataFrame, run_id: str, table: str, row_index: Column, created_at: Column) -> DataFrame:
    """One log row per error; `row_index` counts data rows from 0."""
    return (
        validated.where(F.size("errors") > 0)
        .select(row_index.cast("long").alias("row_index"), F.explode("errors").alias("e"))
        .select(
            F.lit(run_id).alias("run_id"),
            F.lit(table).alias("table_name"),
            "row_index",
            F.col("e.column").alias("column_name"),
            logged_value(F.col("e.value")).alias("invalid_value"),
            "e.error_type",
            "e.message",
            created_at.alias("created_at"),
        )
    )


def first_errors(log: DataFrame, n: int = fv.SAMPLE_ERRORS) -> DataFrame:
    """The errors shown in a report: the first few by row, then by column."""
    return log.orderBy("row_index", "column_name", "error_type").limit(n)


@dataclass(frozen=True)
class Check:
    """A row-level constraint: `holds` must not be false (NULL passes, as in SQL)."""

    name: str
    holds: Column


def not_null(column: str) -> Check:
    return Check(f"not_null:{column}", F.col(column).isNotNull())


def allowed(column: str, values: Sequence[str]) -> Check:
    return Check(f"allowed:{column}", F.col(column).isin(*values))


def ordered(low: str, high: str) -> Check:
    return Check(f"ordered:{low}<{high}", F.col(low) < F.col(high))


def within(column: str, low: Column, high: Column) -> Check:
    return Check(f"within:{column}", F.col(column).between(low, high))


def max_length(column: str, n: int) -> Check:
    return Check(f"max_length:{column}", F.length(column) <= n)


def check_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(constraint, violations) of row-level checks, all counted in one pass."""
    counts = df.agg(*[F.count_if(~c.holds).alias(f"c{i}") for i, c in enumerate(checks)])
    pairs = [F.struct(F.lit(c.name).alias("constraint"), F.col(f"c{i}").alias("violations"))
             for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*pairs)))


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key; rows with a NULL in the key are free to repeat."""
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    per_key = df.where(full).groupBy(*key).agg((F.count("*") - 1).alias("extra"))
    total = F.coalesce(F.sum("extra"), F.lit(0)).cast("long")
    return per_key.agg(total.alias("violations")).select(F.lit("unique:" + ",".join(key)).alias("constraint"), "violations")


def check_reference(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows that point at no parent.  Counted per key first, so hot keys do not travel."""
    used = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("k")).distinct()
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long")
    return used.join(known, "k", "left_anti").agg(total.alias("violations")).select(
        F.lit(f"reference:{column}").alias("constraint"), "violations"
    )
