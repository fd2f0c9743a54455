"""Typed layouts of the core tables, as DDL, and the step that brings rows into them."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from rowloom.operators.losses import lost

_TRACKING = (
    "row_hash string, source string, is_deleted boolean, deleted_at timestamp, "
    "created_at timestamp, updated_at timestamp"
)
_MONEY = "decimal(18,2)"

CLIENTS = (
    "legacy_id string, name string, phone string, status string, child_name string, child_dob date, "
    f"age string, balance {_MONEY}, debt {_MONEY}, spent {_MONEY}, {_TRACKING}"
)
SALES = (
    "legacy_id string, date timestamp, client_id string, product_name string, type string, category string, "
    f"quantity int, full_price {_MONEY}, discount {_MONEY}, final_price {_MONEY}, cash {_MONEY}, "
    f"transfer {_MONEY}, terminal {_MONEY}, debt {_MONEY}, comment string, admin string, trainer string, "
    + _TRACKING
)
SCHEDULE = (
    "legacy_id string, date date, start_time string, end_time string, client_id string, employee_id string, "
    f"status string, type string, category string, comment string, {_TRACKING}"
)
EXPENSES = (
    f"legacy_id string, date date, category string, amount {_MONEY}, comment string, {_TRACKING}"
)
EMPLOYEES = (
    "id string, full_name string, role string, aliases array<string>, is_active boolean, created_at timestamp"
)
PRODUCTS = (
    f"id string, name string, category string, aliases array<string>, base_price {_MONEY}, "
    "units_per_item int, is_active boolean, created_at timestamp"
)
EXPENSE_CATEGORIES = (
    "id string, name string, parent_category string, aliases array<string>, created_at timestamp"
)
RUNS = (
    "run_id string, started_at timestamp, finished_at timestamp, status string, mode string, "
    "tables_processed int, total_rows_synced bigint, validation_errors bigint, "
    "duration_seconds decimal(10,2), error_message string"
)
TABLE_STATS = (
    "run_id string, table_name string, rows_extracted bigint, rows_inserted bigint, rows_updated bigint, "
    "rows_deleted bigint, rows_unchanged bigint, validation_errors bigint, duration_ms bigint, "
    "created_at timestamp"
)
CELL_LOSSES = "run_id string, table_name string, column_name string, lost_cells bigint, created_at timestamp"
VALIDATION_LOG = (
    "run_id string, table_name string, row_index bigint, column_name string, invalid_value string, "
    "error_type string, message string, created_at timestamp"
)

_ZERO = ("balance", "debt", "spent", "full_price", "discount", "final_price", "cash", "transfer", "terminal",
         "amount", "tables_processed", "total_rows_synced", "rows_extracted", "rows_inserted", "rows_updated",
         "rows_deleted", "rows_unchanged", "validation_errors")
DEFAULTS: dict[str, Any] = {
    **{c: 0 for c in _ZERO}, "quantity": 1, "is_deleted": False, "is_active": True, "units_per_item": 1,
}


def conform(
    df: DataFrame,
    layout: str,
    now: Column,
    defaults: dict[str, Any] | None = None,
    stamped: tuple[str, ...] = ("created_at", "updated_at"),
) -> DataFrame:
    """Rows in a layout: columns cast, absent ones added, NULLs of columns with a default filled.

    Cells that do not fit their type become NULL (then the default), columns outside the
    layout are left out.
    """
    values = DEFAULTS if defaults is None else defaults

    def fitted(field: StructField) -> Column:
        kind = field.dataType.simpleString()
        c = F.lit(None).cast(kind)
        if field.name in df.columns:
            same = df.schema[field.name].dataType == field.dataType
            c = F.col(field.name) if same else F.col(field.name).try_cast(kind)
        if field.name in values:
            c = F.coalesce(c, F.lit(values[field.name]).cast(kind))
        elif field.name in stamped:
            c = F.coalesce(c, now.cast(kind))
        return c.alias(field.name)

    return df.select(*[fitted(f) for f in StructType.fromDDL(layout).fields])


def misfits(df: DataFrame, layout: str) -> dict[str, Column]:
    """For each column that conform() casts: whether the cell has text that does not fit, as loss_counts() takes them."""
    fields = {f.name: f.dataType for f in StructType.fromDDL(layout).fields}
    cast = [f.name for f in df.schema.fields if f.name in fields and f.dataType != fields[f.name]]
    return {name: lost(F.col(name), F.col(name).try_cast(fields[name].simpleString())) for name in cast}


def empty(spark: SparkSession, layout: str) -> DataFrame:
    """A table of a layout without rows; Spark plans joins with it away."""
    return conform(spark.range(0), layout, F.current_timestamp())
