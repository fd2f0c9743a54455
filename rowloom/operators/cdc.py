"""Snapshot diff: what a new snapshot of a source inserts, updates, deletes and leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, DELETE, UNCHANGED = "INSERT", "UPDATE", "DELETE", "UNCHANGED"
STAGING_COLUMNS = ("_row_index", "__row_hash", "_loaded_at")


def _filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def existing_state(target: DataFrame, pk: str, hash_col: str = "__row_hash") -> DataFrame:
    """(pk, hash) of a stored table, one row per key; rows without key or hash are left out.

    Of a key that is stored twice the hash of its last row counts.
    """
    state = target.where(F.col(pk).isNotNull() & _filled(F.col(hash_col)))
    order = ["_row_index"] if "_row_index" in target.columns else []
    key = F.col(pk).cast("string").alias("__pk")
    if pk == hash_col:
        return state.select(key, F.col(hash_col).alias("__old_hash")).distinct()
    last = F.max(F.struct(*order, hash_col))[hash_col]
    return state.groupBy(key).agg(last.alias("__old_hash"))


def cdc_diff(
    source: DataFrame,
    target: DataFrame,
    pk: str,
    hash_col: str = "__row_hash",
    row_index: str = "_row_index",
    on_duplicate: str = "insert",
) -> DataFrame:
    """The source rows plus the keys only the target has, each with its `action`.

    Rows without a key are skipped.  Where a key repeats in the source, its first row is
    compared with the target and the others are inserts (on_duplicate="error" fails instead).

    The two narrow sides - first row number per source key, stored hash per key - are matched
    on the key.  The wide source rows then meet that state on (key, row number), a unique
    pair, so one key that holds a large part of the rows is still spread over all tasks, and
    the wide rows are shuffled once.
    """
    if pk not in source.columns:
        # every stored row would count as deleted
        raise ValueError(f"the source has no column {pk!r}")
    rows = source.where(_filled(F.col(pk).cast("string"))).withColumn("__pk", F.col(pk).cast("string"))
    n = F.count("*")
    first = F.min(row_index)
    if on_duplicate == "error":
        first = F.when(n > 1, F.raise_error(F.concat(F.lit(f"{pk} repeats: "), F.col("__pk")))).otherwise(first)
    firsts = rows.groupBy("__pk").agg(first.cast("long").alias("__first"))
    # target keys that the source lacks get row number -1, which no source row has
    state = firsts.join(existing_state(target, pk, hash_col), "__pk", "full_outer").select(
        "__pk", F.coalesce("__first", F.lit(-1)).alias("__at"), "__old_hash"
    )
    matched = rows.withColumn("__at", F.col(row_index).cast("long")).join(state, ["__pk", "__at"], "full_outer")
    action = (
        F.when(F.col("__at") == -1, DELETE)
        .when(F.col("__old_hash").isNull(), INSERT)
        .when(F.col("__old_hash") == F.col(hash_col), UNCHANGED)
        .otherwise(UPDATE)
    )
    key = F.col("__pk").cast(source.schema[pk].dataType).alias(pk)
    values = [key if c == pk else F.col(c) for c in source.columns]
    return matched.select(action.alias("action"), *values)


def cdc_stats(diff: DataFrame) -> DataFrame:
    """One row: inserted, updated, deleted, unchanged."""
    names = {"inserted": INSERT, "updated": UPDATE, "deleted": DELETE, "unchanged": UNCHANGED}
    return diff.agg(*[F.count_if(F.col("action") == a).alias(n) for n, a in names.items()])


def cdc_apply(
    target: DataFrame,
    diff: DataFrame,
    pk: str,
    columns: Sequence[str],
    loaded_at: Column,
    hash_col: str = "__row_hash",
) -> DataFrame:
    """The target after a diff: all rows of a key change or go together.

    Updated rows take the source's cells and hash and keep `_row_index` and `_loaded_at`.
    The result has to go to a new place: the plan reads `target`.  `diff` is read twice, so
    give a written one (see load_cdc).
    """
    changed = [c for c in columns if c != pk] + ([hash_col] if hash_col not in columns and hash_col != pk else [])
    news = diff.where(F.col("action").isin(UPDATE, DELETE)).select(
        F.col(pk).alias("__pk"), "action", *[F.col(c).alias(f"__new_{c}") for c in changed]
    )
    keyed = target.join(news, F.col(pk).cast("string") == F.col("__pk"), "left")
    updated = F.coalesce(F.col("action") == UPDATE, F.lit(False))
    kept = keyed.where(F.coalesce(F.col("action") != DELETE, F.lit(True))).select(
        *[F.when(updated, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
          for c in target.columns]
    )
    new_rows = diff.where(F.col("action") == INSERT)
    stamps = {"_loaded_at": loaded_at}
    inserted = new_rows.select(
        *[
            F.col(c) if c in new_rows.columns
            else stamps.get(c, F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    return kept.unionByName(inserted)
