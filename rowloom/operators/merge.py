"""Keeping keyed core tables up to date: first-per-key, upsert, insert-if-absent, soft delete."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.functions.text import quoted
from rowloom.sources.shared import materialize

# hashes of repeated keys that are handed to all tasks, 8 bytes each; where there are more, all rows meet by key
AGAIN_MOST = 2_000_000


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in `order` (which should leave no ties).

    Spark cuts each task's rows to one per key before the shuffle, so hot keys stay cheap.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def hashes_again(*keys: DataFrame) -> DataFrame | None:
    """The 64-bit hashes (`hash`) that more than one row has among `keys`, frames of one column; None if they are over AGAIN_MOST.

    A key that two rows have is among them, and hardly another.  Only hashes are shuffled, so wide rows that may have a
    key twice can be told from the rest before they are moved.  They are written once, so that their number is known.
    """
    all_ = reduce(DataFrame.unionAll, [k.select(F.xxhash64(k.columns[0]).alias("hash")) for k in keys])
    found = materialize(all_.groupBy("hash").agg(F.count("*").alias("__n")).where("__n > 1").select("hash"), "again")
    n = found.count()
    if n > AGAIN_MOST:
        return None
    # without any, Spark plans the joins with them away
    return found if n else found.limit(0)


def splittable(keys: DataFrame, *names: str) -> DataFrame:
    """The same rows, with a partitioning of `names` that Spark does not recognise.

    A side that was just grouped by the join key joins without an exchange of its own, and then
    the skew-join rule leaves hot keys of the other side alone.  With one more shuffle of this
    narrow side, hot keys are split.
    """
    return keys.withColumns({n: F.concat(F.col(n), F.lit("")) for n in names})


def lookup_by_name(rows: DataFrame, name: Column, lookup: DataFrame, lookup_name: str, lookup_id: str,
                   as_name: str, how: str = "inner") -> DataFrame:
    """Adds the id found under a name; of several, the smallest.

    The lookup side has one row per name, so rows never multiply.  Spark broadcasts it if it
    is small; else the skew-join rule splits the rows of a hot name.
    """
    ids = lookup.where(F.col(lookup_name).isNotNull()).groupBy(F.col(lookup_name).alias("__name")).agg(
        F.min(lookup_id).alias(as_name)
    )
    return rows.join(splittable(ids, "__name"), name == F.col("__name"), how).drop("__name")


def upsert(target: DataFrame, source: DataFrame, key: str, now: Column, gone: DataFrame | None = None,
           status: str | None = None) -> DataFrame:
    """MERGE on a unique key, as a new version of the target.

    Matched rows take all of the source's columns and are no longer deleted, `updated_at` is
    `now`; unmatched source rows are added with `created_at` and `updated_at` set; all other
    target rows stay as they are.  Both sides are unique on the key, so one full outer join
    does it without skew; target rows without a key cannot match and go around it.

    `gone` has keys of the target, none of them in the source (`gone_keys`): their rows are stamped
    deleted by the same join, and take `status` if one is given.
    """
    hit, old, lost = "NOT s.__gone", "t.__old", "s.__gone"
    s = source.withColumn("__gone", F.lit(False))
    if gone is not None:
        s = s.unionByName(gone.select(key, F.lit(True).alias("__gone")), allowMissingColumns=True)
    s = s.withColumn("__now", now).alias("s")
    t = target.where(F.col(key).isNotNull()).withColumn("__old", F.lit(True)).alias("t")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    stamps = {"is_deleted": "false", "deleted_at": "NULL", "updated_at": "s.__now"}
    marks = {} if gone is None else {"is_deleted": "true", "deleted_at": "s.__now"}
    if marks and status:
        marks["status"] = f"'{status}'"

    def value(name: str) -> str:
        kind, c = target.schema[name].dataType.simpleString(), quoted(name)
        mark = f" WHEN {lost} THEN {marks[name]}" if name in marks else ""
        if name == key:
            picked = f"coalesce(s.{c}, t.{c})"
        elif name in source.columns:
            picked = f"CASE WHEN {hit} THEN s.{c}{mark} ELSE t.{c} END"
        elif name in stamps:
            picked = f"CASE WHEN {hit} THEN {stamps[name]}{mark} ELSE t.{c} END"
        elif name == "created_at":
            picked = f"CASE WHEN {old} THEN t.{c} ELSE s.__now END"
        else:
            picked = f"CASE{mark} ELSE t.{c} END" if mark else f"t.{c}"
        return f"CAST({picked} AS {kind}) AS {c}"

    # one text per column: core tables are wide, and this is the cheapest way to say it
    merged = joined.selectExpr(*[value(c) for c in target.columns])
    return merged.unionByName(target.where(F.col(key).isNull()))


def insert_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The new rows whose key is not there yet, one per key; to be appended."""
    order = [F.col(c) for c in new.columns if c != key]
    one = first_per_key(new, [key], order or [F.col(key)])
    return one.join(existing.select(key), key, "left_anti").select(*new.columns)


def distinct_names(*frames: tuple[DataFrame, str]) -> DataFrame:
    """Distinct non-blank names over (table, column) pairs, as `full_name`."""
    names = [df.where(F.trim(F.col(c)) != "").select(F.col(c).alias("full_name")) for df, c in frames]
    union = names[0]
    for more in names[1:]:
        union = union.unionByName(more)
    return union.distinct()


def staged_rows(*stagings: tuple[str, DataFrame], hash_col: str = "__row_hash") -> DataFrame:
    """(source, row_hash) of all staged rows that have a hash."""
    parts = [
        df.where(F.col(hash_col).isNotNull()).select(F.lit(source).alias("source"), F.col(hash_col).alias("row_hash"))
        for source, df in stagings
    ]
    union = parts[0]
    for more in parts[1:]:
        union = union.unionByName(more)
    return union


def staged_hashes(*stagings: tuple[str, DataFrame], hash_col: str = "__row_hash") -> DataFrame:
    """(source, row_hash) of all staged rows, without repeats and NULLs."""
    return staged_rows(*stagings, hash_col=hash_col).distinct()


def soft_delete(
    core: DataFrame,
    staged: DataFrame,
    now: Column,
    sources: Sequence[str] | None = None,
    status: str | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Stamps live rows whose hash is staged no more; adds `just_deleted`.

    With `sources`, a row is looked up among the hashes of its own source, and rows of other
    sources are left alone; without, among all of them.  `only` names the sources whose rows
    may be deleted at all: those of a sheet that was not staged must stay.  Rows without a hash
    are never deleted, as under NOT IN.
    """
    on = ["source", "row_hash"] if sources else ["row_hash"]
    present = splittable(staged.select(*on).distinct(), "row_hash").withColumn("__staged", F.lit(True))
    limits = sources or only
    scope = F.col("source").isin(*limits) if limits else F.lit(True)
    gone = (
        F.col("__staged").isNull() & F.col("row_hash").isNotNull() & scope & (F.col("is_deleted") == F.lit(False))
    )
    marked = core.join(present, on, "left").withColumn("just_deleted", F.coalesce(gone, F.lit(False)))
    stamps = {
        "is_deleted": F.lit(True),
        "deleted_at": now.cast("timestamp"),
    } | ({"status": F.lit(status)} if status else {})
    return marked.select(
        *[F.when(F.col("just_deleted"), stamps[c]).otherwise(F.col(c)).alias(c) if c in stamps else F.col(c)
          for c in core.columns],
        "just_deleted",
    )


def gone_keys(target: DataFrame, source: DataFrame, key: str, staged: DataFrame, sources: Sequence[str] | None = None,
              only: Sequence[str] | None = None) -> DataFrame:
    """(key, source) of the rows that `soft_delete` would stamp after an upsert of `source`.

    A row that the upsert hits carries a staged hash afterwards, so only live, hashed rows that it leaves
    untouched are looked up, by key, source and hash alone.  They are written once; their size decides
    whether the staged hashes have to be shuffled to meet them or are filtered where they lie.
    """
    on = ["source", "row_hash"] if sources else ["row_hash"]
    limits = sources or only
    live = target.where(F.col(key).isNotNull() & F.col("row_hash").isNotNull() & (F.col("is_deleted") == F.lit(False)))
    if limits:
        live = live.where(F.col("source").isin(*limits))
    untouched = materialize(live.select(key, "source", "row_hash").join(source.select(key), key, "left_anti"), "untouched")
    wanted = splittable(untouched.select(*on).distinct(), *on)
    found = splittable(staged.select(*on).join(wanted, on, "left_semi").distinct(), *on)
    return untouched.join(found, on, "left_anti").select(key, "source")


def upsert_and_delete(target: DataFrame, source: DataFrame, key: str, now: Column, staged: DataFrame,
                      sources: Sequence[str] | None = None, status: str | None = None,
                      only: Sequence[str] | None = None) -> DataFrame:
    """`upsert` and then `soft_delete`, with the same rows as one after the other, in one join of the target.

    `source` has to come from the staged rows: what it hits counts as staged.  Rows without a key, which no
    upsert hits, are looked up as `soft_delete` does.
    """
    source = materialize(source, "rows")
    gone = materialize(gone_keys(target, source, key, staged, sources, only), "gone")
    keyed = upsert(target.where(F.col(key).isNotNull()), source, key, now, gone, status)
    keyless = soft_delete(target.where(F.col(key).isNull()), staged, now, sources, status, only)
    return keyed.unionByName(keyless.drop("just_deleted"))


def soft_delete_counts(marked: DataFrame) -> DataFrame:
    """Rows deleted just now, per source."""
    return marked.groupBy("source").agg(F.count_if(F.col("just_deleted")).alias("deleted"))
