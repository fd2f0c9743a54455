"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target / size = r is taken floor(r) times, and once more with probability
r - floor(r). Drawing these independently would miss the target by chance; instead, two documents trade
probability until one of them is certain, in such a way that the expected words of the two together stay
the same. What is left over of a block of documents trades with what is left over of other blocks, level
by level, until a single document per source is decided by chance: a source misses its target by less
than one document.

Blocks are dealt by a hash and hold about BLOCK documents, so a source with most of all rows is spread
like any other. Chance is a hash of the documents and the seed: reruns agree.

Sources are ranked by code point, NULL (a source of its own) last. Documents without words (NULL
texts too) carry nothing and are taken once. Rows equal in id, source and text are counted: with r as above for n of them,
floor(n * (r - floor(r))) are taken once more for certain, and one trades for what is left. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import fresh, let, repeat_rows, row_hash, row_key, same, word_count
from rowloom.sources.shared import materialize

WEIGHTS = (1, 2, 3)
#: Times a document may be taken, and times its size a source's target may reach.
MOST_COPIES = 3
#: Documents that one block decides.
BLOCK = 512

_UNIT = ("doc_id", "key", "size", "n_rows")
_SOURCE = ("source", "source_size", "target", "base", "n_blocks")


def ranked_sources(units: DataFrame) -> DataFrame:
    """One row per source with its size and weight; ranks come from sorted parts and their counts."""
    mass = F.col("size") * F.col("n_rows")
    sizes = units.groupBy("source").agg(F.sum(mass).alias("source_size"), F.count(F.when(mass > 0, 1)).alias("n_units"))
    order = F.col("source").asc_nulls_last()
    parts = materialize(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("start")
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS)).cast("int"))
    return parts.join(starts, "part").select("source", "source_size", "n_units", weight.alias("weight"))


def with_targets(sources: DataFrame) -> DataFrame:
    """Adds target: all words shared by weight, each source capped, the excess shared again.

    Every round is one row of sums; it ends when no further source reaches its cap.
    """
    cap = (F.col("source_size") * MOST_COPIES).cast("double")
    rate, capped = None, -1
    while True:
        full = F.lit(False) if rate is None else F.lit(rate) * F.col("weight") >= cap
        s = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)).alias("open"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if s["n"] == capped or not s["open"]:
            break
        capped, rate = s["n"], ((s["all"] or 0) - s["held"]) / s["open"]
    share = F.lit(rate or 0.0) * F.col("weight")
    return sources.withColumn("target", F.least(cap, share))


def _chance(*columns: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only."""
    return F.shiftrightunsigned(row_hash(*columns, seed=seed), 11) / F.lit(float(1 << 53))


def _decided(item: Column, extra: int) -> Column:
    return F.array(F.struct(*(item[c].alias(c) for c in _UNIT), F.lit(extra).alias("extra")))


def _left(item: Column, p: Column) -> Column:
    return F.struct(*(item[c].alias(c) for c in ("chance", *_UNIT)), p.alias("p"))


def _trade(acc: Column, new: Column) -> Column:
    """One step along a block: the carried document and the next one trade until one is certain."""

    def outcome(done: Column, extra: int, item: Column, p: Column) -> Column:
        return F.struct(_left(item, p).alias("carry"), F.concat(acc["done"], _decided(done, extra)).alias("done"))

    old = acc["carry"]
    # words that one unit of probability of the new document is worth to the carried one
    worth = (new["size"] * new["n_rows"]) / (old["size"] * old["n_rows"])
    p, q = old["p"], new["p"]

    def step(m: Column) -> Column:
        up, down = F.least(1 - p, q * m["worth"]), F.least(p, (1 - q) * m["worth"])
        return F.when(
            m["u"] * (up + down) < down,
            F.when(1 - p <= q * m["worth"], outcome(old, 1, new, q - (1 - p) / m["worth"])).otherwise(outcome(new, 0, old, p + q * m["worth"])),
        ).otherwise(
            F.when(p <= (1 - q) * m["worth"], outcome(old, 0, new, q + p / m["worth"])).otherwise(outcome(new, 1, old, p - (1 - q) * m["worth"]))
        )

    traded = let(F.struct(worth.alias("worth"), _chance(old["chance"], new["chance"], seed=3).alias("u")), step)
    first = F.struct(_left(new, new["p"]).alias("carry"), acc["done"].alias("done"))
    return F.when(old.isNull(), first).otherwise(traded)


def _fold(rows: DataFrame) -> DataFrame:
    """Decides the documents of each (source, block) but one, which is left over as carry."""
    # the source's hash takes part in the order only through the rows; equal chances are told apart by the key
    item = F.struct("chance", *_UNIT, "p")
    items = rows.groupBy(*_SOURCE, "block").agg(F.sort_array(F.collect_list(item)).alias("items"))
    types = dict(rows.dtypes)
    unit = ",".join(f"{c}:{types[c]}" for c in _UNIT)
    nothing = F.struct(
        F.lit(None).cast(f"struct<chance:double,{unit},p:double>").alias("carry"),
        F.array().cast(f"array<struct<{unit},extra:int>>").alias("done"),
    )
    return items.withColumn("folded", F.aggregate("items", nothing, _trade)).select(*_SOURCE, "block", "folded.*")


def plan_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 11) -> DataFrame:
    """How often each document is taken: doc_id, key, source, size, n_rows, source_size, target, copies.

    `key` is `document_key` of the row; n_rows is the number of rows that share it and are taken so often. Rows that
    repeat may come as several such parts.
    """
    units = materialize(
        df.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), document_key(doc_id, source, text).alias("key"), word_count(F.col(text)).alias("size")
        )
        .groupBy("doc_id", "source", "key", "size")
        .agg(F.count("*").alias("n_rows")),
        "units",
    )
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST_COPIES)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    sources = materialize(
        with_targets(materialize(ranked_sources(units), "ranked"))
        .withColumn("ratio", ratio)
        .select(
            F.col("source").alias("its_source"), "source_size", "target",
            F.floor("ratio").cast("long").alias("base"), (F.col("ratio") - F.floor("ratio")).alias("p"),
            F.ceil(F.greatest(F.col("n_units"), F.lit(1)) / BLOCK).cast("long").alias("n_blocks"),
        ),
        "targets",
    )
    rows = units.join(sources, same(units["source"], sources["its_source"])).drop("its_source")
    open_ = (F.col("size") > 0) & (F.col("p") > 1e-9)
    columns = [*_UNIT, "source", "source_size", "target", "copies"]
    plain = F.when(F.col("size") > 0, F.col("base")).otherwise(F.lit(1).cast("long"))
    decided = [rows.filter(~open_).withColumn("copies", plain).select(columns)]
    # of rows that repeat, one at most is left to chance
    sure = F.floor(F.col("p") * F.col("n_rows") + 1e-9).cast("long")
    rows = rows.filter(open_).withColumn("sure", sure).withColumn("rest", F.greatest(F.col("p") * F.col("n_rows") - F.col("sure"), F.lit(0.0)))
    chosen = F.when(F.col("rest") > 1e-9, 1).otherwise(0)
    for n, extra in ((F.col("sure"), 1), (F.col("n_rows") - F.col("sure") - chosen, 0)):
        part = rows.filter("n_rows > 1").withColumn("n_rows", n).filter("n_rows > 0")
        decided.append(part.withColumn("copies", F.col("base") + extra).select(columns))
    rows = rows.filter((F.col("n_rows") == 1) | (chosen == 1)).withColumns({"p": F.when(F.col("n_rows") == 1, F.col("p")).otherwise(F.col("rest")), "n_rows": F.lit(1).cast("long")})
    rows = rows.drop("sure", "rest")

    most = sources.agg(F.max("n_blocks")).first()[0] or 1
    level = rows.withColumns({
        "chance": _chance(F.col("key"), seed=seed), "block": F.pmod(row_hash(F.col("key"), seed=seed + 1), F.col("n_blocks")),
    })
    while True:
        folded = materialize(_fold(level), "level")
        done = folded.select(*_SOURCE, F.explode("done").alias("d")).select(*_SOURCE, "d.*")
        decided.append(done.withColumn("copies", F.col("base") + F.col("extra")).select(columns))
        left = folded.filter(F.col("carry").isNotNull()).select(*_SOURCE, "block", "carry.*")
        last = F.when(_chance(F.col("key"), seed=seed + 2) < F.col("p"), F.col("base") + 1).otherwise(F.col("base"))
        decided.append(left.filter("n_blocks = 1").withColumn("copies", last).select(columns))
        if most == 1:
            return reduce(DataFrame.unionByName, decided)
        most = -(-most // BLOCK)
        level = left.filter("n_blocks > 1").withColumns({
            "n_blocks": F.ceil(F.col("n_blocks") / BLOCK).cast("long"), "block": F.floor(F.col("block") / BLOCK).cast("long"),
        })


def document_key(doc_id: str, source: str, text: str) -> Column:
    return row_key(F.col(doc_id), F.col(source), F.col(text))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 11) -> DataFrame:
    """The mixed table: every row as often as it is taken, with the columns of the input."""
    key, low, more, times = fresh(df, "key"), fresh(df, "low"), fresh(df, "more"), fresh(df, "copies")
    copies = plan_copies(df, doc_id, text, source, seed).groupBy(F.col("key").alias(f"{key}_")).agg(
        F.min("copies").alias(low), F.sum(F.col("copies") * F.col("n_rows")).alias("all_copies"), F.sum("n_rows").alias("all_rows")
    )
    # of equal rows, so many are taken once more than the others
    copies = copies.withColumn(more, F.col("all_copies") - F.col(low) * F.col("all_rows")).drop("all_copies", "all_rows")
    rows = df.withColumn(key, document_key(doc_id, source, text))
    rows = rows.join(copies, rows[key] == copies[f"{key}_"]).drop(f"{key}_")
    alike = rows.filter(F.col(more) == 0).withColumn(times, F.col(low))
    apart = rows.filter(F.col(more) > 0)
    if apart.isEmpty():
        return repeat_rows(alike.drop(key, low, more), times)
    # numbered by parts and their counts, so a row that repeats very often is not numbered in one task
    part, nth, before = (fresh(rows, n) for n in ("part", "nth", "before"))
    apart = materialize(apart.withColumn(part, F.spark_partition_id()), "repeats")
    counts = apart.groupBy(F.col(key).alias(f"{key}_"), F.col(part).alias(f"{part}_")).agg(F.count("*").alias("n"))
    in_order = Window.partitionBy(f"{key}_").orderBy(f"{part}_").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn(before, F.coalesce(F.sum("n").over(in_order), F.lit(0))).drop("n"), "counts")
    apart = apart.withColumn(nth, F.row_number().over(Window.partitionBy(key, part).orderBy(F.lit(1))) - 1)
    apart = apart.join(counts, (F.col(key) == F.col(f"{key}_")) & (F.col(part) == F.col(f"{part}_")))
    taken = F.col(low) + F.when(F.col(nth) + F.col(before) < F.col(more), 1).otherwise(0)
    apart = apart.withColumn(times, taken).select(*[F.col(f"`{c}`") for c in df.columns], times)
    return repeat_rows(alike.drop(key, low, more).unionByName(apart), times)
