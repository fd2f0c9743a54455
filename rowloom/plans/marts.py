"""Marts and views over the core tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowloom import fixed_values as fv
from rowloom.functions.hashing import name_uuid
from rowloom.functions.numbers import units_in_name
from rowloom.functions.text import digits_only
from rowloom.operators.merge import splittable

# rows of a lot, where the pairs of one phone are made in blocks of a lot of users and a lot of clients
PAIR_BLOCK = 1000


def client_purchases(sales: DataFrame, units: Column | None = None) -> DataFrame:
    """Sessions bought and money paid per client, by live sales."""
    per_item = units_in_name(F.col("product_name")) if units is None else units
    return (
        sales.where(~F.col("is_deleted"))
        .groupBy("client_id")
        .agg(
            F.sum(per_item.cast("long") * F.col("quantity")).alias("units_bought"),
            F.sum("final_price").alias("total_spent"),
        )
    )


def purchases_by_lookup(sales: DataFrame, products: DataFrame) -> DataFrame:
    """client_purchases() with the units of the product table; products it lacks count as 1."""
    units = products.groupBy(F.col("name").alias("__product")).agg(F.max("units_per_item").alias("__units"))
    known = sales.join(splittable(units, "__product"), F.col("product_name") == F.col("__product"), "left")
    return client_purchases(known, F.coalesce(F.col("__units"), F.lit(1)))


def client_usage(schedule: DataFrame) -> DataFrame:
    """Sessions used per client: attended, or missed without notice."""
    return (
        schedule.where(~F.col("is_deleted") & F.col("status").isin(*fv.USED_STATUSES))
        .groupBy("client_id")
        .agg(F.count("*").alias("units_used"))
    )


def client_balances(clients: DataFrame, purchases: DataFrame, usage: DataFrame, as_of: Column) -> DataFrame:
    """The balance mart, lowest balance first; clients who bought or used something.

    Purchases and usage come aggregated, one row per client, so the joins cannot multiply
    rows or run into hot keys.
    """
    zero = F.lit(0)
    bought, used = F.coalesce("units_bought", zero), F.coalesce("units_used", zero)
    out = fv.BALANCE_COLUMNS
    mart = (
        clients.where(~F.col("is_deleted"))
        .select(F.col("legacy_id").alias("client_id"), "name", "phone", "status")
        .join(purchases, "client_id", "left")
        .join(usage, "client_id", "left")
        .where((F.col("units_bought") > 0) | (F.col("units_used") > 0))
    )
    # the sort needs the id only to leave no ties
    return (
        mart.select(
            F.col("name").alias(out["name"]),
            F.col("phone").alias(out["phone"]),
            bought.alias(out["bought"]),
            used.alias(out["used"]),
            (bought - used).alias(out["left"]),
            F.coalesce("total_spent", zero).cast("decimal(28,2)").alias(out["paid"]),
            F.col("status").alias(out["status"]),
            as_of.alias(out["updated"]),
            "client_id",
        )
        .orderBy(F.col(out["left"]).asc(), F.col(out["name"]).asc_nulls_last(), "client_id")
        .drop("client_id")
    )


def balance_outliers(balances: DataFrame, low: int = fv.BALANCE_LOW, high: int = fv.BALANCE_HIGH) -> DataFrame:
    left = F.col(fv.BALANCE_COLUMNS["left"])
    return balances.where((left < low) | (left > high))


def _by_phone(messenger: DataFrame, clients: DataFrame, skip_placeholder: bool) -> tuple[DataFrame, DataFrame]:
    """Messenger users and clients with the key `k` on which they match; rows without a usable phone get a key of their own."""
    no_phone = "".join(c for c in fv.NO_PHONE if c.isdigit())
    real = digits_only(F.col("phone")) != no_phone if skip_placeholder else F.lit(True)
    usable = F.col("phone").isNotNull() & (F.length("phone") > fv.MIN_PHONE_CHARS) & real
    t = messenger.select(
        F.col("id").alias("tg_id"), "username", F.col("phone").alias("tg_phone"),
        F.col("updated_at").alias("tg_updated"),
        F.when(usable, digits_only(F.col("phone"))).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("k"),
    )
    c = clients.select(
        F.col("legacy_id").alias("crm_id"), F.col("name").alias("crm_name"), F.col("phone").alias("crm_phone"),
        F.col("updated_at").alias("crm_updated"),
        F.when(real, digits_only(F.col("phone"))).otherwise(F.concat(F.lit("c"), F.col("legacy_id"))).alias("k"),
    )
    return t, c


def phone_members(messenger: DataFrame, clients: DataFrame, skip_placeholder: bool = False) -> DataFrame:
    """Who belongs to which phone: phone (digits), side (user or client), id. Rows that can match nobody by phone are left out."""
    t, c = _by_phone(messenger, clients, skip_placeholder)
    users = t.select(F.col("k").alias("phone"), F.lit("user").alias("side"), F.col("tg_id").cast("string").alias("id"))
    people = c.select(F.col("k").alias("phone"), F.lit("client").alias("side"), F.col("crm_id").alias("id"))
    return users.unionByName(people).where(~F.substring("phone", 1, 1).isin("t", "c"))


def phone_classes(messenger: DataFrame, clients: DataFrame, skip_placeholder: bool = False) -> DataFrame:
    """The identity match without its pairs: phone, how many users and clients have it, and how many pairs they make.

    A phone is one row however many people have it, so the placeholder costs no more than others; with
    phone_members() the pairs of a phone follow where they are asked for.
    """
    n = {"users": "user", "clients": "client"}
    classes = phone_members(messenger, clients, skip_placeholder).groupBy("phone").agg(*[F.count_if(F.col("side") == s).alias(c) for c, s in n.items()])
    return classes.withColumn("pairs", F.col("users") * F.col("clients"))


def _in_blocks(t: DataFrame, c: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides, and the columns on which their rows meet: the key, and a block of its pairs.

    A key with more than PAIR_BLOCK x PAIR_BLOCK pairs has its users and its clients dealt into lots of about
    PAIR_BLOCK rows; each lot meets each lot of the other side once, as a block of its own. So the pairs of
    one key are made by all tasks, for copies of rows that are a PAIR_BLOCK-th of the pairs. Few bytes can
    make many pairs, which is why the skew-join rule, which goes by bytes, does not see to it.
    """
    sizes = t.groupBy("k").agg(F.count("*").alias("__users")).join(c.groupBy("k").agg(F.count("*").alias("__clients")), "k")
    crowded = splittable(
        sizes.where(F.col("__users").cast("double") * F.col("__clients") > PAIR_BLOCK * PAIR_BLOCK).select(
            "k", *[F.ceil(F.col(f"__{side}") / PAIR_BLOCK).alias(f"__{side}_lots") for side in ("users", "clients")]), "k")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        own_lots, other_lots = (F.coalesce(f"__{side}_lots", F.lit(1).cast("long")) for side in (own, other))
        lot, every = F.pmod(F.xxhash64(*rows.columns), own_lots), F.sequence(F.lit(0).cast("long"), other_lots - 1)
        return rows.join(crowded, "k", "left").select(*rows.columns, lot.alias(f"__{own}_lot"), F.explode(every).alias(f"__{other}_lot"))

    return dealt(t, "users", "clients"), dealt(c, "clients", "users"), ["k", "__users_lot", "__clients_lot"]


def unified_customers(messenger: DataFrame, clients: DataFrame, skip_placeholder: bool = False) -> DataFrame:
    """CRM clients and messenger users side by side, matched on the digits of the phone.

    A full outer join, taken apart: pairs by inner join, then the rows of either side that
    match none.  Spark can split a hot number (such as the placeholder phone) in anti joins, not
    in a full outer one; its pairs are made in blocks.

    The placeholder phone pairs everyone who has it, which are as many rows as there are pairs; skip_placeholder=True
    takes it for no phone.  phone_classes() has the same links as one row per phone.
    """
    t, c = _by_phone(messenger, clients, skip_placeholder)
    users, people, on = _in_blocks(t, c)
    pairs = users.join(people, on).drop(*on[1:])
    alone_t = t.join(splittable(c.select("k").distinct(), "k"), "k", "left_anti")
    alone_c = c.join(splittable(t.select("k").distinct(), "k"), "k", "left_anti")
    rows = pairs.unionByName(alone_t, allowMissingColumns=True).unionByName(alone_c, allowMissingColumns=True)
    tg_name = F.concat(F.lit(fv.MESSENGER_PREFIX), F.col("tg_id").cast("string"))
    return rows.select(
        F.coalesce(F.col("crm_id"), name_uuid(tg_name)).alias("id"),
        "crm_name",
        "crm_phone",
        F.col("username").alias("tg_username"),
        "tg_phone",
        F.col("tg_id").alias("tg_user_id"),
        F.when(F.col("crm_id").isNotNull(), "client")
        .when(F.col("tg_phone").isNotNull(), "warm_lead")
        .otherwise("guest")
        .alias("lifecycle_stage"),
        F.coalesce("crm_updated", "tg_updated").alias("last_activity"),
    )


def latest_messages(messages: DataFrame) -> DataFrame:
    """The newest message id of each chat."""
    return messages.groupBy("chat_id").agg(F.max("telegram_id").alias("last_message_id"))


_API_SALES = (
    "date", "product_name", "type", "category", "quantity", "full_price", "discount", "final_price", "cash",
    "transfer", "terminal", "debt", "comment", "client_id", "admin", "trainer",
)
_API_SCHEDULE = (
    "date", "start_time", "end_time", "status", "type", "category", "comment", "client_id", "employee_id",
)


def _recent(core: DataFrame, columns: tuple[str, ...], as_of: Column, days: int) -> DataFrame:
    since = F.date_sub(F.to_date(as_of), days).cast(core.schema["date"].dataType)
    live = core.where(~F.col("is_deleted") & (F.col("date") >= since))
    return live.select(F.col("legacy_id").alias("id"), *columns)


def api_sales(sales: DataFrame, as_of: Column, days: int = fv.API_DAYS) -> DataFrame:
    """Live sales of the last days."""
    return _recent(sales, _API_SALES, as_of, days)


def api_schedule(schedule: DataFrame, as_of: Column, days: int = fv.API_DAYS) -> DataFrame:
    """Live schedule entries of the last days."""
    return _recent(schedule, _API_SCHEDULE, as_of, days)


def api_clients(clients: DataFrame) -> DataFrame:
    return clients.where(~F.col("is_deleted"))


def api_active(lookup: DataFrame) -> DataFrame:
    """Active rows of an employee or product table."""
    return lookup.where("is_active")


def api_auth_events(events: DataFrame) -> DataFrame:
    """All rows as they are: the events of the web app's own table."""
    return events
