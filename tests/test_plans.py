"""The plans the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from harness import sync
from harness.fixtures import fixture, table
from rowloom import fixed_values as fv
from rowloom.operators import cdc, merge
from rowloom.plans import marts, transforms
from rowloom.sources import layout, sinks
from rowloom.sources.shared import materialize

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["client_balances", "cdc_diff", "upsert_clients", "soft_delete", "soft_delete_untouched", "unified_customers", "validate_rows",
                                  "volume_anomaly", "constraint_checks", "insert_absent", "row_hash"])
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    plan = physical(registry.queries()[name](spark, SF))
    assert not re.search("Cartesian|NestedLoop|BatchEvalPython|ArrowEvalPython|MapInPandas", plan)


def test_diff_shuffles_the_wide_rows_once(spark, no_broadcast):
    """Rows with all their cells cross one exchange, by key and row number."""
    source, target = materialize(sync._sheet(spark, SF)), materialize(sync._stored(spark, SF))
    plan = physical(cdc.cdc_diff(source, target, "record_id"))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 4
    assert sum("__at" in line for line in exchanges) == 2
    # the stored side is read by key, hash and row number only
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any(re.search(r"ReadSchema: struct<record_id:string,_row_index:bigint,__row_hash:string>", s) for s in scans)
    assert any("struct<record_id:string,_row_index:bigint>" in s for s in scans)


def test_filters_and_columns_reach_the_scan(spark):
    sales = materialize(fixture(spark, SF, "core_sales"))
    plan = physical(marts.api_sales(sales, F.to_timestamp(F.lit("2001-08-01 00:00:00"))))
    assert re.search(r"PushedFilters: \[.*IsNotNull\(date\).*GreaterThanOrEqual\(date", plan)
    bought = physical(marts.client_purchases(sales))
    assert "ReadSchema: struct<product_name:string,quantity:int,final_price:decimal(18,2),client_id:string,is_deleted" in bought


def test_balances_join_aggregates(spark, no_broadcast):
    clients, sales, schedule = (fixture(spark, SF, n) for n in ("core_clients", "core_sales", "core_schedule"))
    plan = physical(marts.client_balances(clients, marts.client_purchases(sales), marts.client_usage(schedule), F.lit("x")))
    # sales and schedule are summed up before they are shuffled by client
    assert plan.count("partial_sum") >= 1 and plan.count("partial_count") >= 1


@pytest.fixture
def small_skew(spark, no_broadcast):
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k in small:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()        # not the plan looked at below
    df.collect()
    return physical(df)


def hot(spark, n=40000):
    """Rows of which a third carry one name."""
    who = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id").cast("string")))
    return materialize(spark.range(n).repartition(8).select("id", who.alias("who"), F.sha2(F.col("id").cast("string"), 256).alias("load")))


def test_hot_names_are_split_in_lookups(spark, small_skew):
    rows = hot(spark)
    names = materialize(rows.select(F.col("who").alias("name"), F.md5("who").alias("legacy_id")).distinct())
    joined = merge.lookup_by_name(rows, F.col("who"), names, "name", "legacy_id", "client_id")
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == rows.count()


def test_hot_hashes_are_split_in_soft_delete(spark, small_skew):
    core = hot(spark).select(F.col("who").alias("row_hash"), F.lit("cur").alias("source"), F.lit(False).alias("is_deleted"),
                             F.lit(None).cast("timestamp").alias("deleted_at"), "load")
    staged = materialize(core.select("source", "row_hash").where("row_hash <> 'n1'"))
    marked = merge.soft_delete(core, staged, F.current_timestamp(), sources=["cur"])
    assert "SortMergeJoin(skew=true)" in final_plan(marked)
    assert marked.where("just_deleted").count() == 1


def test_deleting_shuffles_the_wide_rows_once(spark, no_broadcast):
    """Untouched rows are looked up by key, source and hash; the table's other columns cross one exchange, that of the upsert."""
    core = hot(spark, 3000).select(F.col("id").cast("string").alias("legacy_id"), F.col("who").alias("row_hash"), F.lit("cur").alias("source"),
                                   F.lit(False).alias("is_deleted"), F.lit(None).cast("timestamp").alias("deleted_at"), "load")
    core = materialize(core)
    rows = core.where("legacy_id % 10 < 8").select("legacy_id", F.concat(F.lit("new"), "row_hash").alias("row_hash"), "source")
    staged = materialize(rows.select("source", "row_hash").unionByName(core.where("row_hash = 'hot'").select("source", "row_hash")))
    now = F.current_timestamp()
    gone = materialize(merge.gone_keys(core, rows, "legacy_id", staged, ["cur"]))
    exchanges = [x for x in physical(merge.upsert(core, rows, "legacy_id", now, gone)).splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2 and not any("row_hash" in x for x in exchanges)
    one_after_the_other = physical(merge.soft_delete(merge.upsert(core, rows, "legacy_id", now), staged, now, ["cur"]))
    assert sum("Exchange hashpartitioning" in x and "row_hash" in x for x in one_after_the_other.splitlines()) >= 2
    out = merge.upsert_and_delete(core, rows, "legacy_id", now, staged, ["cur"])
    assert out.where("is_deleted").count() == gone.count() == sum(1 for i in range(3000) if i % 10 >= 8 and i % 3)
    assert out.count() == 3000


def test_hot_phones_are_split_in_the_identity_match(spark, small_skew):
    people = hot(spark, 20000).select(F.col("id").cast("string").alias("legacy_id"), F.col("load").alias("name"), F.lit(None).cast("timestamp").alias("updated_at"),
                                      F.when(F.col("who") == "hot", "+79000000000").otherwise(F.concat(F.lit("89000"), F.col("id").cast("string"))).alias("phone"))
    users = materialize(spark.range(3).select("id", F.col("id").cast("string").alias("username"), F.lit(None).cast("timestamp").alias("updated_at"),
                                              F.when(F.col("id") == 0, "7 900 000 00 00").otherwise(F.concat(F.lit("89000"), F.col("id").cast("string"))).alias("phone")))
    out = marts.unified_customers(users, materialize(people))
    assert "skew=true" in final_plan(out)
    # the hot number pairs with a third of the people; 890001 and 890002 pair with one each
    assert out.count() == 20000 and out.where("tg_user_id IS NOT NULL").count() == 6667 + 2


def test_the_placeholder_phone(spark):
    stamp = F.lit(None).cast("timestamp").alias("updated_at")
    people = spark.range(30).select(F.col("id").cast("string").alias("legacy_id"), F.lit("x").alias("name"), stamp, F.lit("+70000000000").alias("phone"))
    users = spark.range(20).select("id", F.lit("u").alias("username"), stamp, F.lit("7 000 000 00 00").alias("phone"))
    assert marts.unified_customers(users, people, skip_placeholder=True).count() == 50
    assert marts.unified_customers(users, people).count() == 600
    assert [tuple(r) for r in marts.phone_classes(users, people).collect()] == [("70000000000", 20, 30, 600)]
    assert marts.phone_classes(users, people, skip_placeholder=True).isEmpty()


def _identities(spark, users, people, parts):
    stamp = F.lit(None).cast("timestamp").alias("updated_at")
    phone = lambda c: F.expr(f"CASE {c} % 6 WHEN 0 THEN NULL WHEN 1 THEN '+7 111 11 1{c} ' WHEN 2 THEN '8(900)000' ELSE '+70000000000' END".format(c=c))
    t = spark.range(0, users, 1, parts).select(F.nullif(F.col("id"), F.lit(7)).alias("id"), F.lit("u").alias("username"), phone("id").alias("phone"), stamp)
    c = spark.range(0, people, 1, parts).select(F.col("id").cast("string").alias("legacy_id"), F.lit("x").alias("name"), phone("id").alias("phone"), stamp)
    return t.unionByName(t.where("id < 3")), c.unionByName(c.where("legacy_id IN ('3', '6')"))      # repeated rows are rows


def test_pairs_of_a_crowded_phone_are_all_made_once(spark, monkeypatch):
    """In blocks of three by three, the match has the rows of the plain full outer join."""
    monkeypatch.setattr(marts, "PAIR_BLOCK", 3)
    t, c = _identities(spark, 50, 90, 2)
    digits = "regexp_replace({}.phone, '[^0-9]', '')"
    plain = t.alias("t").join(c.alias("c"), F.expr(f"length(t.phone) > 5 AND {digits.format('t')} = {digits.format('c')}"), "full_outer")
    wanted = plain.select(F.expr("t.id"), F.expr("legacy_id"), F.expr("t.phone"), F.expr("c.phone")).collect()
    found = marts.unified_customers(t, c).select("tg_user_id", F.when(F.col("lifecycle_stage") == "client", F.col("id")), "tg_phone", "crm_phone").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, map(tuple, wanted)))


def test_pairs_of_a_crowded_phone_are_spread(spark, all_partitions):
    """Two sides of one task each, few bytes, and millions of pairs: no task makes a third of them."""
    out = marts.unified_customers(*_identities(spark, 5000, 8000, 1))
    made = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(made) > 10_000_000 and max(made) < sum(made) / 3


@pytest.mark.parametrize(("files", "dealt"), [(1, True), (16, False)])
def test_large_tables_are_dealt_out_by_their_join_only(spark, tmp_path, files, dealt):
    """Tables in as many splits as there are cores cross no exchange before that of the join; small files are dealt to all cores."""
    lines = spark.range(600).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "'N' AS l_returnflag", "0.01D AS l_tax", "'O' AS l_linestatus", "id % 50 + 0D AS l_quantity",
        "id + 0.5D AS l_extendedprice", "0D AS l_discount", "id % 7 AS l_suppkey")
    orders = spark.range(500).selectExpr("id AS o_orderkey", "DATE'2020-01-31' AS o_orderdate", "id % 9 AS o_custkey")
    for name, rows in (("lineitem", lines), ("orders", orders)):
        rows.repartition(files).write.parquet(f"{tmp_path}/{name}.parquet")
    sales = fixture(spark, str(tmp_path), "sales_cur")
    assert ("RoundRobinPartitioning" in physical(sales)) == dealt
    assert sales.agg(F.count("*"), F.sum("_row_index")).first() == (500, sum(8 * i + 3 for i in range(500)))


def _sheets(spark, repeats):
    """Clients, and the two sheets of 400 sales; a `repeats`-th of the history's sales comes twice, and as many are in both sheets."""
    names = spark.range(40).selectExpr("concat('n', id) AS name", "md5(concat('n', id)) AS legacy_id")
    raw = spark.range(400).selectExpr("id", "concat('n', id % 41) AS who", "concat('0', 1 + id % 9, '.05.2024') AS day", "concat('p', id) AS what")
    row = lambda df, shift, mark: df.selectExpr(
        *[f"{v} AS `{c}`" for c, v in _CELLS[mark].items()], f"id + {shift} AS _row_index", f"md5(concat('{mark}', id, {shift})) AS __row_hash")
    both = raw.where(f"id % {repeats} = 1")
    return names, row(raw, 0, "cur"), row(raw.selectExpr("id + 400 AS id", "who", "day", "concat('h', what) AS what").unionByName(both), 0, "hst").unionByName(
        row(both, 900, "hst"))


_CELLS = {
    "cur": {"data": "day", "klient": "who", "produkt": "what", "okonchatelnaya_stoimost": "'5'", "nalichnye": "'5'"} | dict.fromkeys(
        ("tip", "kategoriya", "kolichestvo", "polnaya_stoimost", "skidka", "perevod", "terminal", "vdolg", "kommentariy", "admin", "trener"), "'1'"),
    "hst": {"date": "day", "client_full": "who", "product": "what", "final_price": "'5'"} | dict.fromkeys(
        ("product_type", "product_category", "quantity", "full_price"), "'2'"),
}


@pytest.mark.parametrize(("repeats", "most"), [(7, 1000), (7, 5)])
def test_sales_that_come_once_do_not_meet_by_id(spark, no_broadcast, monkeypatch, repeats, most):
    """Only rows whose id another row has are windowed; the rows are those of the plain windows, however many ids repeat."""
    monkeypatch.setattr(merge, "AGAIN_MOST", most)
    names, cur, hst = (materialize(df) for df in _sheets(spark, repeats))
    now, core = F.lit("2024-06-01").cast("timestamp"), layout.empty(spark, layout.SALES)
    merged = lambda again: transforms.merge_current_then_history(
        core, transforms.sales_rows(cur, names, now, again=again), transforms.sales_rows(hst, names, now, history=True, again=again), now)
    again = transforms.sales_again(cur, hst)
    assert (again is None) == (most == 5)
    plain, found = merged(None), merged(again)
    assert found.columns == plain.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    if again is None:
        return
    # 57 of the history's ids come two or three times, and lie apart from the rest before they are looked up by name
    assert again.count() == 57
    plan = physical(merged(again))
    assert plan.count("LeftAnti") == plan.count("LeftSemi") == len(re.findall(r"Exchange hashpartitioning\(legacy_id", plan)) == 2


def test_sheets_without_repeated_ids_are_not_windowed(spark):
    names, cur, _ = (materialize(df) for df in _sheets(spark, 1000))
    now, again = F.lit("2024-06-01").cast("timestamp"), transforms.sales_again(cur, None)
    rows = transforms.history_over_current(transforms.sales_rows(cur, names, now, again=again), None)
    assert not re.search("Window|LeftAnti|LeftSemi|legacy_id#[0-9]+, [0-9]+", physical(rows).replace("min(legacy_id", ""))
    assert rows.count() == 400 - 400 // 41 and "__again" not in rows.columns


def test_first_per_key_on_events(spark):
    plan = physical(merge.first_per_key(table(spark, SF, "events"), ["user_id"], ["ts"]))
    assert plan.count("WindowGroupLimit") == 2


@pytest.fixture
def all_partitions(spark):
    """As on a large table, whose partitions are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_recent_days_leave_out_the_rest(spark, all_partitions):
    """Of a core table written in ranges of its dates, the API views read what their days need, also with one day that has a third of the rows."""
    day = F.when(F.col("id") % 3 == 0, F.lit("2022-06-01").cast("date")).otherwise(F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 1200).cast("int")))
    rows = spark.range(60_000).select(F.col("id").cast("string").alias("legacy_id"), day.cast("timestamp").alias("date"), F.lit("p").alias("product_name"))
    core = layout.conform(rows, layout.SALES, F.lit("2024-01-01").cast("timestamp"))
    written = materialize(sinks.clustered(core, "date", "legacy_id"), "by_date")
    as_of = F.lit("2024-04-01").cast("timestamp")
    view = marts.api_sales(written, as_of)
    assert view.count() == marts.api_sales(core, as_of).count() > 0
    assert "GreaterThanOrEqual(date" in physical(view)
    files = written.groupBy(F.input_file_name()).agg(F.min("date").alias("low"), F.max("date").alias("high"), F.count("*").alias("n"))
    since = F.date_sub(F.to_date(as_of), fv.API_DAYS)
    read = files.where(F.col("high") >= since)
    assert read.count() <= files.count() / 2
    # the hot day lies in several files
    assert files.where("low <= TIMESTAMP'2022-06-01' AND high >= TIMESTAMP'2022-06-01'").count() >= 2


def test_what_is_collected():
    """Lines that bring rows to the driver: a few by their nature."""
    import pathlib

    allowed = [
        "for row in spark.sql(f\"SHOW PARTITIONS {table}\").collect():          # one row per day",
        "found = {r[\"key\"]: r[\"value\"] for r in spark.sql(f\"SHOW TBLPROPERTIES {version}\").collect()}",
        "return {r[\"bucket\"]: r[\"place\"] for r in manifest(spark, layout).collect()}          # at most layout.n",
        "return sorted(r[0] for r in found.collect())",
        "rows = spark.sql(f\"SHOW TBLPROPERTIES {view}\").where(F.col(\"key\") == _VERSION).collect()     # one row",
        "totals[\"issues\"] = [r.asDict() for r in quality.first_issues(issues).collect()]   # at most ten",
        ").collect()                                        # at most HEADER_SCAN_ROWS rows",
    ]
    found = []
    package = pathlib.Path(cdc.__file__).parent.parent
    for path in package.rglob("*.py"):
        if package / "llm" not in path.parents:
            found += [line.strip() for line in path.read_text("utf-8").splitlines() if ".collect()" in line or ".toPandas" in line]
    assert sorted(found) == sorted(allowed)
