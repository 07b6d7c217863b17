"""Plans at scale: what is shuffled, broadcast and split."""

import datetime as dt
import re
import time
from decimal import Decimal as N

import pytest
from conftest import frame
from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.operators.dedupe import keep_latest
from shelfmark.operators.existence import flag_existing
from shelfmark.operators.overlap import count_overlapping_pairs
from shelfmark.operators.quality import flagged_rows
from shelfmark.operators.surrogate import dense_key
from shelfmark.plans import aggregates, analytics, gold, reports
from shelfmark.plans.staging import VALID, stage_header, stage_lines
from shelfmark.sources.lake import Lake
from test_layers import HEADER, LINE
from verification import feeds, queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    changed = {}

    def change(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def small_skew_limits(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2000",
        spark__sql__shuffle__partitions="8",
    )


def hot(spark, rows=20000):
    """A third of the rows has one key."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id"),
        F.md5(F.col("id").cast("string")).alias("pad"),
    )


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    plan = plan_of(keep_latest(hot(spark), ["k"], ["id"]))
    partial, final = plan.index("Final"), plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2 and partial < plan.index("Exchange") < final


def test_hot_key_of_a_link_is_split(spark, small_skew_limits, tmp_path):
    left, keys = str(tmp_path / "left"), str(tmp_path / "keys")
    hot(spark).write.parquet(left)
    hot(spark).select("k").distinct().write.parquet(keys)
    joined = flag_existing(spark.read.parquet(left), "k", spark.read.parquet(keys), "hit", reference_is_unique=True)
    rows = joined.agg(F.sum("hit"), F.count("*"))
    assert tuple(rows.collect()[0]) == (20000, 20000)
    assert "skew=true" in plan_of(rows)


def test_repeated_reference_keys_are_salted(spark, small_skew_limits):
    flagged = flag_existing(hot(spark), "k", hot(spark), "hit")
    assert re.search(r"hashpartitioning\([^)]*__salt", plan_of(flagged))
    sizes = flagged.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in sizes) == 20000
    assert flagged.agg(F.sum("hit")).first()[0] == 20000


def test_missing_keys_are_spread(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    df = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
    flagged = flag_existing(df, "k", hot(spark).select("k").distinct(), "hit", reference_is_unique=True, null_passes=True)
    per_task = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 4000 and max(per_task) < 2000
    assert flagged.agg(F.min("hit")).first()[0] == 1


def test_shuffles_start_with_enough_partitions(spark, settings, tmp_path):
    settings(spark__sql__adaptive__coalescePartitions__initialPartitionNum="4")
    lake = Lake(spark, str(tmp_path), prefix="size_")
    lake.create_layers()
    stored = lake.refresh("gold", "t", spark.range(10000))
    assert stored.count() == 10000 and lake.stored_bytes("gold", "t") > 10000
    assert session.fit_shuffle(spark, lake.stored_bytes("gold", "t")) == 4
    assert session.fit_shuffle(spark, 2**40) == 2**40 // session.PARTITION_BYTES + 1
    assert session.fit_shuffle(spark, 2**44) == 2**44 // session.PARTITION_BYTES + 1


def test_a_running_session_can_be_tuned(spark):
    assert all(spark.conf.isModifiable(name) for name in session.RUNTIME_SETTINGS)
    other = spark.newSession()
    session.tune(other)
    assert {n: other.conf.get(n) for n in session.RUNTIME_SETTINGS} == session.RUNTIME_SETTINGS


def test_no_pairs_are_built_for_overlaps(spark):
    df = frame(spark, "item string, a date, z date", ("p", dt.date(2024, 1, 1), dt.date(2024, 1, 2)))
    plan = plan_of(count_overlapping_pairs(df, "item", "a", "z"))
    assert "Join" not in plan and "Cartesian" not in plan


def test_dense_key_broadcasts_only_bucket_offsets(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    plan = plan_of(dense_key(df, "n", ["k"]))
    assert plan.count("BroadcastExchange") == 1
    # the only unpartitioned window runs over the bucket sizes
    assert plan.count("SinglePartition") == 1


@pytest.fixture
def fact(spark):
    return frame(
        spark,
        "Transaction_ID string, Customer_ID string, Transaction_Date date, Store_ID string, Product_SKU string, Quantity int, "
        "Unit_Price decimal(18,2), Line_Sales_Amount decimal(18,2), Line_Cost_Amount decimal(24,4), Line_Margin_Amount decimal(24,4), Discount_Amount decimal(18,2)",
        ("T1", "C1", dt.date(2024, 1, 1), "S1", "P1", 1, N(1), N(1), N(1), N(0), N(0)),
    )


def test_store_performance_counts_transactions_without_expanding(spark, fact):
    stores = frame(spark, "Store_ID string, Store_Name string, Region string, City string", ("S1", "A", "N", "X"))
    assert "Expand" not in plan_of(analytics.store_performance(fact, stores))


def test_monthly_levels_copy_rows_once_per_level(spark, fact):
    products = frame(spark, "Product_SKU string, Category string, Is_Current int", ("P1", "Food", 1))
    plan = plan_of(aggregates.sales_monthly(fact, products))
    assert "Expand" not in plan and plan.count("Generate inline") == 1


def test_staged_filter_reaches_the_stored_table(spark, raw, clock, tmp_path):
    path = str(tmp_path / "stg")
    stage_lines(raw("pos_transactions_lines", [LINE]), clock).write.parquet(path)
    plan = plan_of(spark.read.parquet(path).filter("DQ_Is_Valid = 1").select("Transaction_ID", "Quantity"))
    assert "PushedFilters: [IsNotNull(DQ_Is_Valid), EqualTo(DQ_Is_Valid,1)]" in plan
    assert re.search(r"ReadSchema: struct<Transaction_ID:string,Quantity:int,DQ_Is_Valid:int>", plan)


def test_fact_months_prune(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(10).selectExpr("id", "CAST(202401 + id % 2 AS INT) AS Sales_Month").write.partitionBy("Sales_Month").parquet(path)
    plan = plan_of(spark.read.parquet(path).filter("Sales_Month = 202401"))
    assert "PartitionFilters: [isnotnull(Sales_Month" in plan


def stored_fact(spark, fact, path):
    """The fact as the run stores it: split by month, its partitioning by transaction lost."""
    gold.with_sales_month(fact).write.partitionBy("Sales_Month").parquet(path)
    return spark.read.parquet(path)


def shuffles(plan):
    return re.findall(r"Exchange (?:hashpartitioning|RoundRobin)[^\n]*", plan)


def test_aggregates_move_stored_lines_once(spark, fact, tmp_path):
    stored = stored_fact(spark, fact, str(tmp_path / "fact"))
    products = frame(spark, "Product_SKU string, Category string, Is_Current int", ("P1", "Food", 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    for df in (aggregates.sales_monthly(stored, products), aggregates.product_performance(stored)):
        by_transaction = [x for x in shuffles(plan_of(df)) if "Transaction_ID" in x]
        # the lines, before any copy for a level is made
        assert len(by_transaction) == 1 and "REPARTITION" in by_transaction[0]


def test_weather_impact_reads_one_year(spark, fact, tmp_path):
    stored = stored_fact(spark, fact, str(tmp_path / "fact"))
    day = dt.date(2024, 1, 1)
    weather = frame(spark, "Weather_Date date, Store_ID string, Weather_Condition string, Temperature_C double", (day, "S1", "CLEAR", 1.0))
    dates = frame(spark, "Date_Value date, Year int", (day, 2024))
    plan = plan_of(analytics.weather_impact(stored, weather, dates, 2024))
    assert re.search(r"PartitionFilters: \[[^\]]*Sales_Month", plan)


def test_only_valid_rows_meet_in_store_mismatches(spark):
    header = frame(spark, "Transaction_ID string, Store_ID string, DQ_Is_Valid int", ("T1", "S1", 1), ("", "S1", 0))
    lines = frame(spark, "Transaction_ID string, Store_ID string, DQ_Is_Valid int", ("T1", "S2", 1), ("", "S2", 0), ("T1", "S3", 0))
    found = reports.store_mismatches(header, lines)
    assert [tuple(r) for r in found.collect()] == [("T1", "S1", "S2")]
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    join = optimized.index("Join")
    assert "DQ_Is_Valid" not in optimized[:join] and optimized[join:].count("Filter") >= 2 or "LocalRelation" in optimized[join:]


def test_flagged_rows_do_not_parse_twice(spark, raw, clock):
    staged = stage_header(raw("pos_transactions_header", [HEADER, {**HEADER, "Total_Amount": "-1"}, {}]), clock)
    kept = flagged_rows(staged, VALID, "Transaction_ID", F.col("Store_ID").alias("Shop"))
    assert kept.columns == ["Transaction_ID", "Shop"]
    assert kept.collect() == staged.filter(F.col(VALID) == 1).select("Transaction_ID", F.col("Store_ID").alias("Shop")).collect()

    def parsed(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")

    assert 0 < parsed(kept) <= parsed(staged.select("Transaction_ID", "Store_ID", VALID))


ADVISORY, INITIAL = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SCANNED = "spark.sql.files.maxPartitionBytes"


def test_tasks_grow_with_the_input(spark):
    other = spark.newSession()
    other.conf.set(ADVISORY, "64MB")
    assert session.bound_tasks(other, 2**40) == int(other.conf.get(INITIAL)) == 2**40 // session.INPUT_BYTES + 1
    assert {n: int(other.conf.get(n)) for n in session.TASK_BYTES} == session.TASK_BYTES
    # a smaller table does not take partitions away, and a smaller bound stays
    other.conf.set(ADVISORY, "2k")
    other.conf.set(SCANNED, "2000b")
    assert session.bound_tasks(other, 100) == 1
    assert int(other.conf.get(INITIAL)) > 1 and (other.conf.get(ADVISORY), other.conf.get(SCANNED)) == ("2k", "2000b")


def test_reading_a_table_bounds_the_tasks(spark, tmp_path):
    spark.range(100000).write.parquet(str(tmp_path / "part.parquet"))
    other = spark.newSession()
    assert session._bytes(other.conf.get(ADVISORY)) > session.TASK_BYTES[ADVISORY]
    assert feeds.table(other, str(tmp_path), "part").count() == 100000
    assert int(other.conf.get(ADVISORY)) == session.TASK_BYTES[ADVISORY]
    stored = sum(f.stat().st_size for f in (tmp_path / "part.parquet").glob("part-*"))
    assert session.input_bytes(other, str(tmp_path / "part.parquet")) == stored


def test_joined_fact_is_not_moved_again(spark, fact, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    lines = fact.drop("Customer_ID", "Transaction_Date")
    joined = lines.join(fact.select("Transaction_ID", "Customer_ID", "Transaction_Date").repartition("Customer_ID"), "Transaction_ID")
    assert "REPARTITION_BY_COL" not in "".join(x for x in shuffles(plan_of(aggregates.product_performance(joined, stored=False))) if "Transaction_ID" in x)


def test_products_of_a_transaction_count_it_once(spark, fact):
    again = fact.unionByName(fact.withColumns({"Quantity": F.lit(2), "Unit_Price": F.lit(N(2))}))
    rows = again.unionByName(fact.withColumns({"Store_ID": F.lit(None).cast("string"), "Quantity": F.lit(None).cast("int")}))
    for stored in (True, False):
        found = aggregates.product_performance(rows, stored).select("Store_ID", "Units_Sold", "Transaction_Count", "Avg_Unit_Price", "Total_Sales_Amount")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(
            [("S1", 3, 1, N("1.50"), N(2)), (None, None, 1, N(1), N(1)), (None, 3, 1, N("1.33"), N(3))], key=str
        )


def test_overlaps_of_a_product_bound_their_tasks(spark, tmp_path):
    parts = [(k, "name", 10, 1000.0) for k in range(30, 60)]
    frame(spark, "p_partkey long, p_name string, p_size int, p_retailprice double", *parts).write.parquet(str(tmp_path / "part.parquet"))
    other = spark.newSession()
    other.conf.set(ADVISORY, "64m")
    found = queries.REGISTRY["overlap_same_sku"](other, str(tmp_path))
    # before any of its partitions are merged
    assert int(other.conf.get(ADVISORY)) == session.TASK_BYTES[ADVISORY]
    assert found.columns == ["Product_SKU", "Promotion_ID", "Overlapping_Others"]


def test_rebuilt_months_clean_their_rows_once(spark, tmp_path):
    day = dt.date(2001, 11, 5)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_regionkey int", [(0, 0)]),
        "supplier": ("s_suppkey int, s_name string, s_nationkey int", [(s, f"store {s}", 0) for s in range(1, 11)]),
        "part": ("p_partkey int, p_name string, p_size int, p_retailprice double", [(1, "name", 10, 1000.0)]),
        "orders": (
            "o_orderkey int, o_custkey int, o_orderpriority string, o_orderdate date, o_totalprice double",
            [(k, 1, "1-URGENT", day, 100.0) for k in range(1, 11)],
        ),
        "lineitem": (
            "l_orderkey int, l_linenumber int, l_partkey int, l_suppkey int, l_returnflag string, l_shipdate date, "
            "l_quantity double, l_extendedprice double, l_discount double",
            [(k, n, 1, 1, "N", day, 2.0, 50.0, 0.05) for k in range(1, 11) for n in (1, 2)],
        ),
    }
    for name, (ddl, rows) in tables.items():
        frame(spark, ddl, *rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = queries.REGISTRY["rebuilt_months"](spark.newSession(), str(tmp_path))
    # the fact comes from the rows stored for the touched months, not from the feeds again
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]
    assert {r["Sales_Month"] for r in found.collect()} <= {200105, 200111}
    assert found.count() > 0


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def shuffles_left(spark, before, most=0):
    """Shuffles whose files stay, once no more than ``most`` do: executors delete them shortly after the job."""
    for _ in range(100):
        left = {name.split("_")[1] for name in shuffle_files(spark) - before}
        if len(left) <= most:
            break
        time.sleep(0.1)
    return left


def test_stored_rows_leave_no_shuffle_files(spark):
    rows = spark.range(10_000).select(F.xxhash64("id").alias("key"), "id").groupBy("key").agg(F.max("id").alias("id"))
    before, setting = shuffle_files(spark), spark.conf.get(session.CLEAN_UP, "false")
    kept = session.stored(rows, "rows")
    assert not shuffles_left(spark, before) and spark.conf.get(session.CLEAN_UP, "false") == setting
    # the owner's frame can still be run
    assert rows.collect() and sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect()))


def test_stored_columns_are_the_ones_read(spark):
    rows = frame(spark, "key string, n int, price decimal(18,2), day date", ("a", 1, N(2), dt.date(2024, 1, 1)), (None, None, None, None))
    kept = session.stored(rows, "rows", ["key", "price"])
    assert spark.read.parquet(*kept.inputFiles()).columns == ["key", "price"]
    # a plan over the whole frame can be built; what it does not return is not needed
    assert kept.schema == rows.schema
    assert sorted(kept.withColumn("twice", F.col("n") * 2).select("price", "key").collect(), key=str) == sorted(rows.select("price", "key").collect(), key=str)
    for missing in ("n", "day"):
        with pytest.raises(Exception, match=f"{missing} is not among the stored rows"):
            kept.select("key", missing).collect()


def test_rebuilt_months_store_what_they_read(spark, tmp_path):
    day = dt.date(2001, 11, 5)
    for name, ddl, *rows in (
        ("region", "r_regionkey int, r_name string", (0, "ASIA")),
        ("nation", "n_nationkey int, n_regionkey int", (0, 0)),
        ("supplier", "s_suppkey int, s_name string, s_nationkey int", *[(s, f"store {s}", 0) for s in range(1, 11)]),
        ("part", "p_partkey int, p_name string, p_size int, p_retailprice double", (1, "name", 10, 1000.0)),
        ("orders", "o_orderkey int, o_custkey int, o_orderpriority string, o_orderdate date, o_totalprice double", *[(k, 1, "1-URGENT", day, 100.0) for k in range(1, 11)]),
        (
            "lineitem",
            "l_orderkey int, l_linenumber int, l_partkey int, l_suppkey int, l_returnflag string, l_shipdate date, l_quantity double, l_extendedprice double, l_discount double",
            *[(k, n, 1, 1, "N", day, 2.0, 50.0, 0.05) for k in range(1, 11) for n in (1, 2)],
        ),
    ):
        frame(spark, ddl, *rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = shuffle_files(spark)
    found = queries.REGISTRY["rebuilt_months"](spark.newSession(), str(tmp_path))
    # neither the cleaning nor the search for months leaves shuffle files behind, only the listing of each of the six tables
    assert len(shuffles_left(spark, before, 6)) <= 6
    files = found.inputFiles()
    for name, columns in (("lines", queries.LINES_READ), ("headers", queries.HEADERS_READ)):
        assert set(spark.read.parquet(*[f for f in files if f"/{name}-" in f]).columns) == set(columns)
    sums = found.select("Sales_Month", F.col("Line_Count").cast("int"), F.col("Transaction_Count").cast("int")).collect()
    assert sums and all(lines == 2 * transactions for _, lines, transactions in sums)


def test_daily_sums_are_moved_once(spark, fact, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    lines = fact.drop("Customer_ID", "Transaction_Date")
    joined = lines.join(fact.select("Transaction_ID", "Customer_ID", "Transaction_Date"), "Transaction_ID")
    moved = shuffles(plan_of(aggregates.sales_daily(joined)))
    # the two sides of the join, then the sums by day and store: not again by customer
    assert len(moved) == 3 and sum("Transaction_Date" in x for x in moved) == 1


def test_customers_of_a_day_are_counted_once(spark, fact):
    other = fact.withColumn("Transaction_ID", F.lit("T2"))
    walk_in = fact.withColumns({"Transaction_ID": F.lit("T3"), "Customer_ID": F.lit(None).cast("string")})
    rows = fact.unionByName(fact).unionByName(other).unionByName(walk_in).unionByName(other.withColumn("Store_ID", F.lit(None).cast("string")))
    found = aggregates.sales_daily(rows).select("Store_ID", "Transaction_Count", "Line_Count", "Units_Sold", "Unique_Customers", "Total_Sales_Amount")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("S1", 3, 4, 4, 1, N(4)), (None, 1, 1, 1, 1, N(1))], key=str)
