"""The daily full refresh: files to raw, staging, silver, gold and aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.clock import RunClock
from shelfmark.operators.checks import run_checks
from shelfmark.operators.surrogate import hash_key, lasting_key, level_key
from shelfmark.plans import aggregates, contracts, gold, silver
from shelfmark.plans.reports import enough_fact_rows
from shelfmark.plans.staging import STAGERS
from shelfmark.schemas import ENTITIES, GOLD, RAW, SILVER, STAGING
from shelfmark.session import fit_shuffle, tune
from shelfmark.sources.lake import Lake
from shelfmark.sources.landing import load_all

DIMENSION_KEYS = {
    "dim_product": ("Product_Key", ["Product_SKU"]),
    "dim_store": ("Store_Key", ["Store_ID"]),
    "dim_customer": ("Customer_Key", ["Customer_ID"]),
    "dim_promotion": ("Promotion_Key", ["Promotion_ID"]),
    "dim_weather": ("Weather_Key", ["Weather_Date", "Store_ID"]),
}


def silver_name(table: str) -> str:
    return f"{table}_clean"


def staging_name(table: str) -> str:
    return f"stg_{table}"


# keys that need no order: digests of the natural key
SILVER_KEYS = {
    "pos_transactions_header": ("Transaction_Header_SK", ["Transaction_ID"]),
    "pos_transactions_lines": ("Transaction_Line_SK", ["Transaction_Line_ID"]),
    "erp_products": ("Product_SK", ["Product_SKU", "Version_Number"]),
    "erp_stores": ("Store_SK", ["Store_ID"]),
    "crm_customers": ("Customer_SK", ["Customer_ID"]),
    "mkt_promotions": ("Promotion_SK", ["Promotion_ID"]),
    "erp_inventory": ("Inventory_SK", ["Inventory_ID"]),
    "api_weather": ("Weather_SK", ["Weather_Date", "Store_ID"]),
}
AGGREGATE_KEYS = {
    "agg_sales_daily": ("Daily_Sales_Key", ["Transaction_Date", "Store_ID"]),
    "agg_sales_monthly": ("Monthly_Sales_Key", ["Year", "Month", "Store_ID", "Category"]),
    "agg_product_performance": ("Product_Performance_Key", ["Product_SKU", "Store_ID", "Year", "Month"]),
}

BUCKETED = ("pos_transactions_header", "pos_transactions_lines")


def transaction_buckets(lake: Lake) -> int:
    """Buckets of headers and lines, the same for both: the shuffle partitions that the run was fitted to."""
    conf = lake.spark.conf
    return int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))


def stage_all(lake: Lake, clock: RunClock) -> None:
    for table, stage in STAGERS.items():
        lake.refresh(STAGING, staging_name(table), stage(lake.read(RAW, table), clock))


def refine_all(lake: Lake, clock: RunClock, mask_secret: str | None = None) -> None:
    def staged(table: str) -> DataFrame:
        # on stored columns this filter reaches the scan
        return lake.read(STAGING, staging_name(table)).filter("DQ_Is_Valid = 1")

    def clean(table: str) -> DataFrame:
        return lake.read(SILVER, silver_name(table))

    # each table is stored before another one reads it, so no plan is computed twice
    steps: dict[str, Callable[[], DataFrame]] = {
        "erp_stores": lambda: silver.clean_stores(staged("erp_stores"), clock),
        "erp_products": lambda: silver.clean_products(staged("erp_products"), clock),
        "crm_customers": lambda: silver.clean_customers(staged("crm_customers"), clock, mask_secret),
        "mkt_promotions": lambda: silver.clean_promotions(staged("mkt_promotions"), clock),
        "api_weather": lambda: silver.clean_weather(staged("api_weather"), clock),
        "erp_inventory": lambda: silver.clean_inventory(
            staged("erp_inventory"), staged("erp_products"), staged("erp_stores"), clock
        ),
        "pos_transactions_header": lambda: silver.silver_measures_header(
            silver.clean_header(staged("pos_transactions_header"), clean("erp_stores"), clock)
        ),
        "pos_transactions_lines": lambda: silver.silver_measures_lines(
            silver.clean_lines(staged("pos_transactions_lines"), clock)
        ),
    }
    for table, build in steps.items():
        # headers and lines meet by transaction in the fact and in reports: stored so, they need no shuffle there
        buckets = (transaction_buckets(lake), "Transaction_ID") if table in BUCKETED else None
        name, natural = SILVER_KEYS[table]
        lake.refresh(SILVER, silver_name(table), build().withColumn(name, hash_key(*natural)), bucket_by=buckets)


def stored_sales(lines: DataFrame, headers: DataFrame, clock: RunClock) -> DataFrame:
    sales = gold.fact_sales(lines, headers, clock)
    return gold.with_sales_month(sales.withColumn("Sales_Key", hash_key("Transaction_Line_ID")))


def lasting_keys(lake: Lake, table: str, df: DataFrame, name: str, natural: list[str]) -> DataFrame:
    """The stored key map of a dimension, with new natural keys numbered on. Keys of rows that left the
    dimension are kept for their return."""
    stored = f"{table}_keys"
    known = lake.read(GOLD, stored) if lake.exists(GOLD, stored) else None
    return lake.refresh(GOLD, stored, lasting_key(df, name, natural, known))


def publish_all(lake: Lake, clock: RunClock) -> None:
    def clean(table: str) -> DataFrame:
        return lake.read(SILVER, silver_name(table))

    dimensions = {
        "dim_product": gold.dim_product(clean("erp_products"), clock),
        "dim_store": gold.dim_store(clean("erp_stores"), clock),
        "dim_customer": gold.dim_customer(clean("crm_customers"), clock),
        "dim_promotion": gold.dim_promotion(clean("mkt_promotions"), clock),
        "dim_weather": gold.dim_weather(clean("api_weather"), clock),
    }
    for table, df in dimensions.items():
        name, natural = DIMENSION_KEYS[table]
        keys = lasting_keys(lake, table, df, name, natural)
        lake.refresh(GOLD, table, df.join(keys, natural))
    lake.refresh(GOLD, "dim_date", gold.dim_date(lake.spark, clock))
    lake.refresh(
        GOLD,
        "bridge_promotion_product",
        gold.bridge_promotion_product(clean("mkt_promotions"), clean("erp_products"), clock),
    )
    sales = stored_sales(clean("pos_transactions_lines"), clean("pos_transactions_header"), clock)
    lake.refresh(GOLD, "fact_sales", sales, partition_by=["Sales_Month"], sort_by=gold.FACT_SALES_SORT)
    stock = gold.fact_inventory_snapshot(clean("erp_inventory"), clock)
    stock = stock.withColumn("Inventory_Snapshot_Key", hash_key("Product_SKU", "Store_ID", "Snapshot_Date"))
    lake.refresh(GOLD, "fact_inventory_snapshot", stock)


def stored_aggregates(sales: DataFrame, products: DataFrame, clock: RunClock) -> dict[str, DataFrame]:
    built = aggregates.by_month(sales, products)
    for table, (name, natural) in AGGREGATE_KEYS.items():
        built[table] = built[table].withColumns({name: level_key(*natural), "Created_TS": clock.stamp()})
    return built


def aggregate_all(lake: Lake, clock: RunClock) -> None:
    for table, df in stored_aggregates(lake.read(GOLD, "fact_sales"), lake.read(GOLD, "dim_product"), clock).items():
        lake.refresh(GOLD, table, df, partition_by=["Sales_Month"])


def publish_loads(lake: Lake, batches: Sequence[str], clock: RunClock) -> list[int]:
    """Bring the sales fact and its aggregates up to date with some loads of headers and lines, after
    staging and silver hold them; returns the months that were rewritten.

    Only months that the loads touch are computed and stored; the folders of all others stay as they
    are. Categories of products are taken as unchanged: when they change, the monthly aggregate has
    to be built as a whole."""
    def loaded(table: str) -> DataFrame:
        staged = lake.read(STAGING, staging_name(table)).filter(F.col("Batch_ID").isin(*batches))
        return staged.filter("Transaction_ID IS NOT NULL")

    headers, lines = (lake.read(SILVER, silver_name(table)) for table in BUCKETED)
    touched = gold.touched_months(lake.read(GOLD, "fact_sales"), headers, *map(loaded, BUCKETED))
    # no more than the months of the calendar
    months = sorted(r["Sales_Month"] for r in touched.collect())
    if not months:
        return months
    sales = stored_sales(lines, gold.in_months(headers, months), clock)
    fact = lake.replace_partitions(GOLD, "fact_sales", sales, "Sales_Month", months, gold.FACT_SALES_SORT)
    part = fact.filter(F.col("Sales_Month").isin(*months))
    for table, df in stored_aggregates(part, lake.read(GOLD, "dim_product"), clock).items():
        lake.replace_partitions(GOLD, table, df, "Sales_Month", months)
    return months


def check_all(lake: Lake) -> DataFrame:
    """Failures of every declared check, as one report."""
    reports = []
    for layer, named, checks in (
        (STAGING, str, contracts.staging_checks()),
        (SILVER, silver_name, contracts.silver_checks()),
        (GOLD, str, contracts.gold_checks()),
    ):
        for table, rules in checks.items():
            reports.append(run_checks(lake.read(layer, named(table)), named(table), rules))
    return reduce(DataFrame.unionByName, reports)


class LoadFailed(RuntimeError):
    """Some files could not be loaded; `loaded` has the status per file."""

    def __init__(self, loaded: dict[str, bool]) -> None:
        super().__init__(f"not loaded: {[file for file, ok in loaded.items() if not ok]}")
        self.loaded = loaded


def store_quality(lake: Lake) -> DataFrame:
    """Store the report of all checks with the row gate of the fact, and return what failed."""
    gate = enough_fact_rows(lake.read(GOLD, "fact_sales"))
    short = gate.select(
        F.lit("fact_sales").alias("Table_Name"), F.lit("least_rows").alias("Check_Name"), (1 - F.col("Passed")).cast("long").alias("Failures")
    )
    return lake.refresh(GOLD, "quality_report", check_all(lake).unionByName(short)).filter("Failures > 0")


def run(lake: Lake, raw_dir: str, clock: RunClock, truncate: bool = True, mask_secret: str | None = None) -> dict[str, bool]:
    """Load the files and rebuild every table; returns the load status per file.

    A file that cannot be loaded stops the run before anything is rebuilt, so the published
    tables never mix the data of two days. The report of the checks is stored at the end."""
    tune(lake.spark)
    lake.create_layers()
    loaded = load_all(lake, raw_dir, clock.run_ts, truncate)
    if not all(loaded.values()):
        raise LoadFailed(loaded)
    missing = [e.file for e in ENTITIES.values() if not lake.exists(RAW, e.table)]
    if missing:
        raise RuntimeError(f"no raw data for {missing}")
    fit_shuffle(lake.spark, max(lake.stored_bytes(RAW, e.table) for e in ENTITIES.values()))
    stage_all(lake, clock)
    refine_all(lake, clock, mask_secret)
    publish_all(lake, clock)
    aggregate_all(lake, clock)
    store_quality(lake)
    return loaded
