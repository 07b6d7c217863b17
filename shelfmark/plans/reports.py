"""Validation reports over the staging tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.clock import RunClock
from shelfmark.functions import rules
from shelfmark.functions.dates import covered_days, year_span
from shelfmark.functions.numbers import MONEY, or_zero, share, total_money
from shelfmark.operators.overlap import count_overlapping_pairs
from shelfmark.operators.quality import flagged_rows
from shelfmark.plans.staging import VALID


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def reconciliation(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after staging, and how many of them are valid; one scan per table."""

    def of(name: str) -> DataFrame:
        before = raw[name].agg(F.count(F.lit(1)).alias("Raw_Count"))
        after = staged[name].agg(
            F.count(F.lit(1)).alias("Staging_Count"), F.coalesce(F.sum(VALID), F.lit(0)).alias("Valid_Count")
        )
        # two one-row frames side by side
        both = _union(
            [
                before.select("Raw_Count", F.lit(0).alias("Staging_Count"), F.lit(0).alias("Valid_Count")),
                after.select(F.lit(0).alias("Raw_Count"), "Staging_Count", "Valid_Count"),
            ]
        )
        return both.agg(*[F.sum(c).alias(c) for c in both.columns]).withColumn("Table_Name", F.lit(name))

    rows = _union(of(name) for name in raw)
    same = F.col("Raw_Count") == F.col("Staging_Count")
    return rows.select(
        "Table_Name", "Raw_Count", "Staging_Count",
        F.when(same, "MATCH").otherwise("MISMATCH").alias("Match_Status"),
        "Valid_Count", share("Valid_Count", "Staging_Count").alias("Valid_Pct"),
    )


def overall(counts: DataFrame) -> DataFrame:
    total = counts.agg(
        F.sum("Raw_Count").alias("Total_Raw_Rows"),
        F.sum("Staging_Count").alias("Total_Staging_Rows"),
        F.sum("Valid_Count").alias("Total_Valid_Rows"),
    )
    return total.withColumn("Overall_Valid_Pct", share("Total_Valid_Rows", "Total_Staging_Rows"))


def quality_status(counts: DataFrame) -> DataFrame:
    """Totals with the status they earn."""
    total = overall(counts).withColumn(
        "Total_Invalid_Rows", F.col("Total_Staging_Rows") - F.col("Total_Valid_Rows")
    )
    status = None
    for limit, label in rules.STATUS_LADDER:
        reached = F.col("Total_Valid_Rows") * 100 >= F.col("Total_Staging_Rows") * limit
        status = F.when(reached, label) if status is None else status.when(reached, label)
    return total.withColumn("Status", status.otherwise(rules.STATUS_FLOOR))


def empty_tables(counts: DataFrame) -> DataFrame:
    return counts.filter("Staging_Count = 0").select("Table_Name")


def mismatched_tables(counts: DataFrame) -> DataFrame:
    return counts.filter("Match_Status = 'MISMATCH'").select("Table_Name", "Raw_Count", "Staging_Count")


def _missing(flag: str) -> Column:
    return F.count(F.lit(1)) - F.sum(flag)


# table -> (metric, count over the staged rows)
def scorecard_metrics() -> dict[str, list[tuple[str, Column]]]:
    return {
        "pos_transactions_header": [
            ("Walk-In Customers", F.sum("Is_Walk_In")),
            ("Has Discount", F.sum("Has_Discount")),
            ("Invalid Payment Method", _missing("DQ_Payment_Method_Valid")),
        ],
        "pos_transactions_lines": [
            ("Negative Quantities (Returns)", F.sum("Is_Negative_Quantity")),
            ("Has Discount", F.sum("Has_Discount")),
            ("Has Promotion", F.sum("Has_Promotion")),
            ("Pricing Issues (Cost > Price)", F.sum("Has_Price_Issue")),
        ],
        "erp_products": [
            ("Pricing Issues (Cost > Price)", F.sum("Has_Price_Issue")),
            ("Missing Category", _missing("DQ_Category_Valid")),
        ],
        "erp_stores": [("Multiple Managers", F.sum("Has_Multiple_Managers"))],
        "erp_inventory": [
            ("Negative Quantities", F.sum("Is_Negative_Quantity")),
            ("Outlier Quantities (>10K)", F.sum("Is_Outlier_Quantity")),
            ("Below Reorder Level", F.sum("Is_Below_Reorder_Level")),
        ],
        "crm_customers": [
            ("Missing Email", F.sum("Has_Missing_Email")),
            ("Missing Phone", F.sum("Has_Missing_Phone")),
            ("Invalid Gender", _missing("DQ_Gender_Valid")),
        ],
        "mkt_promotions": [
            ("Invalid Date Range (End < Start)", F.sum("Has_Invalid_Date_Range")),
            ("Multiple SKUs", F.sum("Has_Multiple_SKUs")),
        ],
        "api_weather": [
            ("Missing Temperature", F.sum("Has_Missing_Temperature")),
            ("Extreme Temperatures", F.sum("Is_Extreme_Temperature")),
        ],
    }


def scorecard(staged: Mapping[str, DataFrame]) -> DataFrame:
    """(table, metric, count, percentage): one aggregate per table, then its columns as rows."""

    def of(name: str, metrics: list[tuple[str, Column]]) -> DataFrame:
        one = staged[name].agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"m{i}") for i, (_, c) in enumerate(metrics)])
        cells = [F.struct(F.lit(label).alias("Metric"), F.col(f"m{i}").alias("Count")) for i, (label, _) in enumerate(metrics)]
        rows = one.select("n", F.inline(F.array(*cells)))
        return rows.select(F.lit(name).alias("Table_Name"), "Metric", "Count", share("Count", "n").alias("Pct"))

    return _union(of(name, metrics) for name, metrics in scorecard_metrics().items() if name in staged)


def _valid(column: str | None = None) -> Column:
    """The column where the row is valid, else NULL; without a column, 1.

    Aggregates skip NULLs, so a report reads its table once and needs no filter, which would be
    evaluated again on the raw text where staging is not stored."""
    return F.when(F.col(VALID) == 1, F.lit(1) if column is None else F.col(column))


def _average(column: Column) -> Column:
    return F.avg(column).cast(MONEY)


def sales_summary(header: DataFrame) -> DataFrame:
    return header.agg(
        F.countDistinct(_valid("Transaction_ID")).alias("Total_Transactions"),
        total_money(_valid("Total_Amount")).alias("Total_Sales"),
        _average(_valid("Total_Amount")).alias("Avg_Transaction_Value"),
        total_money(or_zero(_valid("Total_Discount"))).alias("Total_Discounts"),
    )


def product_portfolio(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(_valid()).alias("Total_Products"),
        F.countDistinct(_valid("Category")).alias("Unique_Categories"),
        F.countDistinct(_valid("Sub_Category")).alias("Unique_SubCategories"),
        _average(_valid("Price")).alias("Avg_Price"),
    )


def store_network(stores: DataFrame) -> DataFrame:
    return stores.agg(
        F.count(_valid()).alias("Total_Stores"),
        F.countDistinct(_valid("City")).alias("Unique_Cities"),
        F.countDistinct(_valid("Region")).alias("Unique_Regions"),
        _average(_valid("Store_Area_sqm")).alias("Avg_Store_Area_sqm"),
    )


def customer_base(customers: DataFrame, clock: RunClock) -> DataFrame:
    """The average age is cut to whole years, as an integer average is."""
    counted = F.when((F.col(VALID) == 1) & F.col("Birthdate").isNotNull(), F.lit(1))
    age = year_span("Birthdate", clock.today())
    return customers.agg(
        F.count(counted).alias("Total_Customers"),
        F.countDistinct(F.when(counted == 1, F.col("City"))).alias("Unique_Cities"),
        F.floor(F.avg(F.when(counted == 1, age))).cast("int").alias("Avg_Age"),
    )


def date_coverage(staged: Mapping[str, DataFrame]) -> DataFrame:
    datasets = (
        ("Transactions", "pos_transactions_header", "Transaction_Date", "Transaction_Date"),
        ("Weather", "api_weather", "Weather_Date", "Weather_Date"),
        ("Inventory", "erp_inventory", "Snapshot_Date", "Snapshot_Date"),
        ("Promotions", "mkt_promotions", "Start_Date", "End_Date"),
    )
    return _union(
        staged[table]
        .agg(F.min(_valid(first)).alias("Start_Date"), F.max(_valid(last)).alias("End_Date"))
        .select(F.lit(label).alias("Dataset"), "Start_Date", "End_Date", covered_days("Start_Date", "End_Date").alias("Total_Days"))
        for label, table, first, last in datasets
        if table in staged
    )


def repeated_keys(df: DataFrame, key: str, top: int = 5) -> DataFrame:
    """The keys with the most rows; ties in key order."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("Duplicate_Count")).filter("Duplicate_Count > 1")
    return counts.orderBy(F.desc("Duplicate_Count"), key).limit(top)


def suspect_categories(products: DataFrame) -> DataFrame:
    near = F.col("Category").like("%ELEC%") | F.col("Category").like("%BEVER%")
    return products.filter(near).select("Category").distinct()


def store_mismatches(header: DataFrame, lines: DataFrame) -> DataFrame:
    """Valid lines booked for another store than their valid header.

    Each side is reduced to its valid rows first: invalid ones share blank ids, and all of these
    would meet."""
    h = flagged_rows(header, VALID, "Transaction_ID", F.col("Store_ID").alias("Header_Store_ID"))
    l = flagged_rows(lines, VALID, "Transaction_ID", F.col("Store_ID").alias("Line_Store_ID"))
    return h.join(l, "Transaction_ID").filter(F.col("Header_Store_ID") != F.col("Line_Store_ID"))


def sample(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """A few rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def overlapping_promotions(promotions: DataFrame) -> DataFrame:
    return count_overlapping_pairs(
        promotions, "Promotion_ID", "Start_Date", "End_Date", "Overlapping_Promo_Pairs", usable=F.col(VALID) == 1
    )


def enough_fact_rows(fact: DataFrame, least: int = rules.MIN_FACT_ROWS) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("Fact_Rows")).withColumn("Passed", (F.col("Fact_Rows") >= least).cast("int"))


def dirty_header_sample(raw_header: DataFrame, rows: int = 5) -> DataFrame:
    return raw_header.select("Transaction_ID", "Total_Amount", "Total_Discount", "Payment_Method").limit(rows)


def missing_temperature_sample(raw_weather: DataFrame, rows: int = 10) -> DataFrame:
    blank = F.col("Temperature_C").isNull() | (F.col("Temperature_C") == "None")
    columns = ("Weather_Date", "Retail_Location_ID", "Temperature_C", "Weather_Condition")
    return raw_weather.filter(blank).select(*columns).limit(rows)
