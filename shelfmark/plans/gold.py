"""Star schema: dimensions, promotion bridge and facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.clock import RunClock
from shelfmark.functions import dates, measures, numbers, text

CALENDAR_START = "2010-01-01"
CALENDAR_YEARS_AHEAD = 10


def _stamped(df: DataFrame, columns: list, clock: RunClock) -> DataFrame:
    stamps = [c.alias(n) for n, c in clock.audit_columns().items()]
    return df.select(*columns, "DQ_Score", *stamps)


def _current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Is_Valid") == 1)


def calendar(bounds: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """One row per day between two dates of a one-row frame."""
    d = F.col("Date_Value")
    days = bounds.select(F.explode(F.sequence(text.as_col(start), text.as_col(end))).alias("Date_Value"))
    quarter = F.quarter(d).cast("string")
    weekend = F.dayofweek(d).isin(1, 7)
    holiday = ((F.month(d) == 1) & (F.dayofmonth(d) == 1)) | ((F.month(d) == 12) & (F.dayofmonth(d) == 25))
    return days.select(
        dates.date_key(d).alias("Date_SK"),
        d,
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.concat(F.lit("Q"), quarter).alias("Quarter_Name"),
        F.quarter(d).alias("Quarter_Sort"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("Month_Name"),
        F.date_format(d, "MMM").alias("Month_Short"),
        F.month(d).alias("Month_Sort"),
        F.weekofyear(d).alias("Week_Of_Year"),
        F.dayofmonth(d).alias("Day_Of_Month"),
        F.dayofweek(d).alias("Day_Of_Week"),
        F.date_format(d, "EEEE").alias("Day_Name"),
        F.date_format(d, "EEE").alias("Day_Short"),
        weekend.cast("int").alias("Is_Weekend"),
        (~weekend).cast("int").alias("Is_Weekday"),
        (F.dayofmonth(d) == 1).cast("int").alias("Is_Month_Start"),
        (d == F.last_day(d)).cast("int").alias("Is_Month_End"),
        holiday.cast("int").alias("Is_Holiday"),
        F.year(d).alias("Fiscal_Year"),
        F.quarter(d).alias("Fiscal_Quarter"),
        dates.year_month(d).alias("Year_Month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), quarter).alias("Year_Quarter"),
    )


def dim_date(spark: SparkSession, clock: RunClock) -> DataFrame:
    last = f"{clock.as_of.year + CALENDAR_YEARS_AHEAD}-12-31"
    one_row = spark.range(1)
    days = calendar(one_row, F.lit(CALENDAR_START).cast("date"), F.lit(last).cast("date"))
    return days.withColumn("Created_TS", clock.stamp())


def dim_product(products: DataFrame, clock: RunClock) -> DataFrame:
    return _stamped(
        _current(products),
        [
            "Product_SKU", "Product_Name", "Category", "Sub_Category", "Price", "Cost_Price", "Supplier_ID",
            "Effective_From", "Effective_To", "Is_Current", "Version_Number",
            measures.product_margin("Price", "Cost_Price").alias("Margin_Amount"),
            measures.product_margin_pct("Price", "Cost_Price").alias("Margin_Pct"),
        ],
        clock,
    )


def dim_store(stores: DataFrame, clock: RunClock) -> DataFrame:
    return _stamped(
        _current(stores),
        [
            "Store_ID", "Store_Name", "City", "Region", "Store_Manager", "Store_Area_sqm", "Open_Date",
            dates.year_span("Open_Date", clock.today()).alias("Store_Age_Years"),
        ],
        clock,
    )


def dim_customer(customers: DataFrame, clock: RunClock) -> DataFrame:
    return _stamped(
        _current(customers),
        [
            "Customer_ID", "Full_Name", "Gender", "Birthdate", "Registration_Date", "Email", "Phone_Number",
            "City", "Preferred_Channel",
            dates.year_span("Birthdate", clock.today()).alias("Age"),
            dates.day_span("Registration_Date", clock.today()).alias("Customer_Tenure_Days"),
        ],
        clock,
    )


def dim_promotion(promotions: DataFrame, clock: RunClock) -> DataFrame:
    return _stamped(
        _current(promotions),
        [
            "Promotion_ID", "Promo_Name", "Promo_Type", "Start_Date", "End_Date", "Promo_Cost", "Eligible_SKUs",
            dates.day_span("Start_Date", "End_Date").alias("Promo_Duration_Days"),
            dates.active_on(clock.today(), "Start_Date", "End_Date").alias("Is_Active"),
        ],
        clock,
    )


def dim_weather(weather: DataFrame, clock: RunClock) -> DataFrame:
    return _stamped(
        _current(weather),
        [
            "Weather_Date", "Store_ID", "Temperature_C", "Precipitation_mm", "Weather_Condition",
            "Has_Missing_Temperature", "Is_Extreme_Temperature",
            measures.is_rainy("Precipitation_mm").alias("Is_Rainy"),
        ],
        clock,
    )


def promotion_skus(promotions: DataFrame, *keep: str) -> DataFrame:
    """One row per promotion and listed product, each pair once."""
    listed = _current(promotions).filter(F.col("Eligible_SKUs") != text.MISSING)
    split = listed.select("Promotion_ID", *keep, F.explode(F.split("Eligible_SKUs", r"\|")).alias("Product_SKU"))
    skus = split.withColumn("Product_SKU", text.key("Product_SKU")).filter("Product_SKU <> ''")
    return skus.dropDuplicates(["Promotion_ID", "Product_SKU"])


def bridge_promotion_product(promotions: DataFrame, products: DataFrame, clock: RunClock) -> DataFrame:
    known = _current(products).filter("Is_Current = 1").select("Product_SKU")
    pairs = promotion_skus(promotions).join(known, "Product_SKU", "left_semi")
    return pairs.select("Promotion_ID", "Product_SKU", clock.stamp().alias("Created_TS"))


FACT_SALES_SORT = ("Transaction_Date", "Store_ID")


def fact_sales(lines: DataFrame, headers: DataFrame, clock: RunClock) -> DataFrame:
    """Transaction lines with the context of their header.

    The join leaves the rows partitioned by transaction, which later counts of transactions use."""
    context = _current(headers).select(
        "Transaction_ID", "Transaction_Date", "Transaction_TS", "Customer_ID", "Payment_Method", "Is_Walk_In",
        F.col("DQ_Score").alias("Header_Score"),
    )
    joined = _current(lines).join(context, "Transaction_ID")
    parts = ("Line_Sales_Amount", "Quantity", "Cost_Price")
    stamps = [c.alias(n) for n, c in clock.audit_columns().items()]
    return joined.select(
        "Transaction_Line_ID", "Transaction_ID", "Line_Number", "Transaction_Date", "Product_SKU", "Store_ID",
        "Customer_ID",
        F.coalesce("Promotion_ID", F.lit(text.MISSING)).alias("Promotion_ID"),
        "Quantity", "Unit_Price", "Cost_Price", "Line_Sales_Amount",
        numbers.or_zero("Discount_Amount").cast(numbers.MONEY).alias("Discount_Amount"),
        measures.line_cost("Quantity", "Cost_Price").alias("Line_Cost_Amount"),
        measures.line_margin(*parts).alias("Line_Margin_Amount"),
        measures.margin_over_cost(*parts).alias("Line_Margin_Pct"),
        "Payment_Method", "Transaction_TS", "Is_Return", "Is_Outlier_Quantity", "Has_Discount", "Has_Promotion",
        "Is_Walk_In",
        measures.mean_score("DQ_Score", "Header_Score").alias("DQ_Score"),
        *stamps,
    )


def month_of(date: str) -> Column:
    return F.year(date) * 100 + F.month(date)


def with_sales_month(fact: DataFrame) -> DataFrame:
    """The stored fact is split into folders by month."""
    return fact.withColumn("Sales_Month", month_of("Transaction_Date"))


def touched_months(fact: DataFrame, headers: DataFrame, *loaded: DataFrame) -> DataFrame:
    """(Sales_Month) of the months of the fact that new loads can change.

    ``loaded`` are rows of the loads with their Transaction_ID, headers or lines; ``headers`` are all
    trusted headers after them, ``fact`` is the stored fact before. A transaction touches the month it
    stood in and the one it stands in now."""
    changed = reduce(DataFrame.unionAll, [rows.select("Transaction_ID") for rows in loaded]).distinct()
    now = headers.select("Transaction_ID", month_of("Transaction_Date").alias("Sales_Month"))
    before = fact.select("Transaction_ID", "Sales_Month")
    return now.unionByName(before).join(changed, "Transaction_ID", "left_semi").select("Sales_Month").distinct()


def in_months(headers: DataFrame, months: Sequence[int]) -> DataFrame:
    """Headers of some months, by ranges of dates that reach the scan."""
    ranges = [f"Transaction_Date BETWEEN DATE'{m // 100}-{m % 100:02}-01' AND last_day(DATE'{m // 100}-{m % 100:02}-01')" for m in months]
    return headers.filter(" OR ".join(ranges) or "false")


def fact_inventory_snapshot(inventory: DataFrame, clock: RunClock) -> DataFrame:
    return _stamped(
        _current(inventory),
        [
            "Inventory_ID", "Product_SKU", "Store_ID", "Snapshot_Date", "Quantity_On_Hand", "Reorder_Level",
            measures.reorder_need("Quantity_On_Hand", "Reorder_Level").alias("Reorder_Quantity_Needed"),
            "Is_Below_Reorder_Level", "Is_Outlier_Quantity",
        ],
        clock,
    )
