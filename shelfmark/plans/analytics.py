"""Questions over the star schema.

Dimension joins carry no hints: Spark broadcasts a dimension when its measured size allows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.numbers import average_money, cents, from_cents, total_money


def _on_date(fact: DataFrame, dates: DataFrame, column: str, *keep: str) -> DataFrame:
    days = dates.select(F.col("Date_Value"), *keep)
    return fact.join(days, fact[column] == days["Date_Value"])


def _current_products(products: DataFrame, *keep: str) -> DataFrame:
    return products.filter("Is_Current = 1").select("Product_SKU", *keep)


def sales_by_date(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        _on_date(fact, dates, "Transaction_Date", "Day_Name")
        .groupBy("Date_Value", "Day_Name")
        .agg(
            total_money("Line_Sales_Amount").alias("Total_Sales"),
            total_money("Line_Margin_Amount").alias("Total_Margin"),
            F.countDistinct("Transaction_ID").alias("Transaction_Count"),
        )
        .orderBy("Date_Value")
    )


def sales_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    return (
        fact.join(_current_products(products, "Category", "Sub_Category"), "Product_SKU")
        .groupBy("Category", "Sub_Category")
        .agg(
            F.sum("Quantity").alias("Units_Sold"),
            total_money("Line_Sales_Amount").alias("Total_Revenue"),
            average_money("Line_Margin_Pct").alias("Avg_Margin_Pct"),
        )
        .orderBy(F.desc("Total_Revenue"))
    )


def store_performance(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales, margin, customers and transactions per store.

    Lines are summed per transaction first; the join that built the fact already holds a
    transaction in one partition, and a transaction has one customer, so transactions are then
    counted as rows and only customers need a distinct count."""
    names = ["Store_Name", "Region", "City"]
    per_transaction = (
        fact.join(stores.select("Store_ID", *names), "Store_ID")
        .groupBy(*names, "Transaction_ID", "Customer_ID")
        .agg(F.sum(cents("Line_Sales_Amount")).alias("sales"), F.sum(cents("Line_Margin_Amount")).alias("margin"))
    )
    return (
        per_transaction.groupBy(*names)
        .agg(
            from_cents(F.sum("sales")).alias("Total_Sales"),
            from_cents(F.sum("margin")).alias("Total_Margin"),
            F.countDistinct("Customer_ID").alias("Unique_Customers"),
            F.count(F.lit(1)).alias("Transaction_Count"),
        )
        .orderBy(F.desc("Total_Sales"))
    )


def customer_segments(fact: DataFrame, customers: DataFrame) -> DataFrame:
    people = customers.select("Customer_ID", "City", "Preferred_Channel")
    return (
        fact.filter("Is_Walk_In = 0")
        .join(people, "Customer_ID")
        .groupBy("City", "Preferred_Channel")
        .agg(
            F.countDistinct("Customer_ID").alias("Customer_Count"),
            total_money("Line_Sales_Amount").alias("Total_Spent"),
            average_money("Line_Sales_Amount").alias("Avg_Transaction_Value"),
        )
    )


def promotion_effect(fact: DataFrame, promotions: DataFrame) -> DataFrame:
    offers = promotions.select("Promotion_ID", "Promo_Name", "Promo_Type")
    return (
        fact.filter("Has_Promotion = 1")
        .join(offers, "Promotion_ID")
        .groupBy("Promo_Name", "Promo_Type")
        .agg(
            F.countDistinct("Transaction_ID").alias("Transaction_Count"),
            total_money("Line_Sales_Amount").alias("Promo_Sales"),
            total_money("Discount_Amount").alias("Total_Discount"),
            total_money("Line_Margin_Amount").alias("Net_Margin"),
        )
        .orderBy(F.desc("Promo_Sales"))
    )


def weather_impact(fact: DataFrame, weather: DataFrame, dates: DataFrame, year: int) -> DataFrame:
    days = weather.select(F.col("Weather_Date").alias("Transaction_Date"), "Store_ID", "Weather_Condition", "Temperature_C")
    in_year = dates.filter(F.col("Year") == year)
    # the year is also put to the fact's own date and to the month it is stored by, which its scan can use
    lines = fact.filter(F.col("Transaction_Date").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")))
    if "Sales_Month" in fact.columns:
        lines = lines.filter(F.col("Sales_Month").between(year * 100 + 1, year * 100 + 12))
    return (
        _on_date(lines, in_year, "Transaction_Date")
        .join(days, ["Transaction_Date", "Store_ID"])
        .groupBy("Weather_Condition", "Temperature_C")
        .agg(
            F.countDistinct("Transaction_ID").alias("Transaction_Count"),
            total_money("Line_Sales_Amount").alias("Total_Sales"),
            average_money("Line_Sales_Amount").alias("Avg_Line_Value"),
        )
        .orderBy(F.desc("Total_Sales"))
    )


def returns_by_month(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    returned = fact.filter("Is_Return = 1").join(_current_products(products, "Category"), "Product_SKU")
    return (
        _on_date(returned, dates, "Transaction_Date", "Year_Month")
        .groupBy("Year_Month", "Category")
        .agg(
            F.count(F.lit(1)).alias("Return_Count"),
            total_money("Line_Sales_Amount").alias("Return_Amount"),
            F.sum("Quantity").alias("Return_Quantity"),
        )
        .orderBy("Year_Month", F.desc("Return_Amount"))
    )


def inventory_by_store(stock: DataFrame) -> DataFrame:
    return stock.groupBy("Store_ID").agg(F.sum("Quantity_On_Hand").alias("Total_Inventory"))


def reorder_list(stock: DataFrame) -> DataFrame:
    return stock.filter("Is_Below_Reorder_Level = 1").select("Product_SKU", "Store_ID", "Reorder_Quantity_Needed")


def inventory_trend(stock: DataFrame) -> DataFrame:
    """Quantity beside the previous snapshot's; one row per product, store and day at most."""
    by_day = Window.partitionBy("Product_SKU", "Store_ID").orderBy("Snapshot_Date")
    return stock.select(
        "Snapshot_Date", "Product_SKU", "Store_ID", "Quantity_On_Hand",
        F.lag("Quantity_On_Hand").over(by_day).alias("Previous_Quantity"),
    )


def inventory_by_month(stock: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _on_date(stock, dates, "Snapshot_Date", "Year_Month")
        .join(stores.select("Store_ID", "Store_Name"), "Store_ID")
        .join(_current_products(products, "Category"), "Product_SKU")
        .groupBy("Year_Month", "Store_Name", "Category")
        .agg(
            F.sum("Quantity_On_Hand").alias("Total_Inventory"),
            F.sum("Reorder_Quantity_Needed").alias("Total_Reorder_Needed"),
        )
    )


def promotion_products(bridge: DataFrame, promotions: DataFrame, products: DataFrame) -> DataFrame:
    return (
        bridge.join(promotions.select("Promotion_ID", "Promo_Name"), "Promotion_ID")
        .join(_current_products(products, "Product_Name", "Category"), "Product_SKU")
        .select("Promo_Name", "Product_Name", "Category")
    )


def keyed_bridge(bridge: DataFrame, promotions: DataFrame, products: DataFrame) -> DataFrame:
    """The bridge by surrogate keys; both dimensions carry theirs."""
    return (
        bridge.join(promotions.select("Promotion_ID", "Promotion_Key"), "Promotion_ID")
        .join(_current_products(products, "Product_Key"), "Product_SKU")
        .select("Promotion_Key", "Product_Key")
    )


def header_against_lines(headers: DataFrame, lines: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Header totals beside the sum of their lines; lines are summed before they meet the headers."""
    sums = lines.groupBy("Transaction_ID").agg(
        total_money("Line_Sales_Amount").alias("Lines_Total"), F.count(F.lit(1)).alias("Lines_Found")
    )
    gap = F.col("Total_Amount") - F.coalesce("Lines_Total", F.lit(0))
    return headers.join(sums, "Transaction_ID", "left").select(
        "Transaction_ID", "Total_Amount", "Lines_Total",
        F.coalesce("Lines_Found", F.lit(0)).alias("Lines_Found"),
        gap.cast("decimal(18,2)").alias("Gap"),
        (F.abs(gap) <= F.lit(tolerance).cast("decimal(18,2)")).cast("int").alias("Totals_Match"),
    )


def same_product_overlaps(promotions: DataFrame) -> DataFrame:
    """Per promotion and product, how many other promotions of the product run on common days."""
    from shelfmark.operators.overlap import overlap_degree
    from shelfmark.plans.gold import promotion_skus

    runs = promotion_skus(promotions, "Start_Date", "End_Date")
    degrees = overlap_degree(runs, ["Product_SKU"], "Start_Date", "End_Date")
    return degrees.filter("Overlapping_Others > 0").select("Product_SKU", "Promotion_ID", "Overlapping_Others")
