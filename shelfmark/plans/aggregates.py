"""Pre-aggregated sales tables.

Transactions and customers are counted exactly. A transaction has one date and one customer, so
rows are first summed per transaction; counting transactions is then counting rows, and only
the customers need a distinct count. The same distinct counts on raw lines would multiply every
line once per counted column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.numbers import MONEY, cents, from_cents, percent

_SUMS = {
    "Total_Sales_Amount": "Line_Sales_Amount",
    "Total_Cost": "Line_Cost_Amount",
    "Total_Margin": "Line_Margin_Amount",
    "Total_Discount": "Discount_Amount",
    "Units_Sold": "Quantity",
}


def _line_sums() -> list[Column]:
    sums = [F.sum("Quantity" if n == "Units_Sold" else cents(c)).alias(n) for n, c in _SUMS.items()]
    return sums + [F.count(F.lit(1)).alias("Line_Count")]


def _resum() -> list[Column]:
    return [F.sum(n).alias(n) for n in (*_SUMS, "Line_Count")]


def _priced(df: DataFrame) -> DataFrame:
    """Sums in cents back as money."""
    return df.withColumns({n: from_cents(n) for n in _SUMS if n != "Units_Sold"})


def _counted(per_transaction: DataFrame, keys: list[str]) -> DataFrame:
    return _priced(
        per_transaction.groupBy(*keys).agg(
            *_resum(),
            F.count(F.lit(1)).alias("Transaction_Count"),
            F.countDistinct("Customer_ID").alias("Unique_Customers"),
        )
    )


def _margin_share(name: str) -> Column:
    return percent("Total_Margin", "Total_Sales_Amount").alias(name)


def _per(total: str, count: Column) -> Column:
    return (F.col(total).cast("decimal(20,2)") / count.cast("decimal(20,0)")).cast(MONEY)


def _average_ticket() -> Column:
    # a positive number of transactions is the guard, not a positive amount
    n = F.col("Transaction_Count")
    average = F.when(n > 0, _per("Total_Sales_Amount", n)).otherwise(F.lit(0))
    return average.cast(MONEY).alias("Avg_Transaction_Value")


def sales_daily(fact: DataFrame) -> DataFrame:
    """Per day and store."""
    keys = ["Transaction_Date", "Store_ID"]
    per_transaction = fact.groupBy(*keys, "Transaction_ID", "Customer_ID").agg(*_line_sums())
    # one shuffle for the distinct customers and for the sums: both need the transactions of a store's day, and a
    # day of one store is no more than a task can take
    daily = _counted(per_transaction.repartition(*keys), keys)
    return daily.select(
        *keys, "Total_Sales_Amount", "Total_Cost", "Total_Margin", "Total_Discount", "Transaction_Count",
        "Line_Count", "Units_Sold", "Unique_Customers", _average_ticket(), _margin_share("Avg_Margin_Pct"),
    )


def sales_monthly(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Per month, store and category; NULL store or category means all of them."""
    category = products.filter("Is_Current = 1").select("Product_SKU", "Category")
    lines = fact.join(category, "Product_SKU").withColumns(
        {"Year": F.year("Transaction_Date"), "Month": F.month("Transaction_Date")}
    )
    # one shuffle of the lines: both sums below are by keys that hold the transaction
    lines = lines.repartition("Transaction_ID")
    base = lines.groupBy("Year", "Month", "Store_ID", "Category", "Transaction_ID", "Customer_ID").agg(*_line_sums())
    # one copy of each summed row per level, instead of one per level and distinct count
    levels = F.array(
        *[
            F.struct(
                F.lit(level).alias("Level"),
                (F.col("Store_ID") if by_store else F.lit(None).cast("string")).alias("L_Store"),
                (F.col("Category") if by_category else F.lit(None).cast("string")).alias("L_Category"),
            )
            for level, (by_store, by_category) in enumerate(((True, True), (True, False), (False, True), (False, False)))
        ]
    )
    measures = [*_SUMS, "Line_Count"]
    expanded = base.select("Year", "Month", "Transaction_ID", "Customer_ID", *measures, F.inline(levels))
    keys = ["Year", "Month", "Level", "L_Store", "L_Category"]
    per_transaction = expanded.groupBy(*keys, "Transaction_ID", "Customer_ID").agg(*[F.sum(m).alias(m) for m in measures])
    monthly = _counted(per_transaction, keys)
    return monthly.select(
        "Year", "Month", F.col("L_Store").alias("Store_ID"), F.col("L_Category").alias("Category"),
        "Total_Sales_Amount", "Total_Cost", "Total_Margin", "Total_Discount", "Transaction_Count", "Units_Sold",
        "Unique_Customers", _average_ticket(), _margin_share("Margin_Pct"),
    )


def product_performance(fact: DataFrame, stored: bool = True) -> DataFrame:
    """Per product, store and month; NULL store means all stores.

    A ``stored`` fact has lost its partitioning by transaction; one that comes straight from its join has it.
    A transaction hardly ever names a product twice, so lines are not summed per transaction first: the
    distinct count of transactions does that anyway."""
    lines = fact.withColumns({"Year": F.year("Transaction_Date"), "Month": F.month("Transaction_Date")})
    if stored:
        # one shuffle of the lines, as above; copies for the levels stay where they are
        lines = lines.repartition("Transaction_ID")
    levels = F.array(
        F.struct(F.lit(0).alias("Level"), F.col("Store_ID").alias("L_Store")),
        F.struct(F.lit(1).alias("Level"), F.lit(None).cast("string").alias("L_Store")),
    )
    measures = {n: F.col(c) if n == "Units_Sold" else cents(c) for n, c in _SUMS.items()}
    measures |= {"Line_Count": F.lit(1), "Price_Sum": cents("Unit_Price")}
    expanded = lines.select(
        "Product_SKU", "Year", "Month", "Transaction_ID", *[c.alias(n) for n, c in measures.items()], F.inline(levels)
    )
    keys = ["Product_SKU", "Year", "Month", "Level", "L_Store"]
    counted = expanded.groupBy(*keys).agg(
        *_resum(), F.sum("Price_Sum").alias("Price_Sum"), F.countDistinct("Transaction_ID").alias("Transaction_Count")
    )
    return _priced(counted).select(
        "Product_SKU", F.col("L_Store").alias("Store_ID"), "Year", "Month", "Total_Sales_Amount", "Total_Cost",
        "Total_Margin", "Units_Sold", "Transaction_Count",
        _per("Price_Sum", F.col("Line_Count") * 100).alias("Avg_Unit_Price"),
        _margin_share("Margin_Pct"),
    )


def by_month(fact: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """The three tables, with the month that they are stored by. A month's rows come from the fact rows of
    that month alone."""
    daily = sales_daily(fact).withColumn("Sales_Month", F.year("Transaction_Date") * 100 + F.month("Transaction_Date"))
    month = F.col("Year") * 100 + F.col("Month")
    return {
        "agg_sales_daily": daily,
        "agg_sales_monthly": sales_monthly(fact, products).withColumn("Sales_Month", month),
        "agg_product_performance": product_performance(fact).withColumn("Sales_Month", month),
    }
