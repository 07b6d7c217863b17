"""Staging to trusted rows: valid, one per key, standard names, scored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.clock import RunClock
from shelfmark.functions import measures, rules, text
from shelfmark.operators.dedupe import keep_latest
from shelfmark.operators.existence import flag_existing
from shelfmark.operators.quality import Rule, all_set, score
from shelfmark.plans import staging as stg
from shelfmark.schemas import ORIGIN_COLUMNS

# rows of one load share their timestamp; the later row of the file wins
NEWEST = ("Load_Timestamp", "Raw_ID")
_COUNTS = "__counts"


def _latest_usable(
    staged: DataFrame,
    keys: list[str],
    quality: Sequence[Rule],
    needed: Sequence[str],
    newest: Sequence[str] = NEWEST,
    usable: Sequence[str] = (stg.VALID,),
) -> DataFrame:
    """The newest usable row of each key, with its score and validity in place of the rule flags,
    which then need not travel through the shuffle."""
    flags = {r.name for r in quality if r.name.startswith("DQ_")} | {stg.VALID}
    scored = staged.withColumns(
        {_COUNTS: all_set(usable), "Is_Valid": all_set(needed), "DQ_Score": score(quality)}
    ).drop(*flags)
    return keep_latest(scored, keys, newest, F.col(_COUNTS)).drop(_COUNTS)


def _valid(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col(stg.VALID) == 1)


def _weighted(quality: Sequence[Rule], *but: str) -> list[str]:
    return [r.name for r in quality if r.weight and r.name not in but]


def _finish(df: DataFrame, columns: list[str], clock: RunClock) -> DataFrame:
    """Valid rows with the published columns, their origin and audit stamps."""
    stamps = [c.alias(n) for n, c in clock.audit_columns().items()]
    return df.filter(F.col("Is_Valid") == 1).select(*columns, "Is_Valid", "DQ_Score", *ORIGIN_COLUMNS, *stamps)


def clean_stores(staged: DataFrame, clock: RunClock) -> DataFrame:
    quality = stg.stores_rules()
    latest = _latest_usable(staged, ["Store_ID"], quality, _weighted(quality))
    return _finish(
        latest.withColumns(
            {
                "City": text.capitalize("City"),
                "Region": F.upper("Region"),
                "Store_Manager": text.or_missing(text.list_head("Store_Manager")),
            }
        ),
        ["Store_ID", "Store_Name", "City", "Region", "Store_Manager", "Store_Area_sqm", "Open_Date", "Has_Multiple_Managers"],
        clock,
    )


def clean_customers(staged: DataFrame, clock: RunClock, mask_secret: str | None = None) -> DataFrame:
    """With a ``mask_secret``, e-mail and phone are replaced by digests keyed by it."""
    latest = _latest_usable(staged, ["Customer_ID"], stg.customers_rules(clock), ["DQ_Customer_ID_Valid"])
    standard = latest.withColumns(
        {
            "Full_Name": text.proper_case("Full_Name"),
            "Gender": text.value_label("Gender", rules.GENDER_GROUPS, text.MISSING),
            "Email": text.or_missing(F.upper("Email")),
            "Phone_Number": F.coalesce(text.international_phone("Phone_Number"), F.lit(text.MISSING)),
            "City": text.or_missing(text.capitalize("City")),
            "Preferred_Channel": text.pattern_label(
                "Preferred_Channel", rules.CHANNEL_PATTERNS, rules.CHANNEL_DEFAULT
            ),
        }
    )
    flagged = standard.withColumns(
        {
            "Has_Email": (F.col("Email") != text.MISSING).cast("int"),
            "Has_Phone": (F.col("Phone_Number") != text.MISSING).cast("int"),
        }
    )
    if mask_secret is not None:
        flagged = flagged.withColumns({c: text.masked(c, mask_secret) for c in ("Email", "Phone_Number")})
    return _finish(
        flagged,
        [
            "Customer_ID", "Full_Name", "Gender", "Birthdate", "Registration_Date", "Email", "Phone_Number",
            "City", "Preferred_Channel", "Has_Email", "Has_Phone",
        ],
        clock,
    )


PRODUCT_COLUMNS = [
    "Product_SKU", "Product_Name", "Category", "Sub_Category", "Price", "Cost_Price", "Supplier_ID",
    "Effective_From", "Effective_To", "Is_Current", "Version_Number", "Has_Cost_Price", "Has_Price_Issue",
]


def clean_products(staged: DataFrame, clock: RunClock) -> DataFrame:
    """The current version of each product."""
    quality = stg.products_rules()
    gates = [r.name for r in quality if r.gate]
    latest = _latest_usable(staged, ["Product_SKU"], quality, gates, ("Last_Updated", *NEWEST))
    versioned = latest.withColumns(
        {
            "Category": text.pattern_label("Category", rules.CATEGORY_PATTERNS),
            "Sub_Category": text.pattern_label("Sub_Category", rules.SUB_CATEGORY_PATTERNS),
            "Has_Cost_Price": F.col("Cost_Price").isNotNull().cast("int"),
            "Effective_From": F.coalesce("Last_Updated", clock.today()),
            "Effective_To": F.lit(None).cast("date"),
            "Is_Current": F.lit(1),
            "Version_Number": F.lit(1),
        }
    )
    return _finish(versioned, PRODUCT_COLUMNS, clock)


def clean_promotions(staged: DataFrame, clock: RunClock) -> DataFrame:
    quality = stg.promotions_rules()
    latest = _latest_usable(
        staged,
        ["Promotion_ID"],
        quality,
        _weighted(quality, "DQ_Promo_Type_Valid"),
        usable=(stg.VALID, "DQ_Date_Range_Valid"),
    )
    return _finish(
        latest.withColumns(
            {
                "Promo_Type": text.pattern_label("Promo_Type", rules.PROMO_TYPE_PATTERNS, rules.PROMO_TYPE_DEFAULT),
                "Eligible_SKUs": F.coalesce(text.key("Eligible_SKUs"), F.lit(text.MISSING)),
            }
        ),
        [
            "Promotion_ID", "Promo_Name", "Promo_Type", "Start_Date", "End_Date", "Promo_Cost", "Eligible_SKUs",
            "Has_Multiple_SKUs", "Has_Invalid_Date_Range",
        ],
        clock,
    )


def clean_weather(staged: DataFrame, clock: RunClock) -> DataFrame:
    quality = stg.weather_rules()
    located = staged.withColumn("Store_ID", text.strip_prefix("Retail_Location_ID", "LOC_"))
    latest = _latest_usable(
        located, ["Weather_Date", "Store_ID"], quality, _weighted(quality, "DQ_Temperature_Valid")
    )
    return _finish(
        latest.withColumn("Weather_Condition", text.pattern_label("Weather_Condition", rules.WEATHER_PATTERNS)),
        [
            "Weather_Date", "Store_ID", "Temperature_C", "Precipitation_mm", "Weather_Condition",
            "Has_Missing_Temperature", "Is_Extreme_Temperature",
        ],
        clock,
    )


def clean_inventory(staged: DataFrame, staged_products: DataFrame, staged_stores: DataFrame, clock: RunClock) -> DataFrame:
    """The latest snapshot per product and store, where both are known."""
    quality = stg.inventory_rules()
    latest = _latest_usable(
        staged.withColumn("__counted", (F.col("Is_Negative_Quantity") == 0).cast("int")),
        ["Product_SKU", "Store_ID"],
        quality,
        _weighted(quality),
        ("Snapshot_Date", *NEWEST),
        usable=(stg.VALID, "__counted"),
    )
    flagged = flag_existing(latest, "Product_SKU", _valid(staged_products), "Product_Exists")
    flagged = flag_existing(flagged, "Store_ID", _valid(staged_stores), "Store_Exists")
    flags = ("Is_Valid", "Product_Exists", "Store_Exists")
    return _finish(
        flagged.withColumns({"Is_Latest_Snapshot": F.lit(1), "Is_Valid": all_set(flags)}),
        [
            "Inventory_ID", "Product_SKU", "Store_ID", "Snapshot_Date", "Quantity_On_Hand", "Reorder_Level",
            "Is_Below_Reorder_Level", "Is_Negative_Quantity", "Is_Outlier_Quantity", "Is_Latest_Snapshot",
        ],
        clock,
    )


HEADER_COLUMNS = [
    "Transaction_ID", "Transaction_Date", "Transaction_TS", "Store_ID", "Customer_ID", "Payment_Method",
    "Total_Amount", "Total_Discount", "Line_Count", "Is_Walk_In", "Has_Discount",
]


def clean_header(
    staged: DataFrame,
    stores: DataFrame,
    clock: RunClock,
    customers: DataFrame | None = None,
    enforce_customer: bool = False,
    keep_links: bool = False,
) -> DataFrame:
    """One row per transaction of a known store.

    An unknown customer only sets ``Customer_Exists``; pass ``customers`` to compute it, with
    ``keep_links`` to publish the link flags and ``enforce_customer`` to drop such rows."""
    latest = _latest_usable(staged, ["Transaction_ID"], stg.header_rules(), [stg.VALID])
    linked = flag_existing(latest, "Store_ID", stores, "Store_Exists", reference_is_unique=True)
    links = ["Store_Exists"]
    if customers is not None:
        linked = flag_existing(
            linked, "Customer_ID", customers, "Customer_Exists", reference_is_unique=True, null_passes=True
        )
        links.append("Customer_Exists")
    needed = ["Store_Exists", "Is_Valid"] + (["Customer_Exists"] if enforce_customer else [])
    filled = {c: F.coalesce(c, F.lit(text.MISSING)) for c in ("Store_ID", "Customer_ID", "Payment_Method")}
    return _finish(linked.withColumns({**filled, "Is_Valid": all_set(needed)}), HEADER_COLUMNS + (links if keep_links else []), clock)


LINE_COLUMNS = [
    "Transaction_Line_ID", "Transaction_ID", "Line_Number", "Product_SKU", "Store_ID", "Quantity", "Unit_Price",
    "Cost_Price", "Discount_Amount", "Line_Sales_Amount", "Promotion_ID", "Is_Return", "Is_Outlier_Quantity",
    "Has_Discount", "Has_Promotion", "Has_Price_Issue",
]


def clean_lines(staged: DataFrame, clock: RunClock) -> DataFrame:
    """One row per transaction line. Links to other tables are not enforced; see :func:`line_links`."""
    latest = _latest_usable(staged, ["Transaction_Line_ID"], stg.lines_rules(), [stg.VALID])
    return _finish(
        latest.withColumns(
            {
                "Discount_Amount": measures.effective_discount(
                    "Discount_Amount", "Unit_Price", "Quantity", "Line_Sales_Amount"
                ),
                "Is_Return": F.col("Is_Negative_Quantity"),
            }
        ),
        LINE_COLUMNS,
        clock,
    )


def line_links(lines: DataFrame, headers: DataFrame, products: DataFrame, stores: DataFrame, promotions: DataFrame) -> DataFrame:
    """The lines with a 0/1 column per link; a line without a promotion passes that link."""
    links = (
        ("Transaction_ID", headers, "Transaction_Exists", False),
        ("Product_SKU", products.filter("Is_Current = 1"), "Product_Exists", False),
        ("Store_ID", stores, "Store_Exists", False),
        ("Promotion_ID", promotions, "Promotion_Exists", True),
    )
    for key, reference, flag, null_passes in links:
        lines = flag_existing(lines, key, reference, flag, reference_is_unique=True, null_passes=null_passes)
    return lines


def enforce_links(lines: DataFrame) -> DataFrame:
    flags = ("Transaction_Exists", "Product_Exists", "Store_Exists", "Promotion_Exists")
    return lines.filter(all_set(flags) == 1).drop(*flags)


def silver_measures_header(header: DataFrame) -> DataFrame:
    """Computed columns of the stored table."""
    return header.withColumns(
        {
            "Net_Amount": measures.net_amount("Total_Amount", "Total_Discount"),
            "Discount_Rate": measures.discount_rate("Total_Amount", "Total_Discount"),
        }
    )


def silver_measures_lines(lines: DataFrame) -> DataFrame:
    parts = ("Line_Sales_Amount", "Quantity", "Cost_Price")
    return lines.withColumns(
        {
            "Line_Cost": measures.line_cost("Quantity", "Cost_Price"),
            "Line_Margin": measures.line_margin(*parts),
            "Line_Margin_Over_Sales_Pct": measures.margin_over_sales(*parts),
        }
    )
