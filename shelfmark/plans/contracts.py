"""Expected properties of each table. Value lists are those the plans produce."""

from __future__ import annotations

from shelfmark.functions import rules
from shelfmark.operators.checks import Check, accepted, holds, not_null, unique

_ORIGIN = ("Is_Valid", "DQ_Score", "Batch_ID", "Source_File", "Created_TS", "Updated_TS")
_CATEGORIES = tuple(sorted({label for _, label in rules.CATEGORY_PATTERNS}))
_PROMO_TYPES = tuple(sorted({label for _, label in rules.PROMO_TYPE_PATTERNS})) + (rules.PROMO_TYPE_DEFAULT,)
_CHANNELS = tuple(sorted({label for _, label in rules.CHANNEL_PATTERNS})) + (rules.CHANNEL_DEFAULT,)
_GENDERS = (*rules.GENDER_GROUPS, "N/A")


def _silver(*columns: str) -> list[Check]:
    return [*not_null(*columns, *_ORIGIN), accepted("Is_Valid", (1,)), holds("DQ_Score BETWEEN 0 AND 100")]


def staging_checks() -> dict[str, list[Check]]:
    return {"stg_erp_products": [*not_null("Raw_ID", "Product_SKU"), accepted("DQ_Is_Valid", (0, 1))]}


def silver_checks() -> dict[str, list[Check]]:
    return {
        "pos_transactions_header": [
            *_silver("Transaction_ID", "Transaction_Date", "Transaction_TS", "Store_ID", "Payment_Method", "Total_Amount"),
            unique("Transaction_ID"),
            accepted("Payment_Method", rules.PAYMENT_METHODS),
            holds("Total_Amount > 0"),
            holds("Total_Discount IS NULL OR Total_Discount >= 0"),
            holds("Line_Count > 0"),
        ],
        "pos_transactions_lines": [
            *_silver(
                "Transaction_Line_ID", "Transaction_ID", "Line_Number", "Product_SKU", "Store_ID", "Quantity",
                "Unit_Price", "Cost_Price", "Line_Sales_Amount",
            ),
            unique("Transaction_Line_ID"),
            accepted("Is_Return", (0, 1)),
            holds("Line_Number > 0"),
            holds("Quantity <> 0"),
            holds("Unit_Price > 0"),
            holds("Cost_Price >= 0"),
        ],
        "erp_products": [
            *_silver("Product_SKU", "Product_Name", "Category", "Price", "Supplier_ID", "Effective_From"),
            unique("Product_SKU", only_if="Is_Current = 1"),
            accepted("Category", _CATEGORIES),
            accepted("Has_Price_Issue", (0, 1)),
            holds("Price > 0"),
            holds("Cost_Price IS NULL OR Cost_Price >= 0"),
            holds("Effective_To IS NULL OR Effective_To >= Effective_From"),
        ],
        "erp_stores": [
            *_silver("Store_ID", "Store_Name", "City", "Region", "Store_Area_sqm", "Open_Date", "Has_Multiple_Managers"),
            unique("Store_ID"),
            accepted("Has_Multiple_Managers", (0, 1)),
            holds("Store_Area_sqm > 0"),
            holds("Open_Date <= Created_TS"),
        ],
        "erp_inventory": [
            *_silver("Inventory_ID", "Product_SKU", "Store_ID", "Snapshot_Date", "Quantity_On_Hand", "Reorder_Level"),
            unique("Inventory_ID"),
            unique("Product_SKU", "Store_ID", only_if="Is_Latest_Snapshot = 1"),
            holds("Quantity_On_Hand >= 0"),
            holds("Reorder_Level >= 0"),
        ],
        "crm_customers": [
            *_silver("Customer_ID", "Full_Name", "Registration_Date"),
            unique("Customer_ID"),
            accepted("Gender", _GENDERS),
            accepted("Preferred_Channel", _CHANNELS),
            holds("Birthdate < Created_TS AND Birthdate > add_months(to_date(Created_TS), -1440)"),
            holds("Registration_Date <= Created_TS"),
        ],
        "mkt_promotions": [
            *_silver("Promotion_ID", "Promo_Name", "Promo_Type", "Start_Date", "End_Date", "Promo_Cost", "Eligible_SKUs"),
            unique("Promotion_ID"),
            accepted("Promo_Type", _PROMO_TYPES),
            holds("End_Date >= Start_Date"),
            holds("Promo_Cost >= 0"),
        ],
        "api_weather": [
            *_silver("Weather_Date", "Store_ID", "Precipitation_mm", "Weather_Condition", "Has_Missing_Temperature"),
            unique("Weather_Date", "Store_ID"),
            accepted("Has_Missing_Temperature", (0, 1)),
            holds("Precipitation_mm >= 0"),
        ],
    }


def gold_checks() -> dict[str, list[Check]]:
    return {
        "dim_date": [*not_null("Date_SK", "Date_Value"), unique("Date_Value"), unique("Date_SK")],
        "dim_product": [*not_null("Product_SKU", "Product_Name", "Category", "Price"), unique("Product_SKU", only_if="Is_Current = 1")],
        "dim_store": [*not_null("Store_ID", "Store_Name", "City", "Region"), unique("Store_ID")],
        "dim_customer": [*not_null("Customer_ID", "Full_Name", "Gender"), unique("Customer_ID")],
        "dim_promotion": [*not_null("Promotion_ID", "Promo_Name", "Promo_Type"), unique("Promotion_ID")],
        "dim_weather": [*not_null("Weather_Date", "Store_ID"), unique("Weather_Date", "Store_ID")],
        "bridge_promotion_product": [*not_null("Promotion_ID", "Product_SKU"), unique("Promotion_ID", "Product_SKU")],
        "fact_sales": [*not_null("Transaction_Line_ID", "Transaction_ID", "Transaction_Date", "Customer_ID"), unique("Transaction_Line_ID")],
        "fact_inventory_snapshot": [*not_null("Product_SKU", "Store_ID", "Snapshot_Date"), unique("Product_SKU", "Store_ID", "Snapshot_Date")],
        "agg_sales_daily": [unique("Transaction_Date", "Store_ID"), holds("Transaction_Count > 0")],
        "agg_sales_monthly": [*not_null("Year", "Month"), holds("Transaction_Count > 0")],
        "agg_product_performance": [*not_null("Product_SKU", "Year", "Month"), holds("Transaction_Count > 0")],
    }
