"""Raw text rows to typed rows with quality flags; every raw row is kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.clock import RunClock
from shelfmark.functions import dates, numbers, rules, text
from shelfmark.operators.quality import Rule, apply_rules, has_text, known, one_of, optional
from shelfmark.schemas import LINEAGE_COLUMNS

VALID = "DQ_Is_Valid"


def _typed(raw: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return raw.select("Raw_ID", *[c.alias(name) for name, c in columns.items()], *LINEAGE_COLUMNS)


def header_rules() -> list[Rule]:
    return [
        Rule("DQ_Transaction_ID_Valid", has_text("Transaction_ID"), 15, gate=True),
        Rule("DQ_Transaction_Date_Valid", known("Transaction_Date"), 15, gate=True),
        Rule("DQ_Transaction_TS_Valid", known("Transaction_TS"), 10, gate=True),
        Rule("DQ_Store_ID_Valid", has_text("Store_ID"), 15, gate=True),
        Rule("DQ_Customer_ID_Valid", optional("Customer_ID", has_text("Customer_ID")), 10),
        Rule("DQ_Payment_Method_Valid", one_of("Payment_Method", rules.PAYMENT_METHODS), 10, gate=True),
        Rule("DQ_Total_Amount_Valid", "Total_Amount > 0", 15, gate=True),
        Rule("DQ_Total_Discount_Valid", optional("Total_Discount", "Total_Discount BETWEEN 0 AND Total_Amount"), 5),
        Rule("DQ_Line_Count_Valid", "Line_Count >= 1", 5, gate=True),
        Rule("DQ_Timestamp_Consistent", "to_date(Transaction_TS) = Transaction_Date", gate=True),
        Rule("Is_Walk_In", "Customer_ID IS NULL"),
        Rule("Has_Discount", "Total_Discount > 0"),
    ]


def stage_header(raw: DataFrame, clock: RunClock) -> DataFrame:
    typed = _typed(
        raw,
        {
            "Transaction_ID": text.key("Transaction_ID"),
            "Transaction_Date": dates.mixed_date("Transaction_Date"),
            "Transaction_TS": dates.mixed_timestamp("Transaction_TS"),
            "Store_ID": text.key("Store_ID"),
            "Customer_ID": text.optional_key("Customer_ID"),
            "Payment_Method": text.key("Payment_Method"),
            "Total_Amount": numbers.to_amount("Total_Amount"),
            "Total_Discount": numbers.to_optional_amount("Total_Discount"),
            "Line_Count": numbers.to_int("Line_Count"),
        },
    )
    return apply_rules(typed, header_rules(), VALID)


def lines_rules() -> list[Rule]:
    return [
        Rule("DQ_Transaction_Line_ID_Valid", has_text("Transaction_Line_ID"), 10, gate=True),
        Rule("DQ_Transaction_ID_Valid", has_text("Transaction_ID"), 15, gate=True),
        Rule("DQ_Line_Number_Valid", "Line_Number > 0", 5, gate=True),
        Rule("DQ_Product_SKU_Valid", has_text("Product_SKU"), 15, gate=True),
        Rule("DQ_Store_ID_Valid", has_text("Store_ID"), 10, gate=True),
        Rule("DQ_Quantity_Valid", "Quantity <> 0", 10, gate=True),
        Rule("DQ_Unit_Price_Valid", "Unit_Price > 0", 15, gate=True),
        Rule("DQ_Cost_Price_Valid", "Cost_Price >= 0", 10, gate=True),
        Rule("DQ_Discount_Amount_Valid", optional("Discount_Amount", "Discount_Amount >= 0")),
        Rule("DQ_Line_Sales_Amount_Valid", known("Line_Sales_Amount"), 10, gate=True),
        Rule("DQ_Promotion_ID_Valid", optional("Promotion_ID", has_text("Promotion_ID"))),
        Rule("Is_Negative_Quantity", "Quantity < 0"),
        Rule("Is_Outlier_Quantity", f"Quantity > {rules.OUTLIER_LINE_QUANTITY}"),
        Rule("Has_Discount", "Discount_Amount > 0"),
        Rule("Has_Promotion", known("Promotion_ID")),
        Rule("Has_Price_Issue", "Cost_Price > Unit_Price"),
    ]


def stage_lines(raw: DataFrame, clock: RunClock) -> DataFrame:
    marks = numbers.LINE_CURRENCY_MARKS
    typed = _typed(
        raw,
        {
            "Transaction_Line_ID": text.key("Transaction_Line_ID"),
            "Transaction_ID": text.key("Transaction_ID"),
            "Line_Number": numbers.to_int("Line_Number"),
            "Product_SKU": text.key("Product_SKU"),
            "Store_ID": text.key("Store_ID"),
            "Quantity": numbers.to_int("Quantity"),
            "Unit_Price": numbers.to_amount("Unit_Price", marks),
            "Cost_Price": numbers.to_amount("Cost_Price", marks),
            "Discount_Amount": numbers.to_optional_amount("Discount_Amount", marks),
            "Line_Sales_Amount": numbers.to_amount("Line_Sales_Amount", marks),
            "Promotion_ID": text.optional_key("Promotion_ID"),
        },
    )
    return apply_rules(typed, lines_rules(), VALID)


def products_rules() -> list[Rule]:
    return [
        Rule("DQ_Product_SKU_Valid", has_text("Product_SKU"), 20, gate=True),
        Rule("DQ_Product_Name_Valid", has_text("Product_Name"), 15, gate=True),
        Rule("DQ_Category_Valid", has_text("Category"), 15, gate=True),
        Rule("DQ_Sub_Category_Valid", has_text("Sub_Category"), 10),
        Rule("DQ_Price_Valid", "Price > 0", 20, gate=True),
        Rule("DQ_Cost_Price_Valid", "Cost_Price >= 0", 10),
        Rule("DQ_Supplier_ID_Valid", has_text("Supplier_ID"), 10, gate=True),
        Rule("DQ_Last_Updated_Valid", known("Last_Updated")),
        Rule("Has_Price_Issue", "Cost_Price > Price"),
    ]


def stage_products(raw: DataFrame, clock: RunClock) -> DataFrame:
    typed = _typed(
        raw,
        {
            "Product_SKU": text.key("Product_SKU"),
            "Product_Name": text.blank_to_null("Product_Name"),
            "Category": text.upper_text("Category"),
            "Sub_Category": text.upper_text("Sub_Category"),
            "Price": numbers.to_amount("Price"),
            "Cost_Price": numbers.to_amount("Cost_Price"),
            "Supplier_ID": text.key("Supplier_ID"),
            "Last_Updated": dates.iso_date("Last_Updated"),
        },
    )
    return apply_rules(typed, products_rules(), VALID)


def stores_rules() -> list[Rule]:
    return [
        Rule("DQ_Store_ID_Valid", known("Store_ID"), 20, gate=True),
        Rule("DQ_Store_Name_Valid", has_text("Store_Name"), 20, gate=True),
        Rule("DQ_City_Valid", has_text("City"), 15, gate=True),
        Rule("DQ_Region_Valid", has_text("Region"), 15, gate=True),
        Rule("DQ_Store_Area_Valid", "Store_Area_sqm > 0", 15),
        Rule("DQ_Open_Date_Valid", known("Open_Date"), 15),
        Rule("Has_Multiple_Managers", "contains(Store_Manager, ';')"),
    ]


def stage_stores(raw: DataFrame, clock: RunClock) -> DataFrame:
    typed = _typed(
        raw,
        {
            "Store_ID": text.key("Store_ID"),
            "Store_Name": text.blank_to_null("Store_Name"),
            "City": text.blank_to_null("City"),
            "Region": text.blank_to_null("Region"),
            "Store_Manager": text.blank_to_null("Store_Manager"),
            "Store_Area_sqm": numbers.to_amount("Store_Area_sqm", numbers.THOUSANDS_MARKS, "decimal(10,2)"),
            "Open_Date": dates.iso_date("Open_Date"),
        },
    )
    return apply_rules(typed, stores_rules(), VALID)


def inventory_rules() -> list[Rule]:
    return [
        Rule("DQ_Inventory_ID_Valid", has_text("Inventory_ID"), 15, gate=True),
        Rule("DQ_Product_SKU_Valid", has_text("Product_SKU"), 25, gate=True),
        Rule("DQ_Store_ID_Valid", known("Store_ID"), 20, gate=True),
        Rule("DQ_Snapshot_Date_Valid", known("Snapshot_Date"), 15, gate=True),
        Rule("DQ_Quantity_On_Hand_Valid", known("Quantity_On_Hand"), 15, gate=True),
        Rule("DQ_Reorder_Level_Valid", "Reorder_Level >= 0", 10),
        Rule("Is_Negative_Quantity", "Quantity_On_Hand < 0"),
        Rule("Is_Outlier_Quantity", f"Quantity_On_Hand > {rules.OUTLIER_STOCK_QUANTITY}"),
        Rule("Is_Below_Reorder_Level", "Quantity_On_Hand < Reorder_Level"),
    ]


def stage_inventory(raw: DataFrame, clock: RunClock) -> DataFrame:
    typed = _typed(
        raw,
        {
            "Inventory_ID": text.key("Inventory_ID"),
            "Product_SKU": text.key("Product_SKU"),
            "Store_ID": text.key("Store_ID"),
            "Snapshot_Date": dates.iso_date("Snapshot_Date"),
            "Quantity_On_Hand": numbers.to_int("Quantity_On_Hand"),
            "Reorder_Level": numbers.to_int("Reorder_Level"),
        },
    )
    return apply_rules(typed, inventory_rules(), VALID)


def customers_rules(clock: RunClock) -> list[Rule]:
    return [
        Rule("DQ_Customer_ID_Valid", known("Customer_ID"), 20, gate=True),
        Rule("DQ_Full_Name_Valid", has_text("Full_Name"), 15, gate=True),
        Rule("DQ_Gender_Valid", one_of("Gender", rules.KNOWN_GENDERS), 10),
        Rule("DQ_Birthdate_Valid", dates.plausible_birthdate("Birthdate", clock.as_of), 15),
        Rule("DQ_Registration_Date_Valid", known("Registration_Date"), 15, gate=True),
        Rule("DQ_Email_Valid", "Email LIKE '%@%.%'", 15),
        Rule("DQ_Phone_Valid", f"length(rtrim(Phone_Number)) >= {rules.SHORTEST_PHONE}", 10),
        Rule("Has_Missing_Email", "Email IS NULL"),
        Rule("Has_Missing_Phone", "Phone_Number IS NULL"),
        # the whole id stays the key; ids longer than the source system allows are marked
        Rule("Has_Long_Customer_ID", f"length(Customer_ID) > {rules.LONGEST_CUSTOMER_ID}"),
    ]


def stage_customers(raw: DataFrame, clock: RunClock) -> DataFrame:
    typed = _typed(
        raw,
        {
            # normalized here, so that spellings of one id meet in the later dedupe
            "Customer_ID": text.key("Customer_ID"),
            "Full_Name": text.blank_to_null("Full_Name"),
            "Gender": text.upper_text("Gender"),
            "Birthdate": dates.iso_date("Birthdate"),
            "Registration_Date": dates.iso_date("Registration_Date"),
            "Email": text.lower_text("Email"),
            "Phone_Number": text.blank_to_null("Phone_Number"),
            "City": text.blank_to_null("City"),
            "Preferred_Channel": text.upper_text("Preferred_Channel"),
        },
    )
    return apply_rules(typed, customers_rules(clock), VALID)


def promotions_rules() -> list[Rule]:
    return [
        Rule("DQ_Promotion_ID_Valid", has_text("Promotion_ID"), 20, gate=True),
        Rule("DQ_Promo_Name_Valid", has_text("Promo_Name"), 15, gate=True),
        Rule("DQ_Promo_Type_Valid", has_text("Promo_Type"), 15),
        Rule("DQ_Start_Date_Valid", known("Start_Date"), 15, gate=True),
        Rule("DQ_End_Date_Valid", known("End_Date"), 15, gate=True),
        Rule("DQ_Promo_Cost_Valid", "Promo_Cost >= 0", 10),
        Rule("DQ_Date_Range_Valid", "End_Date >= Start_Date", 10, gate=True),
        Rule("Has_Invalid_Date_Range", "End_Date < Start_Date"),
        Rule("Has_Multiple_SKUs", "contains(Eligible_SKUs, '|')"),
    ]


def stage_promotions(raw: DataFrame, clock: RunClock) -> DataFrame:
    typed = _typed(
        raw,
        {
            "Promotion_ID": text.key("Promotion_ID"),
            "Promo_Name": text.blank_to_null("Promo_Name"),
            "Promo_Type": text.upper_text("Promo_Type"),
            "Start_Date": dates.iso_date("Start_Date"),
            "End_Date": dates.iso_date("End_Date"),
            "Promo_Cost": numbers.to_amount("Promo_Cost"),
            "Eligible_SKUs": F.col("Eligible_SKUs"),
        },
    )
    return apply_rules(typed, promotions_rules(), VALID)


def weather_rules() -> list[Rule]:
    return [
        Rule("DQ_Weather_Date_Valid", known("Weather_Date"), 25, gate=True),
        Rule("DQ_Retail_Location_ID_Valid", known("Retail_Location_ID"), 25, gate=True),
        Rule("DQ_Temperature_Valid", known("Temperature_C"), 20),
        Rule("DQ_Precipitation_Valid", known("Precipitation_mm"), 15),
        Rule("DQ_Weather_Condition_Valid", has_text("Weather_Condition"), 15, gate=True),
        Rule("Has_Missing_Temperature", "Temperature_C IS NULL"),
        Rule(
            "Is_Extreme_Temperature",
            f"Temperature_C < {rules.COLDEST_PLAUSIBLE_C} OR Temperature_C > {rules.HOTTEST_PLAUSIBLE_C}",
        ),
    ]


def stage_weather(raw: DataFrame, clock: RunClock) -> DataFrame:
    typed = _typed(
        raw,
        {
            "Weather_Date": dates.iso_date("Weather_Date"),
            "Retail_Location_ID": text.key("Retail_Location_ID"),
            "Temperature_C": numbers.to_decimal("Temperature_C", "decimal(5,2)"),
            "Precipitation_mm": numbers.to_decimal("Precipitation_mm", "decimal(5,2)"),
            "Weather_Condition": text.upper_text("Weather_Condition"),
        },
    )
    return apply_rules(typed, weather_rules(), VALID)


STAGERS: dict[str, Callable[[DataFrame, RunClock], DataFrame]] = {
    "pos_transactions_header": stage_header,
    "pos_transactions_lines": stage_lines,
    "erp_products": stage_products,
    "erp_stores": stage_stores,
    "erp_inventory": stage_inventory,
    "crm_customers": stage_customers,
    "mkt_promotions": stage_promotions,
    "api_weather": stage_weather,
}
