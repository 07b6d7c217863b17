"""The registered queries in DuckDB SQL over the same driver tables.

Written apart from the library: staging, silver and gold are named subqueries that a statement
pulls in as it needs them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from shelfmark.functions import rules
from verification import feeds

# whole numbers that can be missing are shown as double
SPARSE_NUMBERS = frozenset(
    (
        "Line_Count", "Quantity_On_Hand", "Reorder_Level", "Age", "Quantity", "Line_Number",
        "Previous_Quantity", "Customer_Tenure_Days",
    )
)
AS_OF = "DATE '2025-01-01'"

# --- expressions --------------------------------------------------------------------------


def key(x: str) -> str:
    return f"upper(trim({x}))"


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def opt_key(x: str) -> str:
    return f"CASE WHEN {key(x)} NOT IN ('', 'NA', 'NULL', 'N/A') THEN {key(x)} END"


def amount(x: str, marks: str = "$€, ", kind: str = "DECIMAL(18,2)") -> str:
    bare = f"regexp_replace({x}, '[{marks}]', '', 'g')"
    return rf"CASE WHEN regexp_full_match({bare}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)') THEN TRY_CAST({bare} AS {kind}) END"


def opt_amount(x: str, marks: str = "$€, ") -> str:
    return f"CASE WHEN {key(x)} NOT IN ('', 'NA', 'NULL', 'N/A') THEN {amount(x, marks)} END"


def whole(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN TRY_CAST(trim({x}) AS INTEGER) END"


def slashed(x: str) -> str:
    return rf"regexp_replace(trim({x}), '^(\d{{1,2}})[-./](\d{{1,2}})[-./](\d{{4}})', '\1/\2/\3')"


def iso(x: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match(trim({x}), '\d{{4}}-\d{{2}}-\d{{2}}') THEN TRY_CAST(trim({x}) AS DATE) "
        rf"WHEN regexp_full_match(trim({x}), '\d{{8}}') THEN try_strptime(trim({x}), '%Y%m%d')::DATE "
        rf"WHEN regexp_full_match({slashed(x)}, '\d{{1,2}}/\d{{1,2}}/\d{{4}}') THEN try_strptime({slashed(x)}, '%m/%d/%Y')::DATE END"
    )


def mixed_date(x: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({slashed(x)}, '\d{{1,2}}/\d{{1,2}}/\d{{4}}') THEN "
        f"coalesce(try_strptime({slashed(x)}, '%m/%d/%Y'), try_strptime({slashed(x)}, '%d/%m/%Y'))::DATE ELSE {iso(x)} END"
    )


def mixed_ts(x: str) -> str:
    forms = ("%m/%d/%Y %H:%M", "%d/%m/%Y %H:%M", "%m/%d/%Y %I:%M %p", "%d/%m/%Y %I:%M %p", "%Y-%m-%d %H:%M:%S")
    return f"coalesce({', '.join(f"try_strptime({slashed(x)}, '{form}')" for form in forms)})"


def cap(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


def na(x: str) -> str:
    return f"coalesce({blank(x)}, 'N/A')"


def flag(condition: str) -> str:
    return f"coalesce({condition}, false)::INTEGER"


def first_like(x: str, patterns: Sequence[tuple[str, str]], rest: str) -> str:
    """The label of the first pattern that fits."""
    arms = " ".join(f"WHEN {x} LIKE '{pattern}' THEN '{label}'" for pattern, label in patterns)
    return f"CASE {arms} ELSE {rest} END"


def half_up(number: str, by: str, digits: int) -> str:
    """number / by to some digits, in whole numbers: ``number`` and ``by`` are integers, by > 0."""
    n = f"(abs({number})::HUGEINT * {10 ** digits * 2} + ({by})::HUGEINT)"
    return f"(sign({number})::HUGEINT * ({n} // (2 * ({by})::HUGEINT)))::DOUBLE / {10 ** digits}"


def units(x: str, scale: int = 2) -> str:
    """A decimal as a whole number of its last digit."""
    return f"CAST(({x}) * {10 ** scale} AS HUGEINT)"


def pct(part: str, of: str, scale: int) -> str:
    """part / of * 100 to two digits where of > 0, both decimals of one scale."""
    return f"CASE WHEN {of} > 0 THEN {half_up(units(part, scale) + ' * 100', units(of, scale), 2)} ELSE 0 END"


def avg(x: str, digits: int, scale: int = 2) -> str:
    return half_up(f"sum({units(x, scale)})", f"(count({x}) * {10 ** scale})", digits)


LATEST = "Load_Timestamp DESC NULLS LAST, Raw_ID DESC NULLS LAST"

# --- named subqueries ---------------------------------------------------------------------

CTE: dict[str, str] = {f"raw_{e}": feeds.duck_sql(sql) for e, sql in feeds.FEEDS.items()}
CTE["payloads"] = feeds.duck_sql(feeds.PAYLOADS)


def staged(name: str, source: str, columns: dict[str, str], rules: list[tuple[str, str]], valid: str) -> None:
    typed = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())
    flags = ", ".join(f"{flag(sql)} AS {c}" for c, sql in rules)
    CTE[name] = (
        f"SELECT *, {flag(valid)} AS DQ_Is_Valid FROM (SELECT *, {flags} FROM "
        f"(SELECT Raw_ID, {typed}, Batch_ID, Source_File, Load_Timestamp FROM {source}) AS t) AS f"
    )


def texted(c: str) -> tuple[str, str]:
    return (f"DQ_{c}_Valid", f"length(rtrim({c})) > 0")


def given(c: str, name: str | None = None) -> tuple[str, str]:
    return (f"DQ_{name or c}_Valid", f"{c} IS NOT NULL")


_PAY = "('CASH', 'CARD', 'ONLINE', 'CREDIT', 'DEBIT')"

staged(
    "stg_header",
    "raw_pos_transactions_header",
    {
        "Transaction_ID": key("Transaction_ID"),
        "Transaction_Date": mixed_date("Transaction_Date"),
        "Transaction_TS": mixed_ts("Transaction_TS"),
        "Store_ID": key("Store_ID"),
        "Customer_ID": opt_key("Customer_ID"),
        "Payment_Method": key("Payment_Method"),
        "Total_Amount": amount("Total_Amount"),
        "Total_Discount": opt_amount("Total_Discount"),
        "Line_Count": whole("Line_Count"),
    },
    [
        texted("Transaction_ID"),
        given("Transaction_Date"),
        given("Transaction_TS"),
        texted("Store_ID"),
        ("DQ_Customer_ID_Valid", "Customer_ID IS NULL OR Customer_ID <> ''"),
        ("DQ_Payment_Method_Valid", f"Payment_Method IN {_PAY}"),
        ("DQ_Total_Amount_Valid", "Total_Amount > 0"),
        ("DQ_Total_Discount_Valid", "Total_Discount IS NULL OR (Total_Discount >= 0 AND Total_Amount >= Total_Discount)"),
        ("DQ_Line_Count_Valid", "Line_Count > 0"),
        ("DQ_Timestamp_Consistent", "Transaction_TS::DATE = Transaction_Date"),
        ("Is_Walk_In", "Customer_ID IS NULL"),
        ("Has_Discount", "Total_Discount > 0"),
    ],
    "DQ_Transaction_ID_Valid + DQ_Transaction_Date_Valid + DQ_Transaction_TS_Valid + DQ_Store_ID_Valid + "
    "DQ_Payment_Method_Valid + DQ_Total_Amount_Valid + DQ_Line_Count_Valid + DQ_Timestamp_Consistent = 8",
)

_LM = "$€£, "
staged(
    "stg_lines",
    "raw_pos_transactions_lines",
    {
        "Transaction_Line_ID": key("Transaction_Line_ID"),
        "Transaction_ID": key("Transaction_ID"),
        "Line_Number": whole("Line_Number"),
        "Product_SKU": key("Product_SKU"),
        "Store_ID": key("Store_ID"),
        "Quantity": whole("Quantity"),
        "Unit_Price": amount("Unit_Price", _LM),
        "Cost_Price": amount("Cost_Price", _LM),
        "Discount_Amount": opt_amount("Discount_Amount", _LM),
        "Line_Sales_Amount": amount("Line_Sales_Amount", _LM),
        "Promotion_ID": opt_key("Promotion_ID"),
    },
    [
        texted("Transaction_Line_ID"),
        texted("Transaction_ID"),
        ("DQ_Line_Number_Valid", "Line_Number > 0"),
        texted("Product_SKU"),
        texted("Store_ID"),
        ("DQ_Quantity_Valid", "Quantity <> 0"),
        ("DQ_Unit_Price_Valid", "Unit_Price > 0"),
        ("DQ_Cost_Price_Valid", "Cost_Price >= 0"),
        ("DQ_Discount_Amount_Valid", "Discount_Amount IS NULL OR Discount_Amount >= 0"),
        given("Line_Sales_Amount"),
        ("DQ_Promotion_ID_Valid", "Promotion_ID IS NULL OR Promotion_ID <> ''"),
        ("Is_Negative_Quantity", "Quantity < 0"),
        ("Is_Outlier_Quantity", "Quantity > 100"),
        ("Has_Discount", "Discount_Amount > 0"),
        ("Has_Promotion", "Promotion_ID IS NOT NULL"),
        ("Has_Price_Issue", "Cost_Price > Unit_Price"),
    ],
    "DQ_Transaction_Line_ID_Valid + DQ_Transaction_ID_Valid + DQ_Line_Number_Valid + DQ_Product_SKU_Valid + DQ_Store_ID_Valid "
    "+ DQ_Quantity_Valid + DQ_Unit_Price_Valid + DQ_Cost_Price_Valid + DQ_Line_Sales_Amount_Valid = 9",
)

staged(
    "stg_products",
    "raw_erp_products",
    {
        "Product_SKU": key("Product_SKU"),
        "Product_Name": blank("Product_Name"),
        "Category": f"upper({blank('Category')})",
        "Sub_Category": f"upper({blank('Sub_Category')})",
        "Price": amount("Price"),
        "Cost_Price": amount("Cost_Price"),
        "Supplier_ID": key("Supplier_ID"),
        "Last_Updated": iso("Last_Updated"),
    },
    [
        texted("Product_SKU"),
        texted("Product_Name"),
        texted("Category"),
        texted("Sub_Category"),
        ("DQ_Price_Valid", "Price > 0"),
        ("DQ_Cost_Price_Valid", "Cost_Price >= 0"),
        texted("Supplier_ID"),
        given("Last_Updated"),
        ("Has_Price_Issue", "Cost_Price > Price"),
    ],
    "DQ_Product_SKU_Valid + DQ_Product_Name_Valid + DQ_Category_Valid + DQ_Price_Valid + DQ_Supplier_ID_Valid = 5",
)

staged(
    "stg_stores",
    "raw_erp_stores",
    {
        "Store_ID": key("Store_ID"),
        "Store_Name": blank("Store_Name"),
        "City": blank("City"),
        "Region": blank("Region"),
        "Store_Manager": blank("Store_Manager"),
        "Store_Area_sqm": amount("Store_Area_sqm", ", ", "DECIMAL(10,2)"),
        "Open_Date": iso("Open_Date"),
    },
    [
        given("Store_ID"),
        texted("Store_Name"),
        texted("City"),
        texted("Region"),
        ("DQ_Store_Area_Valid", "Store_Area_sqm > 0"),
        given("Open_Date"),
        ("Has_Multiple_Managers", "Store_Manager LIKE '%;%'"),
    ],
    "DQ_Store_ID_Valid + DQ_Store_Name_Valid + DQ_City_Valid + DQ_Region_Valid = 4",
)

staged(
    "stg_inventory",
    "raw_erp_inventory",
    {
        "Inventory_ID": key("Inventory_ID"),
        "Product_SKU": key("Product_SKU"),
        "Store_ID": key("Store_ID"),
        "Snapshot_Date": iso("Snapshot_Date"),
        "Quantity_On_Hand": whole("Quantity_On_Hand"),
        "Reorder_Level": whole("Reorder_Level"),
    },
    [
        texted("Inventory_ID"),
        texted("Product_SKU"),
        given("Store_ID"),
        given("Snapshot_Date"),
        given("Quantity_On_Hand"),
        ("DQ_Reorder_Level_Valid", "Reorder_Level >= 0"),
        ("Is_Negative_Quantity", "Quantity_On_Hand < 0"),
        ("Is_Outlier_Quantity", "Quantity_On_Hand > 10000"),
        ("Is_Below_Reorder_Level", "Quantity_On_Hand < Reorder_Level"),
    ],
    "DQ_Inventory_ID_Valid + DQ_Product_SKU_Valid + DQ_Store_ID_Valid + DQ_Snapshot_Date_Valid + DQ_Quantity_On_Hand_Valid = 5",
)

staged(
    "stg_customers",
    "raw_crm_customers",
    {
        "Customer_ID": key("Customer_ID"),
        "Full_Name": blank("Full_Name"),
        "Gender": f"upper({blank('Gender')})",
        "Birthdate": iso("Birthdate"),
        "Registration_Date": iso("Registration_Date"),
        "Email": f"lower({blank('Email')})",
        "Phone_Number": blank("Phone_Number"),
        "City": blank("City"),
        "Preferred_Channel": f"upper({blank('Preferred_Channel')})",
    },
    [
        given("Customer_ID"),
        texted("Full_Name"),
        ("DQ_Gender_Valid", "Gender IN ('M', 'F', 'MALE', 'FEMALE')"),
        ("DQ_Birthdate_Valid", f"Birthdate < {AS_OF} AND Birthdate > {AS_OF} - INTERVAL 120 YEAR"),
        given("Registration_Date"),
        ("DQ_Email_Valid", "Email LIKE '%@%.%'"),
        ("DQ_Phone_Valid", "length(rtrim(Phone_Number)) >= 10"),
        ("Has_Missing_Email", "Email IS NULL"),
        ("Has_Missing_Phone", "Phone_Number IS NULL"),
        ("Has_Long_Customer_ID", "length(Customer_ID) > 50"),
    ],
    "DQ_Customer_ID_Valid + DQ_Full_Name_Valid + DQ_Registration_Date_Valid = 3",
)

staged(
    "stg_promotions",
    "raw_mkt_promotions",
    {
        "Promotion_ID": key("Promotion_ID"),
        "Promo_Name": blank("Promo_Name"),
        "Promo_Type": f"upper({blank('Promo_Type')})",
        "Start_Date": iso("Start_Date"),
        "End_Date": iso("End_Date"),
        "Promo_Cost": amount("Promo_Cost"),
        "Eligible_SKUs": "Eligible_SKUs",
    },
    [
        texted("Promotion_ID"),
        texted("Promo_Name"),
        texted("Promo_Type"),
        given("Start_Date"),
        given("End_Date"),
        ("DQ_Promo_Cost_Valid", "Promo_Cost >= 0"),
        ("DQ_Date_Range_Valid", "End_Date >= Start_Date"),
        ("Has_Invalid_Date_Range", "End_Date < Start_Date"),
        ("Has_Multiple_SKUs", "Eligible_SKUs LIKE '%|%'"),
    ],
    "DQ_Promotion_ID_Valid + DQ_Promo_Name_Valid + DQ_Start_Date_Valid + DQ_End_Date_Valid + DQ_Date_Range_Valid = 5",
)

staged(
    "stg_weather",
    "raw_api_weather",
    {
        "Weather_Date": iso("Weather_Date"),
        "Retail_Location_ID": key("Retail_Location_ID"),
        "Temperature_C": "TRY_CAST(Temperature_C AS DECIMAL(5,2))",
        "Precipitation_mm": "TRY_CAST(Precipitation_mm AS DECIMAL(5,2))",
        "Weather_Condition": f"upper({blank('Weather_Condition')})",
    },
    [
        given("Weather_Date"),
        given("Retail_Location_ID"),
        given("Temperature_C", "Temperature"),
        given("Precipitation_mm", "Precipitation"),
        texted("Weather_Condition"),
        ("Has_Missing_Temperature", "Temperature_C IS NULL"),
        ("Is_Extreme_Temperature", "NOT Temperature_C BETWEEN -20 AND 45"),
    ],
    "DQ_Weather_Date_Valid + DQ_Retail_Location_ID_Valid + DQ_Weather_Condition_Valid = 3",
)


def weighed(weights: Sequence[tuple[str, int]]) -> str:
    """Weighted sum of DQ_.._Valid flags."""
    return " + ".join(f"{weight} * DQ_{column}_Valid" for column, weight in weights)


def silver(name: str, source: str, by: str, columns: str, weights: Sequence[tuple[str, int]], valid: str, order: str = LATEST, only: str = "DQ_Is_Valid = 1") -> None:
    CTE[name] = (
        f"SELECT {columns}, 1 AS Is_Valid, {weighed(weights)} AS DQ_Score, Batch_ID, Source_File FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS pos FROM {source} WHERE {only}) AS d "
        f"WHERE pos = 1 AND {valid}"
    )


_MANAGER = na("split_part(Store_Manager, ';', 1)")
_UNKNOWN, _OTHER = "'UNKNOWN'", "'OTHER'"
_HAS_PHONE = flag("trim(Phone_Number)[1] = '+'")
_ON_DAY = flag("Start_Date <= DATE '1998-06-15' AND End_Date >= DATE '1998-06-15'")

silver(
    "stores", "stg_stores", "Store_ID",
    f"Store_ID, Store_Name, {cap('City')} AS City, upper(Region) AS Region, {_MANAGER} AS Store_Manager, "
    "Store_Area_sqm, Open_Date, Has_Multiple_Managers",
    (("Store_ID", 20), ("Store_Name", 20), ("City", 15), ("Region", 15), ("Store_Area", 15), ("Open_Date", 15)),
    "DQ_Store_Area_Valid = 1 AND DQ_Open_Date_Valid = 1",
)

_GENDER = "CASE {0} WHEN 'F' THEN 'F' WHEN 'FEMALE' THEN 'F' WHEN 'M' THEN 'M' WHEN 'MALE' THEN 'M' WHEN 'O' THEN 'O' WHEN 'OTHER' THEN 'O' ELSE 'N/A' END"
_PHONE = "CASE WHEN trim(Phone_Number)[1] = '+' THEN trim(Phone_Number) ELSE 'N/A' END"
_NAME = "array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(trim(Full_Name), ' ')], ' ')"

silver(
    "customers", "stg_customers", "Customer_ID",
    f"Customer_ID, {_NAME} AS Full_Name, {_GENDER.format('Gender')} AS Gender, Birthdate, Registration_Date, "
    f"coalesce(upper(Email), 'N/A') AS Email, {_PHONE} AS Phone_Number, coalesce({cap('City')}, 'N/A') AS City, "
    f"{first_like('Preferred_Channel', rules.CHANNEL_PATTERNS, _UNKNOWN)} AS Preferred_Channel, "
    f"(Email IS NOT NULL)::INTEGER AS Has_Email, {_HAS_PHONE} AS Has_Phone",
    (("Customer_ID", 20), ("Full_Name", 15), ("Gender", 10), ("Birthdate", 15), ("Registration_Date", 15), ("Email", 15), ("Phone", 10)),
    "true",
)

silver(
    "products", "stg_products", "Product_SKU",
    f"Product_SKU, Product_Name, {first_like('Category', rules.CATEGORY_PATTERNS, 'Category')} AS Category, "
    f"{first_like('Sub_Category', rules.SUB_CATEGORY_PATTERNS, 'Sub_Category')} AS Sub_Category, Price, Cost_Price, Supplier_ID, "
    f"coalesce(Last_Updated, {AS_OF}) AS Effective_From, NULL::DATE AS Effective_To, 1 AS Is_Current, 1 AS Version_Number, "
    "(Cost_Price IS NOT NULL)::INTEGER AS Has_Cost_Price, Has_Price_Issue",
    (("Product_SKU", 20), ("Product_Name", 15), ("Category", 15), ("Sub_Category", 10), ("Price", 20), ("Cost_Price", 10), ("Supplier_ID", 10)),
    "true",
    order=f"Last_Updated DESC NULLS LAST, {LATEST}",
)
silver(
    "promotions", "stg_promotions", "Promotion_ID",
    f"Promotion_ID, Promo_Name, {first_like('Promo_Type', rules.PROMO_TYPE_PATTERNS, _OTHER)} AS Promo_Type, Start_Date, End_Date, "
    f"Promo_Cost, coalesce({key('Eligible_SKUs')}, 'N/A') AS Eligible_SKUs, Has_Multiple_SKUs, Has_Invalid_Date_Range",
    (("Promotion_ID", 20), ("Promo_Name", 15), ("Promo_Type", 15), ("Start_Date", 15), ("End_Date", 15), ("Promo_Cost", 10), ("Date_Range", 10)),
    "DQ_Promo_Cost_Valid = 1",
)
_LOCATION = "CASE WHEN starts_with(Retail_Location_ID, 'LOC_') THEN substr(Retail_Location_ID, 5) ELSE Retail_Location_ID END"
silver(
    "weather", f"(SELECT *, {_LOCATION} AS Store_ID FROM stg_weather)", "Weather_Date, Store_ID",
    f"Weather_Date, Store_ID, Temperature_C, Precipitation_mm, {first_like('Weather_Condition', rules.WEATHER_PATTERNS, 'Weather_Condition')} AS Weather_Condition, "
    "Has_Missing_Temperature, Is_Extreme_Temperature",
    (("Weather_Date", 25), ("Retail_Location_ID", 25), ("Temperature", 20), ("Precipitation", 15), ("Weather_Condition", 15)),
    "DQ_Precipitation_Valid = 1",
)
silver(
    "inventory", "stg_inventory", "Product_SKU, Store_ID",
    "Inventory_ID, Product_SKU, Store_ID, Snapshot_Date, Quantity_On_Hand, Reorder_Level, Is_Below_Reorder_Level, "
    "Is_Negative_Quantity, Is_Outlier_Quantity, 1 AS Is_Latest_Snapshot",
    (("Inventory_ID", 15), ("Product_SKU", 25), ("Store_ID", 20), ("Snapshot_Date", 15), ("Quantity_On_Hand", 15), ("Reorder_Level", 10)),
    "DQ_Reorder_Level_Valid = 1 AND Product_SKU IN (SELECT Product_SKU FROM stg_products WHERE DQ_Is_Valid = 1) "
    "AND Store_ID IN (SELECT Store_ID FROM stg_stores WHERE DQ_Is_Valid = 1)",
    order=f"Snapshot_Date DESC NULLS LAST, {LATEST}",
    only="DQ_Is_Valid = 1 AND Is_Negative_Quantity = 0",
)
silver(
    "headers", "stg_header", "Transaction_ID",
    "Transaction_ID, Transaction_Date, Transaction_TS, Store_ID, coalesce(Customer_ID, 'N/A') AS Customer_ID, Payment_Method, "
    "Total_Amount, Total_Discount, Line_Count, Is_Walk_In, Has_Discount",
    (("Transaction_ID", 15), ("Transaction_Date", 15), ("Transaction_TS", 10), ("Store_ID", 15), ("Customer_ID", 10), ("Payment_Method", 10), ("Total_Amount", 15), ("Total_Discount", 5), ("Line_Count", 5)),
    "Store_ID IN (SELECT Store_ID FROM stores)",
)
silver(
    "lines", "stg_lines", "Transaction_Line_ID",
    "Transaction_Line_ID, Transaction_ID, Line_Number, Product_SKU, Store_ID, Quantity, Unit_Price, Cost_Price, "
    "coalesce(nullif(Discount_Amount, 0), Unit_Price * Quantity - Line_Sales_Amount)::DECIMAL(18,2) AS Discount_Amount, Line_Sales_Amount, Promotion_ID, "
    "Is_Negative_Quantity AS Is_Return, Is_Outlier_Quantity, Has_Discount, Has_Promotion, Has_Price_Issue",
    (("Transaction_Line_ID", 10), ("Transaction_ID", 15), ("Line_Number", 5), ("Product_SKU", 15), ("Store_ID", 10), ("Quantity", 10), ("Unit_Price", 15), ("Cost_Price", 10), ("Line_Sales_Amount", 10)),
    "true",
)

_COST = "(Quantity * Cost_Price)"
CTE["sales"] = f"""
SELECT l.Transaction_Line_ID, l.Transaction_ID, l.Line_Number, h.Transaction_Date, l.Product_SKU, l.Store_ID, h.Customer_ID,
  coalesce(l.Promotion_ID, 'N/A') AS Promotion_ID, l.Quantity, l.Unit_Price, l.Cost_Price, l.Line_Sales_Amount,
  coalesce(l.Discount_Amount, 0) AS Discount_Amount, {_COST}::DECIMAL(18,2) AS Line_Cost_Amount,
  (Line_Sales_Amount - {_COST})::DECIMAL(18,2) AS Line_Margin_Amount,
  {pct(f'(Line_Sales_Amount - {_COST})', _COST, 2)} AS Line_Margin_Pct,
  h.Payment_Method, h.Transaction_TS, l.Is_Return, l.Is_Outlier_Quantity, l.Has_Discount, l.Has_Promotion, h.Is_Walk_In,
  (l.DQ_Score + h.DQ_Score) // 2 AS DQ_Score
FROM lines AS l JOIN headers AS h USING (Transaction_ID)"""
CTE["stock"] = (
    "SELECT Inventory_ID, Product_SKU, Store_ID, Snapshot_Date, Quantity_On_Hand, Reorder_Level, "
    "greatest(Reorder_Level - Quantity_On_Hand, 0) AS Reorder_Quantity_Needed, Is_Below_Reorder_Level, Is_Outlier_Quantity, DQ_Score FROM inventory"
)
CTE["daily_stock"] = (
    f"SELECT *, greatest(coalesce(Reorder_Level - Quantity_On_Hand, 0), 0) AS Reorder_Quantity_Needed FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY Product_SKU, Store_ID, Snapshot_Date ORDER BY {LATEST}) AS pos FROM stg_inventory WHERE DQ_Is_Valid = 1 AND "
    "Is_Negative_Quantity = 0) AS d WHERE pos = 1"
)


def calendar_sql(table: str, column: str) -> str:
    return (
        f"SELECT unnest(generate_series(date_trunc('year', a), date_trunc('year', z) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d "
        f"FROM (SELECT min({column})::DATE AS a, max({column})::DATE AS z FROM {table}) AS b"
    )


CTE["days"] = calendar_sql("orders", "o_orderdate")
CTE["stock_days"] = calendar_sql("events", "ts")


def keyed(source: str, name: str, columns: str, natural: str, text: str) -> str:
    return f"SELECT {columns}, row_number() OVER (ORDER BY substr(md5({text}), 1, 3), {natural}) AS {name} FROM {source}"


CTE["key_products"] = keyed("products", "Product_Key", "*", "Product_SKU", "Product_SKU")
CTE["key_promotions"] = keyed("promotions", "Promotion_Key", "*", "Promotion_ID", "Promotion_ID")
CTE["bridge"] = (
    f"SELECT DISTINCT Promotion_ID, {key('s')} AS Product_SKU FROM (SELECT Promotion_ID, unnest(string_split(Eligible_SKUs, '|')) AS s FROM promotions "
    f"WHERE Eligible_SKUs <> 'N/A') AS u WHERE {key('s')} IN (SELECT Product_SKU FROM products)"
)
CTE["mismatch"] = (
    "SELECT h.Transaction_ID, h.Store_ID AS Header_Store_ID, l.Store_ID AS Line_Store_ID FROM stg_header AS h JOIN stg_lines AS l "
    "USING (Transaction_ID) WHERE h.DQ_Is_Valid = 1 AND l.DQ_Is_Valid = 1 AND h.Store_ID <> l.Store_ID"
)
CTE["flat"] = """
SELECT event_id, Store_ID, j ->> ('$.daily.time[' || i || ']') AS Weather_Date,
  (j ->> ('$.daily.temperature_2m_mean[' || i || ']'))::DOUBLE AS Temperature_C,
  (j ->> ('$.daily.precipitation_sum[' || i || ']'))::DOUBLE AS Precipitation_mm,
  (j ->> ('$.daily.weathercode[' || i || ']'))::INTEGER AS code
FROM (SELECT event_id, Store_ID, payload::JSON AS j, unnest([0, 1, 2]) AS i FROM payloads) AS p"""

_TABLES = {
    "pos_transactions_header": "header",
    "pos_transactions_lines": "lines",
    "erp_products": "products",
    "erp_stores": "stores",
    "erp_inventory": "inventory",
    "crm_customers": "customers",
    "mkt_promotions": "promotions",
    "api_weather": "weather",
}


def share(n: str, of: str) -> str:
    return half_up(f"(({n}) * 100)", of, 2)


CTE["reconciled"] = " UNION ALL ".join(
    f"SELECT '{entity}' AS Table_Name, (SELECT count(*) FROM raw_{entity}) AS Raw_Count, count(*) AS Staging_Count, "
    f"coalesce(sum(DQ_Is_Valid), 0)::BIGINT AS Valid_Count FROM stg_{short}"
    for entity, short in _TABLES.items()
)

# --- statements ---------------------------------------------------------------------------

_WORD = re.compile(r"[a-z_]+")


def statement(body: str) -> str:
    """The body after the named subqueries it mentions, directly or through others."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(_WORD.findall(sql)):
            if name in CTE and name not in needed:
                visit(CTE[name])
                needed.append(name)

    visit(body)
    head = ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in needed)
    return f"WITH {head}\n{body.strip()}" if head else body.strip()


def out(*columns: str) -> str:
    """Output columns with a mark for their type: d: date, t: timestamp, m: decimal, n: whole
    number; no mark leaves the value as it is."""
    cast = {
        "d": "CAST({0} AS VARCHAR) AS {0}",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}",
        "m": "CAST({0} AS DOUBLE) AS {0}",
        "n": "CAST({0} AS BIGINT) AS {0}",
    }
    parts = []
    for item in columns:
        mark, _, name = item.rpartition(":")
        if name in SPARSE_NUMBERS:
            mark = "m"
        parts.append(cast[mark].format(name) if mark else name)
    return ", ".join(parts)


def flags_of(name: str) -> tuple[str, ...]:
    """Names of the flag columns of a staging subquery, as whole numbers."""
    found = re.findall(r"::INTEGER AS (\w+)", CTE[name])
    return tuple(f"n:{c}" for c in dict.fromkeys(found))


ORIGIN = ("Batch_ID", "Source_File")
SILVER_TAIL = ("n:Is_Valid", "n:DQ_Score", *ORIGIN)

_STG = {
    "dq_flags_header": (
        "stg_header",
        (
            "n:Raw_ID", "Transaction_ID", "d:Transaction_Date", "t:Transaction_TS", "Store_ID", "Customer_ID",
            "Payment_Method", "m:Total_Amount", "m:Total_Discount", "n:Line_Count",
        ),
    ),
    "dq_flags_lines": (
        "stg_lines",
        (
            "n:Raw_ID", "Transaction_Line_ID", "Transaction_ID", "n:Line_Number", "Product_SKU", "Store_ID", "n:Quantity",
            "m:Unit_Price", "m:Cost_Price", "m:Discount_Amount", "m:Line_Sales_Amount", "Promotion_ID",
        ),
    ),
    "stg_products": (
        "stg_products",
        (
            "n:Raw_ID", "Product_SKU", "Product_Name", "Category", "Sub_Category", "m:Price", "m:Cost_Price", "Supplier_ID",
            "d:Last_Updated",
        ),
    ),
    "stg_stores": (
        "stg_stores",
        (
            "n:Raw_ID", "Store_ID", "Store_Name", "City", "Region", "Store_Manager", "m:Store_Area_sqm", "d:Open_Date",
        ),
    ),
    "stg_inventory": (
        "stg_inventory",
        (
            "n:Raw_ID", "Inventory_ID", "Product_SKU", "Store_ID", "d:Snapshot_Date", "n:Quantity_On_Hand", "n:Reorder_Level",
        ),
    ),
    "dq_flags_customer": (
        "stg_customers",
        (
            "n:Raw_ID", "Customer_ID", "Full_Name", "Gender", "d:Birthdate", "d:Registration_Date", "Email", "Phone_Number",
            "City", "Preferred_Channel",
        ),
    ),
    "stg_promotions": (
        "stg_promotions",
        (
            "n:Raw_ID", "Promotion_ID", "Promo_Name", "Promo_Type", "d:Start_Date", "d:End_Date", "m:Promo_Cost",
            "Eligible_SKUs",
        ),
    ),
    "stg_weather": (
        "stg_weather",
        (
            "n:Raw_ID", "d:Weather_Date", "Retail_Location_ID", "m:Temperature_C", "m:Precipitation_mm", "Weather_Condition",
        ),
    ),
}

_SILVER = {
    "silver_stores": (
        "stores",
        (
            "Store_ID", "Store_Name", "City", "Region", "Store_Manager", "m:Store_Area_sqm", "d:Open_Date",
            "n:Has_Multiple_Managers",
        ),
    ),
    "silver_customers": (
        "customers",
        (
            "Customer_ID", "Full_Name", "Gender", "d:Birthdate", "d:Registration_Date", "Email", "Phone_Number", "City",
            "Preferred_Channel", "n:Has_Email", "n:Has_Phone",
        ),
    ),
    "silver_products": (
        "products",
        (
            "Product_SKU", "Product_Name", "Category", "Sub_Category", "m:Price", "m:Cost_Price", "Supplier_ID",
            "d:Effective_From", "d:Effective_To", "n:Is_Current", "n:Version_Number", "n:Has_Cost_Price", "n:Has_Price_Issue",
        ),
    ),
    "silver_promotions": (
        "promotions",
        (
            "Promotion_ID", "Promo_Name", "Promo_Type", "d:Start_Date", "d:End_Date", "m:Promo_Cost", "Eligible_SKUs",
            "n:Has_Multiple_SKUs", "n:Has_Invalid_Date_Range",
        ),
    ),
    "silver_weather": (
        "weather",
        (
            "d:Weather_Date", "Store_ID", "m:Temperature_C", "m:Precipitation_mm", "Weather_Condition",
            "n:Has_Missing_Temperature", "n:Is_Extreme_Temperature",
        ),
    ),
    "silver_inventory": (
        "inventory",
        (
            "Inventory_ID", "Product_SKU", "Store_ID", "d:Snapshot_Date", "n:Quantity_On_Hand", "n:Reorder_Level",
            "n:Is_Below_Reorder_Level", "n:Is_Negative_Quantity", "n:Is_Outlier_Quantity", "n:Is_Latest_Snapshot",
        ),
    ),
    "silver_header": (
        "headers",
        (
            "Transaction_ID", "d:Transaction_Date", "t:Transaction_TS", "Store_ID", "Customer_ID", "Payment_Method",
            "m:Total_Amount", "m:Total_Discount", "n:Line_Count", "n:Is_Walk_In", "n:Has_Discount",
        ),
    ),
    "silver_lines": (
        "lines",
        (
            "Transaction_Line_ID", "Transaction_ID", "n:Line_Number", "Product_SKU", "Store_ID", "n:Quantity", "m:Unit_Price",
            "m:Cost_Price", "m:Discount_Amount", "m:Line_Sales_Amount", "Promotion_ID", "n:Is_Return",
            "n:Is_Outlier_Quantity", "n:Has_Discount", "n:Has_Promotion", "n:Has_Price_Issue",
        ),
    ),
}

_SALES_OUT = (
    "Transaction_Line_ID", "Transaction_ID", "n:Line_Number", "d:Transaction_Date", "Product_SKU", "Store_ID", "Customer_ID",
    "Promotion_ID", "n:Quantity", "m:Unit_Price", "m:Cost_Price", "m:Line_Sales_Amount", "m:Discount_Amount",
    "m:Line_Cost_Amount", "m:Line_Margin_Amount", "m:Line_Margin_Pct", "Payment_Method", "t:Transaction_TS", "n:Is_Return",
    "n:Is_Outlier_Quantity", "n:Has_Discount", "n:Has_Promotion", "n:Is_Walk_In", "n:DQ_Score",
)


def money(x: str, name: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) AS {name}"


def _measures(extra: str = "") -> str:
    return (
        f"{money('Line_Sales_Amount', 'Total_Sales_Amount')}, {money('Line_Cost_Amount', 'Total_Cost')}, "
        f"{money('Line_Margin_Amount', 'Total_Margin')}, {extra}"
        "CAST(sum(Quantity) AS BIGINT) AS Units_Sold, count(DISTINCT Transaction_ID) AS Transaction_Count, "
    )


_TICKET = half_up(f"sum({units('Line_Sales_Amount')})", "(count(DISTINCT Transaction_ID) * 100)", 2) + " AS Avg_Transaction_Value"
_SHARE = pct("sum(Line_Margin_Amount)", "sum(Line_Sales_Amount)", 2)
_DISCOUNT = money("Discount_Amount", "Total_Discount") + ", "
_BUYERS = "count(DISTINCT Customer_ID) AS Unique_Customers"
_YM = "year(Transaction_Date) AS Year, month(Transaction_Date) AS Month"

def decoded(code: str) -> str:
    arms = " ".join(f"WHEN {number} THEN '{label}'" for number, label in rules.WEATHER_CODES.items())
    return f"CASE {code} {arms} ELSE '{rules.WEATHER_CODE_DEFAULT}' END"


def located(position: int, default: float) -> str:
    """Latitude (1) or longitude (2) of a city."""
    arms = " ".join(f"WHEN '{place[0]}' THEN {place[position]}" for place in rules.CITY_COORDINATES)
    return f"CAST(CASE trim(City) {arms} ELSE {default} END AS DOUBLE)"


def dimension(source: str, name: str, natural: str, text: str, columns: tuple[str, ...], computed: str) -> str:
    inner = f"SELECT *{', ' + computed if computed else ''}, row_number() OVER (ORDER BY substr(md5({text}), 1, 3), {natural}) AS {name} FROM {source}"
    return f"SELECT {out(*columns, 'n:DQ_Score', f'n:{name}')} FROM ({inner}) AS k"


def checks_sql(table: str, source: str, rules: list[tuple[str, str]], uniques: list[tuple[str, str, str]]) -> list[str]:
    parts = []
    for label, fails in rules:
        text = label.replace("'", "''")
        parts.append(f"SELECT '{table}' AS Table_Name, '{text}' AS Check_Name, count(*) FILTER (WHERE {fails}) AS Failures FROM {source}")
    for label, keys, where in uniques:
        parts.append(
            f"SELECT '{table}', 'unique({label})', count(*) FROM (SELECT {keys} FROM {source} WHERE {where} GROUP BY {keys} HAVING count(*) > 1) AS u"
        )
    return parts


def nulls(*columns: str) -> list[tuple[str, str]]:
    return [(f"not_null({c})", f"{c} IS NULL") for c in columns]


def rule(expression: str) -> tuple[str, str]:
    return (f"expression_is_true({expression})", f"NOT ({expression})")


_TAIL = ("Is_Valid", "DQ_Score", "Batch_ID", "Source_File")
# the audit stamps are constants in the library's tables
_STAMPS = [("not_null(Created_TS)", "false"), ("not_null(Updated_TS)", "false")]
_ALWAYS = [("accepted_values(Is_Valid)", "Is_Valid <> 1"), rule("DQ_Score BETWEEN 0 AND 100")]

ORACLE_BODIES: dict[str, str] = {
    "clean_keys": f"SELECT Raw_ID, {key('Transaction_ID')} AS Transaction_ID, {opt_key('Customer_ID')} AS Customer_ID, {key('Payment_Method')} AS Payment_Method, coalesce({opt_key('Customer_ID')}, 'N/A') AS Customer_Or_NA FROM raw_pos_transactions_header",
    "clean_contacts": f"SELECT Raw_ID, substr(Customer_ID, 1, 50) AS Customer_Prefix, trim(City) AS City_Trimmed, {blank('Full_Name')} AS Full_Name, lower({blank('Email')}) AS Email, upper({blank('Preferred_Channel')}) AS Preferred_Channel, {na('City')} AS City_Or_NA, CAST(length(rtrim(Phone_Number)) AS DOUBLE) AS Phone_Length FROM raw_crm_customers",
    "parse_currency": f"SELECT Raw_ID, CAST({amount('Unit_Price', _LM)} AS DOUBLE) AS Unit_Price, CAST({amount('Cost_Price', _LM)} AS DOUBLE) AS Cost_Price, CAST({opt_amount('Discount_Amount', _LM)} AS DOUBLE) AS Discount_Amount, coalesce(CAST({opt_amount('Discount_Amount', _LM)} AS DOUBLE), 0) AS Discount_Or_Zero, CAST({amount('Line_Sales_Amount', _LM)} AS DOUBLE) AS Line_Sales_Amount FROM raw_pos_transactions_lines",
    "parse_header_amounts": f"SELECT Raw_ID, CAST({amount('Total_Amount')} AS DOUBLE) AS Total_Amount, CAST({opt_amount('Total_Discount')} AS DOUBLE) AS Total_Discount, CAST({whole('Line_Count')} AS DOUBLE) AS Line_Count FROM raw_pos_transactions_header",
    "safe_casts": f"SELECT {out('n:Raw_ID', 'n:Quantity_On_Hand', 'n:Reorder_Level', 'd:Snapshot_Date')} FROM stg_inventory",
    "safe_weather_casts": f"SELECT {out('n:Raw_ID', 'd:Weather_Date', 'm:Temperature_C', 'm:Precipitation_mm')} FROM stg_weather",
    "parse_mixed_dates": f"SELECT {out('n:Raw_ID', 'd:Transaction_Date', 't:Transaction_TS')}, CAST(DQ_Timestamp_Consistent AS BIGINT) AS Same_Day FROM stg_header",
    "proper_case_names": f"SELECT Raw_ID, {_NAME} AS Full_Name, {cap('trim(City)')} AS City FROM raw_crm_customers",
    "list_head": "SELECT Raw_ID, coalesce(nullif(trim(split_part(Store_Manager, ';', 1)), ''), 'N/A') AS Store_Manager FROM raw_erp_stores",
    "prefix_strip": f"SELECT Raw_ID, regexp_replace({key('Retail_Location_ID')}, '^LOC_', '') AS Store_ID FROM raw_api_weather",
    "phone_filter": f"SELECT Raw_ID, {_PHONE} AS Phone_Number FROM raw_crm_customers",
    "standardize_products": f"SELECT Raw_ID, {first_like('Category', rules.CATEGORY_PATTERNS, 'Category')} AS Category, {first_like('Sub_Category', rules.SUB_CATEGORY_PATTERNS, 'Sub_Category')} AS Sub_Category FROM stg_products",
    "standardize_promo_types": f"SELECT Raw_ID, {first_like('Promo_Type', rules.PROMO_TYPE_PATTERNS, _OTHER)} AS Promo_Type FROM stg_promotions",
    "standardize_weather": f"SELECT Raw_ID, {first_like('Weather_Condition', rules.WEATHER_PATTERNS, 'Weather_Condition')} AS Weather_Condition FROM stg_weather",
    "standardize_customers": f"SELECT Raw_ID, {_GENDER.format(key('Gender'))} AS Gender, {first_like(key('Preferred_Channel'), rules.CHANNEL_PATTERNS, _UNKNOWN)} AS Preferred_Channel FROM raw_crm_customers",
    "calendar_dimension": """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS Date_SK, CAST(d AS VARCHAR) AS Date_Value, year(d) AS Year, quarter(d) AS Quarter,
  'Q' || quarter(d) AS Quarter_Name, quarter(d) AS Quarter_Sort, month(d) AS Month, monthname(d) AS Month_Name, monthname(d)[1:3] AS Month_Short,
  month(d) AS Month_Sort, weekofyear(d) AS Week_Of_Year, day(d) AS Day_Of_Month, dayofweek(d) + 1 AS Day_Of_Week, dayname(d) AS Day_Name,
  dayname(d)[1:3] AS Day_Short, (dayofweek(d) IN (0, 6))::BIGINT AS Is_Weekend, (dayofweek(d) NOT IN (0, 6))::BIGINT AS Is_Weekday,
  (day(d) = 1)::BIGINT AS Is_Month_Start, (d = last_day(d))::BIGINT AS Is_Month_End,
  (strftime(d, '%m-%d') IN ('01-01', '12-25'))::BIGINT AS Is_Holiday, year(d) AS Fiscal_Year, quarter(d) AS Fiscal_Quarter,
  strftime(d, '%Y-%m') AS Year_Month, year(d) || '-Q' || quarter(d) AS Year_Quarter FROM days""",
    "date_math": f"SELECT Raw_ID, CAST(year({AS_OF}) - year(Birthdate) AS DOUBLE) AS Age, CAST({AS_OF} - Registration_Date AS DOUBLE) AS Tenure_Days, CAST(DQ_Birthdate_Valid AS BIGINT) AS Plausible FROM stg_customers",
    "promotion_periods": f"SELECT Raw_ID, CAST(End_Date - Start_Date AS DOUBLE) AS Duration_Days, CAST({_ON_DAY} AS BIGINT) AS Is_Active FROM stg_promotions",
    "order_measures": f"SELECT Raw_ID, CAST(Total_Amount - coalesce(Total_Discount, 0) AS DOUBLE) AS Net_Amount, {pct('coalesce(Total_Discount, 0)', 'Total_Amount', 2)} AS Discount_Rate FROM stg_header",
    "line_measures": f"""SELECT Raw_ID, CAST({_COST} AS DOUBLE) AS Line_Cost, CAST(Line_Sales_Amount - {_COST} AS DOUBLE) AS Line_Margin,
  CASE WHEN Line_Sales_Amount > 0 AND {_COST} IS NULL THEN NULL ELSE {pct(f'(Line_Sales_Amount - {_COST})', 'Line_Sales_Amount', 2)} END AS Line_Margin_Over_Sales_Pct,
  {pct(f'(Line_Sales_Amount - {_COST})', _COST, 2)} AS Line_Margin_Over_Cost_Pct,
  CAST(coalesce(nullif(Discount_Amount, 0), Unit_Price * Quantity - Line_Sales_Amount) AS DOUBLE) AS Discount FROM stg_lines""",
    "product_margin": f"SELECT Raw_ID, CAST(Price - coalesce(Cost_Price, 0) AS DOUBLE) AS Margin_Amount, {pct('(Price - coalesce(Cost_Price, 0))', 'Price', 2)} AS Margin_Pct FROM stg_products",
    **{q: f"SELECT {out(*cols, *flags_of(source), *ORIGIN)} FROM {source}" for q, (source, cols) in _STG.items()},
    **{q: f"SELECT {out(*cols, *SILVER_TAIL)} FROM {source}" for q, (source, cols) in _SILVER.items()},
    "dedupe_lines": f"SELECT Transaction_Line_ID, {out('n:Raw_ID', 'Product_SKU', 'n:Quantity', 'm:Line_Sales_Amount')} FROM stg_lines WHERE DQ_Is_Valid = 1 QUALIFY row_number() OVER (PARTITION BY Transaction_Line_ID ORDER BY {LATEST}) = 1",
    "dedupe_products": f"SELECT Product_SKU, {out('n:Raw_ID', 'm:Price', 'd:Last_Updated')} FROM stg_products WHERE DQ_Is_Valid = 1 QUALIFY row_number() OVER (PARTITION BY Product_SKU ORDER BY stg_products.Last_Updated DESC NULLS LAST, {LATEST}) = 1",
    "dedupe_latest_snapshot": f"SELECT Product_SKU, Store_ID, {out('d:Snapshot_Date', 'n:Raw_ID', 'n:Quantity_On_Hand')} FROM stg_inventory WHERE DQ_Is_Valid = 1 AND Is_Negative_Quantity = 0 QUALIFY row_number() OVER (PARTITION BY Product_SKU, Store_ID ORDER BY stg_inventory.Snapshot_Date DESC NULLS LAST, {LATEST}) = 1",
    "header_links": "SELECT Transaction_ID, CAST(1 AS BIGINT) AS Store_Exists, (Is_Walk_In = 1 OR Customer_ID IN (SELECT Customer_ID FROM customers))::BIGINT AS Customer_Exists FROM headers",
    "fk_existence_flags": """SELECT Transaction_Line_ID, (Transaction_ID IN (SELECT Transaction_ID FROM headers))::BIGINT AS Transaction_Exists,
  (Product_SKU IN (SELECT Product_SKU FROM products))::BIGINT AS Product_Exists, (Store_ID IN (SELECT Store_ID FROM stores))::BIGINT AS Store_Exists,
  (Promotion_ID IS NULL OR Promotion_ID IN (SELECT Promotion_ID FROM promotions))::BIGINT AS Promotion_Exists FROM lines""",
    "enforced_lines": f"""SELECT {out('Transaction_Line_ID', 'Transaction_ID', 'm:Line_Sales_Amount')} FROM lines WHERE Transaction_ID IN (SELECT Transaction_ID FROM headers)
  AND Product_SKU IN (SELECT Product_SKU FROM products) AND Store_ID IN (SELECT Store_ID FROM stores)
  AND (Promotion_ID IS NULL OR Promotion_ID IN (SELECT Promotion_ID FROM promotions))""",
    "dq_scores": "SELECT CAST(DQ_Score AS BIGINT) AS DQ_Score, count(*) AS Row_Count, 'lines' AS Entity FROM lines GROUP BY 1 UNION ALL SELECT CAST(DQ_Score AS BIGINT), count(*), 'header' FROM headers GROUP BY 1",
    "fact_sales": f"SELECT {out(*_SALES_OUT)} FROM sales",
    "fact_inventory": f"SELECT {out('Inventory_ID', 'Product_SKU', 'Store_ID', 'd:Snapshot_Date', 'n:Quantity_On_Hand', 'n:Reorder_Level', 'n:Reorder_Quantity_Needed', 'n:Is_Below_Reorder_Level', 'n:Is_Outlier_Quantity', 'n:DQ_Score')} FROM stock",
    "dim_product": dimension("products", "Product_Key", "Product_SKU", "Product_SKU", ("Product_SKU", "Product_Name", "Category", "Sub_Category", "m:Price", "m:Cost_Price", "Supplier_ID", "d:Effective_From", "d:Effective_To", "n:Is_Current", "n:Version_Number", "m:Margin_Amount", "m:Margin_Pct"), f"Price - coalesce(Cost_Price, 0) AS Margin_Amount, {pct('(Price - coalesce(Cost_Price, 0))', 'Price', 2)} AS Margin_Pct"),
    "dim_store": dimension("stores", "Store_Key", "Store_ID", "Store_ID", ("Store_ID", "Store_Name", "City", "Region", "Store_Manager", "m:Store_Area_sqm", "d:Open_Date", "n:Store_Age_Years"), f"year({AS_OF}) - year(Open_Date) AS Store_Age_Years"),
    "dim_customer": dimension("customers", "Customer_Key", "Customer_ID", "Customer_ID", ("Customer_ID", "Full_Name", "Gender", "d:Birthdate", "d:Registration_Date", "Email", "Phone_Number", "City", "Preferred_Channel", "n:Age", "n:Customer_Tenure_Days"), f"year({AS_OF}) - year(Birthdate) AS Age, {AS_OF} - Registration_Date AS Customer_Tenure_Days"),
    "dim_promotion": dimension("promotions", "Promotion_Key", "Promotion_ID", "Promotion_ID", ("Promotion_ID", "Promo_Name", "Promo_Type", "d:Start_Date", "d:End_Date", "m:Promo_Cost", "Eligible_SKUs", "n:Promo_Duration_Days", "n:Is_Active"), f"End_Date - Start_Date AS Promo_Duration_Days, ({AS_OF} BETWEEN Start_Date AND End_Date)::INTEGER AS Is_Active"),
    "dim_weather": dimension("weather", "Weather_Key", "Weather_Date, Store_ID", "CAST(Weather_Date AS VARCHAR) || '|' || Store_ID", ("d:Weather_Date", "Store_ID", "m:Temperature_C", "m:Precipitation_mm", "Weather_Condition", "n:Has_Missing_Temperature", "n:Is_Extreme_Temperature", "n:Is_Rainy"), "(Precipitation_mm > 0)::INTEGER AS Is_Rainy"),
    "bridge_explode": "SELECT Promotion_ID, Product_SKU FROM bridge",
    "bridge_listing": "SELECT p.Promo_Name, q.Product_Name, q.Category FROM bridge AS b JOIN promotions AS p USING (Promotion_ID) JOIN products AS q USING (Product_SKU)",
    "bridge_keys": "SELECT p.Promotion_Key, q.Product_Key FROM bridge AS b JOIN key_promotions AS p USING (Promotion_ID) JOIN key_products AS q USING (Product_SKU)",
    "agg_daily": f"SELECT CAST(s.Transaction_Date AS VARCHAR) AS Transaction_Date, Store_ID, {_measures(_DISCOUNT)} CAST(count(*) AS DOUBLE) AS Line_Count, {_BUYERS}, {_TICKET}, {_SHARE} AS Avg_Margin_Pct FROM sales AS s GROUP BY s.Transaction_Date, Store_ID",
    "agg_monthly": f"SELECT Year, Month, Store_ID, Category, {_measures(_DISCOUNT)} {_BUYERS}, {_TICKET}, {_SHARE} AS Margin_Pct FROM (SELECT s.*, {_YM}, p.Category FROM sales AS s JOIN products AS p USING (Product_SKU)) AS m GROUP BY GROUPING SETS ((Year, Month, Store_ID, Category), (Year, Month, Store_ID), (Year, Month, Category), (Year, Month))",
    "agg_product": f"SELECT Product_SKU, Store_ID, Year, Month, {_measures()} {avg('Unit_Price', 2)} AS Avg_Unit_Price, {_SHARE} AS Margin_Pct FROM (SELECT *, {_YM} FROM sales) AS m GROUP BY GROUPING SETS ((Product_SKU, Store_ID, Year, Month), (Product_SKU, Year, Month))",
    "sales_by_date": f"SELECT CAST(d AS VARCHAR) AS Date_Value, dayname(d) AS Day_Name, {money('Line_Sales_Amount', 'Total_Sales')}, {money('Line_Margin_Amount', 'Total_Margin')}, count(DISTINCT Transaction_ID) AS Transaction_Count FROM sales JOIN days ON Transaction_Date = d GROUP BY d",
    "sales_by_category": f"SELECT Category, Sub_Category, CAST(sum(Quantity) AS BIGINT) AS Units_Sold, {money('Line_Sales_Amount', 'Total_Revenue')}, {avg('CAST(round(Line_Margin_Pct * 100) AS HUGEINT)', 6, 0).replace('(count(CAST', '(100 * count(CAST')} AS Avg_Margin_Pct FROM sales JOIN products USING (Product_SKU) GROUP BY Category, Sub_Category",
    "store_performance": f"SELECT Store_Name, Region, City, {money('Line_Sales_Amount', 'Total_Sales')}, {money('Line_Margin_Amount', 'Total_Margin')}, {_BUYERS}, count(DISTINCT Transaction_ID) AS Transaction_Count FROM sales JOIN stores USING (Store_ID) GROUP BY Store_Name, Region, City",
    "customer_segments": f"SELECT City, Preferred_Channel, count(DISTINCT Customer_ID) AS Customer_Count, {money('Line_Sales_Amount', 'Total_Spent')}, {avg('Line_Sales_Amount', 6)} AS Avg_Transaction_Value FROM sales JOIN customers USING (Customer_ID) WHERE Is_Walk_In = 0 GROUP BY City, Preferred_Channel",
    "promo_effect": f"SELECT Promo_Name, Promo_Type, count(DISTINCT Transaction_ID) AS Transaction_Count, {money('Line_Sales_Amount', 'Promo_Sales')}, {money('Discount_Amount', 'Total_Discount')}, {money('Line_Margin_Amount', 'Net_Margin')} FROM sales JOIN promotions USING (Promotion_ID) WHERE Has_Promotion = 1 GROUP BY Promo_Name, Promo_Type",
    "weather_impact": f"SELECT Weather_Condition, CAST(w.Temperature_C AS DOUBLE) AS Temperature_C, count(DISTINCT Transaction_ID) AS Transaction_Count, {money('Line_Sales_Amount', 'Total_Sales')}, {avg('Line_Sales_Amount', 6)} AS Avg_Line_Value FROM sales AS s JOIN weather AS w ON s.Transaction_Date = w.Weather_Date AND s.Store_ID = w.Store_ID JOIN days ON Transaction_Date = d WHERE year(d) = 1998 GROUP BY Weather_Condition, w.Temperature_C",
    "returns_by_month": f"SELECT strftime(d, '%Y-%m') AS Year_Month, Category, count(*) AS Return_Count, {money('Line_Sales_Amount', 'Return_Amount')}, CAST(sum(Quantity) AS BIGINT) AS Return_Quantity FROM sales JOIN days ON Transaction_Date = d JOIN products USING (Product_SKU) WHERE Is_Return = 1 GROUP BY 1, 2",
    "inventory_by_store": "SELECT Store_ID, CAST(sum(Quantity_On_Hand) AS BIGINT) AS Total_Inventory FROM stock GROUP BY Store_ID",
    "inventory_reorder": f"SELECT {out('Product_SKU', 'Store_ID', 'n:Reorder_Quantity_Needed')} FROM stock WHERE Is_Below_Reorder_Level = 1",
    "inventory_trend": f"SELECT {out('d:Snapshot_Date', 'Product_SKU', 'Store_ID', 'n:Quantity_On_Hand', 'n:Previous_Quantity')} FROM (SELECT *, lag(Quantity_On_Hand) OVER (PARTITION BY Product_SKU, Store_ID ORDER BY Snapshot_Date) AS Previous_Quantity FROM daily_stock) AS g",
    "inventory_star": "SELECT strftime(d, '%Y-%m') AS Year_Month, Store_Name, Category, CAST(sum(Quantity_On_Hand) AS BIGINT) AS Total_Inventory, CAST(sum(Reorder_Quantity_Needed) AS BIGINT) AS Total_Reorder_Needed FROM daily_stock JOIN stock_days ON Snapshot_Date = d JOIN stores USING (Store_ID) JOIN products USING (Product_SKU) GROUP BY 1, 2, 3",
    "null_unique_accepted_expr_checks": " UNION ALL ".join(
        checks_sql(
            "lines", "lines",
            nulls("Transaction_Line_ID", "Transaction_ID", "Line_Number", "Product_SKU", "Store_ID", "Quantity", "Unit_Price", "Cost_Price", "Line_Sales_Amount", *_TAIL)
            + _STAMPS + _ALWAYS
            + [("accepted_values(Is_Return)", "Is_Return NOT IN (0, 1)"), rule("Line_Number > 0"), rule("Quantity <> 0"), rule("Unit_Price > 0"), rule("Cost_Price >= 0")],
            [("Transaction_Line_ID", "Transaction_Line_ID", "true")],
        )
        + checks_sql(
            "products", "products",
            nulls("Product_SKU", "Product_Name", "Category", "Price", "Supplier_ID", "Effective_From", *_TAIL)
            + _STAMPS + _ALWAYS
            + [
                ("accepted_values(Category)", "Category NOT IN ('Food', 'Clothing', 'Beverages', 'Home', 'Electronics')"),
                ("accepted_values(Has_Price_Issue)", "Has_Price_Issue NOT IN (0, 1)"),
                rule("Price > 0"), rule("Cost_Price IS NULL OR Cost_Price >= 0"), rule("Effective_To IS NULL OR Effective_To >= Effective_From"),
            ],
            [("Product_SKU where Is_Current = 1", "Product_SKU", "Is_Current = 1")],
        )
    ),
    "constraint_violations": " UNION ALL ".join(
        checks_sql(
            "lines", "stg_lines",
            nulls("Quantity", "Unit_Price", "Cost_Price", "Promotion_ID")
            + [rule("Quantity <> 0"), rule("Cost_Price <= Unit_Price"), rule("Discount_Amount IS NULL OR Discount_Amount >= 0")],
            [("Transaction_Line_ID", "Transaction_Line_ID", "Transaction_Line_ID IS NOT NULL"), ("Transaction_Line_ID where DQ_Is_Valid = 1", "Transaction_Line_ID", "DQ_Is_Valid = 1")],
        )
        + checks_sql(
            "header", "stg_header",
            nulls("Transaction_Date", "Customer_ID", "Total_Amount")
            + [("accepted_values(Payment_Method)", f"Payment_Method NOT IN {_PAY}"), rule("Total_Amount >= 0"), rule("Line_Count > 0")],
            [("Transaction_ID", "Transaction_ID", "Transaction_ID IS NOT NULL")],
        )
    ),
    "raw_counts": " UNION ALL ".join(f"SELECT '{e}' AS table_name, count(*) AS row_count FROM raw_{e}" for e in _TABLES),
    "reconcile_counts": f"SELECT Table_Name, CAST(Raw_Count AS BIGINT) AS Raw_Count, Staging_Count, CASE WHEN Raw_Count = Staging_Count THEN 'MATCH' ELSE 'MISMATCH' END AS Match_Status, Valid_Count, {share('Valid_Count', 'Staging_Count')} AS Valid_Pct FROM reconciled",
    "quality_status": f"SELECT CAST(a AS BIGINT) AS Total_Raw_Rows, CAST(b AS BIGINT) AS Total_Staging_Rows, CAST(v AS BIGINT) AS Total_Valid_Rows, {share('v', 'b')} AS Overall_Valid_Pct, CAST(b - v AS BIGINT) AS Total_Invalid_Rows, CASE WHEN v * 100.0 / b >= 95 THEN 'EXCELLENT' WHEN v * 100.0 / b >= 85 THEN 'GOOD' ELSE 'NEEDS ATTENTION' END AS Status FROM (SELECT sum(Raw_Count) AS a, sum(Staging_Count) AS b, sum(Valid_Count) AS v FROM reconciled) AS t",
    "scorecard": " UNION ALL ".join(
        f"SELECT '{t}' AS Table_Name, '{label}' AS Metric, CAST({n} AS BIGINT) AS Count, {share(n, 'count(*)')} AS Pct FROM stg_{_TABLES[t]}"
        for t, label, n in (
            ("pos_transactions_header", "Walk-In Customers", "sum(Is_Walk_In)"),
            ("pos_transactions_header", "Has Discount", "sum(Has_Discount)"),
            ("pos_transactions_header", "Invalid Payment Method", "sum(1 - DQ_Payment_Method_Valid)"),
            ("pos_transactions_lines", "Negative Quantities (Returns)", "sum(Is_Negative_Quantity)"),
            ("pos_transactions_lines", "Has Discount", "sum(Has_Discount)"),
            ("pos_transactions_lines", "Has Promotion", "sum(Has_Promotion)"),
            ("pos_transactions_lines", "Pricing Issues (Cost > Price)", "sum(Has_Price_Issue)"),
            ("erp_products", "Pricing Issues (Cost > Price)", "sum(Has_Price_Issue)"),
            ("erp_products", "Missing Category", "sum(1 - DQ_Category_Valid)"),
            ("erp_stores", "Multiple Managers", "sum(Has_Multiple_Managers)"),
            ("erp_inventory", "Negative Quantities", "sum(Is_Negative_Quantity)"),
            ("erp_inventory", "Outlier Quantities (>10K)", "sum(Is_Outlier_Quantity)"),
            ("erp_inventory", "Below Reorder Level", "sum(Is_Below_Reorder_Level)"),
            ("crm_customers", "Missing Email", "sum(Has_Missing_Email)"),
            ("crm_customers", "Missing Phone", "sum(Has_Missing_Phone)"),
            ("crm_customers", "Invalid Gender", "sum(1 - DQ_Gender_Valid)"),
            ("mkt_promotions", "Invalid Date Range (End < Start)", "sum(Has_Invalid_Date_Range)"),
            ("mkt_promotions", "Multiple SKUs", "sum(Has_Multiple_SKUs)"),
            ("api_weather", "Missing Temperature", "sum(Has_Missing_Temperature)"),
            ("api_weather", "Extreme Temperatures", "sum(Is_Extreme_Temperature)"),
        )
    ),
    "coverage": " UNION ALL ".join(
        f"SELECT '{label}' AS Dataset, CAST(min({a}) AS VARCHAR) AS Start_Date, CAST(max({z}) AS VARCHAR) AS End_Date, CAST(max({z}) - min({a}) + 1 AS BIGINT) AS Total_Days FROM {t} AS c WHERE DQ_Is_Valid = 1"
        for label, t, a, z in (
            ("Transactions", "stg_header", "Transaction_Date", "Transaction_Date"),
            ("Weather", "stg_weather", "Weather_Date", "Weather_Date"),
            ("Inventory", "stg_inventory", "Snapshot_Date", "Snapshot_Date"),
            ("Promotions", "stg_promotions", "c.Start_Date", "c.End_Date"),
        )
    ),
    "business_sales": f"SELECT count(DISTINCT Transaction_ID) AS Total_Transactions, {money('Total_Amount', 'Total_Sales')}, {avg('Total_Amount', 2)} AS Avg_Transaction_Value, {money('coalesce(Total_Discount, 0)', 'Total_Discounts')} FROM stg_header WHERE DQ_Is_Valid = 1",
    "business_products": f"SELECT count(*) AS Total_Products, count(DISTINCT Category) AS Unique_Categories, count(DISTINCT Sub_Category) AS Unique_SubCategories, {avg('Price', 2)} AS Avg_Price FROM stg_products WHERE DQ_Is_Valid = 1",
    "business_stores": f"SELECT count(*) AS Total_Stores, count(DISTINCT City) AS Unique_Cities, count(DISTINCT Region) AS Unique_Regions, {avg('Store_Area_sqm', 2)} AS Avg_Store_Area_sqm FROM stg_stores WHERE DQ_Is_Valid = 1",
    "business_customers": f"SELECT count(*) AS Total_Customers, count(DISTINCT City) AS Unique_Cities, CAST(sum(year({AS_OF}) - year(Birthdate)) // count(*) AS BIGINT) AS Avg_Age FROM stg_customers WHERE DQ_Is_Valid = 1 AND Birthdate IS NOT NULL",
    "fact_row_gate": "SELECT count(*) AS Fact_Rows, (count(*) >= 100)::BIGINT AS Passed FROM sales",
    "duplicate_keys_top5": "SELECT Transaction_Line_ID, count(*) AS Duplicate_Count FROM stg_lines GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "distinct_typos": "SELECT DISTINCT Category FROM stg_products WHERE Category LIKE '%ELEC%' OR Category LIKE '%BEVER%'",
    "store_mismatch": "SELECT * FROM mismatch ORDER BY Transaction_ID, Header_Store_ID, Line_Store_ID LIMIT 5",
    "store_mismatch_totals": "SELECT Header_Store_ID, count(*) AS Lines FROM mismatch GROUP BY 1",
    "overlap_pairs": "SELECT count(*) AS Overlapping_Promo_Pairs FROM stg_promotions AS a JOIN stg_promotions AS b ON a.Promotion_ID < b.Promotion_ID AND a.Start_Date <= b.End_Date AND b.Start_Date <= a.End_Date WHERE a.DQ_Is_Valid = 1 AND b.DQ_Is_Valid = 1",
    "overlap_same_sku": f"""SELECT a.Product_SKU, a.Promotion_ID, count(*) AS Overlapping_Others FROM runs AS a JOIN runs AS b
  ON a.Product_SKU = b.Product_SKU AND a.Promotion_ID <> b.Promotion_ID AND a.Start_Date <= b.End_Date AND b.Start_Date <= a.End_Date GROUP BY 1, 2""",
    "weather_decode": f"SELECT event_id, event_id % 100 AS code, {decoded('event_id % 100')} AS Weather_Condition FROM events",
    "payload_flatten": f"SELECT event_id, Store_ID, Weather_Date, Temperature_C, Precipitation_mm, {decoded('code')} AS Weather_Condition FROM flat",
    "weather_load_profile": "SELECT count(*) AS Total_Records, min(Weather_Date) AS First_Date, max(Weather_Date) AS Last_Date, count(DISTINCT Store_ID) AS Stores_Covered, count(*) FILTER (WHERE Temperature_C IS NULL) AS Missing_Temperature FROM flat",
    "city_coordinates": f"SELECT Raw_ID, City, {located(1, rules.DEFAULT_LATITUDE)} AS Latitude, {located(2, rules.DEFAULT_LONGITUDE)} AS Longitude FROM raw_erp_stores",
    "scd2_history": f"""SELECT Product_SKU, CAST(Price AS DOUBLE) AS Price, CAST(Cost_Price AS DOUBLE) AS Cost_Price, CAST(Last_Updated AS VARCHAR) AS Effective_From,
  CAST(CAST(lead(Last_Updated) OVER w - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS Effective_To, (lead(Last_Updated) OVER w IS NULL)::BIGINT AS Is_Current,
  row_number() OVER w AS Version_Number FROM changes WINDOW w AS (PARTITION BY Product_SKU ORDER BY Last_Updated)""",
    "masked_contacts": "SELECT Customer_ID, CASE WHEN Email = 'N/A' THEN Email ELSE sha256('not a secret' || sha256('not a secret' || Email)) END AS Email, CASE WHEN Phone_Number = 'N/A' THEN Phone_Number ELSE sha256('not a secret' || sha256('not a secret' || Phone_Number)) END AS Phone_Number, CAST(Has_Email AS BIGINT) AS Has_Email, CAST(Has_Phone AS BIGINT) AS Has_Phone FROM customers",
    "header_vs_lines": """SELECT Transaction_ID, CAST(Total_Amount AS DOUBLE) AS Total_Amount, CAST(t AS DOUBLE) AS Lines_Total, coalesce(n, 0) AS Lines_Found,
  CAST(Total_Amount - coalesce(t, 0) AS DOUBLE) AS Gap, (abs(Total_Amount - coalesce(t, 0)) <= 0.01)::BIGINT AS Totals_Match
FROM headers LEFT JOIN (SELECT Transaction_ID, sum(Line_Sales_Amount) AS t, count(*) AS n FROM lines GROUP BY 1) AS s USING (Transaction_ID)""",
}

CTE["runs"] = (
    f"SELECT DISTINCT Promotion_ID, Start_Date, End_Date, {key('s')} AS Product_SKU FROM (SELECT Promotion_ID, Start_Date, End_Date, "
    f"unnest(string_split(Eligible_SKUs, '|')) AS s FROM promotions WHERE Eligible_SKUs <> 'N/A') AS u WHERE {key('s')} <> ''"
)
CTE["by_day"] = (
    f"SELECT * FROM stg_products WHERE DQ_Is_Valid = 1 AND Last_Updated IS NOT NULL QUALIFY row_number() OVER "
    f"(PARTITION BY Product_SKU, Last_Updated ORDER BY {LATEST}) = 1"
)
CTE["changes"] = (
    "SELECT * FROM by_day WINDOW v AS (PARTITION BY Product_SKU ORDER BY Last_Updated) QUALIFY row_number() OVER v = 1 "
    "OR Price IS DISTINCT FROM lag(Price) OVER v OR Cost_Price IS DISTINCT FROM lag(Cost_Price) OVER v"
)

CTE["changed"] = "SELECT DISTINCT Transaction_ID FROM stg_lines WHERE Load_Timestamp >= TIMESTAMP '2001-11-04 00:00:00' AND Transaction_ID IS NOT NULL"
CTE["months"] = (
    "SELECT DISTINCT year(Transaction_Date) * 100 + month(Transaction_Date) AS Sales_Month FROM (SELECT Transaction_Date FROM headers "
    "WHERE Transaction_ID IN (SELECT Transaction_ID FROM changed) UNION ALL SELECT Transaction_Date FROM sales "
    "WHERE Transaction_ID IN (SELECT Transaction_ID FROM changed)) AS x"
)
CTE["marked"] = """
SELECT Raw_ID, Transaction_ID, list_filter([
  CASE WHEN Transaction_Date IS NULL THEN 'not_null(Transaction_Date)' END,
  CASE WHEN Total_Amount IS NULL THEN 'not_null(Total_Amount)' END,
  CASE WHEN Payment_Method NOT IN ('CASH', 'CARD', 'ONLINE', 'CREDIT', 'DEBIT') THEN 'accepted_values(Payment_Method)' END,
  CASE WHEN Total_Amount <= 0 THEN 'expression_is_true(Total_Amount > 0)' END,
  CASE WHEN Line_Count <= 0 THEN 'expression_is_true(Line_Count > 0)' END], lambda x: x IS NOT NULL) AS v FROM stg_header"""
CTE["again"] = (
    "SELECT Raw_ID FROM marked WHERE len(v) = 0 AND Transaction_ID IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY Transaction_ID ORDER BY Raw_ID DESC) > 1"
)
ORACLE_BODIES |= {
    "merged_history": ORACLE_BODIES["scd2_history"],
    "lasting_customer_keys": "SELECT Customer_ID, row_number() OVER (ORDER BY City <> 'Dubai', substr(md5(Customer_ID), 1, 3), Customer_ID) AS Customer_Key FROM customers",
    "enforced_rows": "SELECT Raw_ID, Transaction_ID, CASE WHEN Raw_ID IN (SELECT Raw_ID FROM again) THEN 'unique(Transaction_ID)' ELSE array_to_string(v, '; ') END AS Violated_Rules FROM marked",
    "touched_months": "SELECT CAST(Sales_Month AS BIGINT) AS Sales_Month FROM months",
    "rebuilt_months": "SELECT *, CAST(substr(Transaction_Date, 1, 4) || substr(Transaction_Date, 6, 2) AS BIGINT) AS Sales_Month FROM ("
    + ORACLE_BODIES["agg_daily"].replace("FROM sales AS s", "FROM sales AS s WHERE year(s.Transaction_Date) * 100 + month(s.Transaction_Date) IN (SELECT Sales_Month FROM months)")
    + ") AS d",
}

ORACLE = {name: statement(body) for name, body in ORACLE_BODIES.items()}
