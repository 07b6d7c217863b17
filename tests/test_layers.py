import datetime as dt
from decimal import Decimal as N

import pytest
from conftest import LOADED, rows_by

from shelfmark.functions import rules
from shelfmark.plans import aggregates, analytics, gold, silver
from shelfmark.plans import staging as stg

D = dt.date

HEADER = dict(
    Transaction_ID=" t1", Transaction_Date="1/5/2024", Transaction_TS="1/5/2024 9:30", Store_ID="s1", Customer_ID="c1",
    Payment_Method="cash", Total_Amount="$100.00", Total_Discount="10", Line_Count="2",
)
LINE = dict(
    Transaction_Line_ID="l1", Transaction_ID="T1", Line_Number="1", Product_SKU="p1", Store_ID="S1", Quantity="2",
    Unit_Price="£10.00", Cost_Price="5", Discount_Amount=None, Line_Sales_Amount="15", Promotion_ID="NA",
)
PRODUCT = dict(
    Product_SKU="p1", Product_Name="Tea", Category="BEVERAGE", Sub_Category="SNAKS", Price="10", Cost_Price="6",
    Supplier_ID="sup1", Last_Updated="2024-01-01",
)
STORE = dict(
    Store_ID="s1 ", Store_Name="First", City="LOS ANGELES", Region="east", Store_Manager="Liam Brown; David Smith",
    Store_Area_sqm="1,200.50", Open_Date="2010-05-01",
)
STOCK = dict(Inventory_ID="i1", Product_SKU="p1", Store_ID="s1", Snapshot_Date="2024-01-01", Quantity_On_Hand="5", Reorder_Level="9")
CUSTOMER = dict(
    Customer_ID="c1", Full_Name="aHMED  hassan", Gender="m", Birthdate="1990-02-03", Registration_Date="2020-01-01",
    Email="A@B.com", Phone_Number="+20100000000", City="cairo", Preferred_Channel="in store",
)
PROMOTION = dict(
    Promotion_ID="pr1", Promo_Name="Promo", Promo_Type="25% off", Start_Date="2024-01-01", End_Date="2024-01-31",
    Promo_Cost="$1,000", Eligible_SKUs="p1|P2||p1|P9",
)
WEATHER = dict(
    Weather_Date="2024-01-05", Retail_Location_ID="loc_s1", Temperature_C="46.5", Precipitation_mm="0.5", Weather_Condition="Dense Drizzle",
)

SAMPLE = {
    "pos_transactions_header": HEADER, "pos_transactions_lines": LINE, "erp_products": PRODUCT, "erp_stores": STORE,
    "erp_inventory": STOCK, "crm_customers": CUSTOMER, "mkt_promotions": PROMOTION, "api_weather": WEATHER,
}


@pytest.fixture
def staged(raw, clock):
    def build(entity, *changes):
        rows = [{**SAMPLE[entity], **c} for c in (changes or ({},))]
        return stg.STAGERS[entity](raw(entity, rows), clock)

    return build


def test_weights_sum_to_100(clock):
    sets = [
        stg.header_rules(), stg.lines_rules(), stg.products_rules(), stg.stores_rules(), stg.inventory_rules(),
        stg.customers_rules(clock), stg.promotions_rules(), stg.weather_rules(),
    ]
    assert [sum(r.weight for r in rules) for rules in sets] == [100] * 8


@pytest.mark.parametrize("entity", list(SAMPLE))
def test_sample_row_is_valid(staged, entity):
    assert staged(entity).first()["DQ_Is_Valid"] == 1


def test_header_flags(staged):
    got = rows_by(
        staged(
            "pos_transactions_header", {}, {"Customer_ID": "n/a"}, {"Payment_Method": "cheque"}, {"Transaction_TS": "1/6/2024 9:30"},
            {"Total_Discount": "500"}, {"Line_Count": "0"}, {"Total_Amount": "abc", "Total_Discount": "1"}, {"Transaction_Date": "x"},
            {"Transaction_ID": "  "},
        ),
        "Raw_ID",
    )
    assert [got[i]["DQ_Is_Valid"] for i in range(1, 10)] == [1, 1, 0, 0, 1, 0, 0, 0, 0]
    assert got[1]["Transaction_ID"] == "T1" and got[1]["Has_Discount"] == 1 and got[1]["Is_Walk_In"] == 0
    assert got[2]["Customer_ID"] is None and got[2]["Is_Walk_In"] == 1 and got[2]["DQ_Customer_ID_Valid"] == 1
    assert got[4]["DQ_Timestamp_Consistent"] == 0
    assert got[5]["DQ_Total_Discount_Valid"] == 0 and got[7]["DQ_Total_Discount_Valid"] == 0


def test_line_flags(staged):
    got = rows_by(
        staged(
            "pos_transactions_lines", {}, {"Quantity": "-2"}, {"Quantity": "0"}, {"Quantity": "101"}, {"Cost_Price": "11"},
            {"Promotion_ID": "pr1", "Discount_Amount": "€1"}, {"Line_Sales_Amount": ""}, {"Cost_Price": None},
        ),
        "Raw_ID",
    )
    assert [got[i]["DQ_Is_Valid"] for i in range(1, 9)] == [1, 1, 0, 1, 1, 1, 0, 0]
    assert got[2]["Is_Negative_Quantity"] == 1 and got[4]["Is_Outlier_Quantity"] == 1 and got[5]["Has_Price_Issue"] == 1
    assert (got[6]["Has_Promotion"], got[6]["Has_Discount"], got[1]["Has_Promotion"]) == (1, 1, 0)


def test_other_flags(staged):
    people = rows_by(
        staged("crm_customers", {"Birthdate": "2090-01-01"}, {"Birthdate": "1850-01-01"}, {"Gender": "other"}, {"Email": "x", "Phone_Number": "123"}, {"Registration_Date": None}),
        "Raw_ID",
    )
    assert [people[i]["DQ_Birthdate_Valid"] for i in (1, 2, 3)] == [0, 0, 1]
    assert people[3]["DQ_Gender_Valid"] == 0 and people[4]["DQ_Email_Valid"] == people[4]["DQ_Phone_Valid"] == 0
    assert people[5]["DQ_Is_Valid"] == 0
    sky = rows_by(staged("api_weather", {}, {"Temperature_C": "1000.00"}, {"Temperature_C": "-21"}, {"Weather_Condition": ""}), "Raw_ID")
    assert sky[1]["Is_Extreme_Temperature"] == sky[3]["Is_Extreme_Temperature"] == 1
    assert sky[2]["Has_Missing_Temperature"] == 1 and sky[2]["DQ_Is_Valid"] == 1 and sky[4]["DQ_Is_Valid"] == 0
    offers = rows_by(staged("mkt_promotions", {"End_Date": "2023-12-31"}, {"Eligible_SKUs": "p1"}), "Raw_ID")
    assert offers[1]["Has_Invalid_Date_Range"] == 1 and offers[1]["DQ_Is_Valid"] == 0
    assert offers[2]["Has_Multiple_SKUs"] == 0
    stock = rows_by(staged("erp_inventory", {"Quantity_On_Hand": "10001"}, {"Quantity_On_Hand": "-1"}), "Raw_ID")
    assert stock[1]["Is_Outlier_Quantity"] == 1 and stock[2]["Is_Negative_Quantity"] == 1 and stock[1]["Is_Below_Reorder_Level"] == 0


def test_stores(staged, clock):
    got = rows_by(
        silver.clean_stores(staged("erp_stores", {}, {"Store_ID": "S2", "Open_Date": ""}, {"Store_ID": "s3", "Store_Manager": "NA"}), clock),
        "Store_ID",
    )
    assert set(got) == {"S1", "S3"}
    assert (got["S1"]["City"], got["S1"]["Region"], got["S1"]["Store_Manager"], got["S1"]["DQ_Score"]) == ("Los angeles", "EAST", "Liam Brown", 100)
    assert got["S3"]["Store_Manager"] == "NA"


def test_an_invalid_later_row_does_not_hide_a_valid_one(staged, clock):
    later = LOADED + dt.timedelta(days=1)
    got = silver.clean_stores(staged("erp_stores", {"City": "giza"}, {"Store_Name": " ", "Load_Timestamp": later}), clock).collect()
    assert [r["City"] for r in got] == ["Giza"]


def test_same_timestamp_keeps_the_later_row(staged, clock):
    got = silver.clean_products(staged("erp_products", {"Price": "1"}, {"Price": "2"}), clock).collect()
    assert [r["Price"] for r in got] == [N("2.00")]


def test_products(staged, clock):
    got = rows_by(
        silver.clean_products(
            staged("erp_products", {"Last_Updated": "2024-03-01"}, {"Price": "11"}, {"Product_SKU": "P2", "Last_Updated": None, "Cost_Price": None}), clock
        ),
        "Product_SKU",
    )
    assert (got["P1"]["Price"], got["P1"]["Effective_From"], got["P1"]["Category"], got["P1"]["Sub_Category"]) == (N("10.00"), D(2024, 3, 1), "Beverages", "Snacks")
    assert (got["P2"]["Effective_From"], got["P2"]["Effective_To"], got["P2"]["Has_Cost_Price"], got["P2"]["DQ_Score"]) == (clock.as_of, None, 0, 90)


def test_customers(staged, clock):
    given = staged("crm_customers", {}, {"Customer_ID": " C1", "Phone_Number": "0100", "Email": None, "City": " "}, {"Customer_ID": "c2", "Gender": "x"})
    got = rows_by(silver.clean_customers(given, clock), "Customer_ID")
    assert set(got) == {"C1", "C2"}
    assert (got["C1"]["Phone_Number"], got["C1"]["Email"], got["C1"]["Has_Email"], got["C1"]["City"]) == ("N/A", "N/A", 0, "N/A")
    assert (got["C2"]["Full_Name"], got["C2"]["Gender"], got["C2"]["Email"], got["C2"]["Preferred_Channel"]) == ("Ahmed  Hassan", "N/A", "A@B.COM", "IN-STORE")
    hidden = rows_by(silver.clean_customers(given, clock, mask_secret="s3"), "Customer_ID")
    assert hidden["C1"]["Email"] == "N/A" and len(hidden["C2"]["Email"]) == 64 and hidden["C2"]["Has_Email"] == 1


def test_promotions_and_bridge(staged, clock):
    offers = silver.clean_promotions(
        staged("mkt_promotions", {}, {"Promotion_ID": "pr2", "Eligible_SKUs": None}, {"Promotion_ID": "pr3", "End_Date": "2023-01-01"}, {"Promotion_ID": "pr4", "Promo_Cost": "free"}),
        clock,
    )
    got = rows_by(offers, "Promotion_ID")
    assert set(got) == {"PR1", "PR2"} and got["PR1"]["Promo_Type"] == "DISCOUNT" and got["PR2"]["Eligible_SKUs"] == "N/A"
    products = silver.clean_products(staged("erp_products", {}, {"Product_SKU": "p2"}), clock)
    bridge = gold.bridge_promotion_product(offers, products, clock)
    assert sorted(tuple(r)[:2] for r in bridge.collect()) == [("PR1", "P1"), ("PR1", "P2")]
    listed = analytics.promotion_products(bridge, gold.dim_promotion(offers, clock), gold.dim_product(products, clock))
    assert [tuple(r) for r in listed.collect()] == [("Promo", "Tea", "Beverages")] * 2


def test_weather(staged, clock):
    got = silver.clean_weather(staged("api_weather", {}, {"Retail_Location_ID": "S1", "Temperature_C": None}, {"Precipitation_mm": "x", "Weather_Date": "2024-01-06"}), clock).collect()
    assert [(r["Store_ID"], r["Weather_Condition"], r["Has_Missing_Temperature"], r["DQ_Score"]) for r in got] == [("S1", "RAINY", 1, 80)]


def test_inventory(staged, clock):
    stock = staged(
        "erp_inventory", {}, {"Snapshot_Date": "2024-02-01", "Quantity_On_Hand": "51", "Inventory_ID": "i2"}, {"Snapshot_Date": "2024-03-01", "Quantity_On_Hand": "-1"},
        {"Product_SKU": "P9"}, {"Store_ID": "S9"},
    )
    clean = silver.clean_inventory(stock, staged("erp_products", {}, {}), staged("erp_stores", {}, {}), clock)
    got = gold.fact_inventory_snapshot(clean, clock).collect()
    assert [(r["Inventory_ID"], r["Snapshot_Date"], r["Reorder_Quantity_Needed"]) for r in got] == [("I2", D(2024, 2, 1), 0)]


@pytest.fixture
def star(staged, clock):
    stores = silver.clean_stores(staged("erp_stores", {}, {"Store_ID": "s2", "Store_Name": "Second"}), clock)
    customers = silver.clean_customers(staged("crm_customers"), clock)
    products = silver.clean_products(staged("erp_products", {}, {"Product_SKU": "p2", "Category": "FUD"}), clock)
    header = staged(
        "pos_transactions_header", {}, {"Transaction_ID": "t2", "Customer_ID": None}, {"Transaction_ID": "t3", "Store_ID": "s9"},
        {"Transaction_ID": "t4", "Customer_ID": "c9", "Transaction_Date": "2024-02-01", "Transaction_TS": "2024-02-01 08:00:00"},
    )
    headers = silver.clean_header(header, stores, clock, customers, keep_links=True)
    lines = silver.clean_lines(
        staged(
            "pos_transactions_lines", {}, {"Transaction_Line_ID": "l2", "Product_SKU": "p2", "Store_ID": "s2"},
            {"Transaction_Line_ID": "l3", "Transaction_ID": "t2", "Quantity": "-2", "Line_Sales_Amount": "-15"},
            {"Transaction_Line_ID": "l4", "Transaction_ID": "t3"}, {"Transaction_Line_ID": "l5", "Transaction_ID": "t8"},
            {"Transaction_Line_ID": "l6", "Transaction_ID": "t4", "Promotion_ID": "pr9"},
        ),
        clock,
    )
    return stores, customers, products, headers, lines


def test_header_links(star):
    got = rows_by(star[3], "Transaction_ID")
    assert set(got) == {"T1", "T2", "T4"}
    assert [got[t]["Customer_Exists"] for t in ("T1", "T2", "T4")] == [1, 1, 0]
    assert got["T2"]["Customer_ID"] == "N/A"


def test_line_links(star, staged, clock):
    stores, _, products, headers, lines = star
    offers = silver.clean_promotions(staged("mkt_promotions"), clock)
    linked = silver.line_links(lines, headers, products, stores, offers)
    got = rows_by(linked, "Transaction_Line_ID")
    assert [got[x]["Transaction_Exists"] for x in ("L1", "L4", "L5")] == [1, 0, 0]
    assert (got["L1"]["Promotion_Exists"], got["L6"]["Promotion_Exists"]) == (1, 0)
    assert {r["Transaction_Line_ID"] for r in silver.enforce_links(linked).collect()} == {"L1", "L2", "L3"}


def test_fact_and_questions(star, clock, spark):
    stores, customers, products, headers, lines = star
    fact = gold.fact_sales(lines, headers, clock)
    got = rows_by(fact, "Transaction_Line_ID")
    assert set(got) == {"L1", "L2", "L3", "L6"}
    first, back = got["L1"], got["L3"]
    assert (first["Line_Cost_Amount"], first["Line_Margin_Amount"], first["Line_Margin_Pct"], first["Discount_Amount"]) == (N(10), N(5), N("50.00"), N("5.00"))
    assert (back["Is_Return"], back["Line_Cost_Amount"], back["Line_Margin_Pct"]) == (1, N(-10), N("0.00"))
    assert first["Promotion_ID"] == "N/A" and first["Created_TS"] == clock.run_ts and first["DQ_Score"] == 100

    daily = rows_by(aggregates.sales_daily(fact), "Store_ID")
    dim_store, dim_product = gold.dim_store(stores, clock), gold.dim_product(products, clock)
    per_day = {(r["Transaction_Date"], r["Store_ID"]): r for r in aggregates.sales_daily(fact).collect()}
    one = per_day[(D(2024, 1, 5), "S1")]
    assert (one["Total_Sales_Amount"], one["Transaction_Count"], one["Line_Count"], one["Unique_Customers"], one["Units_Sold"]) == (N(0), 2, 2, 2, 0)
    assert daily["S2"]["Avg_Transaction_Value"] == N("15.00") and daily["S2"]["Avg_Margin_Pct"] == N("33.33")

    monthly = {(r["Month"], r["Store_ID"], r["Category"]): r for r in aggregates.sales_monthly(fact, dim_product).collect()}
    assert monthly[(1, None, None)]["Transaction_Count"] == 2 and monthly[(1, None, None)]["Units_Sold"] == 2
    assert monthly[(1, "S2", "Food")]["Total_Sales_Amount"] == N(15) and (1, "S2", None) in monthly and (1, None, "Food") in monthly

    sold = {(r["Product_SKU"], r["Month"], r["Store_ID"]): r for r in aggregates.product_performance(fact).collect()}
    assert sold[("P1", 1, None)]["Transaction_Count"] == 2 and sold[("P1", 1, None)]["Avg_Unit_Price"] == N("10.00")

    calendar = gold.dim_date(spark, clock)
    by_day = analytics.sales_by_date(fact, calendar).collect()
    assert [(r["Date_Value"], r["Transaction_Count"]) for r in by_day] == [(D(2024, 1, 5), 2), (D(2024, 2, 1), 1)]
    shops = rows_by(analytics.store_performance(fact, dim_store), "Store_Name")
    assert (shops["First"]["Unique_Customers"], shops["First"]["Transaction_Count"], shops["Second"]["Total_Sales"]) == (3, 3, N("15.00"))
    people = analytics.customer_segments(fact, gold.dim_customer(customers, clock)).collect()
    assert [(r["City"], r["Customer_Count"], r["Total_Spent"], r["Avg_Transaction_Value"]) for r in people] == [("Cairo", 1, N("30.00"), N("15.000000"))]
    back = analytics.returns_by_month(fact, calendar, dim_product).collect()
    assert [(r["Year_Month"], r["Category"], r["Return_Count"], r["Return_Amount"], r["Return_Quantity"]) for r in back] == [("2024-01", "Beverages", 1, N("-15.00"), -2)]
    sums = rows_by(analytics.header_against_lines(headers, lines), "Transaction_ID")
    assert sums["T1"]["Lines_Total"] == N("30.00") and sums["T1"]["Gap"] == N("70.00") and sums["T1"]["Totals_Match"] == 0


def test_dimension_columns(staged, clock):
    people = gold.dim_customer(silver.clean_customers(staged("crm_customers", {"Birthdate": "2000-12-31"}), clock), clock).first()
    assert people["Age"] == 25 and people["Customer_Tenure_Days"] == (clock.as_of - D(2020, 1, 1)).days
    offer = gold.dim_promotion(silver.clean_promotions(staged("mkt_promotions"), clock), clock).first()
    assert (offer["Promo_Duration_Days"], offer["Is_Active"]) == (30, 0)
    sky = gold.dim_weather(silver.clean_weather(staged("api_weather"), clock), clock).first()
    assert sky["Is_Rainy"] == 1
    product = gold.dim_product(silver.clean_products(staged("erp_products"), clock), clock).first()
    assert (product["Margin_Amount"], product["Margin_Pct"]) == (N("4.00"), N("40.00"))


def test_rule_lists_name_what_the_plans_produce():
    assert {label for _, label in rules.CATEGORY_PATTERNS} == {"Food", "Clothing", "Beverages", "Home", "Electronics"}
