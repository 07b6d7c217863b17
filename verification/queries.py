"""Every registered query: (spark, sf_dir) -> DataFrame, through the library's plans."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.clock import RunClock
from shelfmark.functions import dates, measures, numbers, rules, text
from shelfmark.operators.checks import VIOLATED, accepted, holds, not_null, run_checks, unique, violations
from shelfmark.operators.dedupe import keep_latest
from shelfmark.operators.history import merge_versions, version_history
from shelfmark.operators.surrogate import dense_key, lasting_key
from shelfmark.plans import aggregates, analytics, contracts, gold, reports, silver
from shelfmark.plans.staging import STAGERS
from shelfmark.plans.warehouse import DIMENSION_KEYS
from shelfmark.session import run_once, stored, tune
from shelfmark.sources import weather as weather_source
from verification import feeds

CLOCK = RunClock.on("2025-01-01")
WEATHER_YEAR = 1998
# lines loaded from then on are the newest loads of the feed
LAST_LINES = "2001-11-04 00:00:00"


def usable_stock():
    return (F.col("DQ_Is_Valid") * (1 - F.col("Is_Negative_Quantity")))


Query = Callable[[SparkSession, str], DataFrame]


class Build:
    """The layers over one driver folder, as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    @cache
    def table(self, name: str) -> DataFrame:
        return feeds.table(self.spark, self.sf_dir, name)

    @cache
    def raw(self, entity: str) -> DataFrame:
        return feeds.raw(self.spark, entity, self.table)

    @cache
    def staged(self, entity: str) -> DataFrame:
        return STAGERS[entity](self.raw(entity), CLOCK)

    def all_raw(self) -> dict[str, DataFrame]:
        return {e: self.raw(e) for e in STAGERS}

    def all_staged(self) -> dict[str, DataFrame]:
        return {e: self.staged(e) for e in STAGERS}

    @cache
    def stores(self) -> DataFrame:
        return silver.clean_stores(self.staged("erp_stores"), CLOCK)

    def customers(self, **options) -> DataFrame:
        return silver.clean_customers(self.staged("crm_customers"), CLOCK, **options)

    @cache
    def products(self) -> DataFrame:
        return silver.clean_products(self.staged("erp_products"), CLOCK)

    @cache
    def promotions(self) -> DataFrame:
        return silver.clean_promotions(self.staged("mkt_promotions"), CLOCK)

    def weather(self) -> DataFrame:
        return silver.clean_weather(self.staged("api_weather"), CLOCK)

    def inventory(self) -> DataFrame:
        return silver.clean_inventory(
            self.staged("erp_inventory"), self.staged("erp_products"), self.staged("erp_stores"), CLOCK
        )

    def headers(self, **options) -> DataFrame:
        return silver.clean_header(self.staged("pos_transactions_header"), self.stores(), CLOCK, **options)

    def lines(self) -> DataFrame:
        return silver.clean_lines(self.staged("pos_transactions_lines"), CLOCK)

    def sales(self) -> DataFrame:
        return gold.fact_sales(self.lines(), self.headers(), CLOCK)

    def stock(self) -> DataFrame:
        return gold.fact_inventory_snapshot(self.inventory(), CLOCK)

    def daily_stock(self) -> DataFrame:
        """The newest usable snapshot of each product, store and day, for trends over days."""
        keys = ["Product_SKU", "Store_ID", "Snapshot_Date"]
        daily = keep_latest(self.staged("erp_inventory"), keys, silver.NEWEST, usable_stock())
        return daily.withColumn(
            "Reorder_Quantity_Needed", measures.reorder_need("Quantity_On_Hand", "Reorder_Level")
        )

    def dates_of(self, table: str, column: str) -> DataFrame:
        """The calendar from the first to the last year of a table's dates."""
        day = F.to_date(column)
        bounds = self.table(table).agg(
            F.trunc(F.min(day), "year").alias("first"),
            F.last_day(F.add_months(F.trunc(F.max(day), "year"), 11)).alias("last"),
        )
        return gold.calendar(bounds, "first", "last")

    def sales_dates(self) -> DataFrame:
        # dates read as day or month first stay inside the same year
        return self.dates_of("orders", "o_orderdate")

    def dim(self, name: str) -> DataFrame:
        plain = {
            "dim_product": lambda: gold.dim_product(self.products(), CLOCK),
            "dim_store": lambda: gold.dim_store(self.stores(), CLOCK),
            "dim_customer": lambda: gold.dim_customer(self.customers(), CLOCK),
            "dim_promotion": lambda: gold.dim_promotion(self.promotions(), CLOCK),
            "dim_weather": lambda: gold.dim_weather(self.weather(), CLOCK),
        }
        return plain[name]()

    def keyed_dim(self, name: str) -> DataFrame:
        return dense_key(self.dim(name), *DIMENSION_KEYS[name])

    def bridge(self) -> DataFrame:
        return gold.bridge_promotion_product(self.promotions(), self.products(), CLOCK)


# whole numbers that can be missing; shown as double, the one type in which both engines'
# data frames hold numbers beside gaps
SPARSE_NUMBERS = frozenset(
    (
        "Phone_Length", "Line_Count", "Quantity_On_Hand", "Reorder_Level", "Age", "Tenure_Days",
        "Duration_Days", "Quantity", "Line_Number", "Previous_Quantity", "Customer_Tenure_Days",
    )
)


def present(df: DataFrame) -> DataFrame:
    """Types both engines print alike: dates and times as text, whole numbers as long, decimals
    as double; the audit stamps are left out."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if name in ("Created_TS", "Updated_TS", "Load_Timestamp"):
            continue
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif name in SPARSE_NUMBERS:
            c = c.cast("double")
        elif kind in ("tinyint", "smallint", "int"):
            c = c.cast("bigint")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        columns.append(c.alias(name))
    return df.select(*columns)


REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Callable[[Build], DataFrame]):
        REGISTRY[name] = lambda spark, sf_dir: present(fn(Build(spark, sf_dir)))
        return fn

    return register


# --- column functions ---------------------------------------------------------------------


@query("clean_keys")
def _(b: Build):
    return b.raw("pos_transactions_header").select(
        "Raw_ID",
        text.key("Transaction_ID").alias("Transaction_ID"),
        text.optional_key("Customer_ID").alias("Customer_ID"),
        text.key("Payment_Method").alias("Payment_Method"),
        F.coalesce(text.optional_key("Customer_ID"), F.lit("N/A")).alias("Customer_Or_NA"),
    )


@query("clean_contacts")
def _(b: Build):
    return b.raw("crm_customers").select(
        "Raw_ID",
        text.bounded("Customer_ID", rules.LONGEST_CUSTOMER_ID).alias("Customer_Prefix"),
        F.trim("City").alias("City_Trimmed"),
        text.blank_to_null("Full_Name").alias("Full_Name"),
        text.lower_text("Email").alias("Email"),
        text.upper_text("Preferred_Channel").alias("Preferred_Channel"),
        text.or_missing("City").alias("City_Or_NA"),
        text.text_length("Phone_Number").alias("Phone_Length"),
    )


@query("parse_currency")
def _(b: Build):
    marks = numbers.LINE_CURRENCY_MARKS
    return b.raw("pos_transactions_lines").select(
        "Raw_ID",
        numbers.to_amount("Unit_Price", marks).alias("Unit_Price"),
        numbers.to_amount("Cost_Price", marks).alias("Cost_Price"),
        numbers.to_optional_amount("Discount_Amount", marks).alias("Discount_Amount"),
        numbers.or_zero(numbers.to_optional_amount("Discount_Amount", marks)).alias("Discount_Or_Zero"),
        numbers.to_amount("Line_Sales_Amount", marks).alias("Line_Sales_Amount"),
    )


@query("parse_header_amounts")
def _(b: Build):
    return b.raw("pos_transactions_header").select(
        "Raw_ID",
        numbers.to_amount("Total_Amount").alias("Total_Amount"),
        numbers.to_optional_amount("Total_Discount").alias("Total_Discount"),
        numbers.to_int("Line_Count").alias("Line_Count"),
    )


@query("safe_casts")
def _(b: Build):
    return b.raw("erp_inventory").select(
        "Raw_ID",
        numbers.to_int("Quantity_On_Hand").alias("Quantity_On_Hand"),
        numbers.to_int("Reorder_Level").alias("Reorder_Level"),
        dates.iso_date("Snapshot_Date").alias("Snapshot_Date"),
    )


@query("safe_weather_casts")
def _(b: Build):
    return b.raw("api_weather").select(
        "Raw_ID",
        dates.iso_date("Weather_Date").alias("Weather_Date"),
        numbers.to_decimal("Temperature_C", "decimal(5,2)").alias("Temperature_C"),
        numbers.to_decimal("Precipitation_mm", "decimal(5,2)").alias("Precipitation_mm"),
    )


@query("parse_mixed_dates")
def _(b: Build):
    parsed = b.raw("pos_transactions_header").select(
        "Raw_ID",
        dates.mixed_date("Transaction_Date").alias("Transaction_Date"),
        dates.mixed_timestamp("Transaction_TS").alias("Transaction_TS"),
    )
    same = F.coalesce(F.to_date("Transaction_TS") == F.col("Transaction_Date"), F.lit(False))
    return parsed.withColumn("Same_Day", same.cast("int"))


@query("proper_case_names")
def _(b: Build):
    return b.raw("crm_customers").select(
        "Raw_ID",
        text.proper_case("Full_Name").alias("Full_Name"),
        text.capitalize(F.trim("City")).alias("City"),
    )


@query("list_head")
def _(b: Build):
    return b.raw("erp_stores").select(
        "Raw_ID", text.or_missing(text.list_head("Store_Manager")).alias("Store_Manager")
    )


@query("prefix_strip")
def _(b: Build):
    return b.raw("api_weather").select(
        "Raw_ID", text.strip_prefix(text.key("Retail_Location_ID"), "LOC_").alias("Store_ID")
    )


@query("phone_filter")
def _(b: Build):
    phone = F.coalesce(text.international_phone("Phone_Number"), F.lit(text.MISSING))
    return b.raw("crm_customers").select("Raw_ID", phone.alias("Phone_Number"))


@query("standardize_products")
def _(b: Build):
    return b.raw("erp_products").select(
        "Raw_ID",
        text.pattern_label(text.upper_text("Category"), rules.CATEGORY_PATTERNS).alias("Category"),
        text.pattern_label(text.upper_text("Sub_Category"), rules.SUB_CATEGORY_PATTERNS).alias("Sub_Category"),
    )


@query("standardize_promo_types")
def _(b: Build):
    label = text.pattern_label(text.upper_text("Promo_Type"), rules.PROMO_TYPE_PATTERNS, rules.PROMO_TYPE_DEFAULT)
    return b.raw("mkt_promotions").select("Raw_ID", label.alias("Promo_Type"))


@query("standardize_weather")
def _(b: Build):
    label = text.pattern_label(text.upper_text("Weather_Condition"), rules.WEATHER_PATTERNS)
    return b.raw("api_weather").select("Raw_ID", label.alias("Weather_Condition"))


@query("standardize_customers")
def _(b: Build):
    return b.raw("crm_customers").select(
        "Raw_ID",
        text.value_label("Gender", rules.GENDER_GROUPS, text.MISSING).alias("Gender"),
        text.pattern_label(
            text.upper_text("Preferred_Channel"), rules.CHANNEL_PATTERNS, rules.CHANNEL_DEFAULT
        ).alias("Preferred_Channel"),
    )


@query("calendar_dimension")
def _(b: Build):
    return b.sales_dates()


@query("date_math")
def _(b: Build):
    staged = b.staged("crm_customers")
    return staged.select(
        "Raw_ID",
        dates.year_span("Birthdate", CLOCK.today()).alias("Age"),
        dates.day_span("Registration_Date", CLOCK.today()).alias("Tenure_Days"),
        F.col("DQ_Birthdate_Valid").alias("Plausible"),
    )


@query("promotion_periods")
def _(b: Build):
    on = F.lit("1998-06-15").cast("date")
    return b.staged("mkt_promotions").select(
        "Raw_ID",
        dates.day_span("Start_Date", "End_Date").alias("Duration_Days"),
        F.coalesce(dates.active_on(on, "Start_Date", "End_Date"), F.lit(0)).alias("Is_Active"),
    )


@query("order_measures")
def _(b: Build):
    return silver.silver_measures_header(b.staged("pos_transactions_header")).select(
        "Raw_ID", "Net_Amount", "Discount_Rate"
    )


@query("line_measures")
def _(b: Build):
    staged = b.staged("pos_transactions_lines")
    parts = ("Line_Sales_Amount", "Quantity", "Cost_Price")
    return silver.silver_measures_lines(staged).select(
        "Raw_ID", "Line_Cost", "Line_Margin", "Line_Margin_Over_Sales_Pct",
        measures.margin_over_cost(*parts).alias("Line_Margin_Over_Cost_Pct"),
        measures.effective_discount("Discount_Amount", "Unit_Price", "Quantity", "Line_Sales_Amount").alias("Discount"),
    )


@query("product_margin")
def _(b: Build):
    return b.staged("erp_products").select(
        "Raw_ID",
        measures.product_margin("Price", "Cost_Price").alias("Margin_Amount"),
        measures.product_margin_pct("Price", "Cost_Price").alias("Margin_Pct"),
    )


# --- staging ------------------------------------------------------------------------------


def _staging(entity: str):
    return lambda b: b.staged(entity)


for _name, _entity in {
    "dq_flags_header": "pos_transactions_header",
    "dq_flags_lines": "pos_transactions_lines",
    "stg_products": "erp_products",
    "stg_stores": "erp_stores",
    "stg_inventory": "erp_inventory",
    "dq_flags_customer": "crm_customers",
    "stg_promotions": "mkt_promotions",
    "stg_weather": "api_weather",
}.items():
    query(_name)(_staging(_entity))


# --- silver -------------------------------------------------------------------------------


@query("dedupe_lines")
def _(b: Build):
    latest = keep_latest(
        b.staged("pos_transactions_lines"), ["Transaction_Line_ID"], silver.NEWEST, F.col("DQ_Is_Valid")
    )
    return latest.select("Transaction_Line_ID", "Raw_ID", "Product_SKU", "Quantity", "Line_Sales_Amount")


@query("dedupe_products")
def _(b: Build):
    newest = ("Last_Updated", *silver.NEWEST)
    latest = keep_latest(b.staged("erp_products"), ["Product_SKU"], newest, F.col("DQ_Is_Valid"))
    return latest.select("Product_SKU", "Raw_ID", "Price", "Last_Updated")


@query("dedupe_latest_snapshot")
def _(b: Build):
    newest = ("Snapshot_Date", *silver.NEWEST)
    latest = keep_latest(b.staged("erp_inventory"), ["Product_SKU", "Store_ID"], newest, usable_stock())
    return latest.select("Product_SKU", "Store_ID", "Snapshot_Date", "Raw_ID", "Quantity_On_Hand")


@query("silver_stores")
def _(b: Build):
    return b.stores()


@query("silver_customers")
def _(b: Build):
    return b.customers()


@query("silver_products")
def _(b: Build):
    return b.products()


@query("silver_promotions")
def _(b: Build):
    return b.promotions()


@query("silver_weather")
def _(b: Build):
    return b.weather()


@query("silver_inventory")
def _(b: Build):
    return b.inventory()


@query("silver_header")
def _(b: Build):
    return b.headers()


@query("silver_lines")
def _(b: Build):
    return b.lines()


@query("header_links")
def _(b: Build):
    linked = b.headers(customers=b.customers(), keep_links=True)
    return linked.select("Transaction_ID", "Store_Exists", "Customer_Exists")


@query("fk_existence_flags")
def _(b: Build):
    linked = silver.line_links(b.lines(), b.headers(), b.products(), b.stores(), b.promotions())
    return linked.select(
        "Transaction_Line_ID", "Transaction_Exists", "Product_Exists", "Store_Exists", "Promotion_Exists"
    )


@query("enforced_lines")
def _(b: Build):
    linked = silver.line_links(b.lines(), b.headers(), b.products(), b.stores(), b.promotions())
    return silver.enforce_links(linked).select("Transaction_Line_ID", "Transaction_ID", "Line_Sales_Amount")


@query("dq_scores")
def _(b: Build):
    lines = b.lines().groupBy("DQ_Score").agg(F.count(F.lit(1)).alias("Row_Count"))
    headers = b.headers().groupBy("DQ_Score").agg(F.count(F.lit(1)).alias("Row_Count"))
    return lines.withColumn("Entity", F.lit("lines")).unionByName(headers.withColumn("Entity", F.lit("header")))


# --- gold ---------------------------------------------------------------------------------


@query("fact_sales")
def _(b: Build):
    return b.sales()


@query("fact_inventory")
def _(b: Build):
    return b.stock()


def _dimension(name: str):
    return lambda b: b.keyed_dim(name)


for _name in DIMENSION_KEYS:
    query(_name)(_dimension(_name))


@query("bridge_explode")
def _(b: Build):
    return b.bridge()


@query("bridge_listing")
def _(b: Build):
    return analytics.promotion_products(b.bridge(), b.dim("dim_promotion"), b.dim("dim_product"))


@query("bridge_keys")
def _(b: Build):
    return analytics.keyed_bridge(b.bridge(), b.keyed_dim("dim_promotion"), b.keyed_dim("dim_product"))


@query("agg_daily")
def _(b: Build):
    return aggregates.sales_daily(b.sales())


@query("agg_monthly")
def _(b: Build):
    return aggregates.sales_monthly(b.sales(), b.dim("dim_product"))


@query("agg_product")
def _(b: Build):
    return aggregates.product_performance(b.sales(), stored=False)


# --- questions ----------------------------------------------------------------------------


@query("sales_by_date")
def _(b: Build):
    return analytics.sales_by_date(b.sales(), b.sales_dates())


@query("sales_by_category")
def _(b: Build):
    return analytics.sales_by_category(b.sales(), b.dim("dim_product"))


@query("store_performance")
def _(b: Build):
    return analytics.store_performance(b.sales(), b.dim("dim_store"))


@query("customer_segments")
def _(b: Build):
    return analytics.customer_segments(b.sales(), b.dim("dim_customer"))


@query("promo_effect")
def _(b: Build):
    return analytics.promotion_effect(b.sales(), b.dim("dim_promotion"))


@query("weather_impact")
def _(b: Build):
    return analytics.weather_impact(b.sales(), b.dim("dim_weather"), b.sales_dates(), WEATHER_YEAR)


@query("returns_by_month")
def _(b: Build):
    return analytics.returns_by_month(b.sales(), b.sales_dates(), b.dim("dim_product"))


@query("inventory_by_store")
def _(b: Build):
    return analytics.inventory_by_store(b.stock())


@query("inventory_reorder")
def _(b: Build):
    return analytics.reorder_list(b.stock())


@query("inventory_trend")
def _(b: Build):
    return analytics.inventory_trend(b.daily_stock())


@query("inventory_star")
def _(b: Build):
    days = b.dates_of("events", "ts")
    return analytics.inventory_by_month(b.daily_stock(), days, b.dim("dim_store"), b.dim("dim_product"))


# --- checks and reports -------------------------------------------------------------------


@query("null_unique_accepted_expr_checks")
def _(b: Build):
    checks = contracts.silver_checks()
    return run_checks(b.lines(), "lines", checks["pos_transactions_lines"]).unionByName(
        run_checks(b.products(), "products", checks["erp_products"])
    )


@query("constraint_violations")
def _(b: Build):
    # the stored rules on rows that silver has not filtered, so that they can fail
    lines = [
        *not_null("Quantity", "Unit_Price", "Cost_Price", "Promotion_ID"),
        holds("Quantity <> 0"),
        holds("Cost_Price <= Unit_Price"),
        holds("Discount_Amount IS NULL OR Discount_Amount >= 0"),
        unique("Transaction_Line_ID"),
        unique("Transaction_Line_ID", only_if="DQ_Is_Valid = 1"),
    ]
    header = [
        *not_null("Transaction_Date", "Customer_ID", "Total_Amount"),
        accepted("Payment_Method", rules.PAYMENT_METHODS),
        holds("Total_Amount >= 0"),
        holds("Line_Count > 0"),
        unique("Transaction_ID"),
    ]
    return run_checks(b.staged("pos_transactions_lines"), "lines", lines).unionByName(
        run_checks(b.staged("pos_transactions_header"), "header", header)
    )


@query("raw_counts")
def _(b: Build):
    return reports.row_counts(b.all_raw())


@query("reconcile_counts")
def _(b: Build):
    return reports.reconciliation(b.all_raw(), b.all_staged())


@query("quality_status")
def _(b: Build):
    return reports.quality_status(reports.reconciliation(b.all_raw(), b.all_staged()))


@query("scorecard")
def _(b: Build):
    return reports.scorecard(b.all_staged())


@query("coverage")
def _(b: Build):
    return reports.date_coverage(b.all_staged())


@query("business_sales")
def _(b: Build):
    return reports.sales_summary(b.staged("pos_transactions_header"))


@query("business_products")
def _(b: Build):
    return reports.product_portfolio(b.staged("erp_products"))


@query("business_stores")
def _(b: Build):
    return reports.store_network(b.staged("erp_stores"))


@query("business_customers")
def _(b: Build):
    return reports.customer_base(b.staged("crm_customers"), CLOCK)


@query("fact_row_gate")
def _(b: Build):
    return reports.enough_fact_rows(b.sales())


@query("duplicate_keys_top5")
def _(b: Build):
    return reports.repeated_keys(b.staged("pos_transactions_lines"), "Transaction_Line_ID")


@query("distinct_typos")
def _(b: Build):
    return reports.suspect_categories(b.staged("erp_products"))


@query("store_mismatch")
def _(b: Build):
    found = reports.store_mismatches(b.staged("pos_transactions_header"), b.staged("pos_transactions_lines"))
    return reports.sample(found, 5, "Transaction_ID", "Header_Store_ID", "Line_Store_ID")


@query("store_mismatch_totals")
def _(b: Build):
    found = reports.store_mismatches(b.staged("pos_transactions_header"), b.staged("pos_transactions_lines"))
    return found.groupBy("Header_Store_ID").agg(F.count(F.lit(1)).alias("Lines"))


@query("overlap_pairs")
def _(b: Build):
    return reports.overlapping_promotions(b.staged("mkt_promotions"))


@query("overlap_same_sku")
def _(b: Build):
    return analytics.same_product_overlaps(b.promotions())


# --- weather source -----------------------------------------------------------------------


@query("weather_decode")
def _(b: Build):
    code = F.col("event_id") % 100
    return b.table("events").select(
        "event_id", code.alias("code"), weather_source.condition_of(code).alias("Weather_Condition")
    )


@query("payload_flatten")
def _(b: Build):
    days = weather_source.daily_rows(feeds.payloads(b.spark, b.table), keep=("event_id", "Store_ID"))
    return days.withColumn("Weather_Condition", weather_source.condition_of("weather_code")).drop("weather_code")


@query("weather_load_profile")
def _(b: Build):
    return weather_source.load_profile(weather_source.daily_rows(feeds.payloads(b.spark, b.table)))


@query("city_coordinates")
def _(b: Build):
    return weather_source.with_coordinates(b.raw("erp_stores")).select("Raw_ID", "City", "Latitude", "Longitude")


# --- documented beyond the models ---------------------------------------------------------


@query("scd2_history")
def _(b: Build):
    tracked = ["Price", "Cost_Price"]
    usable = F.col("DQ_Is_Valid") * F.col("DQ_Last_Updated_Valid")
    history = version_history(b.staged("erp_products"), "Product_SKU", "Last_Updated", tracked, silver.NEWEST, usable)
    return history.select(
        "Product_SKU", "Price", "Cost_Price", "Effective_From", "Effective_To", "Is_Current", "Version_Number"
    )


@query("masked_contacts")
def _(b: Build):
    return b.customers(mask_secret="not a secret").select("Customer_ID", "Email", "Phone_Number", "Has_Email", "Has_Phone")


@query("header_vs_lines")
def _(b: Build):
    return analytics.header_against_lines(b.headers(), b.lines())


# --- one load after another ---------------------------------------------------------------


def load_of(df: DataFrame, number: int) -> DataFrame:
    """The rows of one of the two loads of a feed."""
    return df.filter(F.col("Batch_ID").endswith(f"_{number}"))


@query("merged_history")
def _(b: Build):
    staged = b.staged("erp_products")
    how = ("Product_SKU", "Last_Updated", ["Price", "Cost_Price"], silver.NEWEST, F.col("DQ_Is_Valid") * F.col("DQ_Last_Updated_Valid"))
    columns = ["Product_SKU", "Price", "Cost_Price", "Effective_From", "Effective_To", "Is_Current", "Version_Number"]
    stored = version_history(load_of(staged, 1), *how).select(*columns)
    return merge_versions(stored, load_of(staged, 2), *how)


@query("lasting_customer_keys")
def _(b: Build):
    customers = b.dim("dim_customer")
    # a first map of one city's customers, then one of all
    known = lasting_key(customers.filter("City = 'Dubai'"), "Customer_Key", ["Customer_ID"], None)
    return lasting_key(customers, "Customer_Key", ["Customer_ID"], known)


@query("enforced_rows")
def _(b: Build):
    rules_of_headers = [
        *not_null("Transaction_Date", "Total_Amount"),
        accepted("Payment_Method", rules.PAYMENT_METHODS),
        holds("Total_Amount > 0"),
        holds("Line_Count > 0"),
        unique("Transaction_ID"),
    ]
    marked = violations(b.staged("pos_transactions_header"), rules_of_headers, [F.desc("Raw_ID")])
    return marked.select("Raw_ID", "Transaction_ID", F.concat_ws("; ", VIOLATED).alias("Violated_Rules"))


def months_of_last_lines(b: Build, lines: DataFrame, headers: DataFrame) -> DataFrame:
    last = b.staged("pos_transactions_lines").filter(f"Load_Timestamp >= TIMESTAMP'{LAST_LINES}'")
    return gold.touched_months(gold.with_sales_month(gold.fact_sales(lines, headers, CLOCK)), headers, last)


@query("touched_months")
def _(b: Build):
    return months_of_last_lines(b, b.lines(), b.headers())


# what the touched months and the daily sums read of the cleaned rows
LINES_READ = ("Transaction_ID", "Store_ID", "Quantity", "Cost_Price", "Discount_Amount", "Line_Sales_Amount", "Is_Valid")
HEADERS_READ = ("Transaction_ID", "Transaction_Date", "Customer_ID", "Is_Valid")


@query("rebuilt_months")
def _(b: Build):
    # stored as in a run: both steps read the cleaned rows, none cleans them again
    lines, headers = stored(b.lines(), "lines", LINES_READ), stored(b.headers(), "headers", HEADERS_READ)
    with run_once(b.spark):
        # no more than the months of the calendar
        months = [r["Sales_Month"] for r in months_of_last_lines(b, lines, headers).collect()]
    fact = gold.fact_sales(lines, gold.in_months(headers, months), CLOCK)
    return aggregates.by_month(gold.with_sales_month(fact), b.products())["agg_sales_daily"]
