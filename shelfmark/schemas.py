"""Raw entities: their files, source systems and all-text columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RAW, STAGING, SILVER, GOLD = "raw", "staging", "silver", "gold"
LAYERS = (RAW, STAGING, SILVER, GOLD)

LINEAGE_COLUMNS = ("Batch_ID", "Source_File", "Load_Timestamp")
# what a row keeps of its origin after staging
ORIGIN_COLUMNS = ("Batch_ID", "Source_File")


@dataclass(frozen=True)
class Entity:
    file: str
    table: str
    source: str
    entity: str
    columns: tuple[str, ...]
    # names the file may use for a column of the table
    aliases: tuple[tuple[str, str], ...] = ()

    @property
    def business_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField("Raw_ID", T.LongType())]
            + list(self.business_schema.fields)
            + [
                T.StructField("Batch_ID", T.StringType()),
                T.StructField("Source_File", T.StringType()),
                T.StructField("Load_Timestamp", T.TimestampType()),
            ]
        )


def _entity(table: str, source: str, entity: str, columns: tuple[str, ...], **options) -> Entity:
    return Entity(f"{table}.csv", table, source, entity, columns, **options)


# Files, tables and column names of the source systems.
ENTITIES = {
    e.table: e
    for e in (
        _entity(
            "pos_transactions_header", "POS", "transactions_header",
            (
                "Transaction_ID", "Transaction_Date", "Transaction_TS", "Store_ID", "Customer_ID",
                "Payment_Method", "Total_Amount", "Total_Discount", "Line_Count",
            ),
        ),
        _entity(
            "pos_transactions_lines", "POS", "transactions_lines",
            (
                "Transaction_Line_ID", "Transaction_ID", "Line_Number", "Product_SKU", "Store_ID",
                "Quantity", "Unit_Price", "Cost_Price", "Discount_Amount", "Line_Sales_Amount",
                "Promotion_ID",
            ),
        ),
        _entity(
            "erp_products", "ERP", "products",
            (
                "Product_SKU", "Product_Name", "Category", "Sub_Category", "Price", "Cost_Price",
                "Supplier_ID", "Last_Updated",
            ),
        ),
        _entity(
            "erp_stores", "ERP", "stores",
            (
                "Store_ID", "Store_Name", "City", "Region", "Store_Manager", "Store_Area_sqm",
                "Open_Date",
            ),
        ),
        _entity(
            "erp_inventory", "ERP", "inventory",
            (
                "Inventory_ID", "Product_SKU", "Store_ID", "Snapshot_Date", "Quantity_On_Hand",
                "Reorder_Level",
            ),
        ),
        _entity(
            "crm_customers", "CRM", "customers",
            (
                "Customer_ID", "Full_Name", "Gender", "Birthdate", "Registration_Date", "Email",
                "Phone_Number", "City", "Preferred_Channel",
            ),
        ),
        _entity(
            "mkt_promotions", "MKT", "promotions",
            (
                "Promotion_ID", "Promo_Name", "Promo_Type", "Start_Date", "End_Date", "Promo_Cost",
                "Eligible_SKUs",
            ),
        ),
        _entity(
            "api_weather", "API", "weather",
            (
                "Weather_Date", "Retail_Location_ID", "Temperature_C", "Precipitation_mm",
                "Weather_Condition",
            ),
            aliases=(("Store_ID", "Retail_Location_ID"),),
        ),
    )
}

ENTITY_BY_FILE = {e.file: e for e in ENTITIES.values()}

MANIFEST_TABLE = "ingestion_manifest"
MANIFEST_SCHEMA = T.StructType(
    [
        # counts the loads of an entity; it is the upper part of the ids of their rows
        T.StructField("Load_Number", T.LongType()),
        T.StructField("Batch_ID", T.StringType(), False),
        T.StructField("Source_System", T.StringType()),
        T.StructField("Entity_Name", T.StringType()),
        T.StructField("Source_File", T.StringType()),
        T.StructField("Row_Count", T.LongType()),
        T.StructField("Load_Start_TS", T.TimestampType()),
        T.StructField("Load_End_TS", T.TimestampType()),
        T.StructField("Load_Status", T.StringType()),
        T.StructField("Error_Message", T.StringType()),
        T.StructField("Duration_Seconds", T.DoubleType()),
        T.StructField("Created_TS", T.TimestampType()),
    ]
)

# every streamed file, once as STARTED before its rows are stored and once as COMPLETED after
LEDGER_TABLE = "landed_files"
LEDGER_COLUMNS = ("Batch_ID", "Entity_Name", "Source_File", "Load_Number", "Row_Count", "Load_Status", "Load_Day")

WEATHER_PAYLOAD = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
                    T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
                    T.StructField("weathercode", T.ArrayType(T.IntegerType())),
                ]
            ),
        )
    ]
)
