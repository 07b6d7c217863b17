"""Weather service payloads to daily rows per store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import rules
from shelfmark.functions.text import as_col
from shelfmark.schemas import WEATHER_PAYLOAD


def condition_of(code: Column | str) -> Column:
    """Readable condition of a weather code, by a constant map."""
    pairs = [F.lit(x) for entry in rules.WEATHER_CODES.items() for x in entry]
    label = F.try_element_at(F.create_map(*pairs), as_col(code).cast("int"))
    return F.coalesce(label, F.lit(rules.WEATHER_CODE_DEFAULT))


def with_coordinates(stores: DataFrame, city: str = "City") -> DataFrame:
    """Latitude and longitude of the store's city; a default point for other cities.

    The lookup is a constant of a few entries, so it is an expression rather than a join."""
    name = F.trim(F.col(city))

    def lookup(index: int, default: float) -> Column:
        pairs = [F.lit(x) for row in rules.CITY_COORDINATES for x in (row[0], row[index])]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit(default))

    return stores.withColumns(
        {
            "Latitude": lookup(1, rules.DEFAULT_LATITUDE),
            "Longitude": lookup(2, rules.DEFAULT_LONGITUDE),
        }
    )


def daily_rows(payloads: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("Store_ID",)) -> DataFrame:
    """One row per store and day out of a payload's parallel arrays.

    ``payload`` is JSON text or an already parsed struct."""
    if dict(payloads.dtypes)[payload] == "string":
        payloads = payloads.withColumn(payload, F.from_json(payload, WEATHER_PAYLOAD))
    daily = f"{payload}.daily"
    days = F.arrays_zip(
        F.col(f"{daily}.time").alias("Weather_Date"),
        F.col(f"{daily}.temperature_2m_mean").alias("Temperature_C"),
        F.col(f"{daily}.precipitation_sum").alias("Precipitation_mm"),
        F.col(f"{daily}.weathercode").alias("weather_code"),
    )
    return payloads.select(*keep, F.inline(days).alias("Weather_Date", "Temperature_C", "Precipitation_mm", "weather_code"))


def raw_weather(days: DataFrame, batch: str, file_name: str) -> DataFrame:
    """Daily rows in the column order of the weather file."""
    return days.select(
        "Weather_Date",
        "Store_ID",
        "Temperature_C",
        "Precipitation_mm",
        condition_of("weather_code").alias("Weather_Condition"),
        F.lit(batch).alias("Batch_ID"),
        F.lit(file_name).alias("Source_File"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def load_profile(days: DataFrame) -> DataFrame:
    return days.agg(
        F.count(F.lit(1)).alias("Total_Records"),
        F.min("Weather_Date").alias("First_Date"),
        F.max("Weather_Date").alias("Last_Date"),
        F.countDistinct("Store_ID").alias("Stores_Covered"),
        F.count_if(F.col("Temperature_C").isNull()).alias("Missing_Temperature"),
    )
