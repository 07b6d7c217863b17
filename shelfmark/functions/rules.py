"""Standard names, ordered patterns, codes and coordinates of the retail data."""

from __future__ import annotations

# Order matters: the first pattern that fits names the category.
CATEGORY_PATTERNS = (
    ("F%", "Food"),
    ("CL%", "Clothing"),
    ("BEVE%", "Beverages"),
    ("H%E", "Home"),
    ("ELEC%", "Electronics"),
    ("E%S", "Electronics"),
)

SUB_CATEGORY_PATTERNS = (
    ("W%N", "Women"),
    ("WO%", "Women"),
    ("ACC%", "Accessories"),
    ("SN%", "Snacks"),
    ("S%S", "Snacks"),
    ("MO%", "Mobile"),
    ("M%E", "Mobile"),
    ("M%N", "Men"),
    ("L%S", "Laptops"),
    ("LPATOPS", "Laptops"),
    ("C%G", "Cleaning"),
    ("CLE%", "Cleaning"),
    ("S%A", "Soda"),
    ("SO%", "Soda"),
)

PROMO_TYPE_PATTERNS = (
    ("%DISCOUNT%", "DISCOUNT"),
    ("%BOGO%", "BOGO"),
    ("%BUY%ONE%GET%", "BOGO"),
    ("%BUNDLE%", "BUNDLE"),
    ("%REDUCTION%", "REDUCTION"),
    ("%PRICE%CUT%", "REDUCTION"),
    ("%SALE%", "DISCOUNT"),
    ("%OFF%", "DISCOUNT"),
)
PROMO_TYPE_DEFAULT = "OTHER"

WEATHER_PATTERNS = (
    ("%CLEAR%", "CLEAR"),
    ("%MAIN%CLEAR%", "CLEAR"),
    ("%PARTLY%CLOUD%", "PARTLY CLOUDY"),
    ("%CLOUD%", "CLOUDY"),
    ("%OVERCAST%", "CLOUDY"),
    ("%RAIN%", "RAINY"),
    ("%DRIZZLE%", "RAINY"),
    ("%SNOW%", "SNOWY"),
    ("%STORM%", "STORMY"),
    ("%THUNDER%", "STORMY"),
    ("%FOG%", "FOGGY"),
)

CHANNEL_PATTERNS = (
    ("%ONLINE%", "ONLINE"),
    ("%IN%STORE%", "IN-STORE"),
    ("%STORE%", "IN-STORE"),
    ("%MIX%", "MIXED"),
)
CHANNEL_DEFAULT = "UNKNOWN"

GENDER_GROUPS = {"F": ("F", "FEMALE"), "M": ("M", "MALE"), "O": ("O", "OTHER")}
KNOWN_GENDERS = ("M", "F", "MALE", "FEMALE")

PAYMENT_METHODS = ("CASH", "CARD", "ONLINE", "CREDIT", "DEBIT")

WEATHER_CODES = {
    0: "Clear",
    1: "Mainly Clear",
    2: "Partly Cloudy",
    3: "Overcast",
    45: "Foggy",
    48: "Foggy",
    51: "Light Drizzle",
    53: "Moderate Drizzle",
    55: "Dense Drizzle",
    61: "Slight Rain",
    63: "Moderate Rain",
    65: "Heavy Rain",
    71: "Slight Snow",
    73: "Moderate Snow",
    75: "Heavy Snow",
    95: "Thunderstorm",
}
WEATHER_CODE_DEFAULT = "Unknown"

# city, latitude, longitude
CITY_COORDINATES = (
    ("Cairo", 30.0444, 31.2357),
    ("Giza", 29.9870, 31.2118),
    ("Alexandria", 31.2001, 29.9187),
    ("Riyadh", 24.7136, 46.6753),
    ("Jeddah", 21.4858, 39.1925),
    ("Dubai", 25.2048, 55.2708),
    ("Doha", 25.2854, 51.5310),
)
DEFAULT_LATITUDE = 25.0
DEFAULT_LONGITUDE = 45.0

# Limits of the quality rules
OUTLIER_LINE_QUANTITY = 100
OUTLIER_STOCK_QUANTITY = 10000
COLDEST_PLAUSIBLE_C = -20
HOTTEST_PLAUSIBLE_C = 45
SHORTEST_PHONE = 10
LONGEST_CUSTOMER_ID = 50

# Acceptance thresholds, in percent of valid rows, best first
STATUS_LADDER = ((95, "EXCELLENT"), (85, "GOOD"))
STATUS_FLOOR = "NEEDS ATTENTION"
MIN_FACT_ROWS = 100
