import datetime as dt
from decimal import Decimal

import pytest
from conftest import column, frame
from pyspark.sql import functions as F

from shelfmark.functions import dates, measures, numbers, rules, text
from shelfmark.plans import gold
from shelfmark.sources import weather

D = dt.date
N = Decimal


def apply(spark, fn, values, kind="string"):
    df = frame(spark, f"i int, x {kind}", *[(i, v) for i, v in enumerate(values)])
    return column(df.orderBy("i").select(fn(F.col("x"))))


CASES = [
    (text.key, ["S016 ", " p1", None], ["S016", "P1", None]),
    (text.blank_to_null, ["  ", " a ", None], [None, "a", None]),
    (text.upper_text, [" ab ", ""], ["AB", None]),
    (text.lower_text, [" A@B.C ", " "], ["a@b.c", None]),
    (text.optional_key, ["", "NA", "n/a", "null", " c1 ", None], [None, None, None, None, "C1", None]),
    (numbers.to_amount, ["$1,234.50", "€ 99", "abc", "", "1e3", "£5.00", "-.5", None], [N("1234.50"), N("99.00"), None, None, None, None, N("-0.50"), None]),
    (lambda c: numbers.to_amount(c, numbers.LINE_CURRENCY_MARKS), ["£5.00", "£ 1,000"], [N("5.00"), N("1000.00")]),
    (numbers.to_optional_amount, ["NA", " n/a", "$5", "0"], [None, None, N("5.00"), N("0.00")]),
    (lambda c: numbers.to_amount(c, numbers.THOUSANDS_MARKS, "decimal(10,2)"), ["1,200.50", "$5"], [N("1200.50"), None]),
    (lambda c: numbers.to_decimal(c, "decimal(5,2)"), ["1000.00", "-12.5", "None"], [None, N("-12.50"), None]),
    (numbers.to_int, ["7", " 8 ", "1.5", "x", "-2", ""], [7, 8, None, None, -2, None]),
    (dates.iso_date, ["2024-05-01", "2024-5-1", "2024", "2024-02-30", "2024-05-01 10:00:00", "1/2/2024"], [D(2024, 5, 1), None, None, None, D(2024, 5, 1), D(2024, 1, 2)]),
    (dates.mixed_date, ["1/5/2024", "13/5/2024", "2024-05-01", "x", "3/4/2024", "2/30/2024", "1/2/3/2024", "1/5/24", "1/5/20245"],
     [D(2024, 1, 5), D(2024, 5, 13), D(2024, 5, 1), None, D(2024, 3, 4), None, None, None, None]),
    (dates.mixed_timestamp, ["1/5/2024 9:30", "2024-01-05 09:30:00", "1/5/2024", "31/1/2024 23:59", "x"],
     [dt.datetime(2024, 1, 5, 9, 30), dt.datetime(2024, 1, 5, 9, 30), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 31, 23, 59), None]),
    (lambda c: text.bounded(c, 3), ["abcdef"], ["abc"]),
    (text.proper_case, ["aHMED  hassan", " o'neil mc-lean "], ["Ahmed  Hassan", "O'neil Mc-lean"]),
    (text.capitalize, ["LOS ANGELES", "x", ""], ["Los angeles", "X", ""]),
    (lambda c: text.or_missing(text.list_head(c)), ["Liam Brown; David Smith", "", "NA", None, " ; x"], ["Liam Brown", "N/A", "NA", "N/A", "N/A"]),
    (lambda c: F.coalesce(text.international_phone(c), F.lit("N/A")), [" +20100", "0100", None], ["+20100", "N/A", "N/A"]),
    (lambda c: text.strip_prefix(c, "LOC_"), ["LOC_S001", "S001", "LOCAL"], ["S001", "S001", "LOCAL"]),
    (lambda c: text.value_label(c, rules.GENDER_GROUPS, "N/A"), ["m", "Female", "other", "x", None], ["M", "F", "O", "N/A", "N/A"]),
    (lambda c: text.pattern_label(F.upper(c), rules.CHANNEL_PATTERNS, rules.CHANNEL_DEFAULT), ["Online", "in store", "Mixed", "fax", None], ["ONLINE", "IN-STORE", "MIXED", "UNKNOWN", "UNKNOWN"]),
    (lambda c: text.pattern_label(F.upper(c), rules.CATEGORY_PATTERNS), ["BEVERAGE", "Clothng", "CLOTH", "FUD", "F00d", "H0me", "electronics", "Toys"],
     ["Beverages", "Clothing", "Clothing", "Food", "Food", "Home", "Electronics", "TOYS"]),
    (lambda c: text.pattern_label(F.upper(c), rules.SUB_CATEGORY_PATTERNS), ["SNAKS", "ACCES", "Men", "Women", "Mobile", "Soda", "Cleaning", "Lpatops", "SODAS"],
     ["Snacks", "Accessories", "Men", "Women", "Mobile", "Soda", "Cleaning", "Laptops", "Snacks"]),
    (lambda c: text.pattern_label(F.upper(c), rules.PROMO_TYPE_PATTERNS, rules.PROMO_TYPE_DEFAULT), ["25% off", "Buy one get one", "bundle deal", "price cut", "gift"],
     ["DISCOUNT", "BOGO", "BUNDLE", "REDUCTION", "OTHER"]),
    (lambda c: text.pattern_label(F.upper(c), rules.WEATHER_PATTERNS), ["Mainly Clear", "Overcast", "Dense Drizzle", "Thunderstorm", "Foggy", "partly cloudy", "windy"],
     ["CLEAR", "CLOUDY", "RAINY", "STORMY", "FOGGY", "PARTLY CLOUDY", "WINDY"]),
]


@pytest.mark.parametrize("fn, given, expected", CASES)
def test_text_expressions(spark, fn, given, expected):
    assert apply(spark, fn, given) == expected


def test_weather_codes(spark):
    assert apply(spark, weather.condition_of, [95, 48, 999, None], "int") == ["Thunderstorm", "Foggy", "Unknown", "Unknown"]


def test_coordinates_default(spark):
    df = frame(spark, "City string", ("Cairo ",), ("Paris",), (None,))
    got = [tuple(r)[1:] for r in weather.with_coordinates(df).collect()]
    assert got == [(30.0444, 31.2357), (25.0, 45.0), (25.0, 45.0)]


def test_measures(spark):
    df = frame(spark, "q int, cost decimal(18,2), sales decimal(18,2)", (2, N(5), N(15)), (-2, N(5), N(-15)), (1, N(0), N(3)))
    got = df.select(
        measures.line_cost("q", "cost"), measures.line_margin("sales", "q", "cost"),
        measures.margin_over_cost("sales", "q", "cost"), measures.margin_over_sales("sales", "q", "cost"),
    ).collect()
    assert tuple(got[0]) == (N("10"), N("5"), N("50.00"), N("33.33"))
    assert tuple(got[1]) == (N("-10"), N("-5"), N("0.00"), N("0.00"))
    assert got[2][2] == N("0.00")
    line = frame(spark, "d decimal(18,2), p decimal(18,2), q int, s decimal(18,2)", (None, N(10), 3, N(27)), (N(0), N(10), 3, N(27)), (N(2), N(10), 3, N(27)))
    assert column(line.select(measures.effective_discount("d", "p", "q", "s"))) == [N("3.00"), N("3.00"), N("2.00")]
    scores = frame(spark, "a int, b int", (95, 90), (100, 100))
    assert column(scores.select(measures.mean_score("a", "b"))) == [92, 100]
    stock = frame(spark, "q int, r int", (5, 9), (51, 9))
    assert column(stock.select(measures.reorder_need("q", "r"))) == [4, 0]
    order = frame(spark, "t decimal(18,2), d decimal(18,2)", (N(200), N(50)), (N(0), N(1)), (N(10), None))
    assert [tuple(r) for r in order.select(measures.net_amount("t", "d"), measures.discount_rate("t", "d")).collect()] == [
        (N("150.00"), N("25.00")), (N("-1.00"), N("0.00")), (N("10.00"), N("0.00")),
    ]


def test_dates(spark, clock):
    df = frame(spark, "a date", (D(2000, 12, 31),))
    assert column(df.select(dates.year_span("a", clock.today()))) == [25]
    assert column(df.select(dates.covered_days("a", F.lit(D(2001, 1, 1))))) == [2]
    assert column(df.select(dates.active_on(F.lit(D(2000, 12, 31)), "a", "a"))) == [1]


def test_calendar(spark, clock):
    days = {r["Date_Value"]: r for r in gold.dim_date(spark, clock).collect()}
    assert min(days) == D(2010, 1, 1) and max(days) == D(2035, 12, 31)
    assert len(days) == (max(days) - min(days)).days + 1
    leap = days[D(2024, 2, 29)]
    assert (leap["Date_SK"], leap["Is_Month_End"], leap["Year_Month"], leap["Year_Quarter"]) == (20240229, 1, "2024-02", "2024-Q1")
    assert days[D(2024, 12, 30)]["Week_Of_Year"] == 1
    sunday = days[D(2024, 1, 7)]
    assert (sunday["Day_Of_Week"], sunday["Is_Weekend"], sunday["Is_Weekday"], sunday["Day_Name"]) == (1, 1, 0, "Sunday")
    assert days[D(2024, 12, 25)]["Is_Holiday"] == days[D(2024, 1, 1)]["Is_Holiday"] == 1
    assert days[D(2024, 7, 4)]["Is_Holiday"] == 0


def test_percent_is_rounded_once(spark):
    df = frame(spark, "a decimal(18,2), b decimal(18,2)", (N("1"), N("3")), (N("0.01"), N("2.00")), (N("2"), N("0")))
    assert column(df.select(numbers.percent("a", "b"))) == [N("33.33"), N("0.50"), N("0.00")]
    assert column(df.select(numbers.share(F.lit(1), F.lit(0))))[0] is None


def test_date_forms(spark):
    texts = ["20240102", "1/2/2024", "1-2-2024", "1.2.2024", "2024-01-02", "2024-01-02 03:04:05", "2024", "x", "31/12/2024", "", "2024010", "1/2/24"]
    df = frame(spark, "a string", *[(t,) for t in texts])
    two = D(2024, 1, 2)
    assert column(df.select(dates.iso_date("a"))) == [two, two, two, two, two, two, None, None, None, None, None, None]
    assert column(df.select(dates.mixed_date("a"))) == [two, two, two, two, two, two, None, None, D(2024, 12, 31), None, None, None]


def test_times_of_half_days(spark):
    texts = ["1/5/2024 9:30 PM", "1-5-2024 12:00 AM", "1/5/2024 12:15 pm", "13/5/2024 1:05:09 am", "1/5/2024 21:30", "1/5/2024 13:00 PM", "1/5/2024 xx PM", "1/5/2024 9 AM", "1/5/2024 9:30 AM PM"]
    got = column(frame(spark, "a string", *[(t,) for t in texts]).select(F.date_format(dates.mixed_timestamp("a"), "yyyy-MM-dd HH:mm:ss")))
    assert got == ["2024-01-05 21:30:00", "2024-01-05 00:00:00", "2024-01-05 12:15:00", "2024-05-13 01:05:09", "2024-01-05 21:30:00", None, None, "2024-01-05 09:00:00", None]


def test_month_or_day_first(spark):
    texts = ["0/5/2024", "5/0/2024", "2/30/2024", "30/2/2024", "29/2/2024", "12/12/2024", "13/13/2024", "/5/2024", "xx/5/2024", "1/5-2024", "1/5/2024x"]
    df = frame(spark, "a string", *[(t,) for t in texts])
    expected = [None, None, None, None, D(2024, 2, 29), D(2024, 12, 12), None, None, None, D(2024, 1, 5), None]
    assert column(df.select(dates.mixed_date("a"))) == expected
