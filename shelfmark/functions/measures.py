"""Derived sales, margin, stock and weather measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.numbers import MONEY, or_zero, percent
from shelfmark.functions.text import as_col


def net_amount(total: Column | str, discount: Column | str) -> Column:
    return (as_col(total) - or_zero(discount)).cast(MONEY)


def discount_rate(total: Column | str, discount: Column | str) -> Column:
    return percent(or_zero(discount), total)


def line_cost(quantity: Column | str, unit_cost: Column | str) -> Column:
    return (as_col(quantity) * as_col(unit_cost)).cast(MONEY)


def line_margin(sales: Column | str, quantity: Column | str, unit_cost: Column | str) -> Column:
    return (as_col(sales) - line_cost(quantity, unit_cost)).cast(MONEY)


def margin_over_cost(sales: Column | str, quantity: Column | str, unit_cost: Column | str) -> Column:
    return percent(line_margin(sales, quantity, unit_cost), line_cost(quantity, unit_cost))


def margin_over_sales(sales: Column | str, quantity: Column | str, unit_cost: Column | str) -> Column:
    return percent(line_margin(sales, quantity, unit_cost), sales)


def product_margin(price: Column | str, cost: Column | str) -> Column:
    return (as_col(price) - or_zero(cost)).cast(MONEY)


def product_margin_pct(price: Column | str, cost: Column | str) -> Column:
    return percent(product_margin(price, cost), price)


def effective_discount(discount: Column | str, price: Column | str, quantity: Column | str, sales: Column | str) -> Column:
    """The stated discount, or the gap between list value and sales where none is stated."""
    gap = as_col(price) * as_col(quantity) - as_col(sales)
    return F.coalesce(F.nullif(as_col(discount), F.lit(0)), gap).cast(MONEY)


def reorder_need(on_hand: Column | str, level: Column | str) -> Column:
    on_hand, level = as_col(on_hand), as_col(level)
    return F.when(on_hand < level, level - on_hand).otherwise(F.lit(0))


def mean_score(a: Column | str, b: Column | str) -> Column:
    """Average of two whole scores, rounded towards zero."""
    return ((as_col(a) + as_col(b)).cast("int") / 2).cast("int")


def is_rainy(precipitation: Column | str) -> Column:
    return F.coalesce(as_col(precipitation) > 0, F.lit(False)).cast("int")
