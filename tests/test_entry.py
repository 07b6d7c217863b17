import os

import pytest

import __spark_entry__ as driver
from verification.compare import connect, difference
from verification.oracle import ORACLE
from verification.queries import REGISTRY

SF = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@needs_data
def test_flagship(spark):
    rows = driver.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {
        "Store_Name", "Region", "City", "Total_Sales", "Total_Margin", "Unique_Customers", "Transaction_Count",
    }


@needs_data
@pytest.mark.parametrize(
    "name",
    ["dq_flags_header", "dq_flags_lines", "silver_customers", "silver_inventory", "fact_sales", "dim_weather", "agg_monthly", "overlap_same_sku", "scd2_history"],
)
def test_query_equals_its_sql(spark, name):
    rows, problem = difference(spark, connect(SF), SF, name)
    assert problem is None and rows > 0
