"""Typed contracts: the canonical sales fact, the dimensions, the manifest
and the two marts.

Money is decimal throughout (a float total rounds differently from an exact
engine); keys are ``long`` so that the driver's test tables fit unchanged.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The mandatory sales columns, in the contract's order, and
# the name of the column that collects every non-contract column of a file.
MANDATORY_COLUMNS = [
    "customer_id", "store_id", "product_name", "sales_date",
    "sales_person_id", "price", "quantity", "total_cost",
]
EXTRA_COLUMN = "additional_column"
EXTRA_SEPARATOR = ", "

# Manifest states (active = picked up, inactive = committed).
STATUS_ACTIVE = "A"
STATUS_INACTIVE = "I"
# Our addition: a rejected file is settled too (the original moved it away).
STATUS_QUARANTINED = "Q"

MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(10, 2)

SALES_FACT = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("store_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales_date", T.DateType()),
    T.StructField("sales_person_id", T.LongType()),
    T.StructField("price", MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_cost", MONEY),
    T.StructField(EXTRA_COLUMN, T.StringType()),
])

CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("pincode", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("customer_joining_date", T.DateType()),
])

STORE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("address", T.StringType()),
    T.StructField("store_pincode", T.StringType()),
    T.StructField("store_manager_name", T.StringType()),
    T.StructField("store_opening_date", T.DateType()),
    T.StructField("reviews", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("current_price", PRICE),
    T.StructField("old_price", PRICE),
    T.StructField("created_date", T.TimestampType()),
    T.StructField("updated_date", T.TimestampType()),
    T.StructField("expiry_date", T.DateType()),
])

SALES_TEAM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("manager_id", T.LongType()),
    T.StructField("is_manager", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("pincode", T.StringType()),
    T.StructField("joining_date", T.DateType()),
])

# Append-only file manifest: one event per state change, latest event wins.
MANIFEST = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("file_location", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
])

CUSTOMER_MART = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("sales_date_month", T.StringType()),
    T.StructField("total_sales", MONEY),
])

SALES_TEAM_MART = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("sales_person_id", T.LongType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("sales_month", T.StringType()),
    T.StructField("total_sales", MONEY),
    T.StructField("incentive", MONEY),
])


def empty(spark, schema: T.StructType):
    """An empty relation of a contract (the reference's seed frames)."""
    return spark.createDataFrame([], schema)
