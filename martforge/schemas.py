"""Table shapes (DDL-1, SRC-6).

Keys are ``long``: at cluster scale surrogate keys outgrow ``int``.
Money is ``decimal(18,2)`` end to end, so sums are exact and do not
depend on the order partial aggregates are merged in.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SQL = "decimal(18,2)"

# The mandatory header of a sales drop, in file order.
MANDATORY = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]
ADDITIONAL = "additional_column"

# Conformed fact: the mandatory columns typed, plus the folded extras.
SALES = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("store_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales_date", T.DateType()),
    T.StructField("sales_person_id", T.LongType()),
    T.StructField("price", MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_cost", MONEY),
    T.StructField(ADDITIONAL, T.StringType()),
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
    T.StructField("current_price", T.DecimalType(10, 2)),
    T.StructField("old_price", T.DecimalType(10, 2)),
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

# Append-only file ledger (replaces an UPDATE-in-place status table).
LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
    T.StructField("run_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("seq", T.IntegerType()),
])
# State of a file identity: its latest event, its first time, its number of events.
LEDGER_STATE = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
    T.StructField("last", T.StructType([
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("file_name", T.StringType()),
    ])),
    T.StructField("created_ts", T.TimestampType()),
    T.StructField("n_events", T.LongType()),
])
LEDGER_OPEN = "A"
LEDGER_CLOSED = "I"
LEDGER_REJECTED = "R"   # quarantined: not processed, not looked at again

# Output column lists of the marts (PRJ-5..9).
CUSTOMER_MART = [
    "customer_id", "first_name", "last_name", "address", "pincode",
    "phone_number", "sales_date", "total_cost",
]
SALES_TEAM_MART = [
    "store_id", "sales_person_id", "sales_person_first_name",
    "sales_person_last_name", "store_manager_name", "manager_id",
    "is_manager", "sales_person_address", "sales_person_pincode",
    "sales_date", "total_cost", "sales_month",
]
CUSTOMER_MONTHLY = [
    "customer_id", "full_name", "address", "phone_number",
    "sales_date_month", "total_sales",
]
SALES_TEAM_MONTHLY = [
    "store_id", "sales_person_id", "full_name", "sales_month",
    "total_sales", "incentive",
]
