"""Reporting marts and monthly aggregates (PRJ-5..9, AGG-1..3, WIN-1..4,
SRT-1..3, SCL-1..3/7/8, EXT-2).

Monthly totals use ``groupBy().agg(sum)``: Spark sums map-side before the
shuffle, so a hot customer or salesperson contributes one partial row per
task instead of every sale.  The "window" variants reproduce the exact
semantics of ``sum() OVER (PARTITION BY key, month)`` followed by
``distinct()`` for *any* input (also when one key carries two different
attribute values): they aggregate by key, month and attributes first and
only then run the window over the already-aggregated rows, whose groups
are as small as the number of attribute variants of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions.columns import MONTH_KEY_EXPR, full_name, incentive, month_key
from martforge.operators.ranking import rank_within, top_of_group
from martforge.schemas import CUSTOMER_MART, SALES_TEAM_MART


def customer_mart(enriched: DataFrame) -> DataFrame:
    """PRJ-5: one row per enriched sale, customer side."""
    return enriched.select(*CUSTOMER_MART)


def sales_team_mart(enriched: DataFrame) -> DataFrame:
    """PRJ-6 + SCL-2: one row per enriched sale, salesperson side, with
    the ``yyyy-MM`` month written as a SQL expression."""
    return enriched.select(*SALES_TEAM_MART[:-1], F.expr(f"{MONTH_KEY_EXPR} AS sales_month"))


def customer_monthly(customer_mart_df: DataFrame, method: str = "groupby") -> DataFrame:
    """AGG-1 / WIN-1 + AGG-3 + PRJ-7: monthly spend per customer."""
    attrs = ["customer_id", "full_name", "address", "phone_number", "sales_date_month"]
    base = customer_mart_df.select(
        "customer_id", full_name("first_name", "last_name").alias("full_name"),
        "address", "phone_number", month_key("sales_date").alias("sales_date_month"),
        "total_cost")
    agg = base.groupBy(*attrs).agg(F.sum("total_cost").alias("total_sales"))
    if method == "groupby":
        return agg
    if method != "window":
        raise ValueError(method)
    w = Window.partitionBy("customer_id", "sales_date_month")
    return agg.select(*attrs, F.sum("total_sales").over(w).alias("total_sales"))


def sales_team_monthly(sales_team_mart_df: DataFrame, method: str = "groupby") -> DataFrame:
    """AGG-2 / WIN-2 + AGG-3 + PRJ-8: monthly sales per (store, salesperson)."""
    attrs = ["store_id", "sales_person_id", "full_name", "sales_month"]
    base = sales_team_mart_df.select(
        "store_id", "sales_person_id",
        full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
        "sales_month", "total_cost")
    agg = base.groupBy(*attrs).agg(F.sum("total_cost").alias("total_sales"))
    if method == "groupby":
        return agg
    if method != "window":
        raise ValueError(method)
    w = Window.partitionBy("store_id", "sales_person_id", "sales_month")
    return agg.select(*attrs, F.sum("total_sales").over(w).alias("total_sales"))


def sales_team_rank(monthly: DataFrame, method: str = "split") -> DataFrame:
    """WIN-3 + SRT-1: rank of each salesperson within (store, month) by
    total, descending, ties share a rank.  Both methods run their windows over
    counted values cut into ranges: no (store, month) is sorted in one task."""
    if method not in ("split", "window"):
        raise ValueError(method)
    return rank_within(monthly, ["store_id", "sales_month"], "total_sales", out="rnk")


def sales_team_incentive(monthly: DataFrame, rate: str = "0.01") -> DataFrame:
    """WIN-4 + PRJ-9: ``rate`` of the monthly total for every salesperson
    ranked 1 in their store and month (ties all get it), 0 otherwise."""
    flagged = top_of_group(monthly, ["store_id", "sales_month"], "total_sales", out="_top")
    return flagged.select(
        "store_id", "sales_person_id", "full_name", "sales_month", "total_sales",
        incentive(F.col("_top"), "total_sales", rate).alias("incentive"))


def top_sellers(monthly: DataFrame) -> DataFrame:
    """SRT-2 filter form: the rank-1 rows of each (store, month)."""
    flagged = top_of_group(monthly, ["store_id", "sales_month"], "total_sales", out="_top")
    return flagged.where("_top").drop("_top")


def incentive_report(incentives: DataFrame) -> DataFrame:
    """EXT-1: per salesperson, store and month: billing and incentive."""
    return incentives.select(
        F.col("full_name").alias("sales_person_name"),
        F.col("store_id").alias("sales_person_store_id"),
        "sales_month",
        F.col("total_sales").alias("total_billing"),
        F.col("incentive").alias("total_incentive"))


def daily_products_per_customer(fact: DataFrame) -> DataFrame:
    """EXT-2: per customer and day: items bought and distinct products.

    Needs ``quantity`` and ``product_name``, i.e. the fact before PRJ-2.
    """
    return fact.groupBy("customer_id", "sales_date").agg(
        F.sum("quantity").alias("total_quantity"),
        F.countDistinct("product_name").alias("distinct_products"))
