"""Seeded generators of sales drops and dimension rows (GEN-1..5, DDL-2,
SCL-13, SCL-14).

Rows are produced by ``spark.range`` with seeded ``rand`` columns, so the
generation is distributed and reproducible; nothing is built in Python
lists.  Values are invented.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from martforge.session import shuffle_partitions


# Invented product catalogue (name, unit price).
PRODUCTS = [
    ("tea", "3.50"), ("rice", "12.00"), ("lentils", "6.25"), ("soap", "2.10"),
    ("bread", "1.50"), ("milk", "0.95"), ("coffee", "8.40"), ("sugar", "1.80"),
    ("salt", "0.60"), ("oil", "9.75"), ("flour", "4.20"), ("honey", "7.30"),
    ("pasta", "2.60"), ("cheese", "11.90"), ("eggs", "3.10"),
]


def _pick(values: list, seed: int) -> Column:
    idx = (F.floor(F.rand(seed) * len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def sales(spark: SparkSession, rows: int, seed: int = 7, start: str = "2024-01-01",
          days: int = 163, customers: int = 20, stores: list[int] | None = None,
          people_per_store: int = 4, partitions: int | None = None) -> DataFrame:
    """GEN-1/2: clean sales rows (the 8 mandatory columns).

    ``days=1`` gives the single-day volume drop (GEN-2).  Salespeople are
    tied to stores: store i (0-based) employs ids i*k+1 … i*k+k.
    """
    stores = stores or [121, 122, 123]
    n = partitions or shuffle_partitions(spark)
    base = spark.range(0, rows, 1, n)
    store_idx = F.floor(F.rand(seed + 1) * len(stores)).cast("int")
    product_idx = (F.floor(F.rand(seed + 2) * len(PRODUCTS)) + 1).cast("int")
    names = F.array(*[F.lit(p) for p, _ in PRODUCTS])
    prices = F.array(*[F.lit(v).cast("decimal(18,2)") for _, v in PRODUCTS])
    df = base.select(
        (F.floor(F.rand(seed) * customers) + 1).cast("long").alias("customer_id"),
        store_idx.alias("_s"), product_idx.alias("_p"),
        F.date_add(F.lit(start).cast("date"), F.floor(F.rand(seed + 3) * days).cast("int"))
        .alias("sales_date"),
        (F.floor(F.rand(seed + 4) * people_per_store) + 1).cast("long").alias("_k"),
        (F.floor(F.rand(seed + 5) * 10) + 1).cast("int").alias("quantity"))
    df = df.select(
        "customer_id",
        F.element_at(F.array(*[F.lit(s).cast("long") for s in stores]), F.col("_s") + 1).alias("store_id"),
        F.element_at(names, F.col("_p")).alias("product_name"),
        "sales_date",
        (F.col("_s") * people_per_store + F.col("_k")).alias("sales_person_id"),
        F.element_at(prices, F.col("_p")).alias("price"),
        "quantity")
    return df.withColumn("total_cost", (F.col("price") * F.col("quantity")).cast("decimal(18,2)"))


def with_extra_column(df: DataFrame, seed: int = 11) -> DataFrame:
    """GEN-3: an extra ``payment_mode`` column (cash / UPI)."""
    return df.withColumn("payment_mode", _pick(["cash", "UPI"], seed))


def without_column(df: DataFrame, column: str = "store_id") -> DataFrame:
    """GEN-4: a mandatory column left out (the drop must be quarantined)."""
    return df.drop(column)


def customers(spark: SparkSession, n: int = 20, seed: int = 5) -> DataFrame:
    """GEN-5 / DDL-2: customer dimension rows with invented values."""
    first = ["Asha", "Ravi", "Mina", "Karan", "Leela", "Om", "Tara", "Dev"]
    last = ["Rao", "Shah", "Iyer", "Das", "Nair", "Gill", "Sen", "Bose"]
    return spark.range(1, n + 1).select(
        F.col("id").alias("customer_id"),
        _pick(first, seed).alias("first_name"), _pick(last, seed + 1).alias("last_name"),
        F.lit("12 Market Road").alias("address"), F.lit("560001").alias("pincode"),
        F.format_string("9%09d", (F.rand(seed + 2) * 1e9).cast("long")).alias("phone_number"),
        F.date_add(F.lit("2020-01-01").cast("date"),
                   F.floor(F.rand(seed + 3) * 1327).cast("int")).alias("customer_joining_date"))


def stores(spark: SparkSession, ids: list[int] | None = None) -> DataFrame:
    ids = ids or [121, 122, 123, 124]
    return spark.range(len(ids)).select(
        F.element_at(F.array(*[F.lit(i).cast("long") for i in ids]), (F.col("id") + 1).cast("int")).alias("id"),
        F.concat(F.lit("Plot "), F.col("id").cast("string")).alias("address"),
        F.lit("110001").alias("store_pincode"),
        F.concat(F.lit("Manager "), F.col("id").cast("string")).alias("store_manager_name"),
        F.lit("2022-01-01").cast("date").alias("store_opening_date"),
        F.lit("good").alias("reviews"))


def sales_team(spark: SparkSession, stores_n: int = 3, people_per_store: int = 4) -> DataFrame:
    n = stores_n * people_per_store
    return spark.range(1, n + 1).select(
        F.col("id"),
        F.concat(F.lit("Seller"), F.col("id").cast("string")).alias("first_name"),
        F.lit("Kumar").alias("last_name"),
        ((F.col("id") - 1) / people_per_store).cast("long").alias("manager_id"),
        F.lit("N").alias("is_manager"),
        F.lit("Office Lane").alias("address"), F.lit("400001").alias("pincode"),
        F.lit("2021-06-01").cast("date").alias("joining_date"))
