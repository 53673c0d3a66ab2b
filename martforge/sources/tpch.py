"""Canonical sales tables derived from the driver's TPC-H-style tables.

Mapping (fixed; the oracle SQL in ``martforge.plans.oracle`` states the
same mapping in DuckDB SQL):

=====================  ==================================================
fact.customer_id       orders.o_custkey via l_orderkey = o_orderkey
fact.store_id          supplier.s_nationkey via l_suppkey = s_suppkey
fact.sales_person_id   lineitem.l_suppkey
fact.product_name      part.p_name via l_partkey = p_partkey
fact.sales_date        CAST(l_shipdate AS DATE)
fact.quantity          CAST(l_quantity AS INT)
fact.total_cost        CAST(l_extendedprice AS DECIMAL(18,2))
fact.price             total_cost / quantity in whole cents, half-up
customer               customer (first/last name = c_name split on '#',
                       address = c_mktsegment, pincode = c_nationkey text)
store                  nation (manager = n_name)
sales_team             supplier (names = s_name split on '#')
product                part
=====================  ==================================================

Every reader selects only the columns it needs, so the Parquet scans are
pruned (``ReadSchema``) and Catalyst can push filters into them.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.columns import money
from martforge.operators.joins import join_dimension
from martforge.operators.layout import ensure_parallelism, size_shuffles


# Parquet schemas already inferred in this process, keyed by the file's
# path, size and modification time (a rewritten file is inferred again).
_SCHEMAS: dict[tuple, object] = {}


def _stamp(path: str) -> tuple | None:
    try:
        st = os.stat(path)
    except OSError:
        return None  # not a local path: no caching
    return (path, st.st_size, st.st_mtime_ns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Reading a Parquet file without a schema runs a
    small footer-reading job; for an unchanged local file the schema found
    the first time is reused."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = _stamp(path)
    if key is not None and key in _SCHEMAS:
        return spark.read.schema(_SCHEMAS[key]).parquet(path)
    df = spark.read.parquet(path)
    if key is not None:
        _SCHEMAS[key] = df.schema
        return spark.read.schema(_SCHEMAS[key]).parquet(path)
    return df


def price_cents_expr(total_cost: str = "total_cost", quantity: str = "quantity") -> str:
    """Unit price in whole cents, rounded half-up, in integer arithmetic.

    Written so that Spark and DuckDB compute bit-identical values
    (no binary floating point and no engine-specific decimal division).
    """
    cents = f"CAST({total_cost} * 100 AS BIGINT)"
    return f"(2 * {cents} + {quantity}) DIV (2 * {quantity})"


def price() -> Column:
    """Unit price of a row of ``sales_rows``."""
    return ((F.expr(price_cents_expr()).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)"))
            .cast("decimal(18,2)").alias("price"))


def sales_fact(spark: SparkSession, sf_dir: str, products: bool = True) -> DataFrame:
    """The conformed sales fact (schema ``schemas.SALES``): ``sales_rows`` with their price."""
    return sales_rows(spark, sf_dir, products).select(
        "customer_id", "store_id", "product_name", "sales_date", "sales_person_id", price(),
        "quantity", "total_cost", F.lit(None).cast("string").alias("additional_column"))


def sales_rows(spark: SparkSession, sf_dir: str, products: bool = True) -> DataFrame:
    """The columns of the sales fact that come from the tables.

    lineitem ⋈ orders ⋈ supplier, with the name of the part (null if it is unknown: no
    sale is lost for it).  Without ``products`` the name is null and ``part`` is neither
    read nor joined; where it is too large to be broadcast, that is one shuffle of the
    fact less.  orders, supplier and part all
    grow with the scale factor, so none is broadcast unconditionally:
    ``join_dimension`` broadcasts only below a checked size and otherwise
    leaves a shuffle join that AQE may still convert at run time.
    """
    li = ensure_parallelism(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *(["l_partkey"] if products else []), "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("store_id"))

    # supplier last: when these are shuffle joins, the fact leaves this
    # step hash-partitioned by l_suppkey (= sales_person_id), which the
    # sales-team join of the enrichment then reuses without a new shuffle
    size_shuffles(li)
    # a day takes less room in the shuffle files than a time
    li = li.select(F.col("l_shipdate").cast("date").alias("sales_date"), *[c for c in li.columns if c != "l_shipdate"])
    f = join_dimension(li, orders, "l_orderkey")
    if products:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("product_name"))
        f = join_dimension(f, part, "l_partkey", how="left")
    else:
        f = f.withColumn("product_name", F.lit(None).cast("string"))
    f = join_dimension(f, supplier, "l_suppkey")
    return f.select(
        F.col("customer_id"),
        F.col("store_id"),
        F.col("product_name"),
        "sales_date",
        F.col("l_suppkey").alias("sales_person_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("total_cost"),
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("c_mktsegment").alias("address"),
        F.col("c_nationkey").cast("string").alias("pincode"),
        F.concat(F.lit("+"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("phone_number"),
        F.lit(None).cast("date").alias("customer_joining_date"),
    )


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("address"),
        F.col("n_regionkey").cast("string").alias("store_pincode"),
        F.col("n_name").alias("store_manager_name"),
        F.lit(None).cast("date").alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )


def sales_team_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.split_part(F.col("s_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("s_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("s_nationkey").cast("long").alias("manager_id"),
        F.lit("N").alias("is_manager"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("address"),
        F.col("s_nationkey").cast("string").alias("pincode"),
        F.lit(None).cast("date").alias("joining_date"),
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("current_price"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("old_price"),
        F.lit(None).cast("timestamp").alias("created_date"),
        F.lit(None).cast("timestamp").alias("updated_date"),
        F.lit(None).cast("date").alias("expiry_date"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three dimensions the star join uses (product is not joined)."""
    return {
        "customer": customer_dim(spark, sf_dir),
        "store": store_dim(spark, sf_dir),
        "sales_team": sales_team_dim(spark, sf_dir),
    }


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events derived from ``orders`` (one drop file per order).

    Fixed rule: every order's file is opened ('A', seq 0) on its order
    date; orders with status F or P are closed ('I', seq 1) a day later;
    status P files are re-opened at that same instant (seq 2), so their
    latest state is decided by ``seq``.  ``length`` is o_orderkey + 1000.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    name = F.concat(F.lit("drop_"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    ts = F.col("o_orderdate").cast("timestamp")
    base = o.select(
        name.alias("file_name"),
        F.concat(F.lit("landing/"), name).alias("file_path"),
        (F.col("o_orderkey") + 1000).alias("length"),
        ts.alias("modification_time"),
        (F.year(ts) * 100 + F.month(ts)).cast("long").alias("run_id"),
        "o_orderstatus", ts.alias("t0"))
    later = F.col("t0") + F.expr("INTERVAL 1 DAY")
    ev = F.array(
        F.struct(F.lit("A").alias("status"), F.col("t0").alias("event_ts"), F.lit(0).alias("seq")),
        F.when(F.col("o_orderstatus").isin("F", "P"),
               F.struct(F.lit("I").alias("status"), later.alias("event_ts"), F.lit(1).alias("seq"))),
        F.when(F.col("o_orderstatus") == "P",
               F.struct(F.lit("A").alias("status"), later.alias("event_ts"), F.lit(2).alias("seq"))))
    exploded = base.select("*", F.explode(F.filter(ev, lambda e: e.isNotNull())).alias("e"))
    return exploded.select("file_name", "file_path", "length", "modification_time", "run_id",
                           "e.status", "e.event_ts", "e.seq")


def landing_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drop files in the landing folder: one per order.  Those of low
    priority orders were delivered again two days later, under the same name
    (a manifest: path, file_name, length, mtime)."""
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("drop_"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    first = F.col("o_orderdate").cast("timestamp")
    return o.select(F.concat(F.lit("landing/"), name).alias("path"), name.alias("file_name"),
                    (F.col("o_orderkey") + 1000).alias("length"),
                    F.when(F.col("o_orderpriority") == "5-LOW", first + F.expr("INTERVAL 2 DAYS"))
                    .otherwise(first).alias("modification_time"))


# The runs of the ledger's life (id, instant; files delivered before it are
# listed), and the priority whose files are rejected.
LEDGER_RUNS = [(1, "1997-01-01"), (2, "1999-01-01"), (3, "2001-01-01")]
LEDGER_REJECTS = "4-NOT SPECIFIED"


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery of a drop file: one per order, and for low priority orders a second
    one under the same name two days later."""
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("drop_"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    first = F.col("o_orderdate").cast("timestamp")
    times = F.when(F.col("o_orderpriority") == "5-LOW", F.array(first, first + F.expr("INTERVAL 2 DAYS"))) \
        .otherwise(F.array(first))
    return o.select(F.concat(F.lit("landing/"), name).alias("path"), name.alias("file_name"),
                    (F.col("o_orderkey") + 1000).alias("length"), F.explode(times).alias("modification_time"),
                    "o_orderstatus", "o_orderpriority")


def listing_at(delivered: DataFrame, end: str) -> DataFrame:
    """The landing folder at an instant: the latest delivery of each name before it."""
    keys = [c for c in delivered.columns if c != "modification_time"]
    return (delivered.where(F.col("modification_time") < F.lit(end).cast("timestamp"))
            .groupBy(*keys).agg(F.max("modification_time").alias("modification_time")))
