"""Star enrichment of the sales fact (JN-1..5, PRJ-2..4, PRJ-10).

Each dimension is projected and renamed *before* its join, so the
enriched frame has unique column names (no ambiguous ``address`` or
``first_name``) and the scans read only the columns that survive.
All three joins are inner: facts whose key is unknown or NULL drop out,
as in the original job; ``unmatched_facts`` reports them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.operators.joins import join_dimension, small_enough

# Columns of the enriched fact, in order.
ENRICHED = [
    "customer_id", "store_id", "sales_person_id", "sales_date", "total_cost",
    "first_name", "last_name", "address", "pincode", "phone_number",
    "store_address", "store_manager_name",
    "sales_person_first_name", "sales_person_last_name", "manager_id", "is_manager",
    "sales_person_address", "sales_person_pincode",
]

FACT_KEEP = ["customer_id", "store_id", "sales_person_id", "sales_date", "total_cost"]


def customer_side(customer: DataFrame) -> DataFrame:
    """JN-1 right side; PRJ-2 drops customer_joining_date."""
    return customer.select("customer_id", "first_name", "last_name", "address",
                           "pincode", "phone_number")


def store_side(store: DataFrame) -> DataFrame:
    """JN-2 right side; PRJ-3 drops id, store_pincode, store_opening_date, reviews."""
    return store.select(F.col("id").alias("store_id"),
                        F.col("address").alias("store_address"),
                        "store_manager_name")


def sales_team_side(sales_team: DataFrame) -> DataFrame:
    """JN-3 right side; PRJ-4 renames the salesperson's columns (the
    unused joining_date is not carried)."""
    return sales_team.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id", "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
    )


def enrich_sales(fact: DataFrame, customer: DataFrame, store: DataFrame,
                 sales_team: DataFrame, store_bounded: bool = False,
                 keep: list[str] | None = None, last: str | None = None) -> DataFrame:
    """JN-4: fact ⋈ customer ⋈ store ⋈ sales_team (inner, equi).

    ``store_bounded`` declares the store dimension to be of fixed small
    size (always broadcast).  ``keep`` carries extra fact columns through
    (e.g. ``quantity`` for the per-day product report).  ``last`` ("customer" or
    "sales_team") is the dimension to join last, for a mart of that side alone: the names
    of the other are then not read, and where ``last`` is too large to be broadcast the
    rows leave the join as the sums of that side need them.
    """
    f = fact.select(*FACT_KEEP, *(keep or []))
    # Inner joins commute; the order is chosen for the shuffle plan:
    # sales_team first (reuses a fact already partitioned by salesperson),
    # the bounded store table as a broadcast, customer last.  The monthly
    # sales-team aggregate then gets its own exchange with map-side partial
    # sums, and the customer aggregate reuses the customer partitioning.
    # A sales_team that is broadcast comes behind the customer, as the store
    # does: what they add to a row is then not shuffled with it.
    sides = [(sales_team_side(sales_team), "sales_person_id", False), (store_side(store), "store_id", store_bounded),
             (customer_side(customer), "customer_id", False)]
    if last == "sales_team" or (last is None and small_enough(sides[0][0])):
        sides = sides[::-1]
    e = f
    for side, key, bounded in sides:
        e = join_dimension(e, side, key, bounded=bounded)
    return e.select(*ENRICHED, *(keep or []))


def unmatched_facts(fact: DataFrame, customer: DataFrame, store: DataFrame,
                    sales_team: DataFrame, store_bounded: bool = False) -> DataFrame:
    """Facts an inner star join would drop, with the dimension that misses.

    One pass over the fact: a left outer join per dimension to its distinct
    keys with a marker column.  Unlike an existence join this form is split
    by adaptive execution where one (unknown) key is hot; duplicate dimension
    keys cannot multiply rows, and a NULL key is dealt by its own row, so NULL
    keys neither match nor meet in one task.  A fact missing two dimensions is
    reported once per dimension.
    """
    # same order as the star join: a fact already partitioned by
    # salesperson is checked against sales_team without a new shuffle
    checks = (
        ("sales_team", "sales_person_id", sales_team.select(F.col("id").alias("sales_person_id")), False),
        ("store", "store_id", store.select(F.col("id").alias("store_id")), store_bounded),
        ("customer", "customer_id", customer.select("customer_id"), False),
    )
    marked = fact
    for name, key, keys, bounded in checks:
        # a hash of the row stands for a NULL key; the marker it may hit is not read
        k = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
        spread = F.coalesce(F.col(key), F.xxhash64(*[F.col(c) for c in fact.columns]))
        side = F.broadcast(k) if bounded or small_enough(keys) else k
        marked = (marked.withColumn("_s", spread).join(side, F.col("_s") == F.col("_k"), "left")
                  .withColumn(f"_has_{name}", F.col("_hit").isNotNull() & F.col(key).isNotNull())
                  .drop("_s", "_k", "_hit"))
    missing = F.filter(F.array(*[F.when(~F.col(f"_has_{n}"), F.lit(n)) for n, *_ in checks]),
                       lambda m: m.isNotNull())
    return marked.select(F.explode(missing).alias("missing_dimension"), *fact.columns)
