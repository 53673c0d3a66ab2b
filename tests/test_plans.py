"""Physical-plan properties the design relies on."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martforge.operators import joins
from martforge.plans import catalog


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_nation_is_broadcast(spark):
    p = _plan(catalog.q_sales_team_incentive(spark, SF_SMALL))
    assert "ReadSchema: struct<n_nationkey:int>" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_shipdate" in p
    assert "BroadcastHashJoin" in p


def test_monthly_aggregate_is_partial(spark):
    p = _plan(catalog.q_customer_monthly(spark, SF_SMALL))
    assert "partial_sum" in p
    assert p.count("Exchange hashpartitioning(customer_id") == 1


def test_pushed_filter_reaches_scan(spark):
    df = catalog.tpch.table(spark, SF_SMALL, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in _plan(df)


def test_broadcast_only_below_checked_size(spark):
    small = spark.range(10)
    big = catalog.tpch.table(spark, SF_SMALL, "lineitem")
    assert joins.small_enough(small, 1 << 20)
    assert not joins.small_enough(big, 1024)
    j = joins.join_dimension(spark.range(100).withColumnRenamed("id", "k"),
                             big.select(F.col("l_orderkey").alias("k")), "k", max_broadcast_bytes=1024)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(j.select("k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_only_small_under_split_inputs(spark):
    from martforge.operators.layout import ensure_parallelism
    li = catalog.tpch.table(spark, SF_SMALL, "lineitem")
    spread = ensure_parallelism(li, min_partitions=8)
    assert "RoundRobinPartitioning(8)" in _plan(spread)
    assert ensure_parallelism(li, min_partitions=8, max_bytes=1024) is li     # too big: unchanged
    assert ensure_parallelism(li, min_partitions=1) is li                     # enough splits


def test_marts_read_no_part(spark):
    """The name of the product is in none of the marts: part is joined for it alone."""
    from martforge.sources import tpch

    for fn in (catalog.q_customer_monthly, catalog.q_sales_team_monthly, catalog.q_enriched_sales):
        assert "p_partkey" not in fn(spark, SF_SMALL)._jdf.queryExecution().toString()
    with_names = catalog.enriched(spark, SF_SMALL, keep=["product_name"])
    assert with_names.where("product_name is null").count() == 0
    assert with_names.count() == catalog.enriched(spark, SF_SMALL).count()
    whole, bare = (tpch.sales_fact(spark, SF_SMALL, products=x) for x in (True, False))
    assert whole.schema == bare.schema
    assert whole.drop("product_name").exceptAll(bare.drop("product_name")).count() == 0
