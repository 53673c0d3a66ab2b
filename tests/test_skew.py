"""Hot keys: one customer / one store-month holding a third of all rows."""
from pyspark.sql import functions as F

from martforge.operators import enrich, marts, ranking
from martforge.sources import generate

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed_fact(spark, rows=30000):
    f = generate.sales(spark, rows, seed=21).withColumn("additional_column", F.lit(None).cast("string"))
    hot = F.monotonically_increasing_id() % 3 == 0
    return f.withColumn("customer_id", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("customer_id")))


def test_hot_customer_join_is_split_and_totals_hold(spark):
    def run():
        fact = _skewed_fact(spark)
        e = enrich.enrich_sales(fact, generate.customers(spark), generate.stores(spark),
                                generate.sales_team(spark), store_bounded=True)
        m = marts.customer_monthly(marts.customer_mart(e))
        total = m.agg(F.sum("total_sales")).first()[0]
        m.collect()
        return total, fact.agg(F.sum("total_cost")).first()[0], \
            m._jdf.queryExecution().executedPlan().toString()
    total, expected, plan = _with_conf(spark, SKEW_CONF, run)
    assert total == expected
    assert "skew=true" in plan            # AQE split the hot customer's partition


def test_rank_of_a_hot_group_spreads_over_slices(spark):
    # 2/3 of the rows in one (store, month) group
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 != 0, F.lit(1)).otherwise(F.col("id") % 7).cast("long").alias("store_id"),
        F.lit("2024-01").alias("sales_month"),
        F.col("id").alias("sales_person_id"),
        ((F.col("id") * 7919) % 1000).cast("decimal(28,2)").alias("total_sales"))
    ranked = ranking.rank_within(df, ["store_id", "sales_month"], "total_sales", out="rnk", slices=8)
    slices = (df.withColumn("_g", F.struct("store_id", "sales_month"))
              .repartitionByRange(8, "_g", F.col("total_sales").desc_nulls_last())
              .where("store_id = 1").groupBy(F.spark_partition_id()).count().count())
    assert slices > 1                       # the hot group is cut into several slices
    want = ranking.rank_window(df, ["store_id", "sales_month"], "total_sales", out="rnk")
    assert ranked.exceptAll(want).count() == 0 and want.exceptAll(ranked).count() == 0


def test_window_rank_of_the_mart_sorts_no_whole_group(spark):
    df = spark.range(0, 4000).select(
        F.lit(1).cast("long").alias("store_id"), F.lit("2024-01").alias("sales_month"),
        F.col("id").alias("sales_person_id"), (F.col("id") * 31 % 500).cast("decimal(28,2)").alias("total_sales"))
    ranked = marts.sales_team_rank(df, method="window")
    assert "rank(" not in ranked._jdf.queryExecution().optimizedPlan().toString()
    want = ranking.rank_window(df, ["store_id", "sales_month"], "total_sales", out="rnk")
    assert ranked.exceptAll(want).count() == 0 and want.exceptAll(ranked).count() == 0


def test_rank_of_a_single_tie_folds(spark):
    df = spark.range(0, 6000).select(F.lit(1).alias("g"), F.col("id"), F.lit(None).cast("long").alias("v"))
    ranked = ranking.rank_within(df, ["g"], "v", out="r", slices=8)
    assert ranked.where("r <> 1").count() == 0 and ranked.count() == 6000


def test_unmatched_report_splits_a_hot_unknown_key(spark):
    def run():
        fact = _skewed_fact(spark)
        hot = fact.withColumn("customer_id", F.when(F.col("customer_id") == 1, F.lit(777777).cast("long"))
                              .otherwise(F.col("customer_id")))
        gone = hot.withColumn("customer_id", F.when(F.col("quantity") == 1, None).otherwise(F.col("customer_id")))
        rep = enrich.unmatched_facts(gone, generate.customers(spark), generate.stores(spark),
                                     generate.sales_team(spark))
        n = rep.where("missing_dimension = 'customer'").count()
        rep.collect()
        return n, gone.where("customer_id = 777777 or customer_id is null").count(), \
            rep._jdf.queryExecution().executedPlan().toString()
    n, want, plan = _with_conf(spark, SKEW_CONF, run)
    assert n == want and "skew=true" in plan


def test_shared_dir_refuses_a_cluster_without_a_shared_folder(monkeypatch):
    import pytest

    from martforge import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Fake:
        conf = Conf()

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None
    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())
    from martforge.functions.columns import _rate_type
    assert _rate_type("0.01") == "decimal(2,2)" and _rate_type("1.0") == "decimal(2,1)"
    assert _rate_type("0.00004") == "decimal(5,5)"
    with pytest.raises(ValueError):
        _rate_type("NaN")


def test_header_is_read_to_its_end():
    import io

    from martforge.sources.files import _first_line
    long = ",".join(f"c{i}" for i in range(30_000))
    assert _first_line(io.BytesIO(("\n \r\n" + long + "\r\nx").encode())) == long
    assert _first_line(io.BytesIO(b"")) is None and _first_line(io.BytesIO(b"\n\n")) is None
    assert _first_line(io.BytesIO("﻿a,b".encode())) == "a,b"
