"""JDBC on embedded Derby inside this JVM (no server, no port): split reads, run-wise writes."""
import pytest
from pyspark.sql import functions as F

from martforge.sinks import writers
from martforge.sources import tables

PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _url(tmp):
    return f"jdbc:derby:{tmp}/derby;create=true"


def _sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_split_read_is_even(spark, tmp):
    """Keys lie in two far clumps, some are NULL, one key has a sixth of all rows."""
    keys = spark.range(3000).select(
        F.when(F.col("id") < 1500, F.col("id")).when(F.col("id") < 2400, F.col("id") + 10**12)
        .when(F.col("id") < 2900, F.lit(777)).alias("K"), F.col("id").alias("V"))
    writers.write_jdbc(keys, _url(tmp), "T", mode="overwrite", properties=PROPS)
    df = tables.read_jdbc_split(spark, _url(tmp), "T", '"K"', 8, PROPS, bins=16)
    sizes = _sizes(df)
    assert sum(sizes) == 3000 and df.select("V").distinct().count() == 3000
    # 363 rows a range; the hot key with its step, and the NULL keys with the first range
    assert 8 <= df.rdd.getNumPartitions() <= 17
    assert sorted(sizes)[-2] <= 363 + 100 and max(sizes) <= 501 + 363


def test_split_read_of_odd_tables(spark, tmp):
    one = spark.createDataFrame([(None, 1), (5, 2), (5, 3)], "K long, V long")
    writers.write_jdbc(one.limit(0), _url(tmp), "EMPTY_T", mode="overwrite", properties=PROPS)
    writers.write_jdbc(one, _url(tmp), "ONE_T", mode="overwrite", properties=PROPS)
    writers.write_jdbc(one.where("K is null"), _url(tmp), "NULL_T", mode="overwrite", properties=PROPS)
    read = lambda t, n=4: tables.read_jdbc_split(spark, _url(tmp), t, '"K"', n, PROPS).count()
    assert (read("EMPTY_T"), read("ONE_T"), read("NULL_T"), read("ONE_T", 1)) == (0, 3, 1, 3)


def test_a_run_is_written_once(spark, tmp):
    url = _url(tmp)
    df = spark.range(100).select(F.col("id").alias("customer_id"), (F.col("id") * 2).alias("total"))
    back = lambda: tables.read_jdbc(spark, url, "MART", PROPS).groupBy("run_id").agg(
        F.count("*").alias("n"), F.sum("total").alias("s")).orderBy("run_id").collect()
    writers.write_jdbc_run(df, url, "MART", 1, PROPS)
    assert [tuple(r) for r in back()] == [(1, 100, 9900)]
    writers.write_jdbc_run(df, url, "MART", 1, PROPS)                    # the run again
    writers.write_jdbc_run(df.limit(10), url, "MART", 2, PROPS)
    assert [tuple(r) for r in back()] == [(1, 100, 9900), (2, 10, 90)]
    broken = df.withColumn("total", F.when(F.col("customer_id") == 99, F.raise_error("lost").cast("long"))
                           .otherwise(F.col("total")))
    with pytest.raises(Exception):                                       # a task fails midway
        writers.write_jdbc_run(broken, url, "MART", 3, PROPS)
    assert [tuple(r) for r in back()] == [(1, 100, 9900), (2, 10, 90)]
    writers.write_jdbc_run(df, url, "MART", 3, PROPS)                    # taken up
    assert [tuple(r) for r in back()] == [(1, 100, 9900), (2, 10, 90), (3, 100, 9900)]
