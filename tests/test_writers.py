"""Clustered writes: one pass over the input, hot folders cut, reports in one order."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from martforge.sinks import writers


@pytest.fixture()
def small_slices(spark):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def _sales(spark, n=40000):
    """Nine of ten rows are one salesperson's in one month and store."""
    hot = F.col("id") % 10 != 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, F.lit("2024-01")).otherwise(F.concat(F.lit("2024-"), F.lpad((F.col("id") % 3 + 2).cast("string"), 2, "0")))
        .alias("sales_month"),
        F.when(hot, F.lit(1)).otherwise(F.col("id") % 7).alias("store_id"),
        F.when(hot, F.lit(5)).otherwise(F.col("id") % 11).alias("sales_person_id"), F.col("id").alias("total_cost"))


def test_hot_folder_is_cut_and_the_input_runs_once(spark, tmp, small_slices):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    df = _sales(spark)
    writers.write_partitioned(df.mapInPandas(counted, df.schema), f"{tmp}/p", ["sales_month", "store_id"],
                              ["sales_person_id"])
    assert seen.value == 40000                                   # no sampling pass
    hot = glob.glob(f"{tmp}/p/sales_month=2024-01/store_id=1/*.parquet")
    assert len(hot) > 1                                          # one salesperson's month, several tasks
    sizes = [spark.read.parquet(f).count() for f in hot]
    assert max(sizes) < 36000 / 2
    back = spark.read.parquet(f"{tmp}/p")
    assert back.count() == 40000
    assert back.where("sales_month = '2024-01'").groupBy("store_id").count().collect()[0]["count"] == 36000
    # a small folder is cut only where it shares a shuffle partition with the hot one
    cold = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{tmp}/p/*/*") if "2024-01" not in d]
    assert len(cold) == 21 and cold.count(1) > 10 and max(cold) <= len(hot)


def test_the_writer_sorts_no_second_time(spark):
    plan = writers.cluster_for_partitions(_sales(spark), ["sales_month", "store_id"], ["sales_person_id"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in text and "Sort [sales_month" in text
    assert not {f.name: f.nullable for f in plan.schema.fields}["sales_month"]


def test_null_and_empty_months_share_a_folder(spark, tmp):
    df = spark.createDataFrame([(None, 1), ("", 2), ("2024-01", 3)], "sales_month string, v int")
    writers.write_partitioned(df, f"{tmp}/p", ["sales_month"])
    assert sorted(map(tuple, spark.read.parquet(f"{tmp}/p").select("v", "sales_month").collect()), key=repr) == \
        [(1, None), (2, None), (3, "2024-01")]
    writers.write_partitioned(df.limit(0), f"{tmp}/none", ["sales_month"])
    assert spark.read.schema("v int, sales_month string").parquet(f"{tmp}/none").count() == 0


def test_without_adaptive_execution_it_raises(spark, tmp):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError):
            writers.write_partitioned(_sales(spark, 10), f"{tmp}/p", ["sales_month"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_report_of_a_hot_month(spark, tmp):
    df = _sales(spark, 4000).select("sales_month", F.col("total_cost").alias("rank"),
                                    F.concat(F.lit("person, "), F.col("total_cost")).alias("who"))
    writers.write_csv_report(df, f"{tmp}/r", ["sales_month"], ["rank"], rows_per_file=1000)
    files = sorted(glob.glob(f"{tmp}/r/sales_month=2024-01/*.csv"), key=os.path.basename)
    assert len(files) > 2
    ranks = []
    for f in files:
        with open(f) as lines:
            head, *rows = lines.read().splitlines()
        assert head == "rank,who" and len(rows) <= 1000
        ranks += [int(r.split(",")[0]) for r in rows]
    assert ranks == sorted(i for i in range(4000) if i % 10)      # one order over the files
    back = spark.read.option("header", True).csv(f"{tmp}/r")
    assert back.count() == 4000 and back.where("who = 'person, 7'").count() == 1
