"""What the marts of the stream, and the drops that it reads, leave and shuffle on disk."""
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from martforge.functions.columns import full_name
from martforge.operators import enrich, marts
from martforge.session import tune
from martforge.sinks import writers
from martforge.sources import drops, generate, tpch
from martforge.streaming import monthly
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _dims(spark):
    return monthly.Dimensions(generate.customers(spark), generate.stores(spark), generate.sales_team(spark),
                              store_bounded=True, merge_every=2)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_shuffle_files_go_with_their_write(spark, tmp):
    before = _shuffle_files(spark)
    df = spark.range(0, 2000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count()
    writers.write(df, f"{tmp}/a")
    drops.write_drop(df, f"{tmp}/b", ["k", "count"])
    drops.many_shapes(tpch.sales_rows(spark, SF_SMALL), f"{tmp}/c", {"price": tpch.price()})
    tune(spark)
    for _ in range(50):                      # they are removed in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.read.parquet(f"{tmp}/a").count() == 7


def test_a_batch_leaves_no_table_of_all_sales(spark, tmp):
    out = f"{tmp}/out"
    monthly.add_batch(spark, out, generate.sales(spark, 60, seed=1), 0, _dims(spark))
    assert sorted(os.listdir(out)) == ["customer_monthly", "sales_team_monthly"]


def test_a_mart_shuffles_its_own_side_alone(spark, no_broadcast):
    d, sales = _dims(spark), generate.sales(spark, 60, seed=1)
    rows = lambda last: enrich.enrich_sales(sales, d.customer, d.store, d.sales_team, store_bounded=True, last=last)
    p = _plan(marts.customer_monthly(marts.customer_mart(rows("customer"))))
    assert "sales_person_first_name" not in p and "hashpartitioning(customer_id" in p
    assert p.count("Exchange hashpartitioning") == 4           # two sides of two joins, none for the sums
    p = _plan(marts.sales_team_monthly(marts.sales_team_mart(rows("sales_team"))))
    assert "phone_number" not in p and p.count("Exchange hashpartitioning") == 4


def test_the_order_of_the_joins_changes_no_row(spark):
    d = _dims(spark)
    twice = d.customer.unionByName(d.customer.where("customer_id = 3")).where("customer_id <> 5")
    team = d.sales_team.where("id <> 2").unionByName(d.sales_team.where("id = 4"))
    sales = generate.sales(spark, 200, seed=2)
    got = [sorted(map(repr, enrich.enrich_sales(sales, twice, d.store, team, True, last=x).collect()))
           for x in (None, "customer", "sales_team")]
    assert got[0] and got[0] == got[1] == got[2]


def test_parts_are_sorted_and_merged_by_what_they_are_of(spark, tmp):
    out, d = f"{tmp}/out", _dims(spark)
    for i in range(3):
        monthly.add_batch(spark, out, generate.sales(spark, 300, seed=i), i, d)
    p = _plan(monthly.customer_monthly(spark, out))
    assert p.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(customer_id" in p
    assert "sales_date_month" not in p[p.index("Exchange hashpartitioning"):].split("\n")[0]
    files = glob.glob(f"{out}/customer_monthly/*/*/*.parquet")
    assert len(files) >= 3
    for f in files:
        ids = [r.customer_id for r in spark.read.parquet(f).collect()]
        assert ids == sorted(ids)


def test_nulls_and_variants_keep_their_rows_of_the_mart(spark, tmp):
    """Null keys, months and totals, and one customer under two addresses, over a merge."""
    out, d = f"{tmp}/out", _dims(spark)
    moved = d.customer.unionByName(d.customer.where("customer_id = 1").withColumn("address", F.lit(None).cast("string")))
    d = monthly.Dimensions(moved, d.store, d.sales_team, True, merge_every=2)
    odd = (generate.sales(spark, 80, seed=7)
           .withColumn("sales_date", F.when(F.col("quantity") != 3, F.col("sales_date")))
           .withColumn("total_cost", F.when(F.col("quantity") != 4, F.col("total_cost")))
           .withColumn("customer_id", F.when(F.col("quantity") != 5, F.col("customer_id"))))
    for i in range(3):
        monthly.add_batch(spark, out, odd, i, d)
    whole = odd.unionByName(odd).unionByName(odd)
    plain = (whole.join(moved, "customer_id").join(d.store.select(F.col("id").alias("store_id")), "store_id")
             .join(d.sales_team.select(F.col("id").alias("sales_person_id")), "sales_person_id")
             .groupBy("customer_id", full_name("first_name", "last_name").alias("full_name"), "address", "phone_number",
                      F.date_format("sales_date", "yyyy-MM").alias("sales_date_month"))
             .agg(F.sum("total_cost").cast("decimal(28,2)").alias("total_sales")))
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(plain) == key(monthly.customer_monthly(spark, out))


def test_drops_become_text_behind_their_shuffle(spark, tmp):
    rows = tpch.sales_rows(spark, SF_SMALL)
    p = _plan(drops.shape_lines(rows, {"price": tpch.price()}))
    dealt = p.index("Exchange hashpartitioning(shape")
    assert p.index("BroadcastHashJoin [shape") < dealt                                   # parents are printed first
    assert " div " in p[:dealt] and " div " not in p[dealt:]                             # the price is computed there
    drops.many_shapes(rows, f"{tmp}/a", {"price": tpch.price()})
    drops.many_shapes(tpch.sales_fact(spark, SF_SMALL), f"{tmp}/b")
    tune(spark)
    read = lambda r: {f.split("/")[-2]: open(f).read().split("\n")[:-1] for f in glob.glob(f"{r}/*/*.csv")}
    a, b = read(f"{tmp}/a"), read(f"{tmp}/b")
    assert len(a) == drops.SHAPES and a.keys() == b.keys()
    for name, lines in a.items():
        assert lines[0] == b[name][0] == ",".join(drops.shape_columns(int(name.removeprefix("drop="))))
        assert sorted(lines[1:]) == sorted(b[name][1:])
    assert sum(len(x) - 1 for x in a.values()) == rows.count()
