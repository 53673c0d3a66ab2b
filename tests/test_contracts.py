"""Contract of the dimensions: shapes and keys."""
import pytest
from pyspark.sql import functions as F

from martforge.config import PipelineConfig
from martforge.operators import contracts
from martforge.plans.pipeline import run_pipeline
from martforge.sources import generate


def _found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_generated_dimensions_keep_it(spark):
    dims = {"customer": generate.customers(spark), "store": generate.stores(spark),
            "sales_team": generate.sales_team(spark)}
    assert _found(contracts.dimension_violations(dims)) == []


def test_shapes(spark):
    df = spark.createDataFrame([(1, "a")], "id int, address string").withColumn("store_pincode", F.lit(7))
    got = _found(contracts.shape_violations(df, contracts.DECLARED["store"][0], "store"))
    missing = ["reviews", "store_manager_name", "store_opening_date"]     # int fits long, extras are free
    assert got == sorted([("store", "missing column", c, None, None) for c in missing]
                         + [("store", "type", "store_pincode", None, None)], key=repr)


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, None), (3, "x"), (None, "n"), (4, None), (4, None)],
                               "k long, v string")
    assert _found(contracts.key_violations(df, ["k"], "d")) == [
        ("d", "duplicate key", "1", 2, False), ("d", "duplicate key", "2", 2, True),
        ("d", "duplicate key", "4", 2, False), ("d", "null key", "NULL", 1, False)]
    assert _found(contracts.key_violations(df.select("k").distinct().where("k is not null"), ["k"], "d")) == []
    assert _found(contracts.key_violations(df.limit(0), ["k"], "d")) == []
    both = contracts.key_violations(df, ["k", "v"], "d")
    assert _found(both.where("problem = 'duplicate key'")) == [("d", "duplicate key", "1,a", 2, False)]


def test_pipeline_refuses_or_reports(spark, tmp):
    c, s, t = generate.customers(spark), generate.stores(spark), generate.sales_team(spark)
    twice = c.unionByName(c.where("customer_id = 1"))
    (generate.sales(spark, 20, seed=1).coalesce(1).write.option("header", True).csv(f"{tmp}/landing"))
    conf = dict(landing=f"{tmp}/landing", output=f"{tmp}/out", ledger=f"{tmp}/ledger")
    with pytest.raises(contracts.ContractError, match="duplicate key 1"):
        run_pipeline(spark, PipelineConfig(**conf, check_dimensions="fail"), twice, s, t, run_id=1)
    res = run_pipeline(spark, PipelineConfig(**conf, check_dimensions="report"), twice, s, t, run_id=2)
    assert [r.subject for r in spark.read.parquet(res.outputs["dimension_violations"]).collect()] == ["1"]
