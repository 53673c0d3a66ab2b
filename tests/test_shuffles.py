"""The size of a task follows neither the input nor the session's number of partitions."""
import re

from conftest import SF_SMALL
from martforge.operators import layout
from martforge.plans import catalog
from martforge.session import tune

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _partitions(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(r"Exchange hashpartitioning\(customer_id.*?, (\d+)\), ENSURE", plan)}


def test_shuffle_partitions_follow_the_input(spark, monkeypatch):
    tune(spark)                 # what earlier tests sized is put back
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get(INITIAL, None), spark.conf.get(ADVISORY, None)
    assert _partitions(catalog.q_customer_monthly_window(spark, SF_SMALL)) == {own}      # small: the session's
    assert int(spark.conf.get(ADVISORY).rstrip("b")) <= 16 << 20
    monkeypatch.setattr(layout, "INPUT_BYTES", 1 << 10, raising=False)
    few = max(_partitions(catalog.q_customer_monthly_window(spark, SF_SMALL)))
    monkeypatch.setattr(layout, "INPUT_BYTES", 1 << 9, raising=False)
    more = max(_partitions(catalog.q_customer_monthly_window(spark, SF_SMALL)))
    assert own < few and 2 * few - 2 < more <= 2 * few
    tune(spark)
    assert (spark.conf.get(INITIAL, None), spark.conf.get(ADVISORY, None)) == before
