"""Per-group ranking and top-of-group flags that survive hot groups.

``rank() OVER (PARTITION BY p ORDER BY v DESC)`` needs every row of a
group in one task.  When one group holds a large share of all rows that
task becomes the job.  ``rank_within`` computes the same numbers with the
group split across tasks:

1. count the rows of each (p, v) with partial sums: equal values, and a
   group that is one single tie, fold into one row per task;
2. range-partition these counted values on (p, v) and checkpoint: Spark
   samples the keys, so a hot group is cut into several contiguous slices;
3. a running sum inside each (slice, p), plus the sums of the group's
   earlier slices (a small table of at most slices + groups rows);
4. join the rank of each (p, v) back to the rows (a hot value is split by
   adaptive skew handling).

``top_of_group`` answers "is this row ranked 1?" without ranking at all:
``v <=> max(v)`` over the group, with the max computed by a partially
aggregated ``groupBy`` and joined back (AQE splits a hot join key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators.joins import join_dimension
from martforge.session import shared_dir, shuffle_partitions


def _order(value: str, descending: bool) -> Column:
    return F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()


def rank_window(df: DataFrame, group: list[str], value: str, out: str = "rank",
                descending: bool = True) -> DataFrame:
    """Plain window form (one task per group); for checks, no query takes it."""
    w = Window.partitionBy(*group).orderBy(_order(value, descending))
    return df.withColumn(out, F.rank().over(w))


def rank_within(df: DataFrame, group: list[str], value: str, out: str = "rank",
                descending: bool = True, slices: int | None = None) -> DataFrame:
    """SQL ``rank()`` per group, ordered by ``value`` (DESC NULLS LAST)."""
    spark = df.sparkSession
    n = slices or shuffle_partitions(spark)
    # a non-null composite key: NULL group values stay a group of their own
    keyed = df.withColumn("_rk_g", F.struct(*[F.col(c) for c in group]))
    # Slice ids come from a sampled range partitioner: the sliced values are
    # checkpointed once (to the shared checkpoint dir), so that running sums and
    # slice totals read the same slices when a task is run again.
    shared_dir(spark)
    keyed = keyed.checkpoint(eager=True)     # read twice: counted, and joined with the ranks
    counted = keyed.groupBy("_rk_g", F.col(value).alias("_rk_v")).agg(F.count(F.lit(1)).alias("_rk_n"))
    order_v = _order("_rk_v", descending)
    ranged = (counted.repartitionByRange(n, F.col("_rk_g"), order_v)
              .withColumn("_rk_s", F.spark_partition_id())
              .checkpoint(eager=True))
    earlier = (Window.partitionBy("_rk_s", "_rk_g").orderBy(order_v)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("_rk_l", F.coalesce(F.sum("_rk_n").over(earlier), F.lit(0)))
    sizes = ranged.groupBy("_rk_s", "_rk_g").agg(F.sum("_rk_n").alias("_rk_t"))
    before = (Window.partitionBy("_rk_g").orderBy("_rk_s")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_rk_s", "_rk_g",
                           F.coalesce(F.sum("_rk_t").over(before), F.lit(0)).alias("_rk_o"))
    ranks = (join_dimension(local, offsets, ["_rk_s", "_rk_g"])
             .select(F.col("_rk_g").alias("_rk_h"), "_rk_v",
                     (F.col("_rk_l") + F.col("_rk_o") + 1).cast("int").alias(out)))
    ranked = keyed.join(ranks, (F.col("_rk_g") == F.col("_rk_h")) & F.col(value).eqNullSafe(F.col("_rk_v")))
    return ranked.select(*df.columns, out)


def top_of_group(df: DataFrame, group: list[str], value: str, out: str = "is_top") -> DataFrame:
    """Flag rows whose ``value`` equals the group's maximum (rank 1 under
    DESC NULLS LAST ordering; an all-NULL group is all rank 1)."""
    gkey = F.struct(*[F.col(c) for c in group])
    keyed = df.withColumn("_tg_g", gkey)
    best = keyed.groupBy("_tg_g").agg(F.max(value).alias("_tg_max"))
    joined = join_dimension(keyed, best, "_tg_g")
    return joined.select(*df.columns, F.col(value).eqNullSafe(F.col("_tg_max")).alias(out))
