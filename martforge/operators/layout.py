"""Input layout helpers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from martforge.operators.joins import _parse_bytes, estimated_bytes
from martforge.session import put_back, shuffle_partitions

# Inputs up to this size may be re-spread with a round-robin shuffle.
SPREAD_MAX_BYTES = 1 << 30


def partitions_of(df: DataFrame) -> int | None:
    """Number of partitions the physical plan of ``df`` produces (planning
    only, no job), or None when it cannot be asked (Spark Connect)."""
    try:
        return int(df._jdf.rdd().getNumPartitions())
    except Exception:
        return None


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None,
                       max_bytes: int = SPREAD_MAX_BYTES) -> DataFrame:
    """Spread a *small* scan that yields fewer partitions than the cluster
    has cores (e.g. a Parquet file with one row group) over all cores.

    Two checks bound the extra round-robin shuffle: the estimated input
    size must be at most ``max_bytes`` and the scan must have fewer
    partitions than ``min_partitions`` (default: the cluster's cores).  A
    large input is returned unchanged, however few splits it has.
    """
    spark = df.sparkSession
    size = estimated_bytes(df)
    if size is None or size > max_bytes:
        return df
    if min_partitions is None:
        try:
            min_partitions = spark.sparkContext.defaultParallelism
        except Exception:
            return df
    n = partitions_of(df)
    if n is None or n >= min_partitions:
        return df
    return df.repartition(min_partitions)


# Shuffled bytes that adaptive execution gives a task at most (its rows take
# some 17 times as much when they are sorted), and input bytes for each shuffle partition.
TASK_BYTES = 16 << 20
INPUT_BYTES = 2 << 20

_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(df: DataFrame) -> int:
    """Let the number of shuffle partitions follow the size of ``df``, the largest input of
    the queries to come, so that a task's memory does not: shuffles start with a partition
    for each ``INPUT_BYTES``, never fewer than the session's, and adaptive execution joins
    them up to ``TASK_BYTES`` (or what the session asks for, if that is less).  The next
    ``tune`` puts the session's own settings back."""
    spark = df.sparkSession
    put_back(spark)
    before = {k: spark.conf.get(k, None) for k in (_INITIAL, _ADVISORY)}
    n = max(int(before[_INITIAL] or shuffle_partitions(spark)), -(-(estimated_bytes(df) or 0) // INPUT_BYTES))
    spark.conf.set(_INITIAL, str(n))
    if _parse_bytes(before[_ADVISORY] or "64m") > TASK_BYTES:
        spark.conf.set(_ADVISORY, str(TASK_BYTES))
    spark._martforge_sized = before
    return n


@contextmanager
def task_bytes(spark: SparkSession, size: int):
    """Adaptive execution gives a task at most ``size`` shuffled bytes meanwhile (or what the
    session asks for, if that is less)."""
    before = spark.conf.get(_ADVISORY, None)
    if _parse_bytes(before or "64m") > size:
        spark.conf.set(_ADVISORY, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ADVISORY)
        else:
            spark.conf.set(_ADVISORY, before)
