"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

Operators cut lineage by writing a table there and reading it back: a lost
executor then costs the tasks of one step, never the whole history.  The
shuffle files of the step that wrote the table are dropped at its end, so
disk use is that of the largest step, not the sum of all steps.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from martforge.session import shared_dir, shuffle_partitions

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def save(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back."""
    path = shared_dir(spark, f"llm-{name}")
    with _setting(spark, CLEANUP, "true"):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Delete tables made by ``save`` once nothing reads them any more."""
    for t in tables:
        path = getattr(t, "_scratch", None)
        if path:
            jvm = spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def dense_order(spark: SparkSession, keys: DataFrame, cols: list[str], out: str, distinct: bool = False) -> DataFrame:
    """Number distinct rows 0, 1, ... in ascending order of ``cols``; ``distinct`` says that they are so already.

    Range-partitioned sort; only one count per partition is summed (a table
    of as many rows as partitions).  The numbered table is materialised, so
    the numbers do not change when a task is run again.
    """
    n = shuffle_partitions(spark)
    keys = keys.select(*cols) if distinct else keys.select(*cols).distinct()
    ranged = (keys.repartitionByRange(n, *cols)
              .sortWithinPartitions(*cols)
              .withColumn("_at", F.monotonically_increasing_id()))
    t = save(spark, ranged, "order")
    pid = F.shiftright(F.col("_at"), 33)
    # one row per partition of the sort, bounded by the partition count: one task adds them up
    counts = t.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).coalesce(1)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    done = (t.withColumn("_pid", pid).join(F.broadcast(starts), "_pid")
            .withColumn(out, F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1))
            .select(*cols, out))
    done._scratch = t._scratch
    return done


PLAN_TEXT = "spark.sql.maxPlanStringLength"


def settings(spark: SparkSession) -> None:
    """Batches for Python workers are small: texts may be long.  The driver keeps the text of
    a thousand plans: each is cut, unless the session has a limit of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "250")
    if spark.conf.get(PLAN_TEXT, None) is None:
        spark.conf.set(PLAN_TEXT, "8192")
