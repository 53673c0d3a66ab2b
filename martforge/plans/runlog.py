"""The manifest of runs (ORC-1): which stages a run has finished.

A stage writes its outputs below the run's id (overwriting what an interrupted attempt
left) and is then recorded here; a run that is taken up again skips the stages recorded.
One small Parquet row per stage, appended: a crash leaves a stage either recorded or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.operators.ledger import read_or_empty

RUNS = T.StructType([T.StructField("run_id", T.LongType()), T.StructField("stage", T.StringType()),
                     T.StructField("clock", T.LongType())])

# The first and last record of a run.
STARTED, DONE = "started", "done"


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RUNS)


def _per_run(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path).groupBy("run_id").agg(
        F.max(F.col("stage") == DONE).alias("done"), F.min(F.when(F.col("stage") == STARTED, F.col("clock"))).alias("c"))


def open_runs(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the runs that have a record but are not done."""
    return _per_run(spark, path).where("not done").select("run_id")


def unfinished(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(run id, epoch seconds of its start) of the latest run that started and is not done."""
    r = _per_run(spark, path).where("not done and c is not null").orderBy(F.desc("run_id")).limit(1).first()
    return (r["run_id"], r["c"]) if r else None


class RunLog:
    """Stages of one run."""

    def __init__(self, spark: SparkSession, path: str, run_id: int):
        self.spark, self.path, self.run_id = spark, path, run_id
        # as many rows as a run has stages
        self.done = {r.stage for r in read(spark, path).where(F.col("run_id") == run_id).select("stage").collect()}

    def finished(self, stage: str) -> bool:
        return stage in self.done

    def finish(self, stage: str, clock: int = 0) -> None:
        row = self.spark.createDataFrame([(self.run_id, stage, clock)], RUNS)
        row.coalesce(1).write.mode("append").parquet(self.path)
        self.done.add(stage)
