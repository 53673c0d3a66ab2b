"""Monthly marts of the incremental ingest (STR-1, AGG-1, AGG-2, WIN-4).

A micro-batch joins its own rows to the dimensions, for each mart with the names of its own
side alone (a table of all sales with all names would be several times the sales), and writes
partial sums of the monthly totals below ``part/batch_id=<id>``.  Totals are sums, so the mart is the sum of
the partial sums; every ``merge_every`` batches these are merged into one table
``merged/upto=<id>``, so a reader sums one merged table and a bounded number of parts.

Replays change nothing: an output that stands (its write was committed) is kept, one that
does not is written again, and ``upto`` tells which parts a merged table holds.  Ranks and
incentives need whole months, so they are computed on the merged totals when read.

Names and addresses are those that the dimensions had when the part was written: a customer whose
attributes change has one row per variant, as ``marts.customer_monthly`` has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators import enrich, layout, marts
from martforge.sinks import writers
from martforge.sources import folders

TOTAL = "decimal(28,2)"    # of a sum of money: 26 digits before the point
# shuffled bytes of a task: narrow rows that are joined to names, summed and sorted take some
# 30 times as much there
TASK_BYTES = 6 << 20
CUSTOMER, SALES_TEAM = "customer_monthly", "sales_team_monthly"


@dataclass(frozen=True)
class Dimensions:
    customer: DataFrame
    store: DataFrame
    sales_team: DataFrame
    store_bounded: bool = False
    merge_every: int = 16      # batches


def _merges(spark: SparkSession, base: str) -> list[int]:
    """Last batch of each merged table that stands, ascending."""
    found = [int(n.removeprefix("upto=")) for n in folders.names(spark, f"{base}/merged") if n.startswith("upto=")]
    return sorted(i for i in found if folders.finished(spark, f"{base}/merged/upto={i}"))


def _once(df: DataFrame, path: str) -> None:
    """Sums sorted by what they are of: a name is next to itself, in the file and in the
    shuffle files of the next merge, where it then takes next to no room."""
    spark = df.sparkSession
    if not folders.finished(spark, path):
        with layout.task_bytes(spark, TASK_BYTES):
            writers.write(df.sortWithinPartitions(*_keys(df)), path, compression="zstd")


def _keys(totals: DataFrame) -> list[str]:
    """What the months of a row of ``totals`` are of: the columns but the month and the total."""
    return totals.columns[:-2]


def _totals(spark: SparkSession, base: str, last: int | None = None) -> DataFrame:
    """Sums over the newest merged table and the parts behind it (up to batch ``last``).

    The rows are dealt out by all but their month: the months of a customer stay together, as
    they were sorted.  Each part has one row per key and month, so no key is hot."""
    done = _merges(spark, base)
    upto = done[-1] if done else -1
    parts = spark.read.parquet(f"{base}/part").where(F.col("batch_id") > upto)
    if last is not None:
        parts = parts.where(F.col("batch_id") <= last)
    parts = parts.drop("batch_id")
    if done:
        parts = parts.unionByName(spark.read.parquet(f"{base}/merged/upto={upto}"))
    attrs = parts.columns[:-1]
    return parts.repartition(*_keys(parts)).groupBy(*attrs).agg(F.sum("total_sales").cast(TOTAL).alias("total_sales"))


def add_batch(spark: SparkSession, output: str, sales: DataFrame, batch_id: int, dims: Dimensions) -> None:
    """The partial sums of one micro-batch's conformed ``sales`` (a table that stands: each
    mart reads it), merged when it is time."""
    enriched = lambda last: enrich.enrich_sales(
        sales, dims.customer, dims.store, dims.sales_team, store_bounded=dims.store_bounded, last=last)
    for name, part in ((CUSTOMER, marts.customer_monthly(marts.customer_mart(enriched("customer")))),
                       (SALES_TEAM, marts.sales_team_monthly(marts.sales_team_mart(enriched("sales_team"))))):
        base = f"{output}/{name}"
        _once(part.withColumn("total_sales", F.col("total_sales").cast(TOTAL)), f"{base}/part/batch_id={batch_id}")
        done = _merges(spark, base)
        if batch_id - (done[-1] if done else -1) >= dims.merge_every:
            _once(_totals(spark, base, batch_id), f"{base}/merged/upto={batch_id}")
            _drop_merged(spark, base, done)


def _drop_merged(spark: SparkSession, base: str, before: list[int]) -> None:
    """Parts and tables that the merged table before the new one already replaced: readers
    that took that one up still find the parts behind it."""
    if not before:
        return
    for name in folders.names(spark, f"{base}/part"):
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= before[-1]:
            folders.remove(spark, f"{base}/part/{name}")
    for upto in before[:-1]:
        folders.remove(spark, f"{base}/merged/upto={upto}")


def customer_monthly(spark: SparkSession, output: str) -> DataFrame:
    """AGG-1 over all batches so far."""
    return _totals(spark, f"{output}/{CUSTOMER}")


def sales_team_monthly(spark: SparkSession, output: str) -> DataFrame:
    """AGG-2 over all batches so far."""
    return _totals(spark, f"{output}/{SALES_TEAM}")


def sales_team_incentive(spark: SparkSession, output: str, rate: str = "0.01") -> DataFrame:
    """WIN-4 over all batches so far."""
    return marts.sales_team_incentive(sales_team_monthly(spark, output), rate)
