"""Incremental ingest of deliveries, a file being (path, length, modification time) (STR-2, T16).

Spark's file stream knows a file by its path, so a name that is delivered again is not
seen.  Here each call lists the landing folder, appends the files never listed before in
this identity to an *arrivals* table, and streams that table: its Parquet files are written
once and never change, so the stream's exactly-once bookkeeping holds for deliveries.

A call that dies while it appends leaves some files of the append behind; the next call
appends the rest.  Zero-byte files arrive too (the stream of the folder itself plans no
split for them) and end in the quarantine.  A file replaced between its listing and its
batch has another identity by then: it is left out of that batch and arrives anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martforge.operators.ledger import read_or_empty
from martforge.sources import files as fsrc
from martforge.streaming import incremental, monthly

ARRIVALS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
])


def record(spark: SparkSession, landing: str, arrivals: str, files_per_batch: int = 10_000) -> None:
    """Append the deliveries that ``arrivals`` lacks, at most ``files_per_batch`` to a file
    (a file of this table is one micro-batch)."""
    seen = read_or_empty(spark, arrivals, ARRIVALS)
    new = fsrc.manifest(spark, landing).join(seen, fsrc.IDENTITY, "left_anti").select(*ARRIVALS.fieldNames())
    new = new.checkpoint(eager=True)      # counted and written from one listing
    n = new.count()
    if n:
        (new.repartition(-(-n // files_per_batch)).write.mode("append")
         .option("maxRecordsPerFile", str(files_per_batch)).parquet(arrivals))


def run_available(spark: SparkSession, landing: str, output: str, checkpoint: str,
                  files_per_batch: int = 10_000, header_method: str = "auto",
                  dims: monthly.Dimensions | None = None) -> None:
    """Record the new deliveries and process those not yet processed, then stop.  Outputs
    are those of ``incremental.run_available``; a name delivered twice gives its rows twice
    (each delivery with its own ``batch_id``)."""
    incremental.shared_dir(spark)
    arrivals = f"{output}/arrivals"
    record(spark, landing, arrivals, files_per_batch)
    if read_or_empty(spark, arrivals, ARRIVALS).isEmpty():
        return
    stream: DataFrame = spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", "1").parquet(arrivals)
    q = (stream.writeStream.foreachBatch(incremental.ingest_batch(output, header_method, landing, dims))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
