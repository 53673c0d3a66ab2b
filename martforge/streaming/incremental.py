"""Incremental ingest with Structured Streaming (STR-1..3, SNK-10, FLT-7).

The landing folder is read as a *file stream of manifests*: the
``binaryFile`` source with the ``content`` column pruned emits one row
(path, length, modificationTime) per new file and reads no file body.
Each micro-batch routes and ingests exactly its files with the batch
code path, and writes below ``batch_id=<id>`` with overwrite, so the
at-least-once replay of a batch after a failure rewrites the same
folder (effectively exactly-once).  The checkpoint remembers which files
were seen; ``archive_dir`` moves consumed files out of the landing
folder (``cleanSource=archive``).

File identity in streaming mode is the path: a file rewritten under the
same name is not picked up again (``streaming.arrivals`` ingests it, as the
batch pipeline's ledger does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.columns import basename
from martforge.operators import conform
from martforge.session import shared_dir
from martforge.sinks import writers
from martforge.streaming import monthly


# the fixed schema of Spark's binaryFile source
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, landing: str, glob: str | None = None,
                max_files_per_trigger: int | None = None,
                archive_dir: str | None = None) -> DataFrame:
    reader = (spark.readStream.format("binaryFile")
              .schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(landing).select(
        F.col("_metadata.file_path").alias("path"), basename("path").alias("file_name"), "length",
        F.col("modificationTime").alias("modification_time"))


def ingest_batch(output: str, header_method: str = "auto", landing: str | None = None,
                 dims: monthly.Dimensions | None = None):
    """foreachBatch body: one micro-batch of new files → routing, and every
    conformed row with its bad-row flag (bad ones keep their text) below
    ``batch_id=<id>``: the batch's CSV is parsed once.  With ``dims`` the batch's
    sales are also added to the monthly marts."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shared_dir(spark)  # checkpoint() needs the shared folder
        routing = conform.route_files(batch, method=header_method).checkpoint(eager=True)
        part = f"batch_id={batch_id}"
        writers.write(routing.drop("columns"), f"{output}/routing/{part}")
        writers.write(conform.quarantined_lines(spark, routing, landing), f"{output}/quarantine/{part}")
        rows = conform.ingest(spark, routing, landing).conformed
        writers.write(rows.withColumn("_raw", F.when(F.col("_bad"), F.col("_raw"))), f"{output}/rows/{part}",
                      compression="zstd")
        if dims is not None:
            good = spark.read.parquet(f"{output}/rows/{part}").where(~F.col("_bad")).drop("_bad", "_raw")
            monthly.add_batch(spark, output, good, batch_id, dims)
    return run


def run_available(spark: SparkSession, landing: str, output: str, checkpoint: str,
                  max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None, header_method: str = "auto",
                  dims: monthly.Dimensions | None = None) -> None:
    """Process every file not yet seen, then stop (``availableNow``)."""
    q = (file_stream(spark, landing, max_files_per_trigger=max_files_per_trigger,
                     archive_dir=archive_dir)
         .writeStream.foreachBatch(ingest_batch(output, header_method, landing, dims))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_output(spark: SparkSession, output: str, what: str = "sales") -> DataFrame:
    """All micro-batch outputs of one kind (``sales``, ``bad_rows``,
    ``routing`` or ``quarantine``), with a ``batch_id`` column."""
    if what in ("routing", "quarantine"):
        return spark.read.parquet(f"{output}/{what}")
    rows = spark.read.parquet(f"{output}/rows")
    if what == "sales":
        return rows.where(~F.col("_bad")).drop("_bad", "_raw")
    if what == "bad_rows":
        return rows.where(F.col("_bad")).select("source_file", F.col("_raw").alias("raw"), "batch_id")
    raise ValueError(what)
