"""Append-only file ledger (SRC-7, SNK-6, SNK-7, FLT-3, FLT-6, AGG-4,
JN-5; traps T12, T13, T16).

Instead of INSERT-then-UPDATE on a status table, every state change is an
appended event ``(file identity, status, event_ts, seq)``.  A file is
identified by ``(file_path, length, modification_time)``, so a file
re-delivered under the same name with other content is new work.  The
current state of a file is its latest event, the greatest ``(event_ts,
seq, run_id, status)`` — ``seq`` orders events that share a timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.schemas import LEDGER, LEDGER_CLOSED, LEDGER_OPEN, LEDGER_REJECTED

IDENTITY = ["file_path", "length", "modification_time"]


def _instant(event_ts: int | str):
    """Epoch seconds (time-zone free) or a timestamp literal text."""
    if isinstance(event_ts, int):
        return F.timestamp_seconds(F.lit(event_ts))
    return F.lit(event_ts).cast("timestamp")


def events(files: DataFrame, status: str, run_id: int, event_ts: int | str, seq: int) -> DataFrame:
    """One ledger event per file of ``files`` (a manifest: path, file_name,
    length, modification_time); exactly one row per file (T12)."""
    return files.select(
        F.col("file_name"), F.col("path").alias("file_path"), F.col("length"),
        F.col("modification_time").cast("timestamp").alias("modification_time"),
        F.lit(run_id).cast("long").alias("run_id"), F.lit(status).alias("status"),
        _instant(event_ts).alias("event_ts"), F.lit(seq).cast("int").alias("seq"))


def open_events(files: DataFrame, run_id: int, event_ts: int | str) -> DataFrame:
    """SNK-6: status 'A' for every accepted file of a run."""
    return events(files, LEDGER_OPEN, run_id, event_ts, 0)


def close_events(files: DataFrame, run_id: int, event_ts: int | str) -> DataFrame:
    """SNK-7: status 'I' once the run's outputs are written."""
    return events(files, LEDGER_CLOSED, run_id, event_ts, 1)


def rejected_events(files: DataFrame, run_id: int, event_ts: int | str) -> DataFrame:
    """Status 'R' for files a run quarantined, so later runs skip them
    (a corrected re-delivery has a new identity and is routed again)."""
    return events(files, LEDGER_REJECTED, run_id, event_ts, 0)


def append(ledger_path: str, ev: DataFrame) -> None:
    ev.select(*LEDGER.fieldNames()).write.mode("append").parquet(ledger_path)


def append_once(ledger_path: str, ev: DataFrame, run_id: int) -> None:
    """``append`` without the events that this run has in the ledger already (a run taken
    up again after a crash between its append and its record of it)."""
    have = read(ev.sparkSession, ledger_path).where(F.col("run_id") == run_id).select(*IDENTITY, "status")
    append(ledger_path, ev.join(have, [*IDENTITY, "status"], "left_anti"))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet dataset of ours; empty (typed) when nothing was written yet."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger events; empty (typed) when nothing was written yet."""
    return read_or_empty(spark, ledger_path, LEDGER)


def as_states(events: DataFrame) -> DataFrame:
    """Each event as the state of a file that has this event alone."""
    return events.select(*IDENTITY, F.struct("event_ts", "seq", "run_id", "status", "file_name").alias("last"),
                         F.col("event_ts").alias("created_ts"), F.lit(1).cast("long").alias("n_events"))


def merged(states: DataFrame) -> DataFrame:
    """States of parts of a file's events brought together: one row per file identity.
    Merging in any order, or in steps, gives the same rows."""
    return states.groupBy(*IDENTITY).agg(
        F.max("last").alias("last"), F.min("created_ts").alias("created_ts"), F.sum("n_events").alias("n_events"))


def shown(states: DataFrame) -> DataFrame:
    return states.select(*IDENTITY, "last.file_name", "last.status", "last.run_id", "created_ts",
                         F.col("last.event_ts").alias("updated_ts"), "n_events")


def state(ledger: DataFrame) -> DataFrame:
    """Latest status per file identity, with first and last event time."""
    return shown(merged(as_states(ledger)))


def _identity(files: DataFrame) -> DataFrame:
    return files.select(F.col("path").alias("file_path"), "length",
                        F.col("modification_time").cast("timestamp").alias("modification_time"),
                        "file_name", *[c for c in files.columns
                                       if c not in ("path", "length", "modification_time", "file_name")])


def open_files(files: DataFrame, current: DataFrame) -> DataFrame:
    """SRC-7 / FLT-3 / JN-5 / AGG-4: names of listed files whose ledger
    state is still open ('A'), i.e. a previous run did not finish them."""
    still_open = current.where(F.col("status") == LEDGER_OPEN).select(*IDENTITY)
    return (_identity(files).join(still_open, IDENTITY, "left_semi")
            .select("file_name").distinct())


def pending(files: DataFrame, current: DataFrame) -> DataFrame:
    """Listed files that still need work: never seen, or still open (T13).
    Files closed or rejected by an earlier run are skipped; a re-delivery
    with another length or modification time is a new identity (T16)."""
    closed = current.where(F.col("status").isin(LEDGER_CLOSED, LEDGER_REJECTED)).select(*IDENTITY)
    keyed = files.withColumn("modification_time", F.col("modification_time").cast("timestamp"))
    return keyed.join(closed.withColumnRenamed("file_path", "path"),
                      ["path", "length", "modification_time"], "left_anti")


def redelivered(current: DataFrame) -> DataFrame:
    """Paths seen with more than one (length, modification_time)."""
    return (current.groupBy("file_path")
            .agg(F.count(F.lit(1)).alias("versions"))
            .where(F.col("versions") > 1))
