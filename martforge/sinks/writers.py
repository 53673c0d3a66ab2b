"""Sinks (SNK-1..5, SNK-8, SNK-9, SCL-12).

Outputs are written straight to their final (shared) location; a run's
outputs sit below ``run_id=<epoch ms>`` so each run is an immutable
snapshot that reads back with ``run_id`` as a partition column, and a
re-run with the same id overwrites only its own folder (idempotent).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from martforge.session import dropping_shuffles, shuffle_partitions


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
          partition_by: list[str] | None = None, **options: str) -> str:
    """SNK-1: ``df`` in ``fmt`` under ``path``; errors propagate.  The shuffle files of the
    write go when it ends."""
    w = df.write.format(fmt).mode(mode)
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with dropping_shuffles(df.sparkSession):
        w.save(path)
    return path


def _folder_text(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Text partition columns without NULL.  NULL and empty text share one folder anyway;
    a column that Spark knows to hold no NULL keeps the order of its rows in the writer,
    which otherwise rewrites it and sorts once more."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in partition_by if c in text})


def cluster_for_partitions(df: DataFrame, partition_by: list[str],
                           order: list[str] | None = None) -> DataFrame:
    """Lay rows out so each output directory is written by few tasks, each of even size.

    One shuffle by the partition columns, read as adaptive execution sees fit: small
    directories share a task, and one beyond the advisory size is cut along the map
    outputs it came from (so a hot salesperson's month is cut too).  The sizes are those
    of the shuffle files: the input is run once, no sample of it is taken.  Within a task
    rows are sorted by ``partition_by`` and ``order``, the one sort that the writer needs.
    """
    spark = df.sparkSession
    named = ", ".join(f"`{c}`" for c in partition_by)
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
        raise ValueError("a partitioned write needs spark.sql.adaptive.enabled: without it a hot directory "
                         "would be written by one task")
    spread = spark.sql(f"SELECT /*+ REBALANCE({named}) */ * FROM {{rows}}", rows=_folder_text(df, partition_by))
    return spread.sortWithinPartitions(*partition_by, *(order or []))


@contextmanager
def _small_tasks(spark):
    """Adaptive execution joins small shuffle partitions only below this size meanwhile: a
    folder costs its file however few rows it has, so a small write with many folders is
    spread over all cores too."""
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "32k")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str],
                      order: list[str] | None = None, mode: str = "overwrite") -> str:
    """SNK-2: Parquet partitioned by ``partition_by`` (e.g. sales_month, store_id), the
    rows of a file in ``order`` (readers skip row groups by it)."""
    clustered = cluster_for_partitions(df, partition_by, order)
    with _small_tasks(df.sparkSession):
        return write(clustered, path, "parquet", mode, partition_by=partition_by)


def snapshot_path(base: str, run_id: int) -> str:
    return f"{base.rstrip('/')}/run_id={run_id}"


def write_snapshot(df: DataFrame, base: str, run_id: int,
                   partition_by: list[str] | None = None,
                   order: list[str] | None = None) -> str:
    """SNK-4/5: publish ``df`` as run ``run_id`` below ``base``."""
    path = snapshot_path(base, run_id)
    if partition_by:
        return write_partitioned(df, path, partition_by, order)
    return write(df, path)


def read_snapshot(spark, base: str, run_id: int | None = None) -> DataFrame:
    """Read one run (``run_id``) or all runs (with a ``run_id`` column)."""
    if run_id is not None:
        return spark.read.parquet(snapshot_path(base, run_id))
    return spark.read.parquet(base)


def write_csv_report(df: DataFrame, path: str, partition_by: list[str] | None = None,
                     order: list[str] | None = None, mode: str = "overwrite",
                     rows_per_file: int = 1_000_000) -> str:
    """EXT-1: a headed CSV report, one folder per ``partition_by`` value.

    With ``order`` the rows are cut into ranges of (``partition_by``, ``order``), so a hot
    folder is written by several tasks; its files, by name, hold one order from the first
    row of the first to the last row of the last, each at most ``rows_per_file`` rows.
    ``df`` is run once more for the bounds of the ranges: pass a table that stands
    (``run_pipeline`` passes the snapshot of the monthly mart).
    """
    keys = [*(partition_by or []), *(order or [])]
    out = df
    if order:
        n = shuffle_partitions(df.sparkSession)
        out = _folder_text(df, partition_by or []).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    elif partition_by:
        out = cluster_for_partitions(df, partition_by)
    return write(out, path, "csv", mode, partition_by=partition_by, header="true",
                 maxRecordsPerFile=str(rows_per_file))


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 10000,
               num_partitions: int | None = None) -> None:
    """SNK-3: JDBC write; a failure raises (never swallowed).

    ``num_partitions`` caps concurrent connections to the database.
    """
    w = df
    if num_partitions:
        w = w.coalesce(num_partitions)
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    w.write.jdbc(url, table, mode=mode, properties=props)


def write_jdbc_run(df: DataFrame, url: str, table: str, run_id: int, properties: dict | None = None,
                   batch_size: int = 10000, num_partitions: int | None = None) -> None:
    """SNK-3 / T14: the rows of run ``run_id`` in ``table``, exactly once.

    Tasks write to a staging table of the run (made anew, so what a failed attempt left
    there goes); one transaction of the database then replaces the run's rows of ``table``
    by it.  A failure before its commit leaves ``table`` as it was; a second call leaves it
    as after the first.  ``df`` gets a column ``run_id``; no row passes the driver.
    """
    spark = df.sparkSession
    stamped = df.withColumn("run_id", F.lit(run_id).cast("long"))
    staging = f"{table}_run_{run_id}"
    write_jdbc(stamped, url, staging, "overwrite", properties, batch_size, num_partitions)
    write_jdbc(stamped.limit(0), url, table, "append", properties)     # made when it is missing
    jvm = spark.sparkContext._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    columns = ", ".join(dialect.quoteIdentifier(c) for c in stamped.columns)
    own = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        own.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, own)
    try:
        connection.setAutoCommit(False)
        sql = connection.createStatement()
        try:
            sql.executeUpdate(f"DELETE FROM {table} WHERE {dialect.quoteIdentifier('run_id')} = {run_id}")
            sql.executeUpdate(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        sql.executeUpdate(f"DROP TABLE {staging}")
        connection.commit()
    finally:
        connection.close()


def write_quarantine(routing: DataFrame, lines: DataFrame, base: str, run_id: int) -> dict[str, str]:
    """SNK-9: rejected files (with reason and missing columns) and their raw
    lines, as datasets below ``base`` keyed by run."""
    files = routing.where(F.col("reason") != "accepted").select(
        "path", "file_name", "length", "modification_time", "reason",
        "missing_columns", "extra_columns")
    return {
        "files": write_snapshot(files, f"{base.rstrip('/')}/files", run_id),
        "lines": write_snapshot(lines, f"{base.rstrip('/')}/lines", run_id),
    }


def preview(df: DataFrame, n: int = 20, enabled: bool = False) -> None:
    """SNK-8: ``show()`` for interactive runs; off by default because each
    preview is a separate job."""
    if enabled:
        df.show(n, truncate=False)
