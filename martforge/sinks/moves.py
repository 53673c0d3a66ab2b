"""Moving consumed and rejected files (SNK-9 file part, SNK-10, SCL-10,
FLT-7).

The list of files to move is a DataFrame; the moves run inside tasks
(``mapInPandas`` over Arrow file systems), spread over the paths, so a
landing folder with many files is not moved one by one from the driver.
A file is matched by its exact path (never by a name suffix), and keeps
its path relative to the source folder below the destination folder.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.columns import rewrite_prefix
from martforge.sources.files import ARROW_SCHEMES, arrow_file
from martforge.session import ship, shuffle_partitions

MOVE_SCHEMA = "path string, target string, moved boolean, error string"


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified, encoded URI of ``path`` as file keys are spelled
    (``file:/tmp/x`` for a local ``/tmp/x``)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = fs.makeQualified(hpath).toUri().toString().rstrip("/")
    return re.sub(r"^([^:/]+):///", r"\1:/", uri)


def _fs_and_path(uri: str, cache: dict):
    return arrow_file(uri, cache)


def _already_moved(src: str, dst: str, cache: dict) -> bool:
    from pyarrow import fs as pafs

    try:
        sfs, sp = _fs_and_path(src, cache)
        dfs, dp = _fs_and_path(dst, cache)
        return (sfs.get_file_info(sp).type == pafs.FileType.NotFound
                and dfs.get_file_info(dp).type == pafs.FileType.File)
    except Exception:
        return False


def _checksum(path: str) -> str:
    """Where Hadoop keeps the checksums of a local file."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/.{name}.crc"


def _move_checksum(sfs, sp: str, dfs, dp: str) -> None:
    """The checksums of a moved local file follow it; those of a file that stood at the
    target go (readers would hold them against the new one)."""
    from pyarrow import fs as pafs

    for fs, path in ((sfs, sp), (dfs, dp)):
        if not isinstance(fs, pafs.LocalFileSystem):
            return
    if sfs.get_file_info(_checksum(sp)).type == pafs.FileType.File:
        sfs.move(_checksum(sp), _checksum(dp))
    elif dfs.get_file_info(_checksum(dp)).type == pafs.FileType.File:
        dfs.delete_file(_checksum(dp))


def _move_partition(batches):
    import pandas as pd

    cache: dict = {}
    for pdf in batches:
        moved, errors = [], []
        for src, dst in zip(pdf["path"], pdf["target"]):
            try:
                sfs, sp = _fs_and_path(src, cache)
                dfs, dp = _fs_and_path(dst, cache)
                parent = dp.rsplit("/", 1)[0]
                dfs.create_dir(parent, recursive=True)
                if sfs is dfs:
                    sfs.move(sp, dp)
                else:
                    from pyarrow import fs as pafs
                    pafs.copy_files(sp, dp, source_filesystem=sfs, destination_filesystem=dfs)
                    sfs.delete_file(sp)
                _move_checksum(sfs, sp, dfs, dp)
                moved.append(True)
                errors.append(None)
            except Exception as exc:  # reported per file, the job goes on
                if _already_moved(src, dst, cache):   # a retried task
                    sfs, sp = _fs_and_path(src, cache)
                    dfs, dp = _fs_and_path(dst, cache)
                    if sfs.get_file_info(_checksum(sp)).is_file:
                        _move_checksum(sfs, sp, dfs, dp)
                    moved.append(True)
                    errors.append(None)
                    continue
                moved.append(False)
                errors.append(f"{type(exc).__name__}: {exc}")
        yield pd.DataFrame({"path": pdf["path"], "target": pdf["target"],
                            "moved": moved, "error": pd.Series(errors, dtype=object)})


def arrow_scheme(uri: str) -> bool:
    return uri.partition(":")[0] in ARROW_SCHEMES


def move_files(files: DataFrame, source_dir: str, dest_dir: str) -> DataFrame:
    """Plan the move of every ``path`` of ``files`` from below ``source_dir``
    to the same relative place below ``dest_dir``; returns one status row
    per file (lazy: run it with an action, e.g. by writing the statuses)."""
    spark = files.sparkSession
    src, dst = qualify(spark, source_dir), qualify(spark, dest_dir)
    targets = files.select("path", rewrite_prefix("path", src + "/", dst + "/").alias("target"))
    # outside source_dir: left alone
    return move_pairs(targets.where(F.col("target") != F.col("path")), arrow_scheme(src) and arrow_scheme(dst))


def move_pairs(pairs: DataFrame, only_arrow: bool = False) -> DataFrame:
    """``move_files`` with a target of its own for each path (both encoded URIs); a file
    that stands at the target is replaced."""
    spark = pairs.sparkSession
    ship(spark)
    n = shuffle_partitions(spark)
    arrow = F.regexp_extract("path", r"^([A-Za-z][A-Za-z0-9+.-]*):", 1).isin(*ARROW_SCHEMES)
    moved = pairs.where(arrow).repartition(n, "path").mapInPandas(_move_partition, MOVE_SCHEMA)
    return moved if only_arrow else moved.unionByName(_renamed(spark, pairs.where(~arrow)))


def _renamed(spark: SparkSession, targets: DataFrame) -> DataFrame:
    """Renames through Hadoop's file systems (HDFS, ABFS, ...): operations on
    names alone, asked for by the driver one after the other."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = []
    for r in targets.toLocalIterator():
        src, dst = (jvm.org.apache.hadoop.fs.Path(unquote(x)) for x in (r.path, r.target))
        error = None
        try:
            fs = src.getFileSystem(conf)
            fs.mkdirs(dst.getParent())
            if not fs.rename(src, dst) and not (fs.exists(dst) and not fs.exists(src)):
                error = "rename was refused"
        except Py4JJavaError as exc:
            error = str(exc.java_exception)
        done.append((r.path, r.target, error is None, error))
    return spark.createDataFrame(done, MOVE_SCHEMA)
