"""File sources for sales drops (SRC-1..4, FLT-1, FLT-2, FLT-7).

* ``manifest`` lists every file below a landing folder with Spark's own
  file index (``binaryFile`` with the ``content`` column pruned), so no
  file body is read and the listing is complete (no page limit).
* ``header_signatures`` reads the first line of each file that is not blank.
  Each file is read up to the end of that line, in tasks spread over the files
  (Arrow file systems inside ``mapInPandas``), so the cost grows with the
  number of files, not with their size.  ``method="scan"`` is a pure-JVM
  alternative that reads every byte once and finds the same line.
* ``data_lines`` reads the data lines of all files, whatever their headers, with one
  scan of their folder; the files a run wants are joined by their key, so neither
  their paths nor a scan per header shape reach the driver or the plan.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.columns import basename
from martforge.operators.joins import join_dimension
from martforge.session import ship, shuffle_partitions

IDENTITY = ["path", "length", "modification_time"]      # a file as it was listed
SNIFF_BYTES = 64 * 1024    # read at a time, until the header line ends


def literal(path: str) -> str:
    """``path`` with the characters that Spark's readers take as glob escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def readable(uri: str) -> str:
    """The reader path of a file key (an encoded URI): decoded, no glob."""
    return literal(unquote(uri))


def manifest(spark: SparkSession, landing: str | list[str], glob: str | None = None) -> DataFrame:
    """SRC-1/2 + FLT-2: every file below ``landing`` (directories excluded).

    ``path`` is the file's encoded URI, spelled as ``_metadata.file_path``
    of any other scan: the one key of a file in the whole library.

    Spark's file scans plan no split for a zero-byte file; those are in the
    index of the same listing and are added with length 0 (they must be
    quarantined, not silently ignored).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load([landing] if isinstance(landing, str) else list(landing))
    df = found.select(F.col("_metadata.file_path").alias("path"), basename("path").alias("file_name"), "length",
                      F.col("modificationTime").alias("modification_time"))
    listed = found._jdf.inputFiles()       # stays in the JVM unless something is missing
    if len(listed) == df.count():
        return df
    # the index writes an empty authority out, the metadata column does not
    names = spark.createDataFrame([(re.sub(r"^([^:/]+):///", r"\1:/", x),) for x in listed], "path string")
    empty = [r.path for r in names.join(df, "path", "left_anti").collect()]     # zero-byte files alone
    extra = spark.createDataFrame(
        [(x, unquote(x).rsplit("/", 1)[-1], 0, _modified(spark, x)) for x in empty],
        "path string, file_name string, length long, millis long")
    return df.unionByName(extra.select("path", "file_name", "length",
                                       F.timestamp_millis("millis").alias("modification_time")))


def _modified(spark: SparkSession, uri: str) -> int:
    """Modification time of one file in epoch milliseconds, on any file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(unquote(uri))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(path).getModificationTime()


def split_by_extension(files: DataFrame, ext: str = ".csv") -> tuple[DataFrame, DataFrame]:
    """FLT-1: (csv files, other files); the match is case-sensitive."""
    is_csv = F.col("path").endswith(ext)
    return files.where(is_csv), files.where(~is_csv)


# URI schemes whose files tasks can open through Arrow file systems (the
# Hadoop names of object stores map onto Arrow's); others use the scan.
ARROW_SCHEMES = {"": "", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3",
                 "gs": "gs", "gcs": "gs"}


def arrow_file(uri: str, cache: dict):
    """(Arrow file system, path) for a file URI; file systems are cached
    per bucket/host in ``cache``."""
    from urllib.parse import urlparse

    from pyarrow import fs as pafs

    u = urlparse(uri)
    scheme = ARROW_SCHEMES.get(u.scheme)
    if scheme is None:
        raise ValueError(f"no Arrow file system for {u.scheme}://")
    if scheme in ("", "file"):
        if "file" not in cache:
            cache["file"] = pafs.LocalFileSystem()
        return cache["file"], unquote(u.path)
    key = f"{scheme}://{u.netloc}"
    if key not in cache:
        cache[key] = pafs.FileSystem.from_uri(f"{key}/")[0]
    return cache[key], unquote(u.netloc + u.path)


_LINE_END = re.compile(rb"[\r\n]")
_BLANK = "".join(map(chr, range(0x21)))


def _first_line(stream) -> str | None:
    """The first line that is not blank, however long; None for no such line
    (Spark's CSV reader takes the same line as header)."""
    head, seen = b"", 0
    while True:
        more = stream.read(SNIFF_BYTES)
        head += more
        while (end := _LINE_END.search(head, seen)) or (not more and head):
            line, head = (head[:end.start()], head[end.end():]) if end else (head, b"")
            seen = 0
            text = line.decode("utf-8", errors="replace").lstrip("\ufeff")
            if text.strip(_BLANK):
                return text
        if not more:
            return None
        seen = len(head)


def _sniff_partition(batches):
    """mapInPandas body: read the first line of each file in the batch."""
    import pandas as pd

    cache: dict = {}
    for pdf in batches:
        headers = []
        for path in pdf["path"]:
            filesystem, p = arrow_file(path, cache)
            with filesystem.open_input_stream(p) as stream:
                headers.append(_first_line(stream))
        yield pd.DataFrame({"path": pdf["path"], "header": pd.Series(headers, dtype=object)})


def header_signatures(files: DataFrame, method: str = "auto") -> DataFrame:
    """SRC-3: ``(path, header)`` per file; header is NULL for a file without
    a line that is not blank.

    ``auto`` sniffs the files on a file system that tasks can open through
    Arrow (local, S3, GCS) and scans the others; both find the same header.
    """
    paths = files.select("path")
    if method == "sniff":
        return _sniffed(paths)
    if method == "scan":
        return _scanned(paths)
    if method != "auto":
        raise ValueError(method)
    scheme = F.regexp_extract("path", r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    arrow = scheme.isin(*ARROW_SCHEMES)
    return _sniffed(paths.where(arrow)).unionByName(_scanned(paths.where(~arrow)))


def _sniffed(paths: DataFrame) -> DataFrame:
    ship(paths.sparkSession)
    n = shuffle_partitions(paths.sparkSession)
    return paths.repartition(n, "path").mapInPandas(_sniff_partition, "path string, header string")


def _scanned(paths: DataFrame) -> DataFrame:
    """One pass over all bytes: the line that comes first (by the split it
    starts in, then by its place there) among those not blank."""
    spark = paths.sparkSession
    path_list = [readable(r.path) for r in paths.collect()]
    if not path_list:
        return spark.createDataFrame([], "path string, header string")
    lines = (spark.read.text(path_list)
             .select("value", F.col("_metadata.file_path").alias("path"),
                     F.struct(F.col("_metadata.file_block_start").alias("start"),
                              F.monotonically_increasing_id().alias("id")).alias("at"))
             .withColumn("value", F.regexp_replace("value", "^\ufeff", ""))
             .where(F.col("value").rlike("[^\\x00-\\x20]")))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    # zero-byte files have no line at all
    return paths.join(first, "path", "left")


def common_folder(files: DataFrame) -> str | None:
    """The deepest folder that holds every file (a single file: itself): what the least
    and the greatest path have in common."""
    r = files.agg(F.min("path").alias("a"), F.max("path").alias("b")).first()
    if r["a"] is None or r["a"] == r["b"]:
        return r["a"]
    n = next((i for i, (x, y) in enumerate(zip(r["a"], r["b"])) if x != y), min(len(r["a"]), len(r["b"])))
    return r["a"][:n].rpartition("/")[0]


def data_lines(spark: SparkSession, files: DataFrame, landing: str | list[str] | None = None) -> DataFrame:
    """SRC-4: (path, length, modification_time, raw) of every line behind the header of
    the CSV files below ``landing`` (default: their common folder), in one scan.

    Each line is one cell of a CSV file without quotes whose separator never occurs: the
    reader takes out the header (the first line that is not blank) and blank lines,
    nothing else.  Files outside the time window of ``files`` are left out of the scan by
    their metadata; joining by ``IDENTITY`` (``lines_of``) picks the files wanted, as they
    were listed.
    """
    folder = common_folder(files) if landing is None else None
    roots = [readable(folder)] if folder else [landing] if isinstance(landing, str) else list(landing or [])
    window = files.agg(F.min("modification_time").alias("a"), F.max("modification_time").alias("b"),
                       F.count(F.lit(1)).alias("n")).first()
    if not roots or not window["n"]:     # no file wanted: nothing is read
        return spark.createDataFrame([], "path string, length long, modification_time timestamp, raw string")
    lines = (spark.read.schema("raw string, _torn string").option("header", "true").option("sep", "\x01")
             .option("quote", "").option("columnNameOfCorruptRecord", "_torn")
             .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").csv(roots))
    meta = F.col("_metadata.file_modification_time")
    if window["a"] is not None:
        lines = lines.where((meta >= F.lit(window["a"])) & (meta <= F.lit(window["b"])))
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
                        meta.alias("modification_time"), F.coalesce("_torn", "raw").alias("raw"))


def lines_of(spark: SparkSession, files: DataFrame, landing: str | list[str] | None = None) -> DataFrame:
    """``data_lines`` joined to ``files`` (one row per file, with columns of its own).

    The optimizer knows no size of a checkpointed table, so the rows of ``files`` are
    measured as text: below the broadcast limit they go to the lines, which are then not
    shuffled; beyond it the join is a shuffle join.
    """
    size = files.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("b")).first()["b"]
    return join_dimension(data_lines(spark, files, landing), files, IDENTITY, size=size or 0)
