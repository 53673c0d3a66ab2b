"""Header routing, conforming and union of sales drops (FLT-4/5/8,
PRJ-1, SET-1/2, SCL-4, SRC-6, SNK-9 inputs).

Routing is decided on the per-file header table with Spark array functions.
One scan reads the lines of all accepted files; each line is joined to its file's
header shape by the file's key and parsed by position, so the plan does not grow
with files or shapes.  Only the width of the widest header reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.columns import fold_extras
from martforge.schemas import ADDITIONAL, MANDATORY, SALES
from martforge.sources import files as fsrc

# Routing reasons.
ACCEPTED = "accepted"
NOT_CSV = "not_csv"
EMPTY_FILE = "empty_file"
UNSUPPORTED_HEADER = "unsupported_header"
DUPLICATE_COLUMNS = "duplicate_columns"
MISSING_COLUMNS = "missing_columns"

ROUTING_SCHEMA = ("path string, file_name string, length long, modification_time timestamp, "
                  "header string, columns array<string>, missing_columns array<string>, "
                  "extra_columns array<string>, reason string")


def route_files(files: DataFrame, headers: DataFrame | None = None,
                method: str = "auto") -> DataFrame:
    """FLT-1/4/5 + T6: one row per file with its header, the missing and
    extra columns (header order) and a reason (``accepted`` or why not).

    The column check is case-sensitive and exact, as in the original job.
    """
    csv, other = fsrc.split_by_extension(files)
    if headers is None:
        headers = fsrc.header_signatures(csv, method=method)
    cells = F.split(F.col("header"), ",", -1)
    quoted = lambda x: x.rlike('^"([^"]|"")*"$')
    # names as Spark's CSV header parsing gives them: surrounding quotes
    # removed, doubled quotes unescaped
    cols = F.transform(cells, lambda x: F.when(
        quoted(x), F.regexp_replace(F.regexp_extract(x, '^"(.*)"$', 1), '""', '"')).otherwise(x))
    # a quote anywhere else (e.g. a quoted name holding a comma) is not handled
    stray_quote = F.exists(cells, lambda x: ~quoted(x) & x.contains('"'))
    required = F.array(*[F.lit(c) for c in MANDATORY])
    checked = (csv.join(headers, "path", "left")
               .withColumn("columns", F.when(F.col("header").isNull(), F.array().cast("array<string>"))
                           .otherwise(cols))
               .withColumn("missing_columns", F.array_except(required, F.col("columns")))
               .withColumn("extra_columns", F.array_except(F.col("columns"), required))
               .withColumn("reason", F.when(F.col("header").isNull(), F.lit(EMPTY_FILE))
                           .when(stray_quote | F.array_contains("columns", ""),
                                 F.lit(UNSUPPORTED_HEADER))
                           .when(F.size(F.array_distinct("columns")) < F.size("columns"),
                                 F.lit(DUPLICATE_COLUMNS))
                           .when(F.size("missing_columns") > 0, F.lit(MISSING_COLUMNS))
                           .otherwise(F.lit(ACCEPTED))))
    rejected_other = other.select(
        "*", F.lit(None).cast("string").alias("header"),
        F.array().cast("array<string>").alias("columns"),
        F.array().cast("array<string>").alias("missing_columns"),
        F.array().cast("array<string>").alias("extra_columns"),
        F.lit(NOT_CSV).alias("reason"))
    return checked.unionByName(rejected_other)


def empty_sales(spark: SparkSession) -> DataFrame:
    """SRC-6: the typed, empty fact (the result when no file is accepted)."""
    return spark.createDataFrame([], SALES)


#: Put behind each line as one more cell: its place is the number of cells of the line.
END_CELL = "\x01"


def shapes(routing: DataFrame) -> DataFrame:
    """The accepted files with their header shape: the places of the mandatory columns
    (``at``) and of the extras (``more``, in header order), and the number of columns."""
    place = lambda c: (F.array_position("columns", c) - 1).cast("int")
    return routing.where(F.col("reason") == ACCEPTED).select(
        *fsrc.IDENTITY, F.array(*[place(F.lit(c)) for c in MANDATORY]).alias("at"),
        F.transform("extra_columns", place).alias("more"), F.size("columns").alias("width"))


def conform(lines: DataFrame, width: int) -> DataFrame:
    """PRJ-1 + SCL-4 + T7: ``lines`` (``raw`` with its file's shape, of at most ``width``
    columns) as the mandatory columns, typed, and the extras folded in header order; ``_bad``
    marks lines with a wrong number of cells (also by a quote that does not close) and those with
    a non-empty cell that does not parse; ``_raw`` keeps the line."""
    schema = ", ".join(f"_c{i} string" for i in range(width + 1))
    parsed = F.from_csv(F.concat("raw", F.lit("," + END_CELL)), F.lit(schema))
    # generators, so that a line is parsed once: projections would be merged and parse it for every cell
    df = lines.select("*", F.inline(F.array(parsed))).withColumn(
        "_cells", F.explode(F.array(F.array(*[F.col(f"_c{i}") for i in range(width + 1)]))))
    cell = lambda p: F.get("_cells", p)
    raw = {c: cell(F.get("at", F.lit(i))) for i, c in enumerate(MANDATORY)}
    typed = {c: raw[c].try_cast(f.dataType) for c, f in zip(MANDATORY, SALES.fields)}
    unparsed = [raw[c].isNotNull() & typed[c].isNull() for c in MANDATORY]
    count = F.array_position("_cells", END_CELL) - 1
    bad = reduce(lambda a, b: a | b, unparsed, F.coalesce(count != F.col("width"), F.lit(True)))
    extras = F.when(F.size("more") > 0, F.concat_ws(", ", F.transform("more", cell)))
    return df.select(*[typed[c].alias(c) for c in MANDATORY], extras.alias(ADDITIONAL),
                     F.col("path").alias("source_file"), bad.alias("_bad"), F.col("raw").alias("_raw"))


@dataclass
class Ingested:
    sales: DataFrame        # conformed rows that parsed (schema SALES + source_file)
    bad_rows: DataFrame     # rows that did not parse: source_file, raw line
    routing: DataFrame      # one row per file with its reason
    conformed: DataFrame | None = None   # all rows with _bad and _raw (one scan)


def ingest(spark: SparkSession, routing: DataFrame, landing: str | list[str] | None = None) -> Ingested:
    """SRC-4 + SET-1: the rows of all accepted files, whatever their headers, by one
    scan of ``landing`` (default: the files' common folder)."""
    info = shapes(routing)
    width = info.agg(F.max("width").alias("w")).first()["w"]
    if width is None:
        allrows = empty_sales(spark).select("*", F.lit(None).cast("string").alias("source_file"),
                                            F.lit(False).alias("_bad"), F.lit(None).cast("string").alias("_raw"))
    else:
        allrows = conform(fsrc.lines_of(spark, info, landing), width)
    return split_conformed(allrows, routing)


def split_conformed(allrows: DataFrame, routing: DataFrame) -> Ingested:
    good = allrows.where(~F.col("_bad")).drop("_bad", "_raw")
    bad = allrows.where(F.col("_bad")).select("source_file", F.col("_raw").alias("raw"))
    return Ingested(good, bad, routing, allrows)


def quarantined_lines(spark: SparkSession, routing: DataFrame,
                      landing: str | list[str] | None = None) -> DataFrame:
    """SNK-9 input: the data lines of every rejected CSV file, with the file and the
    reason; the header line and blank lines are left out, but not a later line equal
    to the header."""
    info = routing.where((F.col("reason") != ACCEPTED) & (F.col("reason") != NOT_CSV) & (F.col("length") > 0))
    info = info.select(*fsrc.IDENTITY, "reason", "missing_columns")
    return fsrc.lines_of(spark, info, landing).select(
        "path", "reason", "missing_columns", "raw")


def routing_summary(routing: DataFrame, ingested: Ingested, quarantined: DataFrame,
                    level: int = -2) -> DataFrame:
    """Rows per drop folder and outcome: accepted rows (parsed or not) and
    quarantined lines.  ``level`` picks the path segment naming a drop."""
    drop = lambda c: F.element_at(F.split(F.col(c), "/"), level)
    acc = (ingested.sales.select(F.col("source_file").alias("path"))
           .unionByName(ingested.bad_rows.select(F.col("source_file").alias("path")))
           .groupBy("path").agg(F.count(F.lit(1)).alias("n_rows")))
    rej = quarantined.groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"))
    per_file = routing.join(acc.unionByName(rej), "path", "left")
    return (per_file.groupBy(
                drop("path").alias("drop_name"), "reason",
                F.array_join("missing_columns", ",").alias("missing_columns"),
                F.array_join("extra_columns", ",").alias("extra_columns"))
            .agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows")))
