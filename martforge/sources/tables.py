"""Dimension and table readers (SRC-5, SRC-6).

Whole-table reads over JDBC or Parquet.  A JDBC read without a partition
column is a single task; give ``partition_column`` with bounds to split
it into ``num_partitions`` range queries, or let ``read_jdbc_split`` ask the
database for ranges of equally many rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """SRC-5: a database table as a DataFrame (lazy; filters and the
    column list are pushed into the generated SQL)."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def key_starts(ask: Callable[[str], list], table: str, key: str, parts: int, bins: int = 256) -> list[int]:
    """First keys of at most ``parts`` ranges of about equally many rows, the first range
    left out (it is open below).

    ``ask`` runs SQL on the database, which counts the rows of ``bins`` equal steps of the
    key; a step with more rows than a range should have is counted again in finer steps,
    down to a single key.  The driver gets counts, at most ``bins`` per question.
    """
    lo, hi, n = ask(f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT({key}) AS n FROM {table}")[0]
    if not n or parts < 2:
        return []
    lo, hi, target = int(lo), int(hi), -(-int(n) // parts)

    def counts(a: int, b: int):
        """(first key, rows) of the steps from a to b, in order."""
        step = max(1, -(-(b - a + 1) // bins))
        asked = ask(f"SELECT s, COUNT(*) AS n FROM (SELECT FLOOR(({key} - {a}) / {step}.0) AS s FROM {table} "
                    f"WHERE {key} >= {a} AND {key} <= {b}) steps GROUP BY s")
        for s, rows in sorted((int(r[0]), int(r[1])) for r in asked):
            first = a + s * step
            if rows > target and step > 1:
                yield from counts(first, min(b, first + step - 1))
            else:
                yield first, rows

    starts, filled = [], 0
    for first, rows in counts(lo, hi):
        if filled and filled + rows > target:
            starts.append(first)
            filled = 0
        filled += rows
    return starts


def read_jdbc_split(spark: SparkSession, url: str, table: str, key: str, partitions: int,
                    properties: dict | None = None, bins: int = 256) -> DataFrame:
    """SRC-5 in several tasks, each a range of the whole-numbered ``key`` with about equally
    many rows, however the keys lie (a key that alone has more rows is one range).  The
    first range takes NULL keys, and the outer ones are open, so rows whose keys appear after
    the question are read too.  There may be some more ranges than ``partitions``."""
    props = dict(properties or {})

    def ask(sql: str) -> list:
        return spark.read.jdbc(url, f"({sql}) asked", properties=props).collect()

    starts = key_starts(ask, table, key, partitions, bins)
    if not starts:
        return spark.read.jdbc(url, table, properties=props)
    ranges = [f"{key} < {starts[0]} OR {key} IS NULL"]
    ranges += [f"{key} >= {a} AND {key} < {b}" for a, b in zip(starts, starts[1:])] + [f"{key} >= {starts[-1]}"]
    return spark.read.jdbc(url, table, predicates=ranges, properties=props)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """SRC-6: an empty DataFrame of a given schema."""
    return spark.createDataFrame([], schema)
