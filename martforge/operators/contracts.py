"""Contract of the dimensions: declared shapes and unique keys (DDL-1, AGG-1's condition).

The star join multiplies a sale by the rows that share its dimension key, so a key that
stands twice counts sales twice, and a NULL key or a missing column loses them.  Keys are
counted with partial sums before the shuffle; a key that repeats often arrives as one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import schemas


class ContractError(RuntimeError):
    """A dimension breaks its contract and the config says fail."""


#: Declared shape and key of each dimension.
DECLARED: dict[str, tuple[T.StructType, list[str]]] = {
    "customer": (schemas.CUSTOMER, ["customer_id"]),
    "store": (schemas.STORE, ["id"]),
    "sales_team": (schemas.SALES_TEAM, ["id"]),
    "product": (schemas.PRODUCT, ["id"]),
}

VIOLATIONS = T.StructType([
    T.StructField("dimension", T.StringType()),
    T.StructField("problem", T.StringType()),      # missing column, type, null key, duplicate key
    T.StructField("subject", T.StringType()),      # the column, or the key's values as text
    T.StructField("n_rows", T.LongType()),         # rows of the key; null for columns
    T.StructField("rows_differ", T.BooleanType()),  # whether rows of the key disagree; null for columns
])

_WHOLE = ["tinyint", "smallint", "int", "bigint"]


def _fits(have: T.DataType, want: T.DataType) -> bool:
    h, w = have.simpleString(), want.simpleString()
    if h in _WHOLE and w in _WHOLE:
        return _WHOLE.index(h) <= _WHOLE.index(w)
    return h == w


def shape_violations(df: DataFrame, shape: T.StructType, name: str) -> DataFrame:
    """Declared columns that ``df`` lacks or holds in a type that does not fit (a smaller
    whole number fits).  Extra columns are no violation.  No job runs."""
    have = {f.name: f.dataType for f in df.schema.fields}
    rows = [(name, "missing column" if f.name not in have else "type", f.name, None, None)
            for f in shape.fields if f.name not in have or not _fits(have[f.name], f.dataType)]
    return df.sparkSession.createDataFrame(rows, VIOLATIONS)


def key_violations(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """Keys that are NULL in a part or stand in more than one row.

    ``rows_differ``: the rows of the key are not all equal (compared as a whole, NULL
    equal to NULL), so which one a join picks up matters.
    """
    rest = F.struct(*[F.col(c) for c in df.columns if c not in key] or [F.lit(1)])
    n_null = sum((F.col(c).isNull().cast("int") for c in key), F.lit(0))
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in key])
    found = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.min(rest).alias("_lo"), F.max(rest).alias("_hi"))
             .withColumn("_null", n_null > 0).where("_null or n_rows > 1"))
    return found.select(
        F.lit(name).alias("dimension"),
        F.when(F.col("_null"), "null key").otherwise("duplicate key").alias("problem"), text.alias("subject"),
        "n_rows", (~F.col("_lo").eqNullSafe(F.col("_hi"))).alias("rows_differ"))


def dimension_violations(dims: dict[str, DataFrame]) -> DataFrame:
    """All violations of the named dimensions, one row each; empty when they keep their
    contract.  A key is counted only when its columns are there."""
    out = None
    for name, df in dims.items():
        shape, key = DECLARED[name]
        parts = [shape_violations(df, shape, name)]
        if set(key) <= set(df.columns):
            parts.append(key_violations(df, key, name))
        for part in parts:
            out = part if out is None else out.unionByName(part)
    return out


def refuse(violations: DataFrame, shown: int = 20) -> None:
    """Raise when there is any violation; the message names the first few."""
    first = violations.orderBy("dimension", "problem", "subject").limit(shown).collect()
    if first:
        raise ContractError("; ".join(f"{r.dimension}: {r.problem} {r.subject}" for r in first))
