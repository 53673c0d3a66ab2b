"""Writing sales drops as CSV files (SNK-11) and the drop set used by the
registered ingest queries.

``derived_drops`` cuts the canonical fact (built from the driver tables)
into three drops by ship date — every row goes to exactly one drop — and
writes each with a different header shape:

* ``clean``    before 1998: the mandatory columns in canonical order;
* ``extra``    1998–1999: an extra column in front, the mandatory columns
               reversed, and a second extra column at the end; rows with
               quantity 50 carry a store id that does not parse (``S<id>``),
               so they end up as bad rows;
* ``missing``  2000 onward: ``store_id`` left out (quarantined on ingest).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.schemas import MANDATORY
from martforge.session import dropping_shuffles, shared_dir

# Drop boundaries and shapes of the derived drop set.
CLEAN_BEFORE = "1998-01-01"
EXTRA_BEFORE = "2000-01-01"
EXTRA_FRONT = "payment_mode"
EXTRA_BACK = "coupon"
CORRUPT_QUANTITY = 50


def payment_mode(quantity: str = "quantity") -> Column:
    return F.when(F.col(quantity) > 25, F.lit("UPI")).otherwise(F.lit("cash"))


def coupon(quantity: str = "quantity") -> Column:
    return F.when(F.col(quantity) >= 45, F.concat(F.lit("Q"), F.col(quantity).cast("string")))


def corrupt_store_id() -> Column:
    sid = F.col("store_id").cast("string")
    return F.when(F.col("quantity") == CORRUPT_QUANTITY, F.concat(F.lit("S"), sid)).otherwise(sid)


def write_drop(df: DataFrame, path: str, columns: list[str | Column]) -> str:
    """Write ``df`` as headed CSV files below ``path`` (one file per task)."""
    with dropping_shuffles(df.sparkSession):
        df.select(*columns).write.mode("errorifexists").option("header", "true").csv(path)
    return path


def derived_drops(fact: DataFrame, root: str) -> dict[str, str]:
    """Write the three drops below ``root``; return {drop name: folder}.

    The fact is computed once (checkpointed to the shared checkpoint dir)
    and the three writes read that copy instead of re-running its joins.
    """
    shared_dir(fact.sparkSession)
    fact = fact.checkpoint(eager=True)
    d = F.col("sales_date")
    clean = fact.where(d < F.lit(CLEAN_BEFORE).cast("date"))
    extra = fact.where((d >= F.lit(CLEAN_BEFORE).cast("date")) & (d < F.lit(EXTRA_BEFORE).cast("date")))
    missing = fact.where(d >= F.lit(EXTRA_BEFORE).cast("date"))
    out = {
        "clean": write_drop(clean, f"{root}/clean", MANDATORY),
        "extra": write_drop(extra, f"{root}/extra",
                            [payment_mode().alias(EXTRA_FRONT),
                             *[corrupt_store_id().alias(c) if c == "store_id" else F.col(c)
                               for c in reversed(MANDATORY)],
                             coupon().alias(EXTRA_BACK)]),
        "missing": write_drop(missing, f"{root}/missing",
                              [c for c in MANDATORY if c != "store_id"] + [payment_mode().alias(EXTRA_FRONT)]),
    }
    return out


#: Header shapes of the many-shape drop set: 8 rotations x 2 directions x 13 numbers of extras.
SHAPES = 8 * 2 * 13


def shape_columns(shape: int) -> list[str]:
    """The header of a shape: ``shape // 16`` extras in front of the mandatory columns,
    which are turned by ``shape % 8`` places and reversed for every other eight."""
    turn = shape % 8
    cols = MANDATORY[turn:] + MANDATORY[:turn]
    return [f"extra_{j}" for j in range(shape // 16)] + (cols[::-1] if shape // 8 % 2 else cols)


def shape_lines(fact: DataFrame, derived: dict[str, Column] | None = None) -> DataFrame:
    """(value, drop): the lines of ``many_shapes`` with their shape, each shape in one
    partition and its header first.

    The rows go to their shape as they are and become text there: the text, with its
    extras, takes more room in the shuffle files.  ``derived`` are columns that ``fact``
    lacks, from others of the same row; they are computed there too."""
    shape = F.pmod(F.col("customer_id") * 7 + F.col("quantity"), F.lit(SHAPES)).cast("int")
    spark = fact.sparkSession
    headers = spark.createDataFrame([(i, shape_columns(i)) for i in range(SHAPES)], "shape int, columns array<string>")
    derived = derived or {}
    kept = [c for c in MANDATORY if c not in derived]
    rows = fact.select(shape.alias("shape"), F.lit(1).alias("place"), *kept)
    heads = headers.select("shape", F.lit(0).alias("place"),
                           *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in kept])
    cell = lambda c: F.coalesce(derived.get(c, F.col(c)).cast("string"), F.lit(""))
    cells = F.map_from_arrays(F.array(*[F.lit(c) for c in MANDATORY]), F.array(*[cell(c) for c in MANDATORY]))
    line = F.concat_ws(",", F.transform("columns", lambda c: F.coalesce(
        F.try_element_at("cells", c), F.concat(F.col("shape").cast("string"), F.lit("-"), F.substring(c, 7, 10)))))
    # a fixed table of SHAPES rows
    lines = (heads.union(rows).repartition(SHAPES, "shape").withColumn("cells", cells)
             .join(F.broadcast(headers), "shape")
             .select("shape", "place", F.when(F.col("place") == 0, F.concat_ws(",", "columns")).otherwise(line).alias("value")))
    # the header is the first line of its file: sorted by shape, which the writer asks for anyway
    return lines.sortWithinPartitions("shape", "place").select("value", F.col("shape").alias("drop"))


def many_shapes(fact: DataFrame, root: str, derived: dict[str, Column] | None = None) -> str:
    """Every row of the fact in a drop of one of ``SHAPES`` header shapes (by customer and
    quantity), one folder per shape; the extras hold the shape and their number."""
    with dropping_shuffles(fact.sparkSession):
        shape_lines(fact, derived).write.partitionBy("drop").option("quote", "").option("sep", "\x01").csv(root)
    return root
