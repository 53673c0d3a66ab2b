"""Threshold-scaled document fingerprints, in DataFrame functions only.

Method: a text's five-word shingles (a text of one to four words is one
shingle) are hashed to 64 bits and every hash below a fixed fraction of the
hash range is kept.  Two such sketches merge by union (``merged``), and the share of one
sketch that lies in another estimates containment however unequal the texts
are.  A text none of whose hashes falls below the bound keeps its least one,
so that only empty texts have an empty fingerprint.

Defined results: a null text is an empty one; two empty fingerprints are
alike (1.0), an empty one and another are not (0.0); documents are taken in
descending doc_id, null last, rows that repeat a doc_id in order of a text
hash; the document after the last is the first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

SHINGLE = 5
FRACTION = 8                   # one hash in so many is kept
BUCKET_ROWS = 1000             # neighbours worked on together
MOST_BUCKETS = 65_536
_SPACE = " \t\n\x0b\x0c\r"
_LEAST_ID = -(1 << 63)


def _threshold(fraction: int) -> int:
    return -(1 << 63) + (1 << 64) // fraction


def with_fingerprint(df: DataFrame, text: str, out: str, fraction: int = FRACTION,
                     k: int = SHINGLE) -> DataFrame:
    """``df`` with column ``out``: the ascending kept hashes (array<long>)."""
    bare = F.btrim(F.col(text), F.lit(_SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[\x20\x09-\x0D]+"))
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_h")
    h = F.col("_h")
    many = F.transform(F.slice(h, 1, F.greatest(n - (k - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))
    df = df.withColumn("_s", F.when(n >= k, many).when(n > 0, F.array(F.xxhash64(h)))
                       .otherwise(F.array().cast("array<long>")))
    bound = F.lit(_threshold(fraction))
    df = df.withColumn("_f", F.array_sort(F.array_distinct(F.filter("_s", lambda x: x < bound))))
    return (df.withColumn(out, F.when((F.size("_f") == 0) & (n > 0), F.array(F.array_min("_s")))
                          .otherwise(F.col("_f"))).drop("_h", "_s", "_f"))


def merged(a: str, b: str, fraction: int = FRACTION) -> Column:
    """The sketch of the shingles of both texts: the union of what was kept by the
    bound.  A least hash that was kept for want of any is not part of it, so it is
    what the bound keeps of the joined shingles, in whatever order sketches are merged."""
    return F.array_sort(F.array_union(*[F.filter(c, lambda x: x < F.lit(_threshold(fraction))) for c in (a, b)]))


def likeness(a: str, b: str) -> Column:
    """Estimated resemblance of two fingerprints."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either).cast("double")


def containment(a: str, b: str) -> Column:
    """Estimated share of the smaller text that lies in the other."""
    least = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(least == 0, F.lit(0.0))
            .otherwise(both / least).cast("double"))


def as_text(fp: str) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), " ")


def with_next(spark: SparkSession, docs: DataFrame, key: str, tie: str, carry: list[str],
              prefix: str = "next_") -> DataFrame:
    """``docs`` with the ``carry`` columns of the following row in descending
    ``key`` (the last row gets those of the first).

    Rows are dealt once into ranges of the key; the first row of a range is
    dealt also to the range before it, so no second shuffle and no global
    window is needed.  Only one key per range reaches the driver.
    """
    k = F.coalesce(F.col(key).cast("long"), F.lit(_LEAST_ID))
    ids = docs.select(k.alias("k"))
    n = ids.count()
    parts = max(1, min(MOST_BUCKETS, -(-n // BUCKET_ROWS)))
    bounds: list[int] = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        found = ids.agg(F.percentile_approx("k", at, max(10_000, 4 * parts)).alias("q")).first()["q"]
        bounds = sorted(set(found or []))
    # two levels of bounds: a row is compared with about 2 * sqrt(ranges) of them
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]

    def range_of(c: Column) -> Column:
        if not bounds:
            return F.lit(0)
        heads = F.array(*[F.lit(g[0]) for g in groups])
        tails = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])
        which = F.size(F.filter(heads, lambda x: x <= c))
        inner = F.size(F.filter(F.get(tails, which - 1), lambda x: x <= c))
        return F.when(which == 0, 0).otherwise((which - 1) * step + inner)

    tops = {r["b"]: r["m"] for r in ids.withColumn("b", range_of(F.col("k")))
            .groupBy("b").agg(F.max("k").alias("m")).collect()}       # one row per range
    if not tops:
        tops = {0: 0}
    filled = sorted(tops)
    above = {b: filled[i + 1] if i + 1 < len(filled) else filled[0] for i, b in enumerate(filled)}
    size = filled[-1] + 1
    top = F.array(*[F.lit(tops.get(b)).cast("long") for b in range(size)])
    to = F.array(*[F.lit(above.get(b)).cast("int") for b in range(size)])

    src = docs.withColumn("_k", k)
    src = src.withColumn("_b", range_of(F.col("_k")).cast("int"))
    own = F.struct(F.col("_b").alias("b"), F.lit(0).alias("ghost"))
    also = F.struct(F.get(to, F.col("_b")).alias("b"), F.lit(1).alias("ghost"))
    src = (src.withColumn("_g", F.explode(F.when(F.get(top, F.col("_b")) == F.col("_k"), F.array(own, also))
                                          .otherwise(F.array(own))))
           .withColumn("_b", F.col("_g.b")).withColumn("_ghost", F.col("_g.ghost")).drop("_g"))
    w = Window.partitionBy("_b").orderBy("_ghost", F.col("_k").desc(), tie)
    for c in carry:
        src = src.withColumn(prefix + c, F.lead(c).over(w))
    return src.where("_ghost = 0").drop("_k", "_b", "_ghost")


def edited_report(spark: SparkSession, docs: DataFrame, fraction: int = FRACTION, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, and of the text whose second half is
    replaced by the beginning of the next document's."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = with_fingerprint(src, "text", "fp", fraction).withColumn("_t", F.xxhash64("text"))
    full = with_next(spark, src, "doc_id", "_t", ["text", "fp"])
    half = F.floor(F.length("text") / 2).cast("int")
    full = (full.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                                               F.substring("next_text", F.lit(1), half)))
            .select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", "next_fp", "edited"))
    full = with_fingerprint(full, "edited", "efp", fraction)
    return full.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text("fp").alias("fingerprint"), as_text("efp").alias("edited_fingerprint"),
                       likeness("fp", "efp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"),
                       containment("fp", "efp").alias("held_edited"), containment("fp", "next_fp").alias("held_next"))
