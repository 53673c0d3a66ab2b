"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Method
------
* Every source has a weight and a target: its share, by weight, of all words,
  but at most ``CAP`` times its own size; what is over goes to the other
  sources by weight until none is above.  The water level is found by a few
  aggregations over the source table (two numbers a round reach the driver).
* A document's key is ``-ln(u) / q``: ``u`` from a hash of the document, ``q``
  its quality weight.  In ascending order of the key, prefixes of a source are
  weighted samples without replacement.
* A source first gives ``floor(target / size)`` complete epochs.  The rest of
  its budget is filled in key order: a document is taken if the prefix sum up
  to it fits; what remains is offered, again in key order, to the documents
  not yet taken that are small enough, and at last to the one that comes
  nearest.
* Prefix sums never gather a source in one task: documents of a source are
  dealt into about equal buckets in order of the key (by the distribution that
  keys of its mix of quality weights have), buckets into groups; sums are
  accumulated over the groups, over the buckets of a group and over the members
  of a bucket, so that of n documents about the root of n / BUCKET_ROWS rows
  meet in one window.

Defined results: null text has size 0; documents of size 0 are taken in
complete epochs and count nothing; a null source is a source of its own, last
in order; rows that repeat a document wholly are taken together or not at all;
several labels of a document count as the best one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from martforge.llm.scratch import dense_order, drop, save

WEIGHTS = (5.0, 2.0, 1.0)      # of the sources in order, repeating
CAP = 3                        # a source, and a document, gives at most so many times its size
QUALITY = {1: 2.0, 0: 0.5}     # weight of a labelled document; 1.0 without a label
BUCKET_ROWS = 500             # documents of a source summed in one place
FILLS = 4                      # passes over what does not fit the first prefix
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(spark: SparkSession, sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, source_size, ...) with each source's target."""
    ranked = dense_order(spark, sizes.select(F.col("source").isNull().alias("last"), "source"),
                         ["last", "source"], "rank").withColumnRenamed("source", "_s")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = save(spark, sizes.join(ranked, sizes["source"].eqNullSafe(F.col("_s")))
             .select(*[sizes[c] for c in sizes.columns], w.alias("w")), "sources")
    level = None
    total = t.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    while True:
        full = F.lit(False) if level is None else F.col("source_size") * cap <= F.col("w") * F.lit(level)
        r = t.agg(F.sum(F.when(full, F.col("source_size") * cap).otherwise(0)).alias("capped"),
                  F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("open")).first()
        nxt = (total - (r["capped"] or 0)) / r["open"] if r["open"] else level
        if nxt == level or nxt is None:
            break
        level = nxt
    return t.select(*sizes.columns,
                    F.least(F.col("w") * F.lit(float(level or 0.0)),
                            (F.col("source_size") * cap).cast("double")).alias("target"))


def _prefix(rows: DataFrame, tie: list[str]) -> DataFrame:
    """``end``: sum of ``amount`` up to and with each row in its source."""
    sums = rows.groupBy("sid", "lot", "bucket").agg(F.sum("amount").alias("b"))
    before = Window.partitionBy("sid", "lot").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("sid").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = (sums.groupBy("sid", "lot").agg(F.sum("b").alias("b"))
            .select("sid", "lot", F.coalesce(F.sum("b").over(above), F.lit(0)).alias("lot_base")))
    base = (sums.withColumn("base", F.coalesce(F.sum("b").over(before), F.lit(0))).join(lots, ["sid", "lot"])
            .select("sid", "bucket", (F.col("base") + F.col("lot_base")).alias("base")))
    inside = (Window.partitionBy("sid", "bucket").orderBy("key", *tie)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # dealt by both keys, even where the rows already lie by source
    dealt = rows.repartition("sid", "bucket")
    return (dealt.withColumn("_in", F.sum("amount").over(inside)).join(base, ["sid", "bucket"])
            .withColumn("end", F.col("base") + F.col("_in")).drop("_in", "base"))


def decisions(spark: SparkSession, docs: DataFrame, labels: DataFrame | None = None, weights=WEIGHTS,
              cap: int = CAP, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """One row per distinct (doc_id, th, source): copies (equal rows), size,
    source_size, target, times (how often the document is taken)."""
    light = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"),
                        F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    base = light.groupBy("doc_id", "th", "source").agg(F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"))
    if labels is not None:
        best = (labels.groupBy(F.col("doc_id").alias("_l")).agg(F.max("quality").alias("_q")))
        base = base.join(best, F.col("doc_id") == F.col("_l"), "left").drop("_l")
    else:
        base = base.withColumn("_q", F.lit(None).cast("int"))
    q = F.lit(1.0)
    for k, v in QUALITY.items():
        q = F.when(F.col("_q") == k, F.lit(v)).otherwise(q)
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "th", F.lit(seed)), 11).cast("double") + 0.5) * F.lit(2.0 ** -53)
    base = save(spark, base.withColumn("q", q).withColumn("key", -F.log(u) / F.col("q")).drop("_q"), "mix")
    kinds = sorted({1.0, *QUALITY.values()})
    sizes = base.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                       F.count(F.lit(1)).alias("n_docs"),
                                       F.array(*[F.avg((F.col("q") == k).cast("int")) for k in kinds]).alias("shares"))
    targets = source_targets(spark, sizes, weights, cap).withColumn("sid", F.xxhash64(F.col("source").isNull(), "source"))
    targets = targets.withColumnRenamed("source", "_src")
    full = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap)).cast("long")
    # the share of a source's documents that have a smaller key, as expected
    below = 1 - sum((F.get("shares", F.lit(i)) * F.exp(F.col("key") * -k) for i, k in enumerate(kinds)), F.lit(0.0))
    rows = (base.join(targets, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
            .withColumn("epochs", F.when(F.col("source_size") > 0, full).otherwise(0))
            .withColumn("room", F.col("target") - F.col("epochs") * F.col("source_size"))
            .withColumn("buckets", F.ceil(F.col("n_docs") / F.lit(float(BUCKET_ROWS))))
            .withColumn("bucket", F.floor(below * F.col("buckets")).cast("long"))
            .withColumn("lot", F.floor(F.col("bucket") / F.ceil(F.sqrt("buckets"))).cast("long"))
            .drop("shares", "buckets", "q")
            .withColumn("amount", F.col("size") * F.col("copies")))
    first = _prefix(rows, ["doc_id", "th"])
    state = save(spark, first.withColumn("extra", (F.col("end") <= F.col("room")).cast("int")).drop("end"), "mix")
    drop(spark, base)
    for i in range(FILLS):
        # written down, so that its true size decides whether it is broadcast
        got = save(spark, state.where("extra = 1").groupBy("sid").agg(F.sum("amount").alias("got")), "got")
        gap = state.join(got, "sid", "left").withColumn("gap", F.col("room") - F.coalesce("got", F.lit(0))).drop("got")
        open_ = gap.where((F.col("extra") == 0) & (F.col("amount") > 0) & (F.col("epochs") < cap))
        if i < FILLS - 1:
            more = _prefix(open_.where("amount <= gap"), ["doc_id", "th"]).where("end <= gap")
        else:       # the one document that leaves the source nearest to its target, if any does
            off = F.abs(F.col("gap") - F.col("amount"))
            near = (open_.where(off < F.col("gap")).groupBy("sid")
                    .agg(F.min(F.struct(off, "key", F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "th")).alias("m")))
            more = (open_.join(near.select(F.col("sid").alias("_n"), F.col("m.key").alias("_k"), F.col("m.th").alias("_m")),
                               (F.col("sid") == F.col("_n")) & (F.col("key") == F.col("_k")) & (F.col("th") == F.col("_m"))))
        more = more.select(F.col("sid").alias("_s"), F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
        hit = (F.col("sid") == F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))
        nxt = save(spark, state.join(more, hit, "left")
                   .withColumn("extra", F.when(F.col("_s").isNotNull(), 1).otherwise(F.col("extra")))
                   .drop("_s", "_d", "_t"), "mix")
        drop(spark, state, got)
        state = nxt
    return state.select("doc_id", "th", "source", "copies", "size", "source_size", "target", "key",
                        (F.col("epochs") + F.col("extra")).alias("times"))


def mix_report(spark: SparkSession, docs: DataFrame, labels: DataFrame | None = None, **kw) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    d = decisions(spark, docs, labels, **kw)
    return (d.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")))


def mix(spark: SparkSession, docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    d = (decisions(spark, docs, labels, id_col=id_col, text_col=text_col, source_col=source_col, **kw)
         .where("times > 0").select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"),
                                    F.col("source").alias("_s"), F.col("times").cast("int").alias("_n")))
    row = docs.select(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row"),
                      F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), F.col(source_col).alias("_src"))
    hit = (F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t"))
           & F.col("_src").eqNullSafe(F.col("_s")))
    return (row.join(d, hit).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
            .select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
