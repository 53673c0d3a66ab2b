"""Connected components of an edge list by alternating star contraction.

Each round joins every node to the least node of its neighbourhood: first
its greater neighbours (large star), then its smaller ones (small star).
The edges stay as many as before (those that have become equal are not sought
out, which would take a shuffle), a hub only ever sends and gets one minimum,
and the rounds needed grow with the logarithm of the longest chain.  A task first
joins the edges that it holds to stars, so a small list needs few rounds.
The steps of a round are written to the shared folder, so that the size of a
table of minima decides whether it is broadcast; only the answer whether a node
is left that is no star's reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm.scratch import drop, save


HELD = 1 << 18         # edges that a task joins at once


def star_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node) of the components of the edges (u, v)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = np.arange(len(nodes))
    a, b = at[:len(u)], at[len(u):]
    while True:
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    leaf = label != np.arange(len(nodes))
    return nodes[leaf], nodes[label[leaf]]


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the same components, joined to stars as far as a task holds them together."""
    kept, rows = [], 0

    def stars():
        t = pa.Table.from_batches(kept)
        out = star_edges(*(c.to_numpy() for c in t.columns))
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, t.schema)], names=["u", "v"])

    for b in batches:
        kept.append(b)
        rows += b.num_rows
        if rows >= HELD:
            yield stars()
            kept, rows = [], 0
    if rows:
        yield stars()


def _stars(e: DataFrame) -> DataFrame:
    return e.mapInArrow(_held, e.schema)


def _least(spark: SparkSession, e: DataFrame) -> DataFrame:
    """(u, m, loose): each node with the least of itself and its neighbours, and whether it
    is more than the centre or a leaf of a star around its least node."""
    both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")).toDF("u", "v"))
    less, more = F.when(F.col("v") < F.col("u"), F.col("v")), F.count_if(F.col("v") > F.col("u"))
    # an edge may stand several times
    loose = F.coalesce((F.max(less) != F.min(less)) | (F.min(less).isNotNull() & (more > 0)), F.lit(False))
    return save(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), loose.alias("loose")), "least")


def _large(spark: SparkSession, e: DataFrame, least: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("g"), F.least("u", "v").alias("u"))
    return save(spark, down.join(least, "u").select(F.col("g").alias("u"), F.col("m").alias("v")), "large")


def _small(spark: SparkSession, e: DataFrame) -> DataFrame:
    least = save(spark, e.groupBy("u").agg(F.min("v").alias("m")), "small")
    # the edge to the least neighbour stays, any other one moves to it
    moved = e.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"),
                                      F.col("m").alias("v"))
    out = save(spark, _stars(moved), "edges")
    drop(spark, least)
    return out


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge; label is the least node
    of its component.  ``edges`` has two columns of one type that sorts."""
    cur = save(spark, _stars(edges.toDF("u", "v").where("u <> v")), "edges")
    if cur.isEmpty():
        none = cur.toDF("node", "label")
        none._scratch = cur._scratch
        return none
    while True:
        least = _least(spark, cur)
        if least.where("loose").isEmpty():
            break
        large = _large(spark, cur, least)
        nxt = _small(spark, large)
        drop(spark, cur, least, large)
        cur = nxt
    drop(spark, cur)
    out = least.select(F.col("u").alias("node"), F.col("m").alias("label"))
    out._scratch = least._scratch
    return out


def grown(spark: SparkSession, comp: DataFrame, edges: DataFrame) -> DataFrame:
    """Components of ``comp`` (made by ``components``) with more ``edges`` (a written table):
    only what the edges join is contracted.  ``comp`` is dropped unless nothing is joined."""
    a, b = edges.columns
    label = comp.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    e = edges
    for c in (a, b):
        e = e.join(label, F.col(c) == F.col("_n"), "left").withColumn(c, F.coalesce("_l", c)).drop("_n", "_l")
    joined = components(spark, e)
    if joined.isEmpty():
        drop(spark, joined)
        return comp
    new = joined.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    old = (comp.join(new, F.col("label") == F.col("_n"), "left")
           .select("node", F.coalesce("_l", "label").alias("label")))
    alone = joined.join(comp.select("node"), "node", "left_anti")
    out = save(spark, old.union(alone.select("node", "label")), "components")
    drop(spark, comp, joined)
    return out
