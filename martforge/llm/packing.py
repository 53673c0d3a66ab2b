"""Packing token sequences: patterns fitted by non-negative least squares.

Method
------
1. Every document is tokenized whole; only documents longer than a sequence
   are cut, into full sequences and a rest.  Full pieces need no packing.
2. The histogram of piece lengths (``CAPACITY`` bins, whatever the corpus) is
   all the planner sees.  Lengths are grouped into classes of ``UNIT`` tokens and
   every pattern of up to three documents whose classes fill a sequence is enumerated.
3. Repeat counts of the patterns are fitted to the class histogram by
   non-negative least squares (active set), rounded down, and trimmed where
   they would use more documents than there are.
4. Pattern counts are spelled out in exact lengths, many repeats at a time;
   what is left of each sequence, and the documents in no pattern, go through
   best-fit decreasing in bulk (counts of equal sequences, never one by one).
5. The plan is a table of slots (length, ranks lo..hi -> first sequence,
   offset), whose size depends on the capacity alone.  Pieces of one length are ranked by
   counts per partition, and each finds its slot by its rank.

Defined results: a null text is an empty one (one end token); rows that repeat
a document are packed as further documents.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from martforge.llm.scratch import save
from martforge.llm.tokens import UnitEncoder

CAPACITY = 4096
END_ID = 1
UNIT = 16          # tokens of a length class


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = UnitEncoder.of(path)
        end = int(end_id).to_bytes(4, "little")
        ranks: dict[int, int] = defaultdict(int)      # of each length in this partition
        for b in batches:
            at, piece, start, length, crc, rank, blobs = [], [], [], [], [], [], []
            for i, x in enumerate(b.column("text")):
                ids = enc.ids((x.as_py() or "").encode()) + end
                n = len(ids) // 4
                for j, lo in enumerate(range(0, n, capacity)):
                    part = ids[4 * lo:4 * (lo + capacity)]
                    m = len(part) // 4
                    at.append(i); piece.append(j); start.append(lo); length.append(m)
                    crc.append(zlib.crc32(part)); rank.append(ranks[m]); ranks[m] += 1
                    if with_ids:
                        blobs.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(rank, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "_rank"]
            if with_ids:
                cols.append(pa.array(blobs, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
        enc.units.empty()
    return run


# -- the plan: from the histogram alone ---------------------------------------

def patterns(classes: int, most: int = 3) -> list[tuple[int, ...]]:
    """Every descending tuple of up to ``most`` class sizes that fills ``classes``."""
    out = [(classes,)] if most >= 1 else []
    if most >= 2:
        out += [(a, classes - a) for a in range((classes + 1) // 2, classes)]
    if most >= 3:
        out += [(a, b, classes - a - b) for a in range(1, classes) for b in range(1, a + 1)
                if 1 <= classes - a - b <= b]
    return out


def nnls(A: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x >= 0 with A x near y in least squares (Lawson-Hanson active set).  Ends at the
    least, or when a round no longer brings the squares down by more than rounding."""
    x = np.zeros(A.shape[1])
    active = np.zeros(A.shape[1], dtype=bool)
    tol = 1e-9 * max(1.0, float(np.abs(A.T @ y).max(initial=0)))
    least = np.inf
    while True:
        off = y - A @ x
        if not off @ off < least * (1 - 1e-12):
            break
        least = off @ off
        grad = A.T @ off
        grad[active] = -np.inf
        j = int(np.argmax(grad))
        if not grad[j] > tol:
            break
        active[j] = True
        while True:
            idx = np.flatnonzero(active)
            z = np.linalg.lstsq(A[:, idx], y, rcond=None)[0]
            if (z > tol * 1e-6).all():
                x[:] = 0
                x[idx] = z
                break
            bad = z <= tol * 1e-6
            step = np.min(x[idx][bad] / np.maximum(x[idx][bad] - z[bad], 1e-300))
            x[idx] += step * (z - x[idx])
            drop = idx[bad & (x[idx] <= 1e-9)]
            if not len(drop):
                drop = idx[bad][:1]
            x[drop] = 0
            active[drop] = False
            if not active.any():
                break
    return x


def fit_patterns(hist: np.ndarray, capacity: int, unit: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern of classes, repeats) that together use no more documents of a
    class than there are; ``hist[n]`` counts the pieces of n tokens."""
    classes = capacity // unit
    have = np.zeros(classes + 1, dtype=np.int64)
    np.add.at(have, -(-np.arange(1, capacity) // unit), hist[1:capacity])
    pats = [p for p in patterns(classes) if all(have[c] for c in p)]
    if not pats:
        return []
    # large classes weigh as their tokens: a sequence is lost for each
    w = np.sqrt(np.arange(1, classes + 1))
    A = np.zeros((classes, len(pats)))
    for j, p in enumerate(pats):
        for c in p:
            A[c - 1, j] += w[c - 1]
    x = nnls(A, have[1:] * w)
    out, left = [], have.copy()
    for j in np.argsort(-x, kind="stable"):
        n = int(x[j])
        for c in set(pats[j]):
            n = min(n, int(left[c]) // pats[j].count(c))
        if n > 0:
            for c in pats[j]:
                left[c] -= n
            out.append((pats[j], n))
    return out


def plan(hist: np.ndarray, capacity: int = CAPACITY, unit: int = UNIT) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences) that hold every piece
    of the histogram exactly once."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    groups: list[tuple[list[int], int]] = []
    if left[capacity]:
        groups.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    for pat, n in fit_patterns(left, capacity, unit):
        while n > 0:
            take = left.copy()
            chosen, fits = [], capacity
            for c in pat:                       # the longest of each class that is left
                hi = min(c * unit, capacity - 1, fits)
                lo = (c - 1) * unit + 1
                at = np.flatnonzero(take[lo:hi + 1])
                if not len(at):
                    break
                chosen.append(lo + int(at[-1]))
                take[chosen[-1]] -= 1
                fits -= chosen[-1]
            if len(chosen) < len(pat):
                break
            m = min([n] + [int(left[v]) // chosen.count(v) for v in set(chosen)])
            for v in chosen:
                left[v] -= m
            groups.append((chosen, m))
            n -= m
    # residuals: best-fit decreasing over counts of sequences with equal room
    room: dict[int, list[list]] = defaultdict(list)      # free tokens -> [lengths, count]
    done: list[tuple[list[int], int]] = []
    for lens, m in groups:
        room[capacity - sum(lens)].append([lens, m])
    for n in range(capacity - 1, 0, -1):
        todo = int(left[n])
        while todo:
            free = min((r for r in room if r >= n and room[r]), default=None)
            if free is None:
                per = capacity // n
                full, rest = divmod(todo, per)
                if full:
                    room[capacity - per * n].append([[n] * per, full])
                if rest:
                    room[capacity - rest * n].append([[n] * rest, 1])
                break
            lens, m = room[free].pop()
            k = min(m, todo)
            if k < m:
                room[free].append([lens, m - k])
            room[free - n].append([lens + [n], k])
            todo -= k
        for r in [r for r in room if not room[r]]:
            del room[r]
    for g in room.values():
        done += [(lens, m) for lens, m in g]
    return done


def slots(groups: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, lo, hi, first sequence, offset): the pieces of ``length`` with
    rank lo <= r < hi lie in sequence ``first + r - lo`` at ``offset``."""
    used: dict[int, int] = defaultdict(int)
    out, base = [], 0
    for lens, m in groups:
        offset = 0
        for n in lens:
            out.append((n, used[n], used[n] + m, base, offset))
            used[n] += m
            offset += n
        base += m
    return out


def pack(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY,
         end_id: int = END_ID, unit: int = UNIT, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and the ids with ``with_ids``)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _rank long"
              + (", ids array<int>" if with_ids else ""))
    cut = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
           .mapInArrow(_pieces(path, capacity, end_id, with_ids), schema)
           .withColumn("_part", F.spark_partition_id()))
    pieces = save(spark, cut, "pieces")

    per = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # at most ``capacity`` rows reach the driver
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for r in per.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        hist[r["length"]] = r["n"]
    table = slots(plan(hist, capacity, unit))
    lists = defaultdict(list)
    for n, lo, hi, first, offset in table:
        lists[n].append((lo, first, offset))
    slot_rows = [(n, [lo for lo, _, _ in v], [f for _, f, _ in v], [o for _, _, o in v])
                 for n, v in lists.items()]
    slot_table = spark.createDataFrame(
        slot_rows, "length long, los array<long>, firsts array<long>, offs array<long>")

    ranked = (pieces.join(starts, ["_part", "length"])
              .withColumn("_r", F.col("_base") + F.col("_rank")))
    placed = ranked.join(F.broadcast(slot_table), "length")   # at most ``capacity`` rows
    # slots of a length are in rank order: the last that starts at or below the rank
    which = F.expr("cast(size(filter(los, x -> x <= _r)) as int)")
    placed = placed.withColumn("_w", which)
    out = placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.element_at("firsts", F.col("_w")) + F.col("_r") - F.element_at("los", F.col("_w"))).alias("sequence_id"),
        F.element_at("offs", F.col("_w")).alias("offset"), *(["ids"] if with_ids else []))
    return out
