"""Near-duplicate documents by ProbMinHash, banding and verification.

Method
------
* A document is its multiset of five-word shingles (a text of one to four
  words is one shingle of all its words); the weight of a shingle is how often
  it occurs.
* *ProbMinHash signature*: each shingle is a Poisson process whose rate is its
  weight.  Its arrivals, drawn from a generator seeded by the shingle alone,
  each fall into a random register; a register keeps the shingle that arrives
  first.  A shingle is dropped as soon as its next arrival is later than the
  latest register of its document (early termination), so a document of n
  shingles costs about n + M ln M arrivals instead of n * M.  The share of equal
  registers estimates the probability Jaccard similarity of the weights.
* *Exact copies* are folded: a task hashes most texts once, all later work is on distinct
  texts.
* *Banding*: BANDS bands of ROWS registers.  A text that repeats a shingle has
  the bands of its weights and those of its set (every weight 1); for any other
  text they are the same.  Two texts of similarity 0.8, by plain or by
  probability Jaccard, so share a band with probability 0.9993.
* *Verification* on the full shingle multisets: similarity is the greater of
  plain and probability Jaccard, both computed exactly; 0.8 or more is a link.
* Within a band bucket members are compared with one pivot, not with each
  other.  Members of buckets that are then still in several classes are closed
  exactly, by plain and by probability Jaccard: each meets the hubs of its rarest shingles
  (the text of the commonest shingles with that one; two similar texts have a hub in common), and texts
  of one hub in different classes are joined on their differences from it
  (``_across_classes``), so the work follows the rare differences, not the square of a
  group.  Pairs inside one class cannot change the result and are left out.

Defined results: a null text is an empty one; empty texts are copies of each
other, a text of white space alone is only like its copies; rows that repeat a doc_id are told apart by their text; the class id is
the least doc_id of the class (null only if all are null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm import words as W
from martforge.llm.components import components, grown
from martforge.llm.scratch import dense_order, drop, save

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
TURNS = 2              # further pivots before the exact join
NEAR = 0.3             # likeness to a hub from which on texts are joined by their differences
REMEMBERED = 1 << 17   # texts whose copies a task skips
MASK = 0x9E3779B97F4A7C15   # deals out the further pivots


def shingle_sets(s: W.Slice, k: int = SHINGLE):
    """(row, shingle, weight) sorted by row then shingle, distinct."""
    w = W.find_words(s)
    h = W.span_hashes(s.buf, w.starts, w.ends)
    g, ok = W.grams(h, w.row, k)
    row, sh = w.row[ok], g[ok]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.array([int(np.bitwise_xor.reduce(W.mix(h[a:b] + np.arange(1, b - a + 1, dtype=np.uint64))))
                          for a, b in zip(w.first[short], w.first[short + 1])], dtype=np.uint64)
        row, sh = np.concatenate([row, short]), np.concatenate([sh, W.mix(extra)])
    order = np.lexsort((sh, row))
    row, sh = row[order], sh[order]
    if len(row) == 0:
        return row, sh, np.zeros(0)
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (sh[1:] != sh[:-1])
    at = np.flatnonzero(new)
    return row[at], sh[at], np.diff(np.append(at, len(row))).astype(np.float64)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> W.U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(row: np.ndarray, sh: np.ndarray, weight: np.ndarray, rows: int,
               registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (rows x registers); 0 for a row without shingles."""
    time = np.full((rows, registers), np.inf)
    name = np.zeros((rows, registers), dtype=np.uint64)
    flat_t, flat_n = time.reshape(-1), name.reshape(-1)
    live_row, live, rate, state = row, sh, weight, W.mix(sh)
    t = np.zeros(len(sh))
    latest = np.full(rows, np.inf)
    while len(live):
        state = W.mix(state + W.U(0x9E3779B97F4A7C15))
        t = t - np.log(_uniform(state)) / rate
        cell = live_row * registers + (W.mix(state) % W.U(registers)).astype(np.int64)
        better = np.flatnonzero(t < flat_t[cell])
        if len(better):
            # earliest arrival last, so that it is the one a register keeps
            better = better[np.lexsort((live[better], -t[better]))]
            flat_t[cell[better]] = t[better]
            flat_n[cell[better]] = live[better]
            touched = np.unique(live_row[better])
            latest[touched] = time[touched].max(axis=1)
        go = t < latest[live_row]
        live_row, live, rate, state, t = live_row[go], live[go], rate[go], state[go], t[go]
    return name


def _band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    n = len(sig)
    key = np.zeros((n, bands), dtype=np.uint64)
    parts = sig.reshape(n, bands, rows)
    for r in range(rows):
        key = key * W.U(0x2545F4914F6CDD1D) + parts[:, :, r]
    return W.mix(key + np.arange(1, bands + 1, dtype=np.uint64) * W.U(0x9E3779B97F4A7C15))


def _once(b: pa.RecordBatch, seen: set) -> pa.RecordBatch:
    """The rows of a batch whose text this task has not seen, as far as it remembers."""
    if len(seen) > REMEMBERED:
        seen.clear()
    new = []
    for i, d in enumerate(b.column("dig").to_pylist()):
        if d not in seen:
            seen.add(d)
            new.append(i)
    return b if len(new) == b.num_rows else b.take(pa.array(new, pa.int64()))


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text and bands of each text, once for most of its copies in the partition."""
    seen: set = set()
    for b in batches:
        b = _once(b, seen)
        for s in W.slices(b.column("text")):
            row, sh, weight = shingle_sets(s)
            keys = _band_keys(signatures(row, sh, weight, s.rows), BANDS, ROWS)
            has, again = np.zeros(s.rows, dtype=bool), np.zeros(s.rows, dtype=bool)
            has[row] = True
            again[row[weight > 1]] = True
            twice = np.flatnonzero(again)
            # the sets of texts that repeat shingles, by the same arrivals at rate 1
            own = again[row]
            plain = _band_keys(signatures(np.searchsorted(twice, row[own]), sh[own], np.ones(int(own.sum())),
                                          len(twice)), BANDS, ROWS)
            size = np.where(has, BANDS, 0) + np.where(again, BANDS, 0)
            ends = np.cumsum(size)
            flat = np.empty(int(ends[-1]), dtype=np.uint64)
            at = np.flatnonzero(has)
            flat[((ends - size)[at][:, None] + np.arange(BANDS)).reshape(-1)] = keys[at].reshape(-1)
            flat[((ends - BANDS)[twice][:, None] + np.arange(BANDS)).reshape(-1)] = plain.reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), W.signed(flat))
            yield pa.RecordBatch.from_arrays(
                [b.column("dig").slice(s.lo, s.rows), b.column("text").slice(s.lo, s.rows), lists],
                names=["dig", "text", "bands"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles and weights of each text, packed."""
    for b in batches:
        for s in W.slices(b.column("text")):
            row, sh, weight = shingle_sets(s)
            first = np.searchsorted(row, np.arange(s.rows + 1))
            pack_s, pack_w = sh.tobytes(), weight.astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("node").slice(s.lo, s.rows),
                 pa.array([pack_s[8 * i:8 * j] for i, j in zip(first[:-1], first[1:])], pa.binary()),
                 pa.array([pack_w[4 * i:4 * j] for i, j in zip(first[:-1], first[1:])], pa.binary())],
                names=["node", "sh", "wt"])


def jaccards(sa: np.ndarray, wa: np.ndarray, sb: np.ndarray, wb: np.ndarray) -> tuple[float, float]:
    """Exact plain and probability Jaccard of two sorted weighted sets."""
    both, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0, 0.0
    plain = len(both) / (len(sa) + len(sb) - len(both))
    x, y = wa[ia] / wa.sum(), wb[ib] / wb.sum()
    order = np.argsort(y / x, kind="stable")           # x/y falling
    x, y = x[order], y[order]
    ratio = y / x
    # sum over j of max(x_j / x_i, y_j / y_i): the x side wins where x_j/y_j >= x_i/y_i
    cut = np.searchsorted(ratio, ratio, side="right")
    cx, cy = np.append(0, np.cumsum(x)), np.append(0, np.cumsum(y))
    only_x, only_y = max(0.0, 1 - cx[-1]), max(0.0, 1 - cy[-1])
    total = (cx[cut] + only_x) / x + (cy[-1] - cy[cut] + only_y) / y
    return plain, float(np.sum(1.0 / total))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = [b.column(c) for c in ("a_sh", "a_wt", "b_sh", "b_wt")]
        keep = []
        for i in range(b.num_rows):
            sa, wa, sb, wb = (c[i].as_buffer() for c in cols)
            sa, sb = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
            wa, wb = np.frombuffer(wa, np.uint32), np.frombuffer(wb, np.uint32)
            keep.append(max(jaccards(sa, wa.astype(float), sb, wb.astype(float))) >= SIMILARITY)
        take = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays([b.column("a").take(take), b.column("b").take(take)],
                                         names=["a", "b"])


def _links(spark, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough.  Pairs that are dealt out by b stay there for the first join."""
    a = sets.select(F.col("node").alias("a"), F.col("sh").alias("a_sh"), F.col("wt").alias("a_wt"))
    b = sets.select(F.col("node").alias("b"), F.col("sh").alias("b_sh"), F.col("wt").alias("b_wt"))
    full = (pairs.join(b, "b").join(a, "a").select("a", "b", "a_sh", "a_wt", "b_sh", "b_wt"))
    return save(spark, full.mapInArrow(_verify, "a long, b long"), "links")


def _by_member(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of a pivot (a) and a member (b) of its bucket, dealt out by the member, which is in few buckets."""
    return pairs.repartition("b").distinct()


def _packed(x: pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), kind) for v in x]


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offs = pa.array(np.cumsum([0] + [len(v) for v in values]).astype(np.int32))
    return pa.ListArray.from_arrays(offs, pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sh, wt = _packed(b.column("sh"), np.int64), _packed(b.column("wt"), np.uint32)
        s, w = _lists(sh), _lists([x.astype(np.int64) for x in wt])
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), pa.array([int(x.sum()) for x in wt], pa.int64()),
             pa.ListArray.from_arrays(s.offsets, pa.StructArray.from_arrays([s.values, w.values], names=["s", "w"]))],
            names=["node", "total", "o"])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first shingles of each text that a similar text may share first (those from
    which on at least 0.8 of its set or of its weights stands), and how common the
    shingles of the text are on the whole."""
    for b in batches:
        size = b.column("o").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = b.column("o").flatten()
        w, f = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("w", "f"))
        n, total = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n", "total"))
        row, end = np.repeat(np.arange(len(size)), size), np.cumsum(size)
        # shingles of this text alone come first and match nothing: what follows one is counted from the end
        ends, seen = np.append(0, np.cumsum(w)), np.append(0, np.cumsum(f))
        plain = (end[row] - np.arange(len(row))) / n[row]
        prob = (ends[end[row]] - ends[:-1]) / total[row]
        common = (seen[end] - seen[end - size] + n - size) / n
        at = np.flatnonzero(np.maximum(plain, prob) >= SIMILARITY - 1e-6)
        yield pa.RecordBatch.from_arrays(
            [b.column("node").take(pa.array(row[at])), pa.array(total[row[at]]), flat.field("s").take(pa.array(at)),
             pa.array(common[row[at]], pa.float64()), pa.array(plain[at], pa.float64()), pa.array(prob[at], pa.float64())],
            names=["node", "total", "s", "common", "plain", "prob"])


def _hubs(spark: SparkSession, lists: DataFrame) -> DataFrame:
    """(q, node, total, firsts): each text with each of its hubs, the sum of its weights, and the first shingles
    (s, plain, prob) that lead there with the share of its set and of its weights that stands from there
    on.  Shingles are put in order of their frequency,
    rarest first; two similar texts share one of the first shingles of both.  The hub of
    a shingle is, of the texts that have it among their first, the one whose shingles are
    the most common, so the one with the fewest edits of a group; two similar texts have a
    hub in common."""
    flat = (lists.select("node", "total", F.size("o").alias("n"), F.explode("o").alias("x"))
            .select("node", "total", "n", "x.s", "x.w"))
    # counts are tables, so that a join with them can be split at a hot shingle
    freq = save(spark, flat.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "freq")
    ranked = (flat.join(freq, "s").groupBy("node", "total", "n")
              .agg(F.sort_array(F.collect_list(F.struct("f", "s", "w"))).alias("o")))
    prefix = save(spark, ranked.mapInArrow(
        _prefixes, "node long, total long, s long, common double, plain double, prob double"), "prefix")
    best = save(spark, prefix.groupBy("s").agg(F.max(F.struct("common", F.negate("node").alias("minus"))).alias("m")),
                "best")
    out = save(spark, prefix.join(best, "s").groupBy(F.negate("m.minus").alias("q"), "node")
               .agg(F.first("total").alias("total"), F.collect_list(F.struct("s", "plain", "prob")).alias("firsts")), "hubs")
    drop(spark, prefix, freq, best)
    return out


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a text adds to its hub, what of the hub it lacks, and its likeness to the hub
    by plain and by probability Jaccard."""
    for b in batches:
        own, hub = _packed(b.column("sh"), np.int64), _packed(b.column("hub"), np.int64)
        wt, hub_wt = (_packed(b.column(c), np.uint32) for c in ("wt", "hub_wt"))
        total = [int(x.sum()) for x in wt]
        sides = [((x.view(np.uint64), v.astype(float)), (y.view(np.uint64), w.astype(float)))
                 for x, v, y, w in zip(own, wt, hub, hub_wt)]
        # the earlier text first, as in _verify: sums of floats depend on the order
        first = pc.less(b.column("node"), b.column("q")).to_pylist()
        like = [jaccards(*x, *y) if f else jaccards(*y, *x) for (x, y), f in zip(sides, first)]
        more = [np.setdiff1d(x, y, assume_unique=True) for x, y in zip(own, hub)]
        less = [np.setdiff1d(y, x, assume_unique=True) for x, y in zip(own, hub)]
        yield pa.RecordBatch.from_arrays(
            [b.column(c) for c in ("q", "node", "minor", "most", "firsts")]
            + [pa.array(list(map(len, v)), pa.int64()) for v in (own, more, less)] + [pa.array(total, pa.int64())]
            + [pa.array([f(x) for x in like], pa.float64()) for f in (max, min)] + [_lists(more), _lists(less)],
            names=["q", "node", "minor", "most", "firsts", "n", "more", "less", "total", "near", "far", "plus", "minus"])


def _named(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the label of their node."""
    named = comp.select(F.col("node").alias("m"), F.col("label").alias("l"))
    return (rows.join(named, F.col("node") == F.col("m"), "left")
            .withColumn("label", F.coalesce("l", "node")).drop("m", "l"))


def _from_hubs(spark: SparkSession, hubs: DataFrame, comp: DataFrame, rest: DataFrame, sets: DataFrame) -> DataFrame:
    """The texts of hubs that, with the hub, are in several classes, and how they differ from it
    (``most``: the greatest total of the hub's texts)."""
    own = _named(hubs.join(rest.select("node", "minor"), "node"), comp)
    still = (own.groupBy("q").agg(F.min("label").alias("a"), F.max("label").alias("b"),
                                  F.max(F.when(F.col("node") != F.col("q"), F.col("total"))).alias("most"))
             .where("a <> b").select("q", "most"))
    kinds = ("q long, node long, minor boolean, most long, firsts array<struct<s:long,plain:double,prob:double>>, "
             "n long, more long, less long, total long, near double, far double, plus array<long>, minus array<long>")
    wide = (own.where("node <> q").select("q", "node", "minor", "firsts").join(still, "q")
            .join(sets.select("node", "sh", "wt"), "node")
            .join(sets.select(F.col("node").alias("q"), F.col("sh").alias("hub"), F.col("wt").alias("hub_wt")), "q")
            .mapInArrow(_differences, kinds))
    return save(spark, wide.withColumn("again", F.col("total") > F.col("n")), "differences")


def _open_groups(spark: SparkSession, wide: DataFrame, comp: DataFrame) -> DataFrame:
    """What is left of ``wide``, with labels: the hubs whose texts are still in several classes, one of them
    outside the greatest class of a bucket."""
    own = _named(wide, comp)
    still = (own.groupBy("q").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.max("minor").alias("c"))
             .where("a <> b and c").select("q"))
    return save(spark, own.join(still, "q"), "open")


def _common_at_most(k) -> F.Column:
    """Whether x and y, which differ from their hub in at most ``k`` ways at once, may be similar."""
    lost_x = F.col("x.more") + F.col("y.less") - k
    lost_y = F.col("y.more") + F.col("x.less") - k
    return ((lost_x < F.col("x.total")) & (lost_y < F.col("y.total"))
            & (1 / (1 - F.greatest(lost_x, F.lit(0)) / F.col("x.total"))
               + 1 / (1 - F.greatest(lost_y, F.lit(0)) / F.col("y.total")) <= 1 + 1 / SIMILARITY + 1e-6))


def _across_classes(spark: SparkSession, wide: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes under one hub that may be similar: an exact
    join on what texts do *not* share with their hub.

    Let x lack ``less`` shingles of the hub and hold ``more`` others, and let x and y
    have k of these differences in common.  Then ``x.more + y.less - k`` shingles of x are
    not in y, and the other way round.  A similarity of 0.8 (plain, or by weights, each
    of which is at least one) bounds both losses: with the shares X and Y of their weights in
    common it is at most 1 / (1/X + 1/Y - 1), as for a common i the sum of
    max(x_j / x_i, y_j / y_i) is at least 1 / x_i + (1 - Y) / y_i, and the harmonic mean is
    concave; for sets (all weights one) this is plain Jaccard itself.  So similar texts of
    a large group have differences in common, which are far rarer than the shingles
    of the group: they are joined on those, rarest first, as long as enough of
    them follow.  Texts that may be similar with no difference in common (k = 0) are, if
    neither repeats a shingle, both similar to the hub and so of one class already; the
    few others are met by hub.

    Texts far from their hub (a common line is all they share) differ from it in nearly
    everything; they are joined on the shingle that named the hub, with the same bound
    for the shares X and Y that stand from it on.  One minus either Jaccard is a metric, so
    the likeness of two similar texts to a hub differs by 0.2 at most, and every pair is
    of the near or of the far (texts that are one by plain and the other by probability
    Jaccard, or in between, are taken as both).
    """
    slack, most_sum = 1e-6, F.lit(1 + 1 / SIMILARITY + 1e-6)
    # near the hub: by differences in common
    facts = ["q", "node", "label", "minor", "more", "less", "total"]
    close = wide.where(F.col("near") >= NEAR - slack)
    flat = close.select(*facts, "most", F.explode(F.concat(
        F.transform("plus", lambda s: F.struct(s.alias("s"), F.lit(True).alias("own"))),
        F.transform("minus", lambda s: F.struct(s.alias("s"), F.lit(False).alias("own"))))).alias("d")
    ).select(*facts, "most", "d.s", "d.own")
    shared = flat.groupBy("q", "s", "own").agg(F.count(F.lit(1)).alias("f"), F.min("label").alias("a"),
                                               F.max("label").alias("b")).where("a <> b").select("q", "s", "own", "f")
    shared = save(spark, shared, "shared")
    ranked = (flat.join(shared, ["q", "s", "own"]).groupBy(*facts, "most")
              .agg(F.sort_array(F.collect_list(F.struct("f", "s", "own"))).alias("o")))
    # a difference shared by nobody comes first and matches nothing: what follows is counted from the end.
    # Of two texts of totals up to ``most``, the differences they do not share are at most a quarter of that
    need = F.col("more") + F.col("less") - (1 / SIMILARITY - 1 + slack) * F.col("most")
    first = (ranked.withColumn("m", F.size("o"))
             .withColumn("o", F.slice("o", 1, F.greatest(F.least(F.col("m"), F.floor(F.col("m") - need + 1)), F.lit(0))
                                      .cast("int")))
             .select(*facts, "m", F.posexplode("o").alias("at", "d"))
             .select(*facts, (F.col("m") - F.col("at")).alias("left"), "d.s", "d.own"))
    no = F.lit(None).cast("double")
    by_difference = first.select(*facts, "left", F.when(F.col("own"), 0).otherwise(1).alias("kind"), "s",
                                 F.col("minor").alias("x"), F.lit(True).alias("y"), no.alias("plain"), no.alias("prob"))
    # with none in common: texts that repeat a shingle (y) and those that may be similar to them, or the other way round
    free = wide.where(F.col("more") <= (1 - SIMILARITY + slack) * F.col("total"))
    meets = F.array(F.struct(F.lit(2).alias("kind"), F.col("minor").alias("x"), F.col("again").alias("y")),
                    F.struct(F.lit(3).alias("kind"), (F.col("minor") & F.col("again")).alias("x"), F.lit(True).alias("y")))
    by_hub = (free.select(*facts, F.explode(meets).alias("m")).where("m.x or m.y")
              .select(*facts, F.lit(0).cast("long").alias("left"), "m.kind", F.lit(0).cast("long").alias("s"),
                      "m.x", "m.y", no.alias("plain"), no.alias("prob")))
    # far from it: by the shingle that named the hub
    far = wide.where(F.col("far") <= NEAR + 1 - SIMILARITY + slack)
    by_shingle = (far.select(*facts, F.explode("firsts").alias("m"))
                  .select(*facts, F.lit(0).cast("long").alias("left"), F.lit(4).alias("kind"), "m.s",
                          F.col("minor").alias("x"), F.lit(True).alias("y"), "m.plain", "m.prob"))
    # all in one join, each kind by itself
    meet = save(spark, by_difference.unionByName(by_hub).unionByName(by_shingle), "meet")
    similar = F.when(F.col("x.kind") == 4, (1 / F.col("x.plain") + 1 / F.col("y.plain") <= most_sum)
                     | (1 / F.col("x.prob") + 1 / F.col("y.prob") <= most_sum)
                     ).otherwise(_common_at_most(F.least("x.left", "y.left")))
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("q", "kind", "s")]
    pairs = (meet.where("x").alias("x").join(meet.where("y").alias("y"),
                                             same[0] & same[1] & same[2] & (F.col("x.label") != F.col("y.label")) & similar)
             .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")))
    out = save(spark, pairs.distinct(), "across")
    drop(spark, shared, meet)
    return out


def _closed(spark: SparkSession, rest: DataFrame, sets: DataFrame, comp: DataFrame) -> DataFrame:
    """Components of ``comp`` with every link between the texts of ``rest`` (node, minor:
    whether it is outside the greatest class of some bucket) that joins two of them."""
    lists = (rest.select("node").join(sets.select("node", "sh", "wt"), "node")
             .mapInArrow(_unpack, "node long, total long, o array<struct<s:long,w:long>>"))
    hubs = _hubs(spark, lists)
    wide = _from_hubs(spark, hubs, comp, rest, sets)
    comp = grown(spark, comp, wide.where(F.col("near") >= SIMILARITY).select("q", "node"))
    left = _open_groups(spark, wide, comp)
    drop(spark, hubs, wide)
    across = _across_classes(spark, left)
    links = _links(spark, across, sets)
    comp = grown(spark, comp, links)
    drop(spark, left, across, links)
    return comp


def _unresolved(buckets: DataFrame, comp: DataFrame, turn: int = 0) -> DataFrame:
    """(band, node, label, big, pivot) of the bands whose members are still in several classes, with
    the greatest class (big) and a member of it, another one each turn.  A bucket of two is settled."""
    labelled = _named(buckets.select("band", "node"), comp)
    mask = F.lit(MASK * (turn + 1) % (1 << 62))      # puts the members in another order, and can be undone
    sizes = labelled.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("node").bitwiseXOR(mask)).alias("h"))
    split = (sizes.groupBy("band").agg(F.max(F.struct("n", "label", "h")).alias("big"), F.sum("n").alias("total"),
                                       F.count(F.lit(1)).alias("parts"))
             .where("parts > 1 and total > 2")
             .select("band", F.col("big.label").alias("big"), F.col("big.h").bitwiseXOR(mask).alias("pivot")))
    return labelled.join(split, "band")


def classes(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(dig, class_id, rep, cls): the class of each distinct text, by its digest.
    ``dig`` is ``text_digest`` of the text, ``rep`` its least doc_id, ``cls`` a
    number of the class (two classes may share a least id that rows repeat)."""
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = keyed.withColumn("dig", text_digest("text"))
    seen = save(spark, keyed.groupBy("dig").agg(F.min("doc_id").alias("rep")), "seen")
    # texts are numbered by their least doc_id: pivots are the earliest texts
    order = dense_order(spark, seen, ["rep", "dig"], "node", distinct=True)
    texts = save(spark, order.select("dig", "rep", "node"), "texts")
    drop(spark, seen, order)

    bands = save(spark, keyed.select("dig", "text")
                 .mapInArrow(_band_rows, "dig binary, text string, bands array<long>"), "bands")
    # copies that tasks did not see of each other go where their text meets its number
    flat = save(spark, bands.select("dig", "bands").dropDuplicates(["dig"]).join(texts.select("dig", "node"), "dig")
                .select("node", F.explode(F.array_distinct("bands")).alias("band")), "flat")
    pivots = (flat.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
              .where("pivot < top").select("band", "pivot"))
    buckets = save(spark, flat.join(pivots, "band"), "buckets")
    drop(spark, flat)

    members = buckets.select("node").distinct().join(texts.select("dig", "node"), "node")
    sets = save(spark, bands.select("dig", "text").join(members, "dig").dropDuplicates(["dig", "node"])
                .select("node", "text").mapInArrow(_set_rows, "node long, sh binary, wt binary"), "sets")
    drop(spark, bands)
    pairs = buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = _links(spark, _by_member(pairs), sets)
    comp = components(spark, links)
    drop(spark, links)
    for turn in range(TURNS):
        # members outside the greatest class of their bucket meet another pivot of it
        mixed = save(spark, _unresolved(buckets, comp, turn).where("label <> big")
                     .select(F.col("pivot").alias("a"), F.col("node").alias("b")), "mixed")
        if mixed.isEmpty():
            drop(spark, mixed)
            break
        links = _links(spark, _by_member(mixed), sets)
        comp = grown(spark, comp, links)
        drop(spark, links, mixed)
    rest = save(spark, _unresolved(buckets, comp).groupBy("node")
                .agg(F.max(F.col("label") != F.col("big")).alias("minor")), "rest")
    drop(spark, buckets)
    final = comp if rest.isEmpty() else _closed(spark, rest, sets, comp)
    drop(spark, sets, rest)
    least = (texts.join(final.withColumnRenamed("node", "m"), F.col("node") == F.col("m"), "left")
             .select("dig", "rep", F.coalesce("label", "node").alias("label")))
    ids = least.groupBy("label").agg(F.min("rep").alias("class_id"))
    return least.join(ids, "label").select("dig", "class_id", "rep", F.col("label").alias("cls"))


def text_digest(text) -> F.Column:
    """128-bit key of a text (null: of the empty text)."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, class_id of every row."""
    found = save(spark, classes(spark, docs, id_col, text_col).select("dig", "class_id"), "classes")
    return (docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("dig"))
            .join(found, "dig").select("doc_id", "class_id"))


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the least doc_id (rows of
    that doc_id that differ elsewhere count as the same document, one stays)."""
    found = save(spark, classes(spark, docs, id_col, text_col), "classes")
    # the text that stands for a class: the least digest among those with its least id
    best = (found.where(F.col("rep").eqNullSafe(F.col("class_id"))).groupBy("cls")
            .agg(F.min("dig").alias("_dig"), F.first("class_id").alias("_id")).select("_dig", "_id"))
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    hit = (docs.select(row.alias("_row"), F.col(id_col).cast("long").alias("_own"),
                       text_digest(text_col).alias("_dig"))
           .join(best, "_dig").where(F.col("_own").eqNullSafe(F.col("_id"))))
    one = hit.groupBy("_dig").agg(F.first("_row").alias("_row"))
    return one.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
