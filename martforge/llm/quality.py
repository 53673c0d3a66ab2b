"""Quality rules judged by an isolation forest.

Method
------
* Rule statistics of every whole text, exactly (``STATS``), and scale-free
  features made of them (``FEATURES``).
* *Forests*: one for each group of features (``GROUPS``), so that a rare value of one kind
  (a repeated line) does not hide another (symbols on every word).  Each of the ``TREES`` trees of a forest is
  grown on its own ``SUBSAMPLE`` documents
  (picked by a hash of the document, so the sample is bounded and the same at
  every run) by random splits down to the usual depth limit; the anomaly score of
  a document is ``2 ** (-E[path length] / c(SUBSAMPLE))``.
* *Thresholds*: scores of all labelled rows that pass the base rules are counted in ``BINS``
  bins per group and label.  A group's threshold gains most where a bad document rejected gains
  one and a good one rejected costs ``GOOD_COST``, among those that reject no more than ``FALSE_SHARE`` of the
  good ones.  A group that so catches less than ``LEAST_CAUGHT`` of the bad ones rejects nothing; without
  labels of both kinds none does.
* A document stays if it passes the base rules and every forest.

Defined results: a null text is an empty one (no words: the base rules fail);
several labels of a document count as the best one; rows that repeat a document are
judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm import words as W
from martforge.llm.scratch import save

TREES = 100
SUBSAMPLE = 256
BINS = 2000
FALSE_SHARE = 0.005        # of the good labelled documents, for each group
GOOD_COST = 5              # bad documents that a good one lost outweighs
LEAST_CAUGHT = 0.02        # of the bad labelled documents, for a group to count
MIN_WORDS = 50
MAX_REPEAT = 50            # percent of words in repeated windows
WINDOW = 3
SYMBOLS = b"#*$%&|<>"

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["word_len", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "line_words"]
GROUPS = {"words": ["word_len", "symbols"], "repeats": ["dup_lines", "repeats"],
          "shape": ["upper", "digits", "marks", "line_words"]}

_SYM = np.zeros(256, dtype=np.int64)
_SYM[list(SYMBOLS)] = 1
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[0x41:0x5B] = 1
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[0x30:0x3A] = 1
_MARK = np.zeros(256, dtype=np.int64)
_MARK[list(b"!?;:\"()[]{}=+/\\~^_@")] = 1


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=acc[1:])
    return acc[offs[1:]] - acc[offs[:-1]]


def statistics(s: W.Slice) -> dict[str, np.ndarray]:
    """STATS of each row, and the counts behind FEATURES."""
    rows = s.rows
    w = W.find_words(s)
    lead = (s.buf & 0xC0) != 0x80                     # first bytes of code points
    inside = W._WORD_BYTE[s.buf]
    out = {"n_words": np.diff(w.first).astype(np.int64),
           "word_chars": _per_row((lead & inside).astype(np.int64), s.offs),
           "n_symbols": _per_row(_SYM[s.buf], s.offs), "upper": _per_row(_UPPER[s.buf], s.offs),
           "digits": _per_row(_DIGIT[s.buf], s.offs), "marks": _per_row(_MARK[s.buf], s.offs)}
    # windows found twice or more in their row
    h = W.span_hashes(s.buf, w.starts, w.ends)
    g, ok = W.grams(h, w.row, WINDOW)
    at = np.flatnonzero(ok)
    covered = np.zeros(len(h) + 1, dtype=np.int64)
    if len(at):
        key = g[at] ^ W.mix(w.row[at].astype(np.uint64) + W.U(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(w.row[np.cumsum(covered[:-1]) > 0], minlength=rows)
    # lines with a word that equal an earlier line of their row
    brk = np.flatnonzero(s.buf == 0x0A)
    starts = np.unique(np.concatenate([s.offs[:-1], brk + 1]))
    starts = starts[starts < len(s.buf)]
    line_row = np.searchsorted(s.offs, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(s.buf)), s.offs[line_row + 1]) if len(starts) else starts
    has_word = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, line_row = starts[has_word], ends[has_word], line_row[has_word]
    ends = ends - (s.buf[ends - 1] == 0x0A) if len(ends) else ends
    out["n_lines"] = np.bincount(line_row, minlength=rows)
    lh = W.span_hashes(s.buf, starts, ends) ^ W.mix(line_row.astype(np.uint64) + W.U(1))
    _, first = np.unique(lh, return_index=True)
    later = np.ones(len(lh), dtype=bool)
    later[first] = False
    out["n_dup_lines"] = np.bincount(line_row[later], minlength=rows)
    return out


def features(st: dict[str, np.ndarray]) -> np.ndarray:
    n = np.maximum(st["n_words"], 1)
    chars = np.maximum(st["word_chars"], 1)
    lines = np.maximum(st["n_lines"], 1)
    return np.stack([chars / n, st["n_symbols"] / n, st["n_dup_lines"] / lines, st["n_repeat_words"] / n,
                     st["upper"] / chars, st["digits"] / chars, st["marks"] / n,
                     np.log1p(st["n_words"] / lines)], axis=1)


def _stat_rows(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in W.slices(b.column("_text")):
                st = statistics(s)
                x = features(st)
                keep = [b.column(c).slice(s.lo, s.rows) for c in names]
                yield pa.RecordBatch.from_arrays(
                    keep + [pa.array(st[c].astype(np.int64)) for c in STATS]
                    + [pa.array(x[:, j]) for j in range(x.shape[1])], names=names + STATS + FEATURES)
    return run


def rule_statistics(docs: DataFrame, carry: dict[str, str], text_col: str = "text") -> DataFrame:
    """STATS and FEATURES of every row, with the columns of ``carry`` (new name
    -> name in ``docs``)."""
    src = docs.select(*[F.col(c).alias(n) for n, c in carry.items()], F.col(text_col).alias("_text"))
    schema = ", ".join([f"`{n}` {t}" for n, t in src.drop("_text").dtypes]
                       + [f"{c} long" for c in STATS] + [f"{c} double" for c in FEATURES])
    return src.mapInArrow(_stat_rows(list(carry)), schema)


# -- the forest ---------------------------------------------------------------

def average_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, rng: np.random.Generator, depth: int) -> dict[str, np.ndarray]:
    """One tree as arrays: feature (-1: leaf), cut, left child, leaf length."""
    feat, cut, left, length = [-1], [0.0], [0], [0.0]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, d = todo.pop()
        part = x[rows]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 else np.zeros(0, int)
        if d >= depth or not len(spread):
            length[node] = d + float(average_path(len(rows)))
            continue
        f = int(rng.choice(spread))
        lo, hi = part[:, f].min(), part[:, f].max()
        c = rng.uniform(lo, hi)
        go = part[:, f] < c
        feat[node], cut[node], left[node] = f, c, len(feat)
        for side in (go, ~go):
            feat.append(-1); cut.append(0.0); left.append(0); length.append(0.0)
        todo.append((left[node], rows[go], d + 1))
        todo.append((left[node] + 1, rows[~go], d + 1))
    return {"feat": np.array(feat), "cut": np.array(cut), "left": np.array(left), "length": np.array(length)}


def path_length(tree: dict[str, np.ndarray], x: np.ndarray, depth: int) -> np.ndarray:
    node = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    for _ in range(depth):
        f = tree["feat"][node]
        inner = f >= 0
        if not inner.any():
            break
        step = tree["left"][node] + (x[rows, np.maximum(f, 0)] >= tree["cut"][node])
        node = np.where(inner, step, node)
    return tree["length"][node]


def anomaly(forest: list[dict[str, np.ndarray]], x: np.ndarray, subsample: int) -> np.ndarray:
    if not forest or not len(x):
        return np.zeros(len(x))
    depth = int(np.ceil(np.log2(max(2, subsample))))
    mean = np.zeros(len(x))
    for t in forest:
        mean += path_length(t, x, depth)
    return 2.0 ** (-(mean / len(forest)) / float(average_path(subsample)))


def fit_forests(spark: SparkSession, stats: DataFrame, groups: dict[str, list[str]] = GROUPS, trees: int = TREES,
                subsample: int = SUBSAMPLE):
    """({group: forest}, subsample): grown on about trees * subsample documents, whatever the
    ids: rows that repeat a document count once."""
    stats = stats.dropDuplicates(["_id", "_th"])
    n = stats.count()
    if n == 0:
        return {g: [] for g in groups}, subsample
    share = min(1.0, 1.1 * trees * subsample / n)
    u = F.pmod(F.xxhash64("_id", "_th", F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    rows = (stats.withColumn("_u", u).where(F.col("_u") < share).select("_u", *FEATURES)
            .orderBy("_u", *FEATURES).collect())                 # bounded by the parameters
    if not rows:
        return {g: [] for g in groups}, subsample
    size = min(subsample, len(rows))
    forests = {}
    for g, names in groups.items():
        x = np.array([[r[c] for c in names] for r in rows])
        rng = np.random.default_rng(17)
        order = np.arange(len(x))
        forests[g] = []
        for t in range(trees):
            pick = (order[t * size:(t + 1) * size] if (t + 1) * size <= len(x)
                    else rng.choice(len(x), size, replace=False))
            forests[g].append(grow(x[pick], rng, int(np.ceil(np.log2(max(2, size))))))
    return forests, size


def fit_forest(spark: SparkSession, stats: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE):
    """(forest, subsample): one forest of all features."""
    forests, size = fit_forests(spark, stats, {"all": FEATURES}, trees, subsample)
    return forests["all"], size


def _score_rows(forests, size: int, names: list[str], groups: dict[str, list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [anomaly(forests[g], np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in f], axis=1), size)
                      for g, f in groups.items()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(x) for x in scores],
                                             names=names + [f"anomaly_{g}" for g in groups])
    return run


def thresholds(scored: DataFrame, labels: DataFrame, groups=GROUPS, false_share: float = FALSE_SHARE,
               good_cost: float = GOOD_COST, least: float = LEAST_CAUGHT, bins: int = BINS) -> dict[str, float]:
    """The least score that each group rejects (above 1: nothing is)."""
    best = labels.groupBy(F.col("doc_id").alias("_l")).agg(F.max("quality").alias("_q")).where("_q is not null")
    each = F.array(*[F.struct(F.lit(g).alias("g"), F.floor(F.col(f"anomaly_{g}") * bins).alias("bin")) for g in groups])
    hist = (scored.where("not base_failed").join(best, F.col("_id") == F.col("_l"))
            .select(F.explode(each).alias("e"), (F.col("_q") > 0).alias("good")).groupBy("e.g", "e.bin", "good")
            .agg(F.count(F.lit(1)).alias("n")).collect())        # two counts per bin and group
    count = {g: np.zeros((2, bins + 1)) for g in groups}
    for r in hist:
        count[r["g"]][int(r["good"]), int(r["bin"])] += r["n"]
    out = {}
    for g, (bad, good) in count.items():
        caught, lost = (np.cumsum(x[::-1])[::-1] for x in (bad, good))      # rows at or above a bin
        gain = np.where(lost <= false_share * good.sum(), caught - good_cost * lost, -1.0)
        at = bins - int(np.argmax(gain[::-1]))                   # of equal gains the highest
        found = good.sum() and bad.sum() and gain[at] > 0 and caught[at] >= least * bad.sum()
        out[g] = at / bins if found else 2.0
    return out


def judged(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, STATS, base_failed, the score by each group, kept of every row."""
    keyed = docs.withColumn("_th_", F.xxhash64(text_col))
    stats = rule_statistics(keyed, {"_id": id_col, "_th": "_th_"}, text_col)
    stats = save(spark, stats.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                                         | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))), "stats")
    forests, size = fit_forests(spark, stats)
    names, scores = ["_id", *STATS, "base_failed"], [f"anomaly_{g}" for g in GROUPS]
    schema = ", ".join([f"`{n}` {t}" for n, t in stats.select(*names).dtypes] + [f"{c} double" for c in scores])
    scored = save(spark, stats.select(*names, *FEATURES)
                  .mapInArrow(_score_rows(forests, size, names, GROUPS), schema), "scored")
    kept = ~F.col("base_failed")
    for g, cut in thresholds(scored, labels).items():
        kept = kept & (F.floor(F.col(f"anomaly_{g}") * BINS) < F.lit(round(cut * BINS)))
    return scored.select(F.col("_id").alias("doc_id"), *STATS, "base_failed", *scores, kept.alias("kept"))
