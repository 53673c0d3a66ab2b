"""Substring deduplication by compaction of the repeated de Bruijn graph.

Method
------
Every window of ``k`` consecutive words is an edge of the de Bruijn graph of
the corpus (its nodes are the ``k - 1`` words shared by consecutive windows).

1. *Candidate edges.*  Each window has a minimizer: the least hash of its
   ``G``-word grams.  Equal windows have equal minimizers, so a window can
   only repeat where its minimizer occurs twice in the corpus.  One in about
   eight positions is a minimizer; these are counted with partial sums, and
   the repeated ones are joined back to their documents.
2. *Edges.*  Windows with a repeated minimizer are counted by hash; those
   seen at least twice are the edges of the repeated graph, with their
   multiplicity, their first source coordinate and the least and greatest
   successor.
3. *Compaction.*  Edge ``e`` leads to ``f`` without a branch if ``f`` is the
   only successor of ``e`` and both have the same multiplicity (so ``e`` is
   the only predecessor of ``f``): a join of the edges with themselves.
   Edges linked so have the same occurrences, one word apart; hence the first
   occurrences of a path lie side by side in one document and maximal
   nonbranching paths are runs there.
4. *Source coordinates.*  Only heads of paths are joined back to their
   occurrences.  Each occurrence but the first is a repeated span; the words
   at its own coordinates must have the digest of the words at the first
   coordinates, so a hash collision removes nothing.

Every step is a partially aggregated ``groupBy`` or an equi-join that
adaptive execution can split; a document's windows and spans are the only
lists ever held together.

Defined results: a null text has no words; texts of fewer than ``k`` words
lose none; rows with equal doc_id and equal text are one document (each row
gets its result); rows with equal doc_id and other text are ordered by a text
hash; a null doc_id comes last; further columns of the input pass through
``remove_repeats`` and cannot clash with internal names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from martforge.llm import words as W
from martforge.llm.scratch import dense_order, drop, save

K = 20            # words of a window
G = 6             # words of a minimizer gram


def _window_min(g: np.ndarray, width: int, fold=np.minimum) -> np.ndarray:
    """Fold over ``width`` consecutive values by doubling; result[i] covers
    g[i : i + width], as long as that lies inside."""
    have, out = 1, g
    while have * 2 <= width:
        out = fold(out[:-have], out[have:]) if len(out) > have else out[:0]
        have *= 2
    if have < width:
        step = width - have
        out = fold(out[:-step], out[step:]) if len(out) > step else out[:0]
    return out


def _minimizers(h: np.ndarray, row: np.ndarray, k: int, g: int):
    """(gram hashes, minimizer of each window, whether the window is valid)."""
    gram, _ = W.grams(h, row, g)
    n, width = len(h), k - g + 1
    least = np.zeros(n, dtype=np.uint64)
    ok = np.zeros(n, dtype=bool)
    m = n - k + 1
    if m > 0:
        ok[:m] = row[:m] == row[k - 1:]
        least[:m] = _window_min(gram[:n - g + 1], width)[:m]
        least[~ok] = 0
    return gram, least, ok


def _minimizer_rows(k: int, g: int):
    """Distinct minimizers of each document with their number of places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, ths = b.column("doc_id"), b.column("th")
            for s in W.slices(b.column("text")):
                w = W.find_words(s)
                h = W.span_hashes(s.buf, w.starts, w.ends)
                gram, least, ok = _minimizers(h, w.row, k, g)
                if not ok.any():
                    continue
                # a gram is a minimizer if some window that holds it has it as its least
                width = k - g + 1
                most = _window_min(np.concatenate([np.zeros(width - 1, np.uint64), least]),
                                   width, np.maximum)
                at = np.flatnonzero((most == gram) & (most > 0))
                row = w.row[at]
                key = gram[at] ^ W.mix(row.astype(np.uint64) + W.U(1))
                _, first, count = np.unique(key, return_index=True, return_counts=True)
                take = pa.array(row[first] + s.lo)
                yield pa.RecordBatch.from_arrays(
                    [docs.take(take), ths.take(take), W.signed(gram[at][first]),
                     pa.array(np.minimum(count, 2).astype(np.int32))],
                    names=["doc_id", "th", "m", "c"])
    return run


def _window_rows(k: int, g: int, bits: int):
    """Windows whose minimizer is among the repeated ones of their document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            order = b.column("ord").to_numpy(zero_copy_only=False).astype(np.int64)
            ms = b.column("ms")
            for s in W.slices(b.column("text")):
                w = W.find_words(s)
                h = W.span_hashes(s.buf, w.starts, w.ends)
                _, least, ok = _minimizers(h, w.row, k, g)
                if not ok.any():
                    continue
                part = ms.slice(s.lo, s.rows)
                lens = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                known = part.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                salt = W.mix(np.arange(s.rows, dtype=np.uint64) + W.U(1))
                known = known ^ np.repeat(salt, lens)
                # runs of windows with one minimizer are looked up once
                turn = np.ones(len(h), dtype=bool)
                turn[1:] = (least[1:] != least[:-1]) | (w.row[1:] != w.row[:-1])
                heads = np.flatnonzero(turn)
                found = np.isin(least[heads] ^ salt[w.row[heads]], known)
                hit = np.repeat(found, np.diff(np.append(heads, len(h)))) & ok
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                win, _ = W.grams(h, w.row, k)
                after = np.zeros(len(win), dtype=np.uint64)
                after[:-1] = np.where(ok[1:] & (w.row[1:] == w.row[:-1]), win[1:], 0)
                row = w.row[at]
                place = (order[row + s.lo] << bits) | (at - w.first[row])
                yield pa.RecordBatch.from_arrays(
                    [W.signed(win[at]), W.signed(after[at]), pa.array(place)],
                    names=["h", "nxt", "at"])
    return run


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _path_digests(k: int, bits: int):
    """Digest of the words of each path at its first source coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_h, out_l, out_d, out_a = [], [], [], []
            texts, paths = b.column("text"), b.column("paths")
            for i in range(b.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                for p in paths[i].as_py():
                    at = p["at"] & ((1 << bits) - 1)
                    out_h.append(p["h"]); out_l.append(p["n"]); out_a.append(p["at"])
                    out_d.append(_digest(words[at:at + p["n"] + k - 1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_h, pa.int64()), pa.array(out_l, pa.int64()),
                 pa.array(out_a, pa.int64()), pa.array(out_d, pa.binary())],
                names=["h", "n", "first", "digest"])
    return run


def _kept(words: list[bytes], spans: list[dict], k: int) -> list[bytes]:
    """Words outside the verified spans."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for p in spans:
        lo, hi = p["pos"], p["pos"] + p["n"] + k - 1
        if _digest(words[lo:hi]) == p["digest"]:
            edge[lo] += 1
            edge[hi] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, ok in zip(words, keep.tolist()) if ok]


def _apply(k: int, text_out: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = b.column("_text"), b.column("_spans")
            total, gone, digest, kept_text = [], [], [], []
            for i in range(b.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                mine = spans[i].as_py()
                kept = _kept(words, mine, k) if mine else words
                joined = b" ".join(kept)
                total.append(len(words)); gone.append(len(words) - len(kept))
                if text_out == "digest":
                    digest.append(hashlib.sha256(joined).hexdigest())
                else:   # an untouched text stays as it was
                    kept_text.append(texts[i].as_py() if len(kept) == len(words) else joined.decode())
            cols = [b.column(n) for n in names] + [pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            cols.append(pa.array(digest if text_out == "digest" else kept_text, pa.string()))
            yield pa.RecordBatch.from_arrays(
                cols, names=names + ["_n_words", "_n_removed",
                                     "_sha" if text_out == "digest" else "_kept"])
    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("th"))


def position_bits(keyed: DataFrame) -> int:
    """Bits of a source coordinate that hold a word's place in its document (a text of n
    bytes has at most (n + 1) / 2 words); the rest numbers the documents.  Raises
    where a long cannot hold both, which takes 2**63 words in all if all were as long."""
    r = keyed.agg(F.max(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    bits = max(1, ((r["b"] or 0) // 2 + 1).bit_length())
    if r["n"] >> (63 - bits):
        raise ValueError(f"{r['n']} documents of up to {r['b']} bytes are beyond the coordinates of a long")
    return bits


def repeated_paths(spark: SparkSession, docs: DataFrame, k: int = K, g: int = G,
                   id_col: str = "doc_id", text_col: str = "text"):
    """(paths, spans, order): the compacted repeated paths (h, n edges, first
    coordinate, digest), every later occurrence of each (h, n, ord, pos,
    digest), and the numbering of documents (doc_id, th, ord)."""
    keyed = _keyed(docs, id_col, text_col)
    bits = position_bits(keyed)
    long_enough = keyed.where(F.length("text") >= 2 * k - 1)

    # 1. repeated minimizers, back to their documents
    occ = save(spark, long_enough.select("doc_id", "th", "text").mapInArrow(
        _minimizer_rows(k, g), "doc_id long, th long, m long, c int"), "minimizers")
    order = dense_order(spark, occ.select("doc_id", "th")
                        .withColumn("last", F.col("doc_id").isNull()),
                        ["last", "doc_id", "th"], "ord")
    twice = occ.groupBy("m").agg(F.sum("c").alias("c")).where("c >= 2").select("m")
    per_doc = (occ.join(twice, "m").groupBy("doc_id", "th").agg(F.collect_list("m").alias("ms")))
    same = lambda a, b: (a["doc_id"].eqNullSafe(b["doc_id"])) & (a["th"] == b["th"])
    cand = per_doc.join(order, same(per_doc, order)).select(per_doc["doc_id"], per_doc["th"], "ms", "ord")

    # 2. windows and edges
    cand = save(spark, cand, "candidates")
    drop(spark, occ)
    with_ms = (long_enough.join(cand, same(long_enough, cand)).select("ord", "ms", "text"))
    windows = save(spark, with_ms.mapInArrow(_window_rows(k, g, bits), "h long, nxt long, at long"), "windows")
    drop(spark, cand)
    edges = save(spark, windows.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("at"),
        F.min("nxt").alias("lo"), F.max("nxt").alias("hi")).where("n >= 2"), "edges")

    # 3. nonbranching links and paths
    a = edges.where("lo = hi and lo <> 0").select(F.col("lo").alias("h"), F.col("n").alias("n_from"))
    linked = (edges.select("h", "n", "at").join(a, "h", "left")
              # an edge has one predecessor of its own multiplicity at most
              .groupBy("h", "at").agg(F.max(F.coalesce(F.col("n") == F.col("n_from"), F.lit(False))).alias("linked")))
    by_doc = Window.partitionBy(F.shiftright("at", bits)).orderBy("at")
    runs = (linked.withColumn("start", F.when(~F.col("linked"), F.col("at")))
            .withColumn("head", F.last("start", ignorenulls=True).over(by_doc)))
    paths = (runs.groupBy("head").agg(F.count(F.lit(1)).alias("n"),
                                      F.max(F.when(~F.col("linked"), F.col("h"))).alias("h"))
             .select("h", "n", F.col("head").alias("at")))
    paths = save(spark, paths, "paths")
    drop(spark, edges)

    # 4. digests at the first coordinates, then every other occurrence
    firsts = (paths.withColumn("ord", F.shiftright("at", bits)).groupBy("ord")
              .agg(F.collect_list(F.struct("h", "n", "at")).alias("paths"))
              .join(order, "ord").select("doc_id", "th", "paths"))
    digests = (long_enough.join(firsts, same(long_enough, firsts)).select("text", "paths")
               .mapInArrow(_path_digests(k, bits), "h long, n long, first long, digest binary")
               .dropDuplicates(["h"]))   # rows that repeat a document
    digests = save(spark, digests, "digests")
    spans = (windows.select("h", "at").join(digests, "h").where("at <> first")
             .select("h", "n", "digest", F.shiftright("at", bits).alias("ord"),
                     F.col("at").bitwiseAND((1 << bits) - 1).alias("pos")))
    spans = save(spark, spans, "spans")
    drop(spark, windows, paths)
    return digests, spans, order


def _with_spans(spark, docs, k, g, id_col, text_col, mode, names):
    _, spans, order = repeated_paths(spark, docs, k, g, id_col, text_col)
    per_doc = (spans.groupBy("ord").agg(F.collect_set(F.struct("pos", "n", "digest")).alias("_spans"))
               .join(order, "ord").select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "_spans"))
    left = docs.select(*[F.col(c).alias(n) for c, n in names], F.col(id_col).cast("long").alias("_id"),
                       F.col(text_col).alias("_text"), F.xxhash64(F.col(text_col)).alias("_th"))
    full = left.join(per_doc, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left")
    keep = [n for _, n in names]
    schema = ", ".join([f"`{n}` {t}" for n, t in left.select(*keep).dtypes]
                       + ["_n_words long", "_n_removed long",
                          "_sha string" if mode == "digest" else "_kept string"])
    return full.select(*keep, "_text", "_spans").mapInArrow(_apply(k, mode, keep), schema)


def removal_report(spark: SparkSession, docs: DataFrame, k: int = K, g: int = G,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    out = _with_spans(spark, docs, k, g, id_col, text_col, "digest", [(id_col, "c0")])
    return out.select(F.col("c0").alias("doc_id"), F.col("_n_words").alias("n_words"),
                      F.col("_n_removed").alias("n_removed"), F.col("_sha").alias("kept_sha256"))


def remove_repeats(spark: SparkSession, docs: DataFrame, k: int = K, g: int = G,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated words taken out of the text; all columns
    stay, a text that loses nothing is left byte for byte, and ``n_chars``
    (if there is one) follows the text."""
    cols = docs.columns
    names = [(c, f"c{i}") for i, c in enumerate(cols) if c != text_col]
    out = _with_spans(spark, docs, k, g, id_col, text_col, "text", names)
    back = {c: F.col(n) for c, n in names} | {text_col: F.col("_kept")}
    if "n_chars" in back:
        kind = docs.schema["n_chars"].dataType
        back["n_chars"] = F.when(F.col("_n_removed") > 0, F.length("_kept").cast(kind)).otherwise(back["n_chars"])
    return out.select(*[back[c].alias(c) for c in cols])
