"""Language identification by nearest centroid.

Method
------
* Features: byte trigrams of the lower-cased text, every run of other than
  letters folded to one space, hashed to ``DIMS`` dimensions; a document's vector
  is its term counts (log-damped) times the inverse document frequency,
  normalised to length 1.
* Document frequencies cover all training documents, summed from per-batch
  counts.
* Centroids: at most about ``SAMPLE`` training documents per language (a hash of
  the id picks them; the bound is a parameter) are clustered by spherical k-means
  into ``CLUSTERS`` centroids per language, each language in its own task.
* Prediction: the language of the centroid of greatest cosine.
* Rejection by distance: a document is rejected if that cosine is below
  ``MARGIN`` times the ``REJECT`` quantile of the language's own sample.

Defined results: a text that is null or has no letter is ``und`` with score 0 and
rejected; nulls in other columns play no part; training documents with a null
language are left out; without any training document all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DIMS = 8192
SAMPLE = 600           # training documents per language that are clustered, about
CLUSTERS = 3
REJECT = 0.001         # quantile of the sample's own similarity
MARGIN = 0.25
BLOCK_ROWS = 64

_LOW = np.full(256, 0x20, dtype=np.uint8)          # bytes that are not letters: space
for _c in range(0x41, 0x5B):
    _LOW[_c] = _c + 0x20
_LOW[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOW[0x80:] = np.arange(0x80, 0x100)               # bytes of other letters stay


def held_out(id_col: str) -> Column:
    """Documents that are never learned from."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4) == 2


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def counts(text: str, dims: int = DIMS) -> np.ndarray:
    """Trigram counts of a whole text."""
    raw = _LOW[np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)]
    space = raw == 0x20
    if len(raw):
        raw = raw[~(space & np.append(False, space[:-1]))]       # one space between words
    b = np.concatenate([[0x20], raw, [0x20]]).astype(np.uint32)
    key = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    key = (key * np.uint32(2654435761)) >> np.uint32(32 - int(np.log2(dims)))
    return np.bincount(key, minlength=dims)


def vectors(block: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(block).astype(np.float32) * idf
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.maximum(n, 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMS, dtype=np.int64), 0
    for b in batches:
        for x in b.column("text"):
            text = x.as_py()
            if text and has_letter(text):
                df += counts(text) > 0
                n += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, DIMS, dtype=np.int32)), pa.array(np.append(n, df))], names=["dim", "n"])


def _vector_rows(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, out = [], []
            for lang, x in zip(b.column("lang").to_pylist(), b.column("text")):
                text = x.as_py()
                if text and has_letter(text):
                    langs.append(lang)
                    out.append(vectors(counts(text)[None, :], idf)[0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())],
                                             names=["lang", "vec"])
    return run


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Spherical k-means; the same rows give the same centroids."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[[0]]
    while len(c) < k:                       # far-apart first centroids
        far = 1 - np.max(x @ c.T, axis=1)
        p = np.maximum(far, 0) ** 2
        c = np.vstack([c, x[rng.choice(len(x), p=p / p.sum()) if p.sum() > 0 else 0]])
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        new = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def _cluster(clusters: int, reject: float):
    def run(table: pa.Table) -> pa.Table:
        vecs = sorted(table.column("vec").to_pylist())         # order of arrival must not matter
        x = np.stack([np.frombuffer(v, np.float32) for v in vecs])
        c = kmeans(x, clusters)
        low = float(np.quantile(np.max(x @ c.T, axis=1), reject))
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": [lang] * len(c), "centroid": [v.tobytes() for v in c], "low": [low] * len(c)},
                        schema=pa.schema([("lang", pa.string()), ("centroid", pa.binary()), ("low", pa.float64())]))
    return run


class Model:
    """What prediction needs: a few vectors per language."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, floors: np.ndarray):
        self.idf, self.langs, self.centroids, self.floors = idf, langs, centroids, floors


def fit(spark: SparkSession, train: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS,
        reject: float = REJECT, margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    rows = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    src = rows.select(F.col(text_col).alias("text"))
    df = src.mapInArrow(_frequencies, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n"))
    freq = np.zeros(DIMS, dtype=np.int64)
    total = 0
    for r in df.collect():                  # DIMS + 1 numbers
        if r["dim"] < 0:
            total = r["n"]
        else:
            freq[r["dim"]] = r["n"]
    idf = np.log((1 + total) / (1 + freq)).astype(np.float32)
    # every language's share that gives about ``sample`` documents; one number per
    # language reaches the driver, as the centroids will, and no text is shuffled
    sizes = {r["l"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model(idf, [], np.zeros((0, DIMS), np.float32), np.zeros(0))
    # by id and text, so that rows without an id are sampled as all others; copies of a row are folded
    u = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for l, n in sorted(sizes.items()) for x in (l, float(sample) / n)])
    picked = (rows.select(F.col(id_col), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
              .where(u < F.try_element_at(share, F.col("lang"))).select("lang", "text").distinct())
    found = (picked.mapInArrow(_vector_rows(idf), "lang string, vec binary").groupBy("lang")
             .applyInArrow(_cluster(clusters, reject), "lang string, centroid binary, low double")
             .collect())                    # CLUSTERS rows per language
    found.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    return Model(idf, [r["lang"] for r in found],
                 np.stack([np.frombuffer(bytes(r["centroid"]), np.float32) for r in found])
                 if found else np.zeros((0, DIMS), np.float32),
                 np.array([r["low"] * margin for r in found]))


def _predict(m: Model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            lang, score, out = ["und"] * n, np.zeros(n), np.ones(n, dtype=bool)
            texts = b.column("_text")
            block, at = np.zeros((BLOCK_ROWS, DIMS), dtype=np.float32), []

            def flush():
                if at and len(m.langs):
                    sim = vectors(block[:len(at)], m.idf) @ m.centroids.T
                    best = np.argmax(sim, axis=1)
                    for j, i in enumerate(at):
                        lang[i] = m.langs[best[j]]
                        score[i] = min(1.0, max(0.0, float(sim[j, best[j]])))
                        out[i] = score[i] < m.floors[best[j]]
                at.clear()

            for i in range(n):
                text = texts[i].as_py()
                if text and has_letter(text):
                    block[len(at)] = counts(text)
                    at.append(i)
                    if len(at) == BLOCK_ROWS:
                        flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array(lang), pa.array(score), pa.array(out)],
                names=names + ["_lang", "_score", "_rejected"])
    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected (which replace columns of
    these names)."""
    cols = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    names = [f"c{i}" for i in range(len(cols))]
    src = docs.select(*[F.col(c).alias(n) for c, n in zip(cols, names)], F.col(text_col).alias("_text"))
    schema = ", ".join([f"`{n}` {t}" for n, t in src.drop("_text").dtypes]
                       + ["_lang string, _score double, _rejected boolean"])
    out = src.mapInArrow(_predict(model, names), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(cols, names)], F.col("_lang").alias("lang_pred"),
                      F.col("_score").alias("score"), F.col("_rejected").alias("rejected"))


def report(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    model = fit(spark, docs.where(~held_out(id_col)), id_col=id_col)
    out = predict(docs.select(id_col, "text"), model)
    return out.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), "lang_pred", "score",
                      "rejected")
