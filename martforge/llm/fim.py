"""Fill-in-middle transformation of whole texts, cut at units found by word-parallel
(SWAR) arithmetic on the UTF-8 bytes.

Method
------
* The UTF-8 of a slice of rows is viewed as 64-bit words.  The bytes that end a
  unit are marked arithmetically, eight at a time, by their top bit: for lines
  the bytes equal to ``\\n`` (an exact zero-byte test of ``word ^ "\\n" * 8``), for
  characters the last byte of each code point (the byte before one that does not
  continue).
* ``bitwise_count`` of every word and one running sum answer *rank* (units that end
  before a byte) for all rows at once; a search in the running sum finds the word
  that holds the k-th end, and clearing the lowest marks of that word finds the
  byte in it (*select*).  Lengths in code points are ranks of the character marks.
* Two cuts per document, drawn from a hash of its id, part it into prefix, middle
  and suffix; sentinels put them into one of two orders.

Only the three pieces of a row are joined one by one; everything else is done for
a whole slice of rows.  A text is never cut short.

Defined results: a null text is an empty one; an empty text, a text that holds a
sentinel and one that is not drawn are ``plain`` (output: the text; no prefix,
middle or counts).  A null id is drawn as the empty id.  Rows are independent, so
repeated ids, ties and repeated rows each give their own equal row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martforge.llm import words as W

SENTINELS = ("<P>", "<S>", "<M>")        # before prefix, suffix, middle
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_TOP = np.uint64(0x8080808080808080)
_ONES = np.uint64(0x0101010101010101)
_U = np.uint64


def _words(buf: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, padded with zero bytes to one word more."""
    padded = np.zeros((len(buf) // 8 + 1) * 8, dtype=np.uint8)
    padded[:len(buf)] = buf
    return padded.view("<u8")


def mark_byte(words: np.ndarray, value: int) -> np.ndarray:
    """Top bit of every byte that equals ``value``; no other bit."""
    x = words ^ (_ONES * _U(value))
    # a byte is zero where neither its top bit nor a carry out of its low seven bits shows
    return ~(((x & _LOW7) + _LOW7) | x | _LOW7)


def mark_code_points(words: np.ndarray, n_bytes: int) -> np.ndarray:
    """Top bit of the last byte of every code point of ``n_bytes`` bytes of UTF-8."""
    # a byte 10xxxxxx continues: its top bit is set and the bit below it is not
    starts = ~(words & ~(words << _U(1))) & _TOP
    ahead = np.append(starts[1:], _U(0))
    ends = (starts >> _U(8)) | (ahead << _U(56))       # the byte before a start
    keep = np.zeros(len(words), dtype=np.uint64)       # padding is no code point; the last byte ends one
    full, part = divmod(n_bytes, 8)
    keep[:full] = _TOP
    if part:
        keep[full] = _TOP & _U((1 << (8 * part)) - 1)
    ends &= keep
    if n_bytes:
        ends[(n_bytes - 1) >> 3] |= _U(0x80 << (8 * ((n_bytes - 1) & 7)))
    return ends


@dataclass
class Marks:
    """Marked bytes with a running count by word."""
    words: np.ndarray
    before: np.ndarray      # marks in all earlier words; one entry more than words

    @classmethod
    def of(cls, words: np.ndarray) -> "Marks":
        before = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(words), out=before[1:])
        return cls(words, before)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word = at >> 3
        below = (_U(1) << ((at & 7) * 8).astype(np.uint64)) - _U(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte of the ``k``-th mark (from 1; there must be that many)."""
        word = np.searchsorted(self.before[1:], k, side="left")
        left = k - self.before[word] - 1               # marks of the word to clear: 0 to 7
        x = self.words[word]
        for turn in range(7):
            x = np.where(left > turn, x & (x - _U(1)), x)
        lowest = x & (~x + _U(1))
        return word * 8 + (np.bitwise_count(lowest - _U(1)) >> 3)


def unit_cuts(s: W.Slice, unit: str, pick) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(units, first cut, second cut, code points before each cut) of each row of a
    slice; cuts are bytes from the row's start.  ``pick(n)`` gives the units in
    front of the two cuts, each 0 to n."""
    words, start, end = _words(s.buf), s.offs[:-1], s.offs[1:]
    points = Marks.of(mark_code_points(words, len(s.buf)))
    ends = points if unit == "character" else Marks.of(mark_byte(words, 0x0A))
    done = ends.rank(start)
    closed = ends.rank(end) - done
    n = closed + 0
    if unit == "line":                                  # a last line without its \n is a unit too
        some = np.flatnonzero(end > start)
        n[some] += s.buf[end[some] - 1] != 0x0A
    cuts = []
    for k in pick(n):
        cut = np.where(k > closed, end, start)          # all units, the open one included
        inner = np.flatnonzero((k > 0) & (k <= closed))
        cut[inner] = ends.select(done[inner] + k[inner]) + 1
        cuts.append(cut)
    base = points.rank(start)
    chars = [points.rank(c) - base for c in cuts]
    return n, cuts[0] - start, cuts[1] - start, chars[0], chars[1]


def _checked(sentinels: tuple[str, str, str]) -> None:
    """A text without sentinels must stay parted at them: none may run into another."""
    bad = len(set(sentinels)) < 3 or "" in sentinels
    for a in sentinels:
        for b in sentinels:
            bad = bad or (a != b and b in a) or any(a.endswith(b[:i]) for i in range(1, min(len(a), len(b))))
    if bad:
        raise ValueError(f"sentinels must be distinct and free of overlaps: {sentinels}")


def fill_in_middle(docs: DataFrame, percent: int = 100, spm_percent: int = 50, seed: str = "7", unit: str = "line",
                   sentinels: tuple[str, str, str] = SENTINELS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output.

    Four draws of a document come from the SHA-256 of ``seed:doc_id``: two cuts
    modulo n + 1, whether it is transformed (``percent``) and its order
    (``spm_percent`` of those: suffix first)."""
    _checked(sentinels)
    if unit not in ("line", "character"):
        raise ValueError(f"unknown unit {unit!r}")
    kind = docs.schema[id_col].dataType.simpleString()
    p, sf, m = (x.encode() for x in sentinels)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    holds = F.lit(False)
    for x in sentinels:
        holds = holds | F.contains(text, F.lit(x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [b.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(1, 5)]
            holds_one = b.column("holds").to_numpy(zero_copy_only=False)
            for s in W.slices(b.column("text")):
                rows = slice(s.lo, s.hi)
                h1, h2, h3, h4 = (x[rows] for x in h)

                def pick(n):
                    a, c = h1 % (n + 1), h2 % (n + 1)
                    return np.minimum(a, c), np.maximum(a, c)

                n, one, two, c1, c2 = unit_cuts(s, unit, pick)
                plain = (np.diff(s.offs) == 0) | holds_one[rows] | (h3 % 100 >= percent)
                form = np.where(plain, "plain", np.where(h4 % 100 < spm_percent, "spm", "psm"))
                raw, out = s.buf.tobytes(), []
                for f, lo, hi, x, y in zip(form, s.offs[:-1], s.offs[1:], one, two):
                    if f == "plain":
                        out.append(raw[lo:hi])
                        continue
                    pre, mid, suf = raw[lo:lo + x], raw[lo + x:lo + y], raw[lo + y:hi]
                    out.append(b"".join((p, pre, sf, suf, m, mid) if f == "psm" else (sf, suf, p, pre, m, mid)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(s.lo, s.rows), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
                     pa.array(c1, pa.int64(), mask=plain), pa.array(c2 - c1, pa.int64(), mask=plain),
                     pa.array(out, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return (docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), holds.alias("holds"), *draws)
            .mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"))


def restored(output, form, sentinels: tuple[str, str, str] = SENTINELS) -> F.Column:
    """The text that an output was made of."""
    _checked(sentinels)
    p, s, m = sentinels

    def between(first: str, last: str | None) -> F.Column:
        rest = F.substring_index(output, first, -1)
        return rest if last is None else F.substring_index(rest, last, 1)

    middle = between(m, None)
    return (F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output))


def fim_report(docs: DataFrame) -> DataFrame:
    """The transformation with digests of its output and of the text rebuilt from it."""
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
