"""SentencePiece BPE ids of whole texts by a prefix table, and their decoding.

Method
------
The encoding rule of such a model joins, again and again, the adjacent pair of
symbols whose joined piece has the best score (leftmost of equals).  Two facts
make it a table over prefixes:

* two neighbours ``a, b`` of any result are what the rule makes of the string
  ``a + b`` alone (no join reaches across their border), and
* a row of pieces of which all neighbours are *compatible* in this sense is the
  result for its string: the first join across a border would also happen in
  the string of that pair alone.

So each prefix of a text has one *last piece*: of the pieces that end there (an
Aho-Corasick automaton names them) the one that is compatible with the last
piece of the prefix before it.  The table of last pieces is filled from left to
right; walking back from the end by the pieces' lengths gives the ids.  Pieces that
the rule never makes out of their own string are left out of the automaton.
Code points that no piece holds stand alone and become their UTF-8 byte pieces.

Where no piece of the file has a space mark behind another character
(``parted``), no join crosses such a place, so the table of a text falls apart
into those of its units (space marks with what follows).  Where no piece has a letter
beside another sign than the mark either (``unit_pattern``), units end between those too,
so that a word is one unit with and without a comma.  What the tables of short units gave
is remembered in a memory bounded in bytes, emptied with each partition; a file that is not
``parted`` has tables over whole texts.  Compatibility of a pair is found by running the
joins of both pieces in turn and looking for an earlier one across their border; it is a
fact of the file, remembered in a bounded memory too.

Normalising (``normalize``) and decoding (``decode``) are the library's; ids are
decoded in slices, so that a huge text needs no huge list.

Defined results: a null or empty text has only its begin and end ids; nothing is
cut; control strings inside a text are ordinary text, as in the library.  Rows are
independent of each other.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martforge.llm.memory import BoundedMemory

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNIT_BYTES = 96 << 20      # results of units remembered by a worker
PAIR_BYTES = 48 << 20      # pairs remembered by a worker
SHORT = 64                 # code points of a unit that is remembered
DECODE_SLICE = 1 << 16     # ids decoded at once


def unit_pattern(pieces: Iterable[str]) -> re.Pattern:
    """What cuts a text into units, between which no join of these pieces crosses, if none
    has a space mark behind another character."""
    odd = "".join(sorted({c for p in pieces for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()}))
    runs = re.compile(rf"{SPACE}*[^\W\d_{odd}]+|{SPACE}*(?:[^\w{SPACE}]|[\d_{odd}])+|{SPACE}+")
    # each piece then stands in one of the runs
    return runs if all(runs.fullmatch(p) for p in pieces) else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceTable:
    """Ids of one model file; one per worker and file."""

    def __init__(self, path: str, unit_bytes: int = UNIT_BYTES, pair_bytes: int = PAIR_BYTES):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        self.sp = sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("a model with unused pieces is not covered")
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
        self.id_of = {sp.id_to_piece(i): i for i in plain}
        self.score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        self.length = [0] * n
        self.bytes = {bytes([x]): sp.piece_to_id(f"<0x{x:02X}>") for x in range(256)}
        singles = {p for p in self.id_of if len(p) == 1}
        if sp.piece_to_id("<0x00>") == sp.unk_id() or any(not singles.issuperset(p) for p in self.id_of):
            raise ValueError("the model needs byte pieces and a piece for every character of its pieces")
        self.parted = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)
        self.cut = unit_pattern(self.id_of).findall
        self.pairs, self.units = BoundedMemory(pair_bytes), BoundedMemory(unit_bytes)
        self.shift = n.bit_length()
        self.steps = {}
        self.find = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            *steps, whole = self.by_rule(p)
            if whole[1:] == (p, p):
                self.steps[i], self.length[i] = (*steps, whole), len(p)
                self.find.add_word(p, i)
        self.find.make_automaton()
        self.anchor = self.id_of["a"] if "a" in self.id_of else max(self.steps)
        self.framed = (sp.bos_id(), sp.eos_id())

    def by_rule(self, text: str) -> list[tuple[float, str, str]]:
        """The rule on a short string, step by step: (score of the next join, first
        symbol, last symbol); the last step has no join left (score: minus infinity)."""
        s, score, out = list(text), self.score, []
        while True:
            best, at = -math.inf, -1
            for i in range(len(s) - 1):
                v = score.get(s[i] + s[i + 1], -math.inf)
                if v > best:
                    best, at = v, i
            out.append((best, s[0], s[-1]))
            if at < 0:
                return out
            s[at:at + 2] = [s[at] + s[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the rule leaves the border of ``a`` and ``b`` alone in the string of both."""
        left, right, i, j, score = self.steps[a], self.steps[b], 0, 0, self.score
        ok = True
        while True:
            (x, _, last), (y, first, _) = left[i], right[j]
            across = score.get(last + first, -math.inf)
            if across > x and across >= y and across > -math.inf:   # of equals, the leftmost
                ok = False
                break
            if x == y == -math.inf:
                break
            if x >= y:
                i += 1
            else:
                j += 1
        self.pairs.keep(a << self.shift | b, ok)
        return ok

    def table(self, text: str) -> list[int]:
        """The last piece of each prefix of a text; -1 for a character of no piece."""
        last = [-1] * len(text)
        length, shift, pairs, done = self.length, self.shift, self.pairs, -1
        for end, i in self.find.iter(text):
            if end == done:                # a prefix has one last piece
                continue
            before = end - length[i]
            if before >= 0 and (a := last[before]) >= 0:
                pair = a << shift | i
                ok = pairs.young.get(pair)
                if ok is None and (ok := pairs.old.get(pair)) is not None:
                    pairs.keep(pair, ok)
                if not (self.compatible(a, i) if ok is None else ok):
                    continue
            last[end], done = i, end
        return last

    def encode_unit(self, text: str) -> bytes:
        """Ids (little-endian uint32) read back from the table of a normalised text."""
        last, ids, at = self.table(text), [], len(text) - 1
        while at >= 0:
            i = last[at]
            if i >= 0:
                ids.append(i)
                at -= self.length[i]
            else:
                ids += [self.bytes[bytes([x])] for x in reversed(text[at].encode())]
                at -= 1
        return struct.pack(f"<{len(ids)}I", *ids[::-1])

    def unit(self, text: str) -> bytes:
        """``encode_unit`` of a unit that the young memory did not have."""
        known = self.units
        found = known.young.get(text)      # it may have come since
        if found is None:
            found = known.old.get(text) or self.encode_unit(text)
            if len(text) <= SHORT:
                known.keep(text, found, len(text) * 2 + len(found))
        return found

    def ids(self, text: str) -> bytes:
        """Ids of a whole text, without begin and end, as little-endian uint32 bytes."""
        text = self.sp.normalize(text)
        if not self.parted:
            return self.encode_unit(text) if text else b""
        units = self.cut(text)
        out = list(map(self.units.young.get, units))
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    out[i] = self.unit(units[i])
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The library's text of ids (with begin and end), slice by slice.  A slice
        ends before a piece that is neither byte nor control piece, where nothing is pending."""
        lo, n, lead = 0, len(ids), []
        skip = len(self.sp.decode([self.anchor]))
        while lo < n:
            hi = min(n, lo + DECODE_SLICE)
            while hi < n and not self.length[ids[hi]]:
                hi += 1
            text = self.sp.decode(lead + ids[lo:hi].tolist())
            yield text[skip:] if lead else text
            lo, lead = hi, [self.anchor]


_open: dict[str, PieceTable] = {}


def opened(path: str) -> PieceTable:
    if path not in _open:
        _open[path] = PieceTable(path)
    return _open[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian uint32, with begin and end), decoded (the
    text that the library decodes them to)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = opened(path)
        begin, end = (np.array([x], dtype="<u4").tobytes() for x in t.framed)
        for b in batches:
            ids, texts = [], []
            for x in b.column("text"):
                raw = begin + t.ids(x.as_py() or "") + end
                ids.append(raw)
                texts.append("".join(t.decode(np.frombuffer(raw, dtype="<u4"))))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                names=["doc_id", "ids", "decoded"])
        t.units.empty()

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, ids binary, decoded string"))


def piece_report(docs: DataFrame, path: str) -> DataFrame:
    """Number and digests of the ids and of the decoded text of every row."""
    out = encode(docs, path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
