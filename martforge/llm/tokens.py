"""Token ids of whole texts with a public tokenizer file, and token counts.

* *Independent units.*  The tokenizer's pre-tokenizer never joins text across ASCII
  white space and its normalizer maps that white space to one space, so the ids of a text
  are those of its white-space-separated units in turn.  Units are encoded by the library
  itself and remembered, as are plain letter, digit and sign runs, in memories that are
  bounded in bytes and emptied with each partition.
* *Overlap resynchronisation* (token counts): a text is encoded in overlapping chunks that
  end anywhere, so the units at their ends may be cut and have other tokens.  Two neighbours
  are spliced at a unit of the overlap around which both have the same tokens at the same
  places; it starts behind white space, and nothing the tokenizer does reaches across, so
  the boundary is stable: a longer chunk would give the same tokens.  Where there is no
  such boundary the overlap is widened, in the end to the whole text.

``unit_safe`` checks that the file at hand has this form; otherwise texts are encoded
whole.

Defined results: a null or empty text has no tokens; special strings inside a
text are what the library makes of them by default; nothing is added, cut
or padded.  Rows are independent of each other.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martforge.llm.memory import ENTRY, BoundedMemory

MODEL = "word_bpe_49k.json"
CHUNK = 2_048         # code points of a chunk
OVERLAP = 128         # code points shared by neighbouring chunks, at first
AGREE = 3             # units whose tokens must agree on each side of a splice
UNIT_BYTES = 160 << 20    # units remembered by a worker: most of a partition's, whatever the corpus
RUN_BYTES = 64 << 20      # runs remembered by a worker

_UNIT = re.compile(r"[^ \t\n\x0b\x0c\r]+")
# Units of these letters only are made of runs that the pre-tokenizer splits
# the same way wherever they stand (no apostrophe, no special string).
_PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ]+")
_RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"  # fixed value of the file's format

_open: dict[str, "UnitEncoder"] = {}


def model_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def unit_safe(path: str) -> bool:
    """Whether ASCII white space always parts tokens in this file's form."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return ([n.get("type") for n in norm] == ["NFC", "Replace", "Lowercase"]
            and norm[1].get("pattern") == {"Regex": "\\s+"} and norm[1].get("content") == " "
            and len(pre) == 2 and pre[0].get("pattern") == {"Regex": _SPLIT}
            and pre[0].get("behavior") == "Removed" and pre[0].get("invert") is True
            and pre[1].get("type") == "ByteLevel" and not pre[1].get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                        for t in spec.get("added_tokens", [])))


class _Units(dict):
    """unit (bytes) -> its ids as little-endian uint32 bytes: the young generation of a
    bounded memory, as a dict, for lookups without Python code."""

    def __init__(self, tok, unit_bytes: int = UNIT_BYTES, run_bytes: int = RUN_BYTES):
        super().__init__()
        self.tok, self.half = tok, unit_bytes // 2
        self.runs = BoundedMemory(run_bytes)
        self.empty()
        from tokenizers.pre_tokenizers import ByteLevel
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [c for c in map(chr, range(0x21, 0x100)) if _PLAIN.fullmatch(c)]
        self.bytes_of = {ord(c): level.pre_tokenize_str(c)[0][0] for c in plain}

    def empty(self) -> None:
        self.clear()
        self.old, self.used = {}, 0
        self.runs.empty()

    def _library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, unit: bytes) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            text = unit.decode()
            if len(text) <= 64 and _PLAIN.fullmatch(text):
                known = self.runs.young
                ids = b"".join([known.get(r) or self._run(r) for r in _RUNS.findall(text.lower())])
            else:
                ids = self._library(text)
        if len(unit) <= 64:
            size = len(unit) + len(ids) + ENTRY
            if self.used + size > self.half:
                self.old, self.used = dict(self), 0
                self.clear()
            self[unit] = ids
            self.used += size
        return ids

    def _run(self, run: str) -> bytes:
        ids = self.runs.young.get(run)
        if ids is None:
            ids = self.runs.old.get(run)
            if ids is None:
                # one run is one pre-token: straight to the library's BPE
                found = self.tok.model.tokenize(run.translate(self.bytes_of))
                ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
            self.runs.keep(run, ids, len(run) + len(ids))
        return ids


class UnitEncoder:
    """Ids of whole texts; one per worker and file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.safe = unit_safe(path)
        self.units = _Units(self.tok)

    @classmethod
    def of(cls, path: str) -> "UnitEncoder":
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # one task, one core
        if path not in _open:
            _open[path] = cls(path)
        return _open[path]

    def ids(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian uint32 bytes."""
        if self.safe:
            return b"".join(map(self.units.__getitem__, text.split()))
        return np.array(self.tok.encode(text.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, text: str, lo: int, hi: int) -> list[bytes]:
        """Ids of each unit of text[lo:hi]; units cut by its ends come out as they are cut."""
        return list(map(self.units.__getitem__, text[lo:hi].encode().split()))

    def spliced(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[bytes, int]:
        """Ids of a whole text from overlapping chunks, and the number of splices."""
        n = len(text)
        if not self.safe:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), 0
        out: list[bytes] = []
        # the chunk at hand starts at lo; all before it is given out; tokens before floor are settled
        splices, lo, floor, hi = 0, 0, 0, min(n, chunk)
        units = self._part(text, lo, hi)
        while hi < n:
            width = overlap
            while True:
                back = max(floor, hi - width)
                nxt_hi = min(n, back + chunk + width)
                units2 = self._part(text, back, nxt_hi)
                places = [m.start() for m in _UNIT.finditer(text, back, hi)]
                cut = _splice(units[len(units) - len(places):], units2[:len(places)]) if len(places) <= len(units) else None
                if cut is not None:
                    break
                if back <= floor:                 # nothing left to widen backwards: encode further ahead
                    chunk = chunk * 2
                    hi = min(n, max(hi, nxt_hi) + chunk)
                    units = self._part(text, lo, hi)
                    if hi == n:
                        return b"".join(out + units), splices
                    width = overlap
                    continue
                width *= 4
            out += units[:len(units) - len(places) + cut]
            lo, floor, hi, units, splices = places[cut], hi, nxt_hi, units2[cut:], splices + 1
        return b"".join(out + units), splices


def _splice(a: list[bytes], b: list[bytes]) -> int | None:
    """A unit of the overlap, nearest to its middle, before which and from which on AGREE
    units at the same places have the same tokens in both encodings; None if there is none."""
    same = [x == y for x, y in zip(a, b)]
    fits = [p for p in range(AGREE, len(same) - AGREE + 1) if all(same[p - AGREE:p + AGREE])]
    return min(fits, key=lambda p: abs(2 * p - len(same)), default=None)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_splices of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = UnitEncoder.of(path)
        for b in batches:
            sizes, counts, splices = [], [], []
            for x in b.column("text"):
                text = x.as_py() or ""
                ids, n = enc.spliced(text, chunk)
                sizes.append(len(text.encode()))
                counts.append(len(ids) // 4)
                splices.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_()), pa.array(splices, pa.int32())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_splices"])
        enc.units.empty()

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_splices int"))
