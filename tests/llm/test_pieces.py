import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martforge.llm import fim, piecebpe
from martforge.llm import oracle
from martforge.llm import words as W
from martforge.llm.tokens import model_path

MODEL = model_path(piecebpe.MODEL)


@pytest.fixture(scope="module")
def table():
    return piecebpe.PieceTable(MODEL)


def _texts():
    rng = random.Random(7)
    odd = ["", " ", "   ", "  a  b ", "a\nb\t", "▁▁x ▁ y", "ﬁ①Å", "<s></s><unk><0x0A>", "\x00a", "a" * 77, "-" * 50,
           " " * 133 + "x" + " " * 61, "漢字かな交じり文 " * 9, "😀😀 👨‍👩‍👧", "don't  stop　now"]
    for _ in range(1500):
        pick = rng.randrange(3)
        if pick == 0:
            odd.append("".join(rng.choice("abcdefgh  ") for _ in range(rng.randrange(60))))
        elif pick == 1:
            odd.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2fff),
                                               rng.randrange(0x4e00, 0x9fff), rng.randrange(0x1f300, 0x1f6ff)]))
                               for _ in range(rng.randrange(30))))
        else:
            odd.append("".join(rng.choice([" ", "-", "=", "\n", "  ", "e", "he", "#", "▁"])
                               for _ in range(rng.randrange(50))))
    return odd


def test_ids_are_those_of_the_library(table):
    for t in _texts():
        assert np.frombuffer(table.ids(t), "<u4").tolist() == table.sp.encode(t), t


def test_one_table_over_a_whole_text_gives_the_same(table):
    for t in _texts()[:300]:
        whole = table.encode_unit(table.sp.normalize(t)) if t else b""
        assert whole == table.ids(t), t


def test_every_prefix_has_the_last_piece_of_its_own_ids(table):
    text = table.sp.normalize("unbelievable  misrepresentations ①aaa")
    last = table.table(text)
    for end in range(1, len(text) + 1):
        own = np.frombuffer(table.encode_unit(text[:end]), "<u4")
        assert last[end - 1] in (int(own[-1]), -1)


def test_small_memories_change_nothing(table):
    small = piecebpe.PieceTable(MODEL, unit_bytes=4000, pair_bytes=2000)
    for t in _texts()[:200]:
        assert small.ids(t) == table.ids(t)
    assert small.units.used <= 2000 and small.pairs.used <= 1000


def test_a_word_has_one_table_with_and_without_signs(monkeypatch):
    table, made = piecebpe.PieceTable(MODEL), []
    plain = table.encode_unit
    monkeypatch.setattr(table, "encode_unit", lambda text: made.append(text) or plain(text))
    words = [f"{a}{b}{c}" for a in ("zor", "quib", "lan") for b in ("tep", "mu", "vax") for c in ("ish", "orn")]
    text = " ".join(w + x for x in ("", ",", ".", "!\n", " (") for w in words)
    assert np.frombuffer(table.ids(text), "<u4").tolist() == table.sp.encode(text)
    assert len(made) <= len(words) + 10 and len(set(made)) == len(made)


def test_units_end_only_where_no_piece_goes_on():
    cut = piecebpe.unit_pattern
    assert cut(["a", "▁a", ",", "▁▁(", "²."]).findall("▁▁ab,c▁(²a") == ["▁▁ab", ",", "c", "▁(²", "a"]
    assert cut(["a", "a,"]).findall("▁▁ab,c▁(²a▁") == ["▁▁ab,c", "▁(²a", "▁"]
    assert cut(["a", "1a"]).findall("x1a▁▁") == ["x1a", "▁▁"]


def test_decoding_in_slices(table, monkeypatch):
    monkeypatch.setattr(piecebpe, "DECODE_SLICE", 5)
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 1, 2, 0]) for _ in range(40)]
        assert "".join(table.decode(np.array(ids))) == table.sp.decode(ids)


def test_piece_report_against_the_library(s, docs, odd, none, table):
    for df in (docs, odd):
        got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256)
                     for r in piecebpe.piece_report(df, MODEL).collect())
        want = []
        for r in df.collect():
            ids = table.sp.encode(r.text or "", add_bos=True, add_eos=True)
            want.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(table.sp.decode(ids).encode()).hexdigest()))
        assert got == sorted(want)
    assert piecebpe.piece_report(none, MODEL).count() == 0


def _units(text, unit):
    if unit == "character":
        return list(text)
    lines = text.split("\n")
    return [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])


def brute_fim(doc_id, text, percent=100, spm=50, unit="line"):
    text = text or ""
    u = _units(text, unit)
    hexed = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= percent:
        return doc_id, len(u), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.fixture(scope="module")
def lines(s):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(["\n", "\n\n", "é", "漢", "😀", "ab", " ", "<", "P>", "\x8a", "Ċ"])
                        for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(1000, "x" * 5000), (1001, "\n" * 300), (1002, "ab\n<S>\nc"), (1003, "a"), (-5, "a\nb\nc\n"), (1004, "<P")]
    return s.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("unit", ["line", "character"])
def test_fill_in_middle_against_brute_force(s, lines, odd, docs, none, unit):
    for df in (lines, odd, docs):
        for percent, spm in ((100, 50), (60, 0), (100, 100)):
            out = fim.fill_in_middle(df, percent, spm, unit=unit)
            got = sorted(map(str, (tuple(r) for r in out.collect())))
            assert got == sorted(str(brute_fim(r.doc_id, r.text, percent, spm, unit)) for r in df.collect())
    assert fim.fill_in_middle(none).count() == 0


def test_text_is_rebuilt_from_output_and_form(s, lines, odd):
    for df in (lines, odd):
        out = fim.fill_in_middle(df).withColumn("back", fim.restored(F.col("output"), F.col("form")))
        got = sorted((str(r.doc_id), r.back) for r in out.collect())
        assert got == sorted((str(r.doc_id), r.text or "") for r in df.collect())


def test_marks_rank_and_select():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 8, 9, 64, 1000):
        buf = rng.choice(np.array([0x0A, 0x8A, 0x0B, 0x09, 0x00, 0xFF], dtype=np.uint8), n)
        m = fim.Marks.of(fim.mark_byte(fim._words(buf), 0x0A))
        at = np.flatnonzero(buf == 0x0A)
        assert m.rank(np.arange(n + 1)).tolist() == np.searchsorted(at, np.arange(n + 1)).tolist()
        if len(at):
            assert m.select(np.arange(1, len(at) + 1)).tolist() == at.tolist()
    text = "aé漢😀\nb" * 9
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    ends = fim.Marks.of(fim.mark_code_points(fim._words(raw), len(raw)))
    want = np.cumsum([len(c.encode()) for c in text]) - 1
    assert ends.select(np.arange(1, len(text) + 1)).tolist() == want.tolist()


def test_sentinels_that_run_into_each_other_are_refused(docs):
    for bad in (("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("", "<S>", "<M>"), ("<P>", "<P>x", "<M>")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, sentinels=bad)


def test_fim_report_equals_its_sql(s, lines, tmp):
    path = f"{tmp}/fim-lines"
    lines.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    cols = "doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256"
    want = con.execute(f"SELECT {cols} FROM ({oracle.SQL['op13_fill_in_middle']})").fetchall()
    got = [tuple(r) for r in fim.fim_report(s.read.parquet(path)).select(*cols.split(", ")).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
