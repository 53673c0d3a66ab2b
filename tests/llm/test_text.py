import hashlib
import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from martforge.llm import chat, fingerprint, langid, mixing, packing, quality, tokens, warc
from martforge.llm import words as W

SPACE = " \t\n\x0b\x0c\r"


def test_words_are_those_of_split():
    texts = ["", "  a  b", None, "x\ny\tz ", "é b c", "\x1c d"]
    sl = next(W.slices(pa.array(texts)))
    w = W.find_words(sl)
    got = [[bytes(sl.buf[a:b]) for a, b in zip(w.starts[w.first[i]:w.first[i + 1]], w.ends[w.first[i]:w.first[i + 1]])]
           for i in range(sl.rows)]
    assert got == [(t or "").encode().split() for t in texts]


# -- chat ---------------------------------------------------------------------

def test_chat_reads_back_any_text(s):
    texts = ["\\### Assistant: </turn> ok", "</turn>\n", "\\", "### User: ### ", "<\\/turn>", "", None, "a\r\nb", "##\\# "]
    turns = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(texts)]
    turns += [(2, None, None, "x"), (2, 0, "odd: role\\", "y"), (3, 0, "assistant", "z"), (None, 1, "user", "q"),
              (4, 0, "user", "same"), (4, 0, "user", "same")]
    df = s.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.t] for r in out.select("conv_id", chat.read_back("formatted").alias("t")).collect()}
    assert back[1] == [(r, t or "") for _, _, r, t in turns[:len(texts)]]
    assert back[2] == [("", "x"), ("odd: role\\", "y")] and back[None] == [("user", "q")]
    valid = {r.conv_id: (r.valid, r.first_bad) for r in out.collect()}
    assert valid[1] == (True, None) and valid[3] == (False, 0) and valid[4] == (False, 1) and valid[2] == (False, 0)
    rep = {r.conv_id: r for r in chat.report(df).collect()}
    said = "".join((t or "") for _, _, r, t in turns[:len(texts)] if r == "assistant")
    assert rep[1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and rep[1].loss_chars == len(said)
    assert chat.report(df.limit(0)).count() == 0


# -- mixing -------------------------------------------------------------------

def water_level(sizes, weights, cap=3):
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[x] for x in capped)
        open_ = [x for x in sizes if x not in capped]
        w = sum(weights[x] for x in open_)
        new = {x for x in open_ if weights[x] * left / w > cap * sizes[x]} if w else set()
        if not new:
            return {x: cap * sizes[x] if x in capped else weights[x] * left / w for x in sizes}
        capped |= new


def test_mix_targets_and_budgets(s, docs):
    labels = s.read.parquet("/root/testdata/sf0.001/labels.parquet")
    src = docs.withColumn("source", F.when(F.col("doc_id") < 100, F.lit(None)).otherwise(
        F.concat(F.lit("s"), (F.col("doc_id") % 9).cast("string"))))
    rows = [(r.doc_id, r.source, len((r.text or "").encode().split())) for r in src.collect()]
    sizes = defaultdict(int)
    for _, x, n in rows:
        sizes[x] += n
    order = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    want = water_level(sizes, {x: (5, 2, 1)[i % 3] for i, x in enumerate(order)})
    got = mixing.mix_report(s, src, labels).collect()
    assert len(got) == len(rows)
    source = {d: x for d, x, _ in rows}
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6 and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[source[r.doc_id]] += r.taken
    for x in sizes:
        assert abs(taken[x] - want[x]) <= max(0.02 * want[x], 250)   # tiny sources: a document's size
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_report(s, src, labels).collect()))


def test_mix_of_odd_rows(s, odd, none):
    rep = mixing.mix_report(s, odd).collect()
    assert len(rep) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in rep)
    out = mixing.mix(s, odd)
    assert out.columns == odd.columns
    want = Counter()
    for r in rep:
        want[r.doc_id] += r.taken
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len((r.text or "").encode().split())
    assert +got == +want
    assert mixing.mix_report(s, none).count() == 0 and mixing.mix(s, none).count() == 0


def test_lighter_keys_for_better_documents(s):
    rows = [(i, "w " * 10, "a" if i < 400 else "b") for i in range(800)]
    df = s.createDataFrame(rows, "doc_id long, text string, source string")
    labels = s.createDataFrame([(i, i % 2) for i in range(800)], "doc_id long, quality int")
    d = mixing.mix_report(s, df, labels, weights=(1.0, 3.0)).where("doc_id < 400").collect()
    good = sum(r.taken for r in d if r.doc_id % 2 == 1)
    bad = sum(r.taken for r in d if r.doc_id % 2 == 0)
    assert good > 1.5 * bad


# -- quality ------------------------------------------------------------------

def brute_stats(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    win = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = set()
    for i in range(len(w) - 2):
        if win[tuple(w[i:i + 3])] > 1:
            rep.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(rep))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é#|\n\r\t漢", max_size=60)), min_size=1, max_size=8))
def test_rule_statistics(texts):
    got = []
    for sl in W.slices(pa.array(texts, pa.string())):
        x = quality.statistics(sl)
        got += list(zip(*[x[c].tolist() for c in quality.STATS]))
    assert got == [brute_stats(t) for t in texts]


def test_forest_finds_the_odd_one_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    far = np.array([[9.0, 9.0, 9.0]])
    forest = [quality.grow(x[rng.choice(600, 256, replace=False)], rng, 8) for _ in range(100)]
    score = quality.anomaly(forest, np.vstack([x, far]), 256)
    assert score[-1] > np.quantile(score[:-1], 0.99)


def test_quality_of_documents(s, odd, none):
    docs = s.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = s.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in quality.judged(s, docs, labels).collect()}
    for r in docs.where("doc_id % 7 = 0").collect():
        g = got[r.doc_id]
        n, *rest = brute_stats(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (n, *rest)
        assert g.base_failed == (n < 50 or 100 * rest[3] > 50 * n)
    good = [got[r.doc_id] for r in labels.where("quality = 1").collect()]
    bad = [got[r.doc_id] for r in labels.where("quality = 0").collect()]
    assert sum(not g.kept and not g.base_failed for g in good) <= 0.02 * len(good)
    assert sum(not g.kept for g in bad) > 0.5 * len(bad)
    assert quality.judged(s, odd, labels).count() == odd.count()
    assert quality.judged(s, none, labels).count() == 0
    assert quality.judged(s, docs, labels.limit(0)).where("not kept and not base_failed").count() == 0


def test_path_lengths_equal_a_plain_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2)).round(1)
    tree = quality.grow(x[:64], rng, 6)

    def walk(row, node=0):
        f = tree["feat"][node]
        return tree["length"][node] if f < 0 else walk(row, tree["left"][node] + (row[f] >= tree["cut"][node]))

    assert quality.path_length(tree, x, 6).tolist() == [walk(r) for r in x]


def plain_kept(rows, best):
    """kept of each row, from its scores and the labels: every cut is tried."""
    labelled = [r for r in rows if not r.base_failed and r.doc_id in best]
    good, bad = ([r for r in labelled if (best[r.doc_id] > 0) == x] for x in (True, False))
    cuts = {}
    for c in [f"anomaly_{g}" for g in quality.GROUPS]:
        of = lambda group: sorted((int(r[c] * 2000) for r in group), reverse=True)  # noqa: B023,E731
        tried = []
        for cut in range(2001):
            caught, lost = (sum(x >= cut for x in of(group)) for group in (bad, good))
            if lost <= 0.005 * len(good) and caught >= 0.02 * len(bad) and caught > 5 * lost:
                tried.append((caught - 5 * lost, cut))
        cuts[c] = max(tried)[1] if tried else 4000
    return [not r.base_failed and all(int(r[c] * 2000) < cut for c, cut in cuts.items()) for r in rows]


def test_verdict_and_what_the_forest_adds(s):
    """The verdict from the labels of even documents equals a plain version; on the
    labels of odd documents, which set no threshold, the forests catch bad ones and spare good ones."""
    docs = s.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = s.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judged(s, docs, labels.where("doc_id % 2 = 0")).collect()
    best = {}
    for r in labels.where("quality is not null").collect():
        best[r.doc_id] = max(r.quality, best.get(r.doc_id, 0))
    assert [r.kept for r in rows] == plain_kept(rows, {d: q for d, q in best.items() if d % 2 == 0})
    odd = [r for r in rows if not r.base_failed and r.doc_id % 2 and r.doc_id in best]
    good, bad = ([r.kept for r in odd if (best[r.doc_id] > 0) == x] for x in (True, False))
    print("bad caught", bad.count(False), "of", len(bad), "good lost", good.count(False), "of", len(good))
    assert 2 * bad.count(False) >= len(bad) > 5 and good.count(False) <= 0.02 * len(good)


# -- archives -----------------------------------------------------------------

PAGES = "page_id long, url string, html string, body string"


def test_archives_round_trip(s, tmp):
    big = "<p>é" + "x" * 1200
    rows = [(1, "http://a.example/x?y=1", big, "z"), (2, "http://a.example/x", big, "z"), (3, None, None, None),
            (4, "http://b.example/\r\nWARC/1.1\r\n", "small", None), (5, "http://b.example/", "small", None),
            (6, "::bad[", "WARC/1.1\r\n\r\n\r\n" * 200, None), (7, "http://a.example/x", big, "z"), (7, "http://a.example/x", big, "z")]
    df = s.createDataFrame(rows, PAGES)
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0)
                 for r in warc.archive_report(s, df).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = sorted((i, len((h or "").encode()), sha(h), "revisit" if h == big and i < 7 else "response",
                   7 if h == big and i < 7 else 0) for i, _, h, _ in rows)
    assert got == want
    assert warc.archive_report(s, df.limit(0)).count() == 0


def test_a_revisit_of_a_repeated_id_has_its_own_payload(s):
    one, other, long = "a" * 1500, "b" * 4000, "c" * 300_000
    rows = [(1, "u", one, "x"), (9, "v", one, "x"), (9, "w", other, "x"), (None, "n", one, "x"), (4, None, long, "x"),
            (5, "", long, "x"), (None, None, None, None)]
    df = s.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    got = sorted(str((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in warc.archive_report(s, df).collect())
    assert got == sorted(map(str, [(1, 1500, "revisit", 9), (9, 1500, "response", None), (9, 4000, "response", None),
                                   (None, 1500, "revisit", 9), (4, 300_000, "revisit", 5),
                                   (5, 300_000, "response", None), (None, 0, "response", None)]))


def test_archives_are_bounded_in_bytes(s, tmp, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 40_000)
    rows = [(i, f"u{i}", chr(97 + i % 26) * n) for i, n in enumerate([10] * 30 + [3000] * 30 + [30_000] * 5 + [100_000])]
    df = s.createDataFrame(rows, "page_id long, url string, html string").repartition(1)
    warc.write_archives(s, df, tmp + "/w", per_file=20)
    found = warc.read_archives(s, tmp + "/w").collect()
    per = defaultdict(list)
    for r in found:
        per[r.run].append(r.payload_bytes)
    assert sorted(r.id for r in found if r.id is not None) == list(range(66))
    full = {k: [x for x in v if x] for k, v in per.items()}
    assert all(sum(v) <= 40_000 or len(v) == 1 for v in full.values()), full


def test_blocks_of_a_run_are_put_in_order():
    rows = [(i, i) for i in range(9)]
    assert warc.in_order([rows[4:7], rows[:2], rows[7:], rows[2:4]]) == rows


def test_histories_are_globally_ordered(s, tmp):
    pages = s.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(5)
    warc.write_archives(s, pages, tmp + "/w", per_file=4)
    runs = warc.read_archives(s, tmp + "/w")
    rows = warc.merged_index(s, runs, range_rows=7).orderBy("place").collect()
    keys = [(r.url_key, r.time, r.id) for r in rows]
    assert len(rows) == 50 and keys == sorted(keys) and len({r.run for r in rows}) > 5


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), max_size=9), max_size=9))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


# -- language -----------------------------------------------------------------

def test_samples_are_bounded_whatever_the_ids(s):
    """Rows without an id and rows that repeat do not all meet in one task or on the driver."""
    rows = [(None, f"das ist der {i} Text und {i * 7} noch mehr Wörter", "de", 1) for i in range(900)]
    rows += [(5, "equal rows of one id", "en", 1)] * 900
    df = s.createDataFrame(rows, "doc_id long, text string, lang string, extra int")
    orig = langid._cluster

    def counted(clusters, reject):
        inner = orig(clusters, reject)

        def run(table):
            out = inner(table)
            return out.set_column(2, "low", [[float(table.num_rows)] * out.num_rows])
        return run

    langid._cluster = counted
    try:
        m = langid.fit(s, df, sample=100, margin=1.0)
    finally:
        langid._cluster = orig
    seen = dict(zip(m.langs, m.floors))
    assert 50 < seen["de"] < 160 and seen.get("en", 1) == 1
    stats = quality.rule_statistics(df.withColumn("_th_", F.xxhash64("text")), {"_id": "doc_id", "_th": "_th_"}, "text")
    forest, size = quality.fit_forest(s, stats.withColumn("base_failed", F.lit(False)), trees=4, subsample=16)
    assert size <= 16 and len(forest) == 4


def test_language_of_held_out_documents(s):
    docs = s.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    out = langid.report(s, docs).collect()
    assert len(out) == 1000
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    test = [r for r in out if r.held_out and any(c.isalpha() for c in truth[r.doc_id][1])]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in test) >= 0.97 * len(test)
    assert sum(r.rejected for r in test) <= 0.01 * len(test)


def test_language_of_odd_rows(s, odd, none):
    model = langid.fit(s, s.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    out = langid.predict(odd.withColumn("score", F.lit("clash")), model)
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert got[(1, None)].lang_pred == "und" and got[(3, " \n\t ")].lang_pred == "und" and got[(3, " \n\t ")].rejected
    assert got[(2, "")].score == 0.0 and out.count() == odd.count()
    assert langid.report(s, none).count() == 0
    assert {r.lang_pred for r in langid.report(s, odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# -- fingerprints -------------------------------------------------------------

def test_fingerprints_against_brute_force(s, docs, odd, none):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprint.edited_report(s, docs).collect()}

    def sh(t):
        w = t.encode().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    off = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[d].n_chars == len(t)
        a, b = sh(t), sh(edited)
        if len(a | b) > 400:
            off.append(abs(got[d].near_edited - len(a & b) / len(a | b)))
        assert got[d].fingerprint != "" or not a
    assert np.mean(off) < 0.05
    by_text = defaultdict(set)
    for d, t in rows:
        by_text[t].add(got[d].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    out = fingerprint.edited_report(s, odd).collect()
    assert len(out) == odd.count() and all(0 <= r.near_next <= 1 for r in out)
    assert fingerprint.edited_report(s, none).count() == 0
    one = fingerprint.edited_report(s, odd.where("doc_id = 8")).first()
    assert one.near_next == 1.0


def test_merged_sketch_is_that_of_the_joined_shingles(s):
    words = [f"w{i}" for i in range(20_000)]
    rows = [(0, " ".join(words)), (1, " ".join(words[700:720])), (2, "a b"), (3, "c d e f"), (4, ""),
            (5, " ".join(words[:3000])), (6, " ".join(words[2996:6000]))]
    df = fingerprint.with_fingerprint(s.createDataFrame(rows, "id long, text string"), "text", "fp")
    a, b = df.selectExpr("id as a", "fp as fa"), df.selectExpr("id as b", "fp as fb")
    both = a.crossJoin(b).select("a", "b", fingerprint.merged("fa", "fb").alias("m"),
                                 fingerprint.containment("fa", "fb").alias("c")).collect()
    fp, bound = {r.id: list(r.fp) for r in df.collect()}, fingerprint._threshold(fingerprint.FRACTION)
    for r in both:
        assert list(r.m) == sorted({x for x in fp[r.a] + fp[r.b] if x < bound})
    found = {(r.a, r.b): r for r in both}
    # two halves that overlap by one shingle's words: their union is the sketch of the whole
    whole = fingerprint.with_fingerprint(s.createDataFrame([(7, " ".join(words[:6000]))], "id long, text string"), "text", "fp")
    assert list(found[(5, 6)].m) == list(whole.first().fp)
    # 20 words inside 20,000
    assert found[(0, 1)].c == 1.0 and found[(0, 6)].c == 1.0 and found[(1, 6)].c < 0.2


def test_next_row_over_many_ranges(s, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 3)
    ids = [5, 5, None, 900, -3, 17, 18, 19, 2, 1, 0, 44, 45, 46, 47, 48, 49, 50, 51, 52]
    df = s.createDataFrame([(i, f"t{n}", n) for n, i in enumerate(ids)], "doc_id long, text string, tie long")
    got = {r.tie: r.next_text for r in fingerprint.with_next(s, df, "doc_id", "tie", ["text"]).collect()}
    order = sorted(range(len(ids)), key=lambda n: (ids[n] is None, -(ids[n] or 0), n))
    assert got == {n: f"t{order[(p + 1) % len(order)]}" for p, n in enumerate(order)}


# -- tokens and packing -------------------------------------------------------

def test_small_memories_change_no_ids():
    path = tokens.model_path(tokens.MODEL)
    e = tokens.UnitEncoder(path)
    e.units = tokens._Units(e.tok, 3000, 1500)
    text = " ".join(f"word{i % 37} Été{i} x-{i}y" for i in range(400))
    assert np.frombuffer(e.ids(text.encode()), "<u4").tolist() == library(e, text)
    assert e.units.used <= 1500 and e.units.runs.used <= 750 and len(e.units) < 20
    e.units.empty()
    assert not e.units and not e.units.old and not e.units.runs.young



@pytest.fixture(scope="module")
def enc():
    return tokens.UnitEncoder.of(tokens.model_path(tokens.MODEL))


def library(enc, text):
    return enc.tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aB'sS !?<|endoftext>\n\té́ßÀ÷12½ 　漢"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_unit_ids_are_the_librarys(text):
    e = tokens.UnitEncoder.of(tokens.model_path(tokens.MODEL))
    assert np.frombuffer(e.ids(text.encode()), "<u4").tolist() == library(e, text)


def test_spliced_ids_are_the_librarys(enc, docs):
    texts = [r.text or "" for r in docs.limit(60).collect()]
    for text in ["".join(texts), " ".join(texts[:9]) + "q" * 9000 + " " + texts[3], "x" * 7000, "the the " * 3000,
                 "<|endoftext|>" * 900, ("'s don't" + "é ́" * 5 + "\t") * 600]:
        for chunk, overlap in ((700, 60), (3000, 512)):
            ids, splices = enc.spliced(text, chunk, overlap)
            assert np.frombuffer(ids, "<u4").tolist() == library(enc, text)
            assert (splices == 0) if " " not in text else splices > len(text) // chunk // 3


def test_token_counts_of_rows(s, enc, docs, odd, none):
    path = tokens.model_path(tokens.MODEL)
    for df, chunk in ((docs, tokens.CHUNK), (odd, tokens.CHUNK), (docs, 300)):
        text = Counter((str(r.doc_id), len((r.text or "").encode()), len(library(enc, r.text or ""))) for r in df.collect())
        out = tokens.token_counts(df, path, chunk=chunk).collect()
        assert Counter((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == text
        assert sum(r.n_splices > 0 for r in out) >= sum(len(r.text or "") > 2 * chunk for r in df.collect())
        assert all(r.over_limit == (r.n_tokens > 2048) for r in out)
    assert tokens.token_counts(none, path).count() == 0


def test_packing_holds_every_piece_once(s, enc, docs, odd, none):
    path = tokens.model_path(tokens.MODEL)
    for df in (docs, odd):
        out = packing.pack(s, df, path, with_ids=True).collect()
        want = Counter()
        for r in df.collect():
            ids = library(enc, r.text or "") + [1]
            for j, lo in enumerate(range(0, len(ids), 4096)):
                part = np.array(ids[lo:lo + 4096], "<u4")
                want[(str(r.doc_id), j, lo, len(part), zlib.crc32(part.tobytes()))] += 1
        assert Counter((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
        seqs = defaultdict(list)
        for r in out:
            assert len(r.ids) == r.length
            seqs[r.sequence_id].append((r.offset, r.length))
        for v in seqs.values():
            at = 0
            for o, n in sorted(v):
                assert o == at
                at += n
            assert at <= 4096
        total = sum(r.length for r in out)
        assert len(seqs) <= -(-total // 4096) * 1.03 + 1
    assert packing.pack(s, none, path).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
def test_plan_uses_the_histogram(h):
    hist = np.zeros(65, dtype=np.int64)
    for n, c in h.items():
        hist[n] = c
    used = Counter()
    for lens, m in packing.plan(hist, 64, 4):
        assert sum(lens) <= 64 and m > 0
        for n in lens:
            used[n] += m
    assert used == Counter({n: int(c) for n, c in h.items()})


def test_nnls_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(10):
        A, y = rng.random((8, 20)), rng.normal(size=8) + 1
        x = packing.nnls(A, y)
        grad = A.T @ (y - A @ x)
        assert (x >= 0).all() and (grad < 1e-6).all() and np.abs(grad[x > 1e-9]).max(initial=0) < 1e-6
