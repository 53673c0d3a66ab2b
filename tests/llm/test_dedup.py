import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martforge.llm import components as stars, neardup, scratch, spans
from martforge.llm import words as W
from martforge.llm.components import components, grown
from martforge.llm.scratch import save


def shingles(text):
    w = (text or "").encode().split()
    if len(w) < 5:
        return Counter([b" ".join(w)] if w else [])
    return Counter(b" ".join(w[i:i + 5]) for i in range(len(w) - 4))


def similarity(a, b):
    """Greater of plain and probability Jaccard, by the definitions."""
    if not a or not b:
        return float(a == b)
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    na, nb = sum(a.values()), sum(b.values())
    x, y = {k: v / na for k, v in a.items()}, {k: v / nb for k, v in b.items()}
    prob = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
               for i in x.keys() & y.keys())
    return max(plain, prob)


def fast_similarity(a, b):
    """As ``similarity``, by the function that the first test compares with it."""
    key = {k: i for i, k in enumerate(sorted(a.keys() | b.keys()))}
    side = [sorted((key[k], v) for k, v in x.items()) for x in (a, b)]
    arrays = [np.array(v, t) for x in side for v, t in zip(zip(*x), (np.uint64, float))]
    return max(neardup.jaccards(*arrays))


def brute_classes(rows, similarity=similarity):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or similarity(sets[i], sets[j]) >= 0.8 and sets[i]:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else (least[r] if d is None else min(least[r], d))
    return sorted((str(d), str(least[find(i)])) for i, (d, _) in enumerate(rows))


def test_jaccards_equal_the_definition():
    rng = np.random.default_rng(3)
    for _ in range(40):
        a = Counter(rng.integers(0, 30, rng.integers(1, 60)).tolist())
        b = Counter(rng.integers(0, 30, rng.integers(1, 60)).tolist())
        sa, sb = sorted(a), sorted(b)
        got = max(neardup.jaccards(np.array(sa, np.uint64), np.array([a[k] for k in sa], float),
                                   np.array(sb, np.uint64), np.array([b[k] for k in sb], float)))
        assert abs(got - similarity(a, b)) < 1e-9


def test_registers_estimate_probability_jaccard():
    words = [f"t{i}" for i in range(400)]
    other = words[:360] + [f"u{i}" for i in range(40)]
    col = pa.array([" ".join(words), " ".join(other), " ".join(words)])
    sl = next(W.slices(col))
    row, sh, wt = neardup.shingle_sets(sl)
    sig = neardup.signatures(row, sh, wt, sl.rows, 2048)
    true = similarity(shingles(" ".join(words)), shingles(" ".join(other)))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.05
    assert (sig[0] == sig[2]).all()


def test_classes_of_odd_rows(s, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted((str(r.doc_id), str(r.class_id)) for r in neardup.near_duplicates(s, odd).collect())
    assert got == brute_classes(rows)


def test_classes_of_a_group_of_edits(s):
    """A hub and edits of it: members link through others, not only the pivot."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(60):
        t = list(base)
        for p in rng.integers(0, 120, rng.integers(0, 5)):
            t[p] = f"e{i}_{p}"
        rows.append((i, " ".join(t)))
    for i in range(60, 100):     # share half a passage only
        rows.append((i, " ".join(base[:60] + [f"o{i}_{j}" for j in range(60)])))
    df = s.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.class_id)) for r in neardup.near_duplicates(s, df).collect())
    assert got == brute_classes(rows)


def test_texts_alike_by_set_that_repeat_a_line(s):
    """Plain Jaccard 0.98 whatever the number of repeats; probability Jaccard falls with it."""
    rows = []
    for g in range(12):
        body = [f"g{g}w{i}" for i in range(204)]
        line = [f"g{g}l{i}" for i in range(10)]
        rows += [(10 * g + i, " ".join(body + line * n)) for i, n in enumerate((1, 50))]
    df = s.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.class_id)) for r in neardup.near_duplicates(s, df).collect())
    assert got == brute_classes(rows)
    assert len({c for _, c in got}) == 12


def _closed_from_nothing(s, texts):
    """Classes by the closing join alone, every text a class of its own before."""
    df = s.createDataFrame(list(enumerate(texts)), "node long, text string").repartition(3)
    sets = df.mapInArrow(neardup._set_rows, "node long, sh binary, wt binary")
    rest = df.select("node", F.lit(True).alias("minor"))
    comp = s.createDataFrame([], "node long, label long")
    found = {r.node: r.label for r in neardup._closed(s, rest, sets, comp).collect()}
    return sorted((str(i), str(found.get(i, i))) for i in range(len(texts)))


def test_closing_join_finds_pairs_alike_by_weight(s):
    """The join alone: the classes of brute force come out, also by pairs of plain Jaccard below 0.8."""
    rng = np.random.default_rng(11)
    texts = []
    for i in range(120):
        line = [f"l{i % 3}w{j}" for j in range(int(rng.integers(5, 9)))]
        own = [f"o{i if i % 2 else i % 6}x{j}" for j in range(int(rng.integers(0, 25)))]
        texts.append(" ".join(own + line * int(rng.integers(1, 60))))
    assert _closed_from_nothing(s, texts) == brute_classes(list(enumerate(texts)), fast_similarity)


def test_closing_join_of_edited_groups(s):
    """Groups about 0.6 to 0.9 alike that share lines, with and without repeated lines."""
    rng = np.random.default_rng(12)
    texts = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(80)] + [f"line{g // 2}x{i}" for i in range(12)] * (1 + g % 2 * 3)
        for i in range(35):
            t = list(base)
            for p in rng.integers(0, len(t), int(rng.integers(0, 9))):
                # edits recur, so that texts away from the hub are alike as well
                t[p] = f"e{g}_{p}_{int(rng.integers(0, 3))}"
            texts.append(" ".join(t[int(rng.integers(0, 15)):]))
    want = brute_classes(list(enumerate(texts)), fast_similarity)
    assert _closed_from_nothing(s, texts) == want
    assert 10 < len({c for _, c in want}) < 130


def test_closing_join_does_not_grow_with_the_square_of_a_group(s, monkeypatch):
    """Outliers of a large group, 0.6 to 0.75 alike to every member: few pairs come out."""
    rng = np.random.default_rng(13)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(400):
        t = list(base)
        for j, p in enumerate(rng.choice(150, 1 if i % 4 else 7, replace=False)):
            t[p] = f"e{i}_{j}"
        texts.append(" ".join(t))
    made = []
    orig = neardup._across_classes

    def counted(*args):
        out = orig(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_across_classes", counted)
    assert len(_closed_from_nothing(s, texts)) == 400
    assert made[0] < 400        # a join on common shingles makes some 30,000 pairs


def test_copies_are_folded(s):
    df = s.createDataFrame([(i, "a b c d e f " * 3) for i in range(500)] + [(900, None), (901, "")],
                           "doc_id long, text string").repartition(2)
    keyed = df.select(neardup.text_digest("text").alias("dig"), F.coalesce("text", F.lit("")).alias("text"))
    rows = keyed.mapInArrow(neardup._band_rows, "dig binary, text string, bands array<long>").collect()
    assert len(rows) <= 4 and {len(r.bands) for r in rows if r.text} == {2 * neardup.BANDS}
    assert all(r.bands == [] for r in rows if not r.text)


def test_keep_one_keeps_columns(s, odd, none):
    kept = neardup.keep_one(s, odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 7, 7, 8, 9, 10]
    assert neardup.keep_one(s, none).count() == 0 and neardup.near_duplicates(s, none).count() == 0


def test_components_of_chains(s):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, 300), (300, 400), (7, 7)]
    got = {r.node: r.label for r in components(s, s.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[500] == got[400] == got[300] == 300


def test_settled_stars_take_no_round(s, monkeypatch):
    written = []
    monkeypatch.setattr(stars, "save", lambda spark, df, name: written.append(name) or save(spark, df, name))
    edges = [(1, i) for i in range(2, 30)] + [(100 + i, 50) for i in range(20)]
    got = {r.node: r.label for r in components(s, s.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 30)}, 50: 50, **{100 + i: 50 for i in range(20)}}
    assert written == ["edges", "least"]


def _plans(monkeypatch, *modules):
    """Name and optimized plan of each table that is written from now on."""
    seen = []

    def kept(spark, df, name):
        seen.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return save(spark, df, name)

    for m in modules:
        monkeypatch.setattr(m, "save", kept)
    return seen


def test_rounds_aggregate_for_minima_only(s, monkeypatch):
    seen = _plans(monkeypatch, stars)
    edges = [(i, i + 1) for i in range(40)] * 3 + [(i + 1, i) for i in range(40)] + [(90, i) for i in range(91, 99)] * 2
    got = {r.node: r.label for r in components(s, s.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 90 for i in range(90, 99)}}
    rounds = [plan for name, plan in seen if name == "edges"]
    assert len(rounds) > 1 and not any("Aggregate" in plan for plan in rounds)


def test_each_text_is_numbered_and_shingled_once(s, monkeypatch):
    seen = _plans(monkeypatch, neardup)
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{base} end{i % 3}") for i in range(12)] + [(50, "alone in the world it stands")]
    df = s.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(s, df).collect()}
    assert got == {**{i: 0 for i in range(12)}, 50: 50}
    plans = dict(seen)
    # numbers come with the order, without a join with the texts by digest; copies go before shingling
    assert "dig" not in "".join(x for x in plans["texts"].split("\n") if "Join" in x)
    assert 0 <= plans["sets"].find("MapInArrow") < plans["sets"].find("Aggregate [dig")


def test_components_grown_by_links(s):
    rng = np.random.default_rng(5)
    first, more = ([(int(a), int(b)) for a, b in rng.integers(0, 200, (n, 2))] for n in (70, 40))
    more += [(900, 901), (3, 3)]        # nodes without an edge so far
    table = lambda rows: s.createDataFrame(rows, "a long, b long")
    want = {r.node: r.label for r in components(s, table(first + more)).collect()}
    comp = components(s, table(first))
    assert {r.node: r.label for r in grown(s, comp, table(more)).collect()} == want
    comp = components(s, table(first))
    assert grown(s, comp, table(first[::-1])) is comp and comp.count() > 0


def test_star_edges_join_all_that_a_task_holds(s, monkeypatch):
    rng = np.random.default_rng(6)
    u, v = rng.integers(0, 300, 220), rng.integers(0, 300, 220)
    u, v = u[u != v], v[u != v]
    least = {int(x): int(x) for x in np.concatenate([u, v])}
    for _ in least:
        for a, b in zip(u.tolist(), v.tolist()):
            least[a] = least[b] = min(least[a], least[b])
    node, label = stars.star_edges(u, v)
    assert sorted(zip(node.tolist(), label.tolist())) == sorted((a, b) for a, b in least.items() if a != b)
    # a chain in one partition is a star before the first round
    written = []
    monkeypatch.setattr(stars, "save", lambda spark, df, name: written.append(name) or save(spark, df, name))
    chain = s.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").coalesce(1)
    assert {r.label for r in components(s, chain).collect()} == {0} and written == ["edges", "least"]


def test_no_edges_take_no_shuffle(s, monkeypatch):
    written = []
    monkeypatch.setattr(stars, "save", lambda spark, df, name: written.append(name) or save(spark, df, name))
    none = components(s, s.createDataFrame([(4, 4)], "a long, b long"))
    assert none.columns == ["node", "label"] and none.count() == 0 and written == ["edges"]


def test_further_pivots_are_of_the_greatest_class(s):
    buckets = s.createDataFrame([(1, n) for n in range(10)] + [(2, 1), (2, 2), (3, 20), (3, 21)], "band long, node long")
    comp = s.createDataFrame([(n, 3) for n in range(3, 8)] + [(8, 8), (9, 8)], "node long, label long")
    for turn in range(2):
        rows = neardup._unresolved(buckets, comp, turn).collect()
        assert len(rows) == 10 and {r.band for r in rows} == {1} and {r.big for r in rows} == {3}
        assert len({r.pivot for r in rows}) == 1 and 3 <= rows[0].pivot < 8


def test_closing_join_meets_its_hubs_once(s, monkeypatch):
    """Likeness to the hubs comes with the differences from them, and all kinds of pairs from one join."""
    seen = _plans(monkeypatch, neardup)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[i % 7:] + [f"e{i}"] * (i % 3)) for i in range(20)]
    assert _closed_from_nothing(s, texts) == brute_classes(list(enumerate(texts)), fast_similarity)
    names = [name for name, _ in seen]
    assert names.count("links") == 1 and names.count("differences") == 1
    assert sum(x.strip(" +-:").startswith("Join") for x in dict(seen)["across"].split("\n")) == 1


def test_texts_are_not_made_distinct_again(s, monkeypatch):
    seen = _plans(monkeypatch, scratch)
    df = s.createDataFrame([(i % 4, f"a b c d e f {i % 5}") for i in range(20)], "doc_id long, text string")
    got = neardup.classes(s, df).collect()
    assert len(got) == 5 and [("Aggregate" in plan) for name, plan in seen if name == "order"] == [False]


def brute_removed(rows, k):
    """rows: (doc_id, text) in order; the words of each that stay."""
    seen, out = {}, []
    for d, (_, text) in enumerate(rows):
        w = (text or "").encode().split()
        gone = set()
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            if key in seen and seen[key] < (d, p):
                gone.update(range(p, p + k))
            seen.setdefault(key, (d, p))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def _check(s, df, rows, k):
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256)
                 for r in spans.removal_report(s, df, k=k, g=min(6, k)).collect())
    want = sorted((str(rows[i][0]), len((rows[i][1] or "").encode().split()),
                   len((rows[i][1] or "").encode().split()) - len(kept),
                   hashlib.sha256(b" ".join(kept)).hexdigest())
                  for i, kept in enumerate(brute_removed(rows, k)))
    assert got == want


def test_removal_against_brute_force(s):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(120):        # few words: many branches, cycles and tandem repeats
        rows.append((i, " ".join(f"v{x}" for x in rng.integers(0, 3, rng.integers(0, 60)))))
    rows += [(200, "a b " * 40), (201, "c " * 70), (202, rows[5][1] + " " + rows[6][1]), (203, None)]
    df = s.createDataFrame(rows, "doc_id long, text string")
    for k in (8, 20):
        _check(s, df, rows, k)


def test_removal_of_odd_rows(s, odd, none):
    out = {(r.doc_id, r.n_words): r.n_removed for r in spans.removal_report(s, odd).collect()}
    assert out[(4, 40)] == 0 and out[(6, 40)] == 40 and out[(5, 42)] == 40
    assert out[(None, 41)] == 40 and out[(None, 0)] == 0 and out[(9, 120)] == 119
    whole = spans.remove_repeats(s, odd)
    assert whole.columns == odd.columns and whole.count() == odd.count()
    text = {r.doc_id: r.text for r in whole.collect() if r.doc_id in (5, 8, 6)}
    assert text[5] == "before after" and text[6] == "" and text[8].startswith("w0x0 ")
    assert spans.remove_repeats(s, none).count() == 0
