"""Every stage of the pipeline against a plain Python version, on the stage's own input."""

import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from martforge.llm import langid
from martforge.llm.scratch import PLAN_TEXT, settings
from martforge.llm.tokens import MODEL, model_path

from .test_dedup import brute_classes, brute_removed, fast_similarity

SF = "/root/testdata/sf0.001"


def planted(rows):
    """Rows with new ids: gibberish, no letters, null text, copies, near copies, a shared passage."""
    rng = random.Random(4)
    texts = [r["text"] for r in rows if r["text"] and len(r["text"].split()) > 80][:6]
    passage = [f"passage{i}" for i in range(60)]
    near = texts[2].split()
    near[len(near) // 2] = "changed"
    made = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(400)), "12 34 -- 56", None, "",
            texts[0], texts[0], texts[1], " ".join(near),
            " ".join(texts[3].split()[:70] + passage), " ".join(passage + texts[4].split()[:70])]
    base = dict(rows[0])
    return [base | {"doc_id": 900_000 + i, "text": t, "n_chars": len(t or "")} for i, t in enumerate(made)]


@pytest.fixture(scope="module")
def stages(s, docs, tmp_path_factory):
    """name -> (input rows, output rows) of one call of ``run``."""
    folder = str(tmp_path_factory.mktemp("stages"))
    extra = planted([r.asDict() for r in docs.collect()])
    docs.unionByName(s.createDataFrame(extra, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    s.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    seen = {}

    def recorded(name, fn):
        def stage(spark, rows, sf_dir):
            out = corpus_pipeline.save(spark, fn(spark, rows, sf_dir), "recorded")
            seen[name] = ([r.asDict() for r in rows.collect()], [r.asDict() for r in out.collect()])
            return out
        return stage

    whole, corpus_pipeline.STAGES = corpus_pipeline.STAGES, [(n, recorded(n, f)) for n, f in corpus_pipeline.STAGES]
    try:
        corpus_pipeline.run(s, folder).count()
    finally:
        corpus_pipeline.STAGES = whole
    return seen


def by_id(rows):
    return sorted(rows, key=lambda r: r["doc_id"])


def plain_language(model, text):
    """Language of a text, or None if it is rejected."""
    if not any(c.isalpha() for c in text or ""):
        return None
    raw = [b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32
           for b in text.lower().encode()]
    raw = [b for i, b in enumerate(raw) if not (b == 32 and i and raw[i - 1] == 32)]
    raw = [32, *raw, 32]
    found = Counter()
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        found[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 19] += 1
    v = {k: math.log1p(n) * float(model.idf[k]) for k, n in found.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    likeness = [sum(x * float(c[k]) for k, x in v.items()) / norm for c in model.centroids]
    best = max(range(len(likeness)), key=likeness.__getitem__)
    return model.langs[best] if likeness[best] >= model.floors[best] else None


def test_language(s, stages):
    before, after = stages["language"]
    df = s.createDataFrame(before, s.read.parquet(f"{SF}/documents.parquet").schema)
    model = langid.fit(s, df.where(~langid.held_out("doc_id")))
    want = [r | {"lang": lang} for r in by_id(before) if (lang := plain_language(model, r["text"]))]
    assert by_id(after) == want
    assert {900_000, 900_001, 900_002, 900_003}.isdisjoint(r["doc_id"] for r in after)
    assert sum(r["doc_id"] < 900_000 for r in after) >= 0.99 * sum(r["doc_id"] < 900_000 for r in before)


def test_one_of_each(stages):
    before, after = stages["near duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in by_id(before)]
    classes = {c for _, c in brute_classes(rows, fast_similarity)}
    assert by_id(after) == [r for r in by_id(before) if str(r["doc_id"]) in classes]
    assert {900_004, 900_005, 900_006, 900_007}.isdisjoint(r["doc_id"] for r in after)


def test_without_repeats(stages):
    before, after = stages["substring dedup"]
    rows = by_id(before)
    kept = brute_removed([(r["doc_id"], r["text"]) for r in rows], 20)
    want = {}
    for r, words in zip(rows, kept):
        whole = r["text"].encode().split()
        if words == whole:
            want[r["doc_id"]] = r
        elif words:
            want[r["doc_id"]] = r | {"text": words}
    assert {r["doc_id"] for r in after} == want.keys()
    for r in after:
        w = want[r["doc_id"]]
        if isinstance(w["text"], list):
            assert r["text"].encode().split() == w["text"]
            assert r["n_chars"] == len(r["text"])
            r, w = r | {"text": "", "n_chars": 0}, w | {"text": "", "n_chars": 0}
        assert r == w
    assert sum(len(r["text"]) for r in after) < sum(len(r["text"]) for r in before)


def plain_mix(rows, quality):
    """doc_id -> how often the mix takes it: water level, complete epochs, then the rest of
    the budget in order of the keys, filled up by what still fits and the nearest document."""
    groups = defaultdict(list)
    for r in rows:
        text = (r["text"] or "").encode()
        th = xxhash.xxh64_intdigest(text, 42)
        h = xxhash.xxh64_intdigest(struct.pack("<q", r["doc_id"]), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<Q", th), h)
        h = xxhash.xxh64_intdigest(struct.pack("<i", 7), h)
        q = {1: 2.0, 0: 0.5}.get(quality.get(r["doc_id"]), 1.0)
        groups[r["source"]].append((-math.log(((h >> 11) + 0.5) * 2.0 ** -53) / q, r["doc_id"], len(text.split())))
    order = sorted(groups, key=lambda x: (x is None, x or ""))
    size = {g: sum(n for *_, n in groups[g]) for g in order}
    weight = {g: (5, 2, 1)[i % 3] for i, g in enumerate(order)}
    full = set()
    while True:
        rest = sum(size.values()) - sum(3 * size[g] for g in full)
        open_ = sum(weight[g] for g in order if g not in full)
        over = {g for g in order if g not in full and weight[g] * rest / open_ >= 3 * size[g]}
        if not over:
            break
        full |= over
    times = {}
    for g in order:
        target = 3 * size[g] if g in full else weight[g] * rest / open_
        epochs = min(3, int(target // size[g])) if size[g] else 0
        room = target - epochs * size[g]
        docs, taken, at = sorted(groups[g]), set(), 0
        for _, d, n in docs:
            at += n
            if at <= room:
                taken.add(d)
        for turn in range(4):
            gap = room - sum(n for _, d, n in docs if d in taken)
            left = [x for x in docs if x[1] not in taken and x[2] and epochs < 3]
            if turn < 3:
                at = 0
                for _, d, n in [x for x in left if x[2] <= gap]:
                    at += n
                    if at <= gap:
                        taken.add(d)
            elif left:
                off, _, d = min((abs(gap - n), key, d) for key, d, n in left)
                if off < gap:
                    taken.add(d)
        times |= {d: epochs + (d in taken) for _, d, _ in docs}
    return times


def test_mixed(s, stages):
    before, after = stages["source mix"]
    quality = {}
    for r in s.read.parquet(f"{SF}/labels.parquet").collect():
        if r["quality"] is not None:
            quality[r["doc_id"]] = max(r["quality"], quality.get(r["doc_id"], 0))
    times = plain_mix(before, quality)
    assert Counter(r["doc_id"] for r in after) == Counter({d: n for d, n in times.items() if n})
    rows = {r["doc_id"]: r for r in before}
    assert all(r == rows[r["doc_id"]] for r in after)


def test_packed(stages):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    encoder = Tokenizer.from_file(str(model_path(MODEL)))
    want = Counter()
    for r in before:
        ids = encoder.encode(r["text"], add_special_tokens=False).ids + [1]
        for i in range(0, len(ids), 4096):
            piece = np.array(ids[i:i + 4096], "<u4")
            want[r["doc_id"], i // 4096, i, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after) == want
    sequences = defaultdict(list)
    for r in after:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    room = []                        # plain best fit, longest first
    for n in sorted((k[3] for k in want.elements()), reverse=True):
        fits = [i for i, free in enumerate(room) if free >= n]
        if fits:
            room[min(fits, key=room.__getitem__)] -= n
        else:
            room.append(4096 - n)
    assert len(sequences) <= len(room) * 1.02 + 1


def test_plan_texts_are_cut_unless_the_session_says_so(s):
    before = s.conf.get(PLAN_TEXT, None)
    try:
        for own in (None, "123456"):
            s.conf.unset(PLAN_TEXT) if own is None else s.conf.set(PLAN_TEXT, own)
            settings(s)
            assert s.conf.get(PLAN_TEXT) == (own or "8192")
    finally:
        s.conf.unset(PLAN_TEXT) if before is None else s.conf.set(PLAN_TEXT, before)
