"""Line dedup, passage dedup, decontamination and the Jaccard join against brute force."""
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import bloom, decontaminate, jaccard, linededup, suffixdedup


def test_twice_filter_holds_every_repeated_hash(spark):
    rows = spark.range(4000, numPartitions=40).selectExpr("id % 3000 AS id")

    def hashes(batch):
        yield batch.column(0).to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    bits = bloom.twice_seen(rows, hashes, 20)
    own = np.arange(3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert bloom.holds(bits, own[:1000]).all()
    assert bloom.holds(bits, own[1000:]).mean() < 0.05


@pytest.mark.parametrize("keep", ["none", "first"])
def test_line_dedup(spark, keep):
    draw = random.Random(1)
    rows = [(i, "\n".join(draw.choice(["a", " A\t", "b ", "C", "é", "", " "]) + draw.choice(["", str(draw.randint(0, 40))])
                          for _ in range(draw.randint(0, 9)))) for i in range(200)]
    found = defaultdict(list)
    for i, t in rows:
        for k in {line.strip(" \t\n\v\f\r").lower() for line in t.split("\n")} - {""}:
            found[k].append(i)
    want = {}
    for i, t in rows:
        left, spare = [], set()
        for line in t.split("\n"):
            k = line.strip(" \t\n\v\f\r").lower()
            if k and len(found[k]) >= 5 and not (keep == "first" and min(found[k]) == i and k not in spare):
                continue
            spare.add(k)
            left.append(line)
        want[i] = ("\n".join(left), t.count("\n") + 1, t.count("\n") + 1 - len(left))
    got = linededup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), least_docs=5, keep=keep)
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got.collect()} == want


def test_line_dedup_odd_rows(odd_docs):
    got = linededup.drop_repeated_lines(odd_docs, least_docs=3)
    assert got.columns == ["doc_id", "text", "lang", "n_lines", "n_dropped"]
    rows = sorted(got.collect(), key=lambda r: (r.doc_id or 0, r.text or ""))
    assert [(r.doc_id, r.n_lines, r.n_dropped) for r in rows] == [
        (None, 1, 1), (1, 1, 0), (2, 1, 0), (3, 3, 0), (4, 1, 0), (5, 3, 2), (5, 3, 2), (6, 1, 0), (7, 1, 0)]
    assert linededup.drop_repeated_lines(odd_docs.limit(0)).count() == 0


def _repeated(rows, length, keep):
    found = defaultdict(list)
    raw = [(t or "").encode() for _, t in rows]
    place = [(i is not None, i or 0) for i, _ in rows]
    for p, b in zip(place, raw):
        for s in range(len(b) - length + 1):
            found[b[s:s + length]].append((*p, s))
    out = []
    for (i, _), p, b in zip(rows, place, raw):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            others = found[b[s:s + length]]
            if len(others) > 1 if keep == "none" else min(others) < (*p, s):
                gone[s:s + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,heavy", [("none", 1000), ("none", 3), ("first", 3)])
def test_passages(spark, keep, heavy):
    draw = random.Random(3)
    base = ["".join(draw.choice("abcdé fg") for _ in range(draw.randint(0, 300))) for _ in range(12)]
    rows = [(i, "".join(draw.choice([draw.choice(base)[draw.randint(0, 40):], "".join(draw.choice("xyz ") for _ in range(draw.randint(0, 30)))])
                        for _ in range(draw.randint(0, 4)))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, rows[7][1]), (101, rows[7][1]), (102, None), (103, ""), (None, "ab" * 200), (105, "q" * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixdedup.remove_repeated(df, length=40, gram=12, keep=keep, heavy=heavy, group=20).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got], key=repr) == _repeated(rows, 40, keep)


def test_passages_odd_rows(odd_docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffixdedup.remove_repeated(odd_docs).collect()}
    assert got[1] == (0, 0) and got[4] == (150_000, 150_000) and got[6] == (700, 700) and got[7] == (9, 0)
    assert suffixdedup.remove_repeated(odd_docs.limit(0)).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_fm_index_counts_and_places():
    draw = np.random.default_rng(4)
    text = np.concatenate([np.append(draw.integers(1, 5, draw.integers(1, 40)), 0) for _ in range(30)])
    index = decontaminate.FmIndex(text, 5)
    for n in (1, 2, 3, 5):
        for phrase in draw.integers(1, 5, (20, n)):
            want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == phrase).all()]
            low, high = index.search(phrase[None], np.array([n]))
            assert sorted(index.locate(np.arange(low[0], high[0]))) == want


@pytest.mark.parametrize("words_a_pass", [1 << 20, 20])
def test_decontaminate(spark, odd_docs, monkeypatch, words_a_pass):
    monkeypatch.setattr(decontaminate, "PASS_WORDS", words_a_pass)
    draw = random.Random(6)
    items = [(i, " ".join(draw.choice("abcdef") for _ in range(draw.choice([0, 2, 5, 12, 20])))) for i in range(12)] + [(50, None)]
    docs = []
    for i in range(120):
        words = [draw.choice("abcdefgh") for _ in range(draw.randint(0, 40))]
        words[3:3] = (draw.choice(items)[1] or "").upper().split() if draw.random() < 0.5 else []
        docs.append((i, draw.choice([" ", ", ", " é- "]).join(words)))
    want = {}
    for i, t in docs:
        w, hit, own = WORD.findall(t.lower()), set(), set()
        for item, text in items:
            x = WORD.findall((text or "").lower())
            for s in range(max(1, len(x) - 9) if x else 0):
                g = x[s:s + 10]
                for at in range(len(w) - len(g) + 1):
                    if w[at:at + len(g)] == g:
                        hit.update(range(at, at + len(g)))
                        own.add(str(item))
        want[i] = (len(w), hit, sorted(own))
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), tests)
    got = {r.doc_id: (r.n_words, {x for s in r.spans for x in range(s.start, s.end)}, r["items"]) for r in found.collect()}
    assert got == want
    clean = {r.doc_id: r.text for r in decontaminate.remove_spans(found).collect()}
    assert all(len(WORD.findall(clean[i].lower())) == want[i][0] - len(want[i][1]) for i, _ in docs)
    at_once = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), tests, cut=True)
    assert {r.doc_id: (r.text, r.n_words, r["items"]) for r in at_once.collect()} == {i: (clean[i], want[i][0], want[i][2]) for i in want}
    assert decontaminate.find(odd_docs, tests).count() == odd_docs.count()
    assert decontaminate.find(odd_docs.limit(0), tests.limit(0)).count() == 0


def _joined(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^ \t\n\v\f\r]+", (t or "").encode().lower())
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = top(rows[a][0]), top(rows[b][0])
                root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for (i, _), s in zip(rows, sets)}


@pytest.mark.parametrize("k,percent", [(3, 90), (2, 80)])
def test_jaccard_join(spark, monkeypatch, k, percent):
    for name, value in (("TOGETHER", 32), ("PIVOTS", 8), ("COMMON", 20), ("SAMPLE", 16)):  # so that regions are cut
        monkeypatch.setattr(jaccard, name, value)
    draw = random.Random(2)
    base, rows = [draw.choice("abcdefghijklmnop") * draw.randint(1, 3) for _ in range(60)], []
    for i in range(250):
        w = list(base) if i % 3 else [draw.choice("abcdefg") for _ in range(draw.randint(0, 6))]
        for _ in range(draw.randint(0, 4)):
            if w:
                w[draw.randrange(len(w))] = draw.choice("xyzuvw") + str(draw.randint(0, 3))
        rows.append((i, draw.choice([" ", "\t", "  "]).join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \n")]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
    assert {r.doc: (r.n_shingles, r.component_id) for r in got} == _joined(rows, k, percent)


def test_jaccard_join_of_texts_with_other_white_space(spark):
    draw, rows = random.Random(4), []
    for i in range(0, 120, 2):
        w = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 6))) for _ in range(32)]
        breaks = draw.sample(range(33), 2)  # wide gaps must not decide which shingles stand for the text
        rows += [(i, " ".join(w)), (i + 1, "".join(x + ("\n" + " " * 8 if j in breaks else " ") for j, x in enumerate([*w, "end"])))]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    want = _joined(rows, 3, 90)
    assert {i: c for i, (_, c) in want.items()} == {i: i - i % 2 for i, _ in rows}
    assert {r.doc: (r.n_shingles, r.component_id) for r in got} == want


def test_jaccard_odd_rows(odd_docs):
    got = jaccard.join(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.component_id == r.doc for r in got if r.doc is not None)
    assert jaccard.join(odd_docs.limit(0)).count() == 0


def test_regions_are_compared_in_small_blocks():
    import tracemalloc

    draw = np.random.default_rng(8)
    sets = [np.sort(draw.choice(1 << 40, 4000, replace=False)) for _ in range(120)]
    sets += [np.sort(np.concatenate([s[:-20], draw.choice(1 << 40, 20)])) for s in sets]
    n = np.array([len(s) for s in sets])
    classes = [np.frombuffer(jaccard._classes(s.astype(np.uint64)), np.uint8) for s in sets]
    tracemalloc.start()
    a, b = jaccard._compatible(np.arange(240), n, classes, 90)
    thinned = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    root = jaccard.local_roots(sets[:8] + sets[120:128], 90)
    tracemalloc.stop()
    assert sorted(zip(a.tolist(), b.tolist())) == [(i + 120, i) for i in range(120)]
    assert root.tolist() == [*range(8), *range(8)]
    assert thinned < 12 << 20


def _links(edges, docs):
    """The least document that edges lead each one to."""
    root = {d: d for d in docs}
    for _ in docs:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("far", [0, 9])
def test_settled_near_copies_do_not_meet(spark, monkeypatch, far):
    for name, value in (("TOGETHER", 16), ("PIVOTS", 4), ("SAMPLE", 200)):  # the base is among the sample
        monkeypatch.setattr(jaccard, name, value)
    draw = random.Random(8)
    base, sets = list(range(1000, 1060)), {}
    for i in range(150):  # linked to the base, often not to each other
        sets[i] = sorted({*(x for x in base if x not in draw.sample(base, 3)), *(draw.randrange(10**9) for _ in range(3))})
    sets[150] = base
    for i in range(151, 151 + far):  # some linked to a single copy, some to none
        sets[i] = sorted({*sets[i - 151][4:], *(draw.randrange(10**9) for _ in range(i % 3 * 4))})
    met, tiles = [], jaccard._tiles

    def seen(members, percent):
        out = tiles(members, percent)
        met.append(members.count())
        return out

    monkeypatch.setattr(jaccard, "_tiles", seen)
    members = spark.createDataFrame([(1, i, s) for i, s in sets.items()], "region long, doc long, set array<bigint>")
    got = _links([(e.a, e.b) for e in jaccard.region_links(members, 80).collect()], sets)
    want = []
    for i, s in sets.items():
        want += [(i, j) for j, t in sets.items() if i < j and 100 * len({*s} & {*t}) >= 80 * len({*s} | {*t})]
    assert got == _links(want, sets)
    if not far:
        assert sum(met) == 0


def test_blocks_of_settled_documents_meet_only_the_others(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TOGETHER", 8)
    draw = random.Random(5)
    pool = [draw.randrange(10**9) for _ in range(12)]
    sets = [sorted(draw.sample(pool, 9)) for _ in range(60)]
    rows = [(1, i, s, 60, 0 if i < 50 else None) for i, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "region long, doc long, set array<bigint>, size long, settled long")
    edges = {(e.a, e.b) for e in jaccard._tiles(members, 80).collect()}
    want = [(i, j) for i in range(60) for j in range(max(i + 1, 50), 60) if 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]})]
    together = [(0, i) for i in range(50)]
    assert _links([*edges, *together], range(60)) == _links([*want, *together], range(60))
    assert jaccard._tiles(members.withColumn("settled", F.lit(0).cast("long")), 80).count() == 0
