"""Kept rows and texts of every stage of the pipeline, and of run(), against plain Python."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwatch.llm import langid, pieces
from tests.llm.test_text import _joined

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the house of one with that there which would about people water",
         "fr": "une maison du nord avec cette nous vous leur quelque gens eau"}
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


@pytest.fixture(scope="module")
def docs():
    draw, rows = random.Random(8), []
    for i in range(80):
        lang = ("en", "fr")[i % 2]
        words = [draw.choice(WORDS[lang].split()) + draw.choice(["", "", str(i)]) for _ in range(40)]
        rows.append([i, "\n" + " ".join(words), lang])
        if i % 8 == 0:
            rows.append([500 - i, "\n" + "  ".join([*words, "end"]), lang])   # a near copy
        if i % 9 == 0:
            rows[-1][1] += "\n Same FOOTER of all\nlast " + str(i)
    rows += [[i, "\nsame footer OF all \n" + " ".join(f"w{i}x{j} the of" for j in range(20)), "en"] for i in range(600, 606)]
    rows += [[3, rows[20][1] + " other text under an id that is taken", "en"], [3, rows[2][1], "en"], [3, rows[2][1], "en"],
             [None, rows[2][1], "en"], [None, "\nno id " + rows[7][1][5:], "fr"], [None, "\nno id " + rows[7][1][5:], "fr"],
             [700, None, "en"], [701, "", "fr"], [702, " 12 34 ", "en"], [None, "", "en"], [None, "", "en"]]
    for i in (10, 30):
        rows[i][1] += ", ".join(["\nA", *ITEM.split()[:-2], "b"])
    return [(i, t, lang, "s", len(t) if t is not None else None) for i, t, lang in rows]


ITEM = "benchmark question what is the name of the seventh planet from our sun"


def _language(rows, m):
    def losses(t):
        b = [int(langid.LETTERS[x]) for x in t.encode()] + [0, 0]
        at = [((((b[i - 1] << 16) | (b[i] << 8) | b[i + 1]) * 2654435761) % 2**32) >> 18 for i in range(1, len(b) - 1) if b[i]]
        at = [x for x in at if x]
        out = [sum(w[x] for x in at) / max(1, len(at)) + c for w, c in zip(m.weights, m.bias)]
        return sorted(sum(np.log1p(np.exp(-o * c)) * t for o, c, t in zip(out, code, m.trust)) for code in m.codes)

    kept = []
    for r in rows:
        if r[1] and any(c.isalpha() for c in r[1]):
            a, b = losses(r[1])[:2]
            kept += [r] if b - a >= langid.CLEAR else []
    return kept


def _key(line):
    return line.strip(" \t\n\v\f\r").lower()


def _lines(rows):
    n = Counter(k for r in rows for k in {_key(x) for x in (r[1] or "").split("\n")} - {""})
    return [_text(r, r[1] and "\n".join(x for x in r[1].split("\n") if n[_key(x)] < 10)) for r in rows]


def _text(r, t):
    return (r[0], t, *r[2:4], len(t) if t is not None else None)


def _near(rows):
    bare = [r for r in rows if r[0] is None and not (r[1] or "").split()]
    own = sorted(set(rows) - set(bare), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    group = _joined([(i, r[1]) for i, r in enumerate(own)], 5, 80)
    return [r for i, r in enumerate(own) if group[i][1] == i] + bare


def _benchmarks(rows):
    item, out = ITEM.split(), []
    for r in rows:
        found, hit = list(WORD.finditer(r[1] or "")), set()
        words = [f.group().lower() for f in found]
        for s in range(len(words) - 9):
            if any(words[s:s + 10] == item[g:g + 10] for g in range(len(item) - 9)):
                hit.update(range(s, s + 10))
        t = r[1]
        for x in sorted(hit, reverse=True):
            t = t[:found[x].start()] + t[found[x + 1].start() if x + 1 in hit else found[x].end():]
        out.append(_text(r, t))
    return out


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=repr)


def test_stages_and_run(spark, docs, tmp_path):
    folder, v = str(tmp_path), pieces.load()
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    m = langid.train(table.filter(~langid.held_out(table.doc_id)))
    rows = docs
    for (_, stage), plain in zip(corpus_pipeline.STAGES, (lambda r: _language(r, m), _lines, _near, _benchmarks)):
        want = plain(rows)
        assert _rows(stage(spark, spark.createDataFrame(rows, SCHEMA), folder)) == sorted(want, key=repr)
        assert _rows(stage(spark, spark.createDataFrame(docs, SCHEMA), folder)) == sorted(plain(docs), key=repr)
        assert want != rows  # every stage has something to do
        rows = want
    out = corpus_pipeline.run(spark, folder)
    assert _rows(out) == sorted(rows, key=repr)
    for r in out.collect():
        best = pieces.n_best(" " + r.text, v, 1)[0][0]
        assert round(r.score * pieces.UNIT) == best and pieces.decoded(np.array(r.ids), v) == r.text.encode()


def test_benchmarks_go_in_one_python_step(spark, docs, tmp_path):
    """Two Python steps in a task are two workers for each core, which executors keep."""
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.remove_benchmarks(spark, spark.createDataFrame(docs, SCHEMA), str(tmp_path))
    assert clean._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert _rows(clean) == sorted(_benchmarks(docs), key=repr)


def test_near_duplicates_go_by_text(spark, docs):
    got = [_rows(corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(docs, SCHEMA).repartition(n), "")) for n in (1, 5)]
    assert got[0] == got[1] == sorted(_near(docs), key=repr)
    assert len([r for r in got[0] if r[0] == 3]) == len({r[1] for r in docs if r[0] == 3}) - 1  # one is a near copy
    assert corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def test_stages_keep_columns_of_any_name(spark, docs):
    extra = ["score", "ids", "items", "spans", "n_lines", "n_dropped", "n_words", "_row", "_lost", "_key", "_text", "c0", "lang_pred", "second"]
    rows = spark.createDataFrame(docs[:20] + docs[-6:], SCHEMA)
    wide = rows.withColumns({c: F.lit(f"own {c}") for c in extra})
    for name, stage in corpus_pipeline.STAGES:
        plain = stage(spark, rows, "/root/testdata/sf0.001")
        got = stage(spark, wide, "/root/testdata/sf0.001")
        assert got.columns[: len(wide.columns)] == wide.columns, name
        assert all(r[c] == f"own {c}" for r in got.select(extra).collect() for c in extra), name
        assert sorted(map(str, got.select(rows.columns).collect())) == sorted(map(str, plain.select(rows.columns).collect())), name


def test_numbers_and_signs_are_no_letters():
    assert not any(langid.has_letter(t) for t in ("½ ² ①② 12 _ …", "٣", "")) and langid.has_letter("½ é") and langid.has_letter("日")
