"""Source mixing against plain Python: targets, copies, odd rows."""
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import sourcemix


def _targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, full, left = {}, set(), share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        level = left / sum(w[s] for s in rest) if rest else 0
        above = [s for s in rest if level * w[s] >= most * sizes[s]]
        if not above:
            return {**out, **{s: level * w[s] for s in rest}}
        for s in above:
            out[s] = most * sizes[s]
            full.add(s)
            left -= out[s]


def _corpus(draw, names, n):
    rows = []
    for i in range(n):
        source = names[0] if draw.random() < 0.35 else draw.choice(names)
        words = 0 if draw.random() < 0.05 else int(draw.paretovariate(1.2) * 5) % 900
        rows.append((i, source, draw.choice([" ", "\t", " x ", "\n\n"]).join("w" for _ in range(words))))
    return rows


@pytest.mark.parametrize("names", [["a", "b", None, "É", "Z", "zz"], [f"host-{i}" for i in range(700)]])
def test_mix_against_plain_python(spark, names):
    rows = _corpus(random.Random(3), names, 5000)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({
        "size": sourcemix.word_count(F.col("text")), "drawn": sourcemix.drawn("doc_id", "text")})
    mixed = sourcemix.mix(docs)
    got = [(r.row, r.mix) for r in mixed.collect()]
    assert len(got) == len(rows)
    sizes = {}
    for _, source, text in rows:
        n = len([w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w])
        sizes[source] = sizes.get(source, 0) + n
    want = _targets(sizes)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    taken, longest = {}, {}
    for row, m in got:
        assert m.source_size == sizes[row.source] and m.target == pytest.approx(want[row.source])
        rate = m.target / m.source_size if m.source_size else 0
        assert m.copies in {int(rate), int(rate) + 1} and m.taken == m.copies * m.size <= 2 * m.size
        taken[row.source] = taken.get(row.source, 0) + m.taken
        longest[row.source] = max(longest.get(row.source, 0), m.size)
    assert all(abs(taken[s] - want[s]) <= 1.1 * longest[s] for s in sizes)
    again = sourcemix.mix(docs.repartition(7, "text"))
    assert sorted((r.row.doc_id, r.mix.copies) for r in again.collect()) == sorted((r.doc_id, m.copies) for r, m in got)
    assert sourcemix.emit(mixed).columns == docs.columns and sourcemix.emit(mixed).count() == sum(m.copies for _, m in got)


def test_mix_follows_its_sql(spark):
    documents = pd.DataFrame(_corpus(random.Random(5), ["a", "b", "c", None, "d"], 800), columns=["doc_id", "source", "text"])
    con = duckdb.connect()
    con.register("documents", documents)
    docs = spark.createDataFrame(documents.astype(object).where(documents.notna(), None), "doc_id long, source string, text string")
    docs = docs.withColumns({"size": sourcemix.word_count(F.col("text")), "drawn": sourcemix.drawn("doc_id", "text")})
    got = sourcemix.mix(docs).select("row.doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken").collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(sourcemix.SQL).fetchall())


def test_mix_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumns({c: F.lit(1) for c in ("source_size", "copies", "row", "mix", "slot", "bin")}).withColumns({
        "size": sourcemix.word_count(F.col("text")), "drawn": sourcemix.drawn("doc_id", "text")})
    mixed = sourcemix.mix(docs, source="lang")
    assert mixed.select("row.*").columns == docs.columns and mixed.count() == odd_docs.count()
    assert {r.row.size for r in mixed.collect()} == {0, 30000, 6, 2, 1, 3}
    assert mixed.filter("mix.size = 0 AND mix.taken != 0").count() == 0
    assert sourcemix.emit(mixed).columns == docs.columns
    assert sourcemix.mix(docs.limit(0), source="lang").count() == 0
    wordless = sourcemix.mix(docs.filter("size = 0"), source="lang").collect()
    assert wordless and all(r.mix.target == 0 and r.mix.taken == 0 for r in wordless)
