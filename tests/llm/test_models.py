"""Pieces, nearest neighbours, classifiers, archives, URL verdicts and the pipeline."""
import io
import random
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwatch.llm import langid, permindex, pieces, toxicity, urlfilter, warc

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def _all_scores(word, v):
    ways = {0: [0]}
    for j, arcs in enumerate(pieces.arcs_to(word, v)):
        ways.setdefault(j, [s + score for i, _, score in arcs for s in ways[i]])
    return sorted(ways[len(word)], reverse=True)


def test_n_best_of_words_and_texts(vocabulary):
    draw, v = random.Random(1), vocabulary
    for _ in range(150):
        word = " " + "".join(draw.choice("theaniouñçé▁\n日 ") for _ in range(draw.randint(1, 8)))
        want, got = _all_scores(word, v), pieces.n_best(word, v, 5)
        assert [s for s, _ in got] == want[:5] and len({i for _, i in got}) == len(got)
        _, _, best, gap = pieces.viterbi([word, "a"], v)
        assert best[0] == want[0] and gap[0] == (want[0] - want[1] if len(want) > 1 else -1)
    for _ in range(60):
        text = "".join(draw.choice(["the", "an ou", "日本", " ", "\n", "ñç", "▁x", " a", "tion"]) for _ in range(draw.randint(1, 4)))
        ids, _, best, others = pieces.Encoder(v, 4).encode([text])
        assert [int(best[0]), *(int(best[0]) - cost for cost, _ in others[0])] == _all_scores(" " + text, v)[:4]
        assert pieces.decoded(ids, v) == text.encode()


def test_viterbi_order_of_a_run_of_millions():
    nodes = 2_200_000  # level * nodes * nodes passes 2^63
    source, target = np.array([0, 0, 1, 2, 1, nodes - 2]), np.array([1, 2, nodes - 2, nodes - 2, 2, nodes - 1])
    value = np.full(nodes, pieces._NEVER)
    value[0] = 0
    by = pieces._relax(target, source, target, np.array([-5, -9, -4, -1, -3, -2]), value, source)
    assert value[[1, 2, nodes - 2, nodes - 1]].tolist() == [-5, -8, -9, -11]
    assert by[[1, 2, nodes - 2, nodes - 1]].tolist() == [0, 4, 2, 5]


def test_pieces_round_trip(spark, vocabulary, odd_docs):
    keep = ["doc_id", "lang", "n_lines", "text"]
    back = pieces.decode(pieces.encode(odd_docs, vocabulary, keep), vocabulary, keep).collect()
    assert len(back) == odd_docs.count()
    assert all(r.decoded == (r.text or "") and all(r.same) and len(r.sha256) == len(set(r.sha256)) for r in back)
    assert pieces.encode(odd_docs.limit(0), vocabulary, keep).count() == 0
    assert pieces.op1_sentencepiece(spark, TINY).filter("NOT round_trip").count() == 0


def test_neighbours(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(1500, 12))
    x[1000:1400] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 12), (2002, [float("nan")] * 12),
                                                        (2003, [None] * 12), (2004, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = permindex.search(df, df.filter("vec_id % 100 = 0"), block=400).collect()
    found, right = {}, 0
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        assert r.score == np.sqrt(((x[r.vec_id] - x[r.query_id]) ** 2).sum()) and r.vec_id != r.query_id
        found.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 1500, 100):
        far = np.sqrt(((x - x[q]) ** 2).sum(1))
        far[q] = np.inf
        best = np.lexsort((np.arange(1500), far))[:10]
        right += len(set(best) & set(found[q]))
        if 1000 <= q < 1400:
            assert found[q] == best.tolist()
    assert right >= 0.9 * 150
    assert permindex.search(df.limit(0), df.limit(0)).count() == 0


def test_language_held_out(spark, odd_docs):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = langid.op5_language_codes(spark, folder).join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    model = langid.train(odd_docs)
    rows = langid.predict(odd_docs, model, ["doc_id", "n_lines"]).collect()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3, 7}
    none = langid.train(odd_docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd_docs, none, ["doc_id"]).collect()} == {"und"}


def test_language_sample_of_one_id(spark, monkeypatch):
    """A key that all rows share, or copies of one row, neither swell nor empty the sample."""
    sizes, fit = [], langid._fit_bits
    monkeypatch.setattr(langid, "_fit_bits", lambda x, signs: sizes.append(np.unique(signs, axis=0, return_counts=True)[1]) or fit(x, signs, 2))
    words = {"en": "the house of one", "fr": "une maison du nord"}
    for key in ("7", "NULL", "id"):
        rows = spark.range(4000).selectExpr(f"CAST({key} AS long) AS doc_id", "IF(id % 2 = 0, 'en', 'fr') AS lang",
                                            f"IF(id % 2 = 0, '{words['en']} ', '{words['fr']} ') || repeat('x', id % 97) || id AS text")
        copies = spark.range(3000).selectExpr("CAST(9 AS long) AS doc_id", "'en' AS lang", "'of the one' AS text")
        sizes.clear()
        langid.train(rows.unionByName(copies), per_language=200)
        assert len(sizes[-1]) == 2 and all(140 < n < 260 for n in sizes[-1])


def test_codewords_differ():
    for n in (2, 4, 7, 12):
        codes = langid.codewords(n)
        assert min((codes[i] != codes[j]).sum() for i in range(n) for j in range(i)) >= max(1, codes.shape[1] // 4)


def test_toxicity_held_out(spark, odd_docs):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.op10_toxicity_pu(spark, folder).join(labels, "doc_id").filter("held_out").toPandas()
    toxic, rank = got["toxic"].to_numpy() == 1, got["score"].rank().to_numpy()
    area = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.85 and got["predicted"][~toxic].mean() < 0.02
    empty = toxicity.train(odd_docs, labels.limit(0))
    scores = [r.score for r in toxicity.score(odd_docs, empty).collect()]
    assert len(scores) == odd_docs.count() and max(scores) < 1e-9


def test_toxicity_counts_rows_of_one_id_once(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    once = toxicity.train(docs, labels)
    often = toxicity.train(docs.unionByName(docs).unionByName(docs.limit(0)), labels.unionByName(labels))
    assert len(once.vocabulary) and (once.vocabulary == often.vocabulary).all()
    assert np.allclose(once.weights, often.weights) and once.prior == often.prior


def test_zip_directories_with_and_without_zip64():
    for wide in (False, True):
        sink = io.BytesIO()
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as z:
            for name, body in ((warc.INDEX, b"index"), (warc.DATA, b"data" * 50)):
                with z.open(zipfile.ZipInfo(name), "w", force_zip64=wide) as member:
                    member.write(body)
        raw = sink.getvalue()
        if wide:  # move the end record's numbers into a ZIP64 end record
            at = raw.rfind(b"PK\x05\x06")
            n, size, offset = struct.unpack_from("<HII", raw, at + 10)
            end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, offset)
            locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at, 1)
            raw = raw[:at] + end64 + locator + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
        places = warc.members(io.BytesIO(raw), len(raw))
        assert raw[places[warc.DATA][0]:][:places[warc.DATA][1]] == b"data" * 50
        assert raw[places[warc.INDEX][0]:][:places[warc.INDEX][1]] == b"index"


def test_archives(spark):
    long = "é" * 600
    rows = [(1, "http://a/", long), (2, "http://b/", long), (9, None, long), (9, None, long), (3, "u", "short"), (4, "u", "short"),
            (5, "u", None), (6, "u", ""), (None, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    got = sorted([(r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived(df).collect()], key=repr)
    assert got == sorted([(1, 1200, "revisit", 9), (2, 1200, "revisit", 9), (9, 1200, "response", None), (9, 1200, "response", None),
                          (3, 5, "response", None), (4, 5, "response", None), (5, 0, "response", None), (6, 0, "response", None),
                          (0, 1200, "revisit", 9)], key=repr)
    assert warc.archived(df.limit(0)).count() == 0


def test_foreign_archive(spark, tmp_path):
    """Several members, one of them plain, HTTP messages, gzipped and plain indexes, text numbers, a record without digest."""
    import gzip
    import hashlib
    import json

    def made(kind, urn, payload, digest=None, http=b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"):
        body = http + payload
        head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn}", "WARC-Target-URI: http://x/"]
        head += [f"WARC-Payload-Digest: {digest}"] if digest else []
        head += [f"Content-Type: {'application/http; msgtype=response' if http else 'text/plain'}", f"Content-Length: {len(body)}", "", ""]
        return "\r\n".join(head).encode() + body + b"\r\n\r\n"

    sha = hashlib.sha1(b"one").hexdigest()
    first = [gzip.compress(made("response", "<urn:uuid:1>", b"one", f"sha1:{sha}")), gzip.compress(made("resource", "<urn:uuid:2>", b"two", http=b""))]
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    second = [made("response", "<urn:uuid:3>", b"3\r\none\r\n0\r\n\r\n", f"sha1:{sha}", chunked), made("revisit", "<urn:uuid:4>", b"", f"sha1:{sha}")]

    def lines(parts, name):
        at, out = 0, []
        for part in parts:
            out.append("x)/ 2020 " + json.dumps({"offset": str(at), "length": str(len(part)), "filename": name}))
            at += len(part)
        return "\n".join(out)

    def pack(name, index, members):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_STORED) as z:
            for member, body in {**index, **members}.items():
                z.writestr(member, body)
        return str(tmp_path / name)

    packed = gzip.compress(lines(first, "a.warc.gz").encode()[:20]) + gzip.compress(lines(first, "a.warc.gz").encode()[20:])
    uri = pack("f.wacz", {"indexes/a.cdx.gz": packed, "indexes/b.cdxj": "!meta {\"a\": 1}\n" + lines(second, "b.warc") + "\n"},
               {"archive/a.warc.gz": b"".join(first), "archive/b.warc": b"".join(second), "pages/pages.jsonl": "{}"})
    got = warc.read_archives(spark.createDataFrame([(uri,)], "archive string"), read_bytes=300)
    assert got.rdd.getNumPartitions() > 1
    rows = {r.record_id[-2]: (r.page_id, r.record_type, r.payload_digest, r.payload and bytes(r.payload), r.target_uri) for r in got.collect()}
    assert rows == {"1": (None, "response", sha, b"one", "http://x/"),
                    "2": (None, "resource", hashlib.sha1(b"two").hexdigest(), b"two", "http://x/"),
                    "3": (None, "response", sha, b"3\r\none\r\n0\r\n\r\n", "http://x/"), "4": (None, "revisit", sha, None, "http://x/")}
    lost = pack("l.wacz", {"indexes/a.cdxj": lines(first, "z.warc.gz")}, {"archive/a.warc.gz": b"".join(first)})
    with pytest.raises(Exception, match="no stored member"):
        warc.read_archives(spark.createDataFrame([(lost,)], "archive string")).count()


def test_link_graph_verdicts(spark):
    link = '<a href="{}">'
    rows = [(1, "https://good.org/x", link.format("https://near.net/")), (2, "https://near.net/", ""),
            (3, "http://bad.example.org/es/1", ""), (4, "http://fan.net/", link.format("//BAD.example.org/es/1")),
            (5, "http://alone.net/?q#f", None), (6, None, "x"), (7, "no scheme", "x"), (8, "x://H.com/fr/a?b", ""), (8, "x://H.com/fr/a?b", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df).collect()}
    assert got == {1: ("good.org", "/x", "org/", "allow"), 2: ("near.net", "/", None, "allow"),
                   3: ("bad.example.org", "/es/1", "example.org/es/", "block"), 4: ("fan.net", "/", None, "block"),
                   5: ("alone.net", "/", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
                   8: ("h.com", "/fr/a", "com/fr/", "allow")}
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_distrust_counts_however_small_and_far(spark):
    """Hosts up to 24 links from a blocked page, their shares down to 1e-16, nothing that trusts them."""
    rows, last = [(0, "http://bad.example.org/es/1", "")], "bad.example.org"
    for i in range(1, 25):
        for side in range(4):  # all four link to the host of the level before
            rows.append((i * 10 + side, f"http://h{side}.l{i}.net/", f'<a href="http://{last}/es/1">'))
        last = f"h0.l{i}.net"
    rows.append((999, "http://alone.net/", '<a href="http://unseen.net/">'))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(df).collect()}
    assert got == {i: "allow" if i == 999 else "block" for i, _, _ in rows}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    out = corpus_pipeline.run(spark, TINY).collect()
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, TINY)
    assert kept.columns == docs.columns and 0 < len(out) <= docs.count()
    assert len({r.doc_id for r in out}) == len(out)
    assert all(r.n_chars == len(r.text) and (len(r.ids) > 0 or not r.text) for r in out)
