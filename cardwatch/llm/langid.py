"""Language identification by error-correcting output codes.

Every language owns a codeword; a binary linear classifier over byte trigrams predicts each bit of
it. Decoding sums, over the bits, the loss a codeword would have to take, weighted by how reliable
the bit's classifier was on rows it was not fitted on, and picks the codeword of smallest loss. Two
codewords of nearly the same loss make a prediction ambiguous.
"""
from __future__ import annotations

import re
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import LOWER, joined, slices, table, text_bytes

#: Trigram buckets; labelled rows fitted on, in expectation, per language and at most over all.
BUCKETS, PER_LANGUAGE, ALL_ROWS = 1 << 14, 500, 8000
#: Least distance of the two smallest losses, as a share of the weights' sum, that is clear.
CLEAR = 0.02
UNKNOWN = "und"

#: Letters (any non-ASCII byte counts) stay, every other byte is a gap.
LETTERS = np.zeros(256, np.uint8)
LETTERS[97:123], LETTERS[128:] = np.arange(97, 123), np.arange(128, 256)
LETTERS = LETTERS[LOWER]


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray    # languages x bits, +1 or -1
    weights: np.ndarray  # bits x buckets
    bias: np.ndarray     # bits
    trust: np.ndarray    # weight of each bit in decoding, sums to 1


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at every byte (0: no letter at its middle), and the texts' offsets."""
    data, offsets = joined([t + b"  " for t in texts])
    x = LETTERS[data].astype(np.uint32)
    code = np.zeros(len(x), np.uint32)
    code[1:-1] = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 14)
    bucket[x == 0] = 0
    return bucket.astype(np.intp), offsets


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n codewords of +1 and -1: every split for up to 7 languages, else the best of random ones."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, float).T
    draw, best, bits = np.random.default_rng(seed), None, int(np.ceil(10 * np.log2(n)))
    for _ in range(50):
        code = draw.choice([-1.0, 1.0], (n, bits))
        far = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if best is None or far > best[0]:
            best = far, code
    return best[1]


def _fit_bits(x: np.ndarray, signs: np.ndarray, steps: int = 200, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of every bit at once by Adam on the full sample."""
    w, b = np.zeros((x.shape[1], signs.shape[1]), np.float32), np.zeros(signs.shape[1], np.float32)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for t in range(1, steps + 1):
        pull = -signs / (1 + np.exp(np.clip(signs * (x @ w + b), -30, 30))) / len(x)
        for p, g, m, v in ((w, x.T @ pull + decay * w, *moments[:2]), (b, pull.sum(0), *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w, b


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          per_language: int = PER_LANGUAGE, all_rows: int = ALL_ROWS) -> Model:
    """Fit on a sample of the labelled rows: about ``per_language`` of each language, about
    ``all_rows`` in all (the documented bound). Rows without text or language take no part; rows of
    the same key, text and language count as one, other rows of a key are drawn on their own."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("draw", F.xxhash64("key", "text", F.lit("langid")))
    counts = {r["lang"]: max(1, r["n"]) for r in rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).collect()}
    languages = sorted(counts)
    codes = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, codes, np.zeros((0, BUCKETS)), np.zeros(0), np.zeros(0))
    most = max(1, min(per_language, all_rows // len(languages)))
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, most / counts[k]))])
    drawn = F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                bucket, offsets = trigrams(text_bytes(part.column("text")))
                found = [np.unique(bucket[a:b], return_counts=True) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("key").cast(pa.string()), part.column("draw"),
                     pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                     pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))],
                    ["lang", "key", "draw", "bucket", "n"])

    # copies collapse before they are collected, however many there are
    sample = rows.filter(drawn < share[F.col("lang")]).dropDuplicates(["lang", "key", "text"]).mapInArrow(
        counted, "lang string, key string, draw long, bucket array<int>, n array<float>").toPandas()
    sample = sample.sort_values(["key", "lang", "draw"], ignore_index=True)
    x = np.zeros((len(sample), BUCKETS), np.float32)
    for i, (at, n) in enumerate(zip(sample["bucket"], sample["n"])):
        x[i, at] = n
    x[:, 0] = 0
    x /= np.maximum(x.sum(1, keepdims=True), 1)
    used = np.flatnonzero(x.any(0))
    x = x[:, used]
    scale = 1 / np.maximum(np.sqrt((x * x).mean(0)), 1e-4)
    x *= scale
    signs = codes[[languages.index(v) for v in sample["lang"]]].astype(np.float32)
    held = np.arange(len(x)) % 5 == 0
    w, b = _fit_bits(x[~held], signs[~held])
    right = ((x[held] @ w + b) * signs[held] > 0).mean(0)
    trust = np.log((right + 0.01) / (1.01 - right)).clip(0.05)
    w, b = _fit_bits(x, signs)
    weights = np.zeros((len(b), BUCKETS))
    weights[:, used] = (w * scale[:, None]).T
    return Model(languages, codes, weights, b, trust / trust.sum())


def losses(model: Model, texts: list[bytes]) -> np.ndarray:
    """Loss of every language's codeword for each text: texts x languages."""
    bucket, offsets = trigrams(texts)
    n = np.maximum(np.add.reduceat((bucket > 0).astype(np.float64), offsets[:-1]), 1)
    out = np.empty((len(texts), len(model.bias)))
    for k, (w, b) in enumerate(zip(model.weights.astype(np.float64), model.bias)):
        w = w.copy()
        w[0] = 0
        out[:, k] = np.add.reduceat(w[bucket], offsets[:-1]) / n + b
    margins = out[:, None, :] * model.codes[None, :, :]
    return (np.logaddexp(0, -margins) * model.trust).sum(2)


def has_letter(text: str) -> bool:
    """A letter as Unicode has it: numbers such as one half, and signs, are none."""
    return any(found.group().isalpha() for found in _LETTER.finditer(text))


_LETTER = re.compile(r"[^\W\d_]")


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and lang_pred, score, second, ambiguous, from the whole text alone.

    ``und`` with score 0 (and not ambiguous) where the text is null or has no letter, or no
    language was learned. Ties go to the first language in sorted order.
    """
    n = len(keep)
    place = keep.index(text) if text in keep else n
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bits x BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, place):
                texts = part.column(place).to_pylist()
                known = [i for i, t in enumerate(texts) if t and m.languages and has_letter(t)]
                best, second = np.full(len(texts), -1), np.full(len(texts), -1)
                score, close = np.zeros(len(texts)), np.zeros(len(texts), bool)
                if known:
                    loss = losses(m, [texts[i].encode() for i in known])
                    order = np.argsort(loss, 1, kind="stable")
                    low = np.take_along_axis(loss, order, 1)
                    best[known] = order[:, 0]
                    bits = max(1, m.codes.shape[1])
                    score[known] = 1 / np.exp((low[:, :1] - low) * bits).sum(1)
                    if len(m.languages) > 1:
                        second[known] = order[:, 1]
                        close[known] = low[:, 1] - low[:, 0] < CLEAR
                name = [*m.languages, None]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array([name[i] if i >= 0 else UNKNOWN for i in best], pa.string()),
                     pa.array(score), pa.array([name[i] for i in second], pa.string()), pa.array(close)],
                    names=[*part.schema.names[:n], "lang_pred", "score", "second", "ambiguous"])

    rows = docs.select(*keep) if place < n else docs.select(*keep, F.col(text).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(run, f"{kept}, lang_pred string, score double, second string, ambiguous boolean")


def held_out(key: Column) -> Column:
    """True for the rows the model must not learn from."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def op5_language_codes(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return (predict(docs, model, ["doc_id"])
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                    "second", "ambiguous"))
