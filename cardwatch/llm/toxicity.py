"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic rows are taken as labelled. Everything else is unlabelled text, a mixture of
both classes whose share of toxic rows is the class prior. The risk of calling toxic text clean is
measured on the positives, the risk of calling clean text toxic is the unlabelled risk less the
positives' part of it, held at zero or above so that a flexible model cannot drive it negative.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import ALNUM, LOWER, csr_rows, joined, slices, span_hashes, table, text_bytes, word_spans
from cardwatch.session import saved

#: Rows fitted on, in expectation: confirmed toxic and unlabelled (the documented bound); confirmed
#: rows a feature must occur in; bytes of the word beginnings that are features beside whole words.
POSITIVE_ROWS, UNLABELLED_ROWS, LEAST_ROWS, BEGINNINGS = 2000, 8000, 5, (4, 5, 6)
#: Standard errors by which a feature must be commoner among confirmed rows to be used.
LEAST_Z = 5.0
_BITS = 22


@dataclass
class Model:
    """Sorted 64-bit feature hashes, their weights, the bias and the class prior."""

    vocabulary: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.vocabulary >> np.uint64(64 - _BITS)).astype(np.intp)] = True


def features(texts: list[bytes], model: Model | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, behind each other, and their numbers.

    Features are words and beginnings of words, as 64-bit hashes; with a model, as places in its
    vocabulary, others left out.
    """
    data, offsets = joined(texts)
    data = LOWER[data]
    starts, ends, n = word_spans(data, offsets, ALNUM)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), n)
    kinds = [(starts, ends, row)]
    for size in BEGINNINGS:
        longer = ends - starts > size
        kinds.append((starts[longer], starts[longer] + size, row[longer]))
    hashes = span_hashes(data, np.concatenate([k[0] for k in kinds]), np.concatenate([k[1] for k in kinds]))
    hashes ^= np.repeat(np.arange(len(kinds), dtype=np.uint64), [len(k[0]) for k in kinds])
    row = np.concatenate([k[2] for k in kinds])
    if model is not None:
        some = model.maybe[(hashes >> np.uint64(64 - _BITS)).astype(np.intp)]
        hashes, row = hashes[some], row[some]
        at = np.searchsorted(model.vocabulary, hashes)
        found = at < len(model.vocabulary)
        found[found] = model.vocabulary[at[found]] == hashes[found]
        own = np.unique(row[found] * max(1, len(model.vocabulary)) + at[found])
        row, value = np.divmod(own, max(1, len(model.vocabulary)))
        return value, np.bincount(row, minlength=len(texts))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[first], np.bincount(row[first], minlength=len(texts))


def margins(weights: np.ndarray, bias: float, feature: np.ndarray, n: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weights[feature], dtype=np.float64)])
    ends = np.cumsum(n)
    return sums[ends] - sums[ends - n] + bias


def telling(feature: np.ndarray, on_positive: np.ndarray, positive: np.ndarray, size: int) -> np.ndarray:
    """Features more frequent among confirmed rows than in the mixture by LEAST_Z standard errors."""
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    c_p = np.bincount(feature[on_positive], minlength=size)
    c_u = np.bincount(feature[~on_positive], minlength=size)
    share = (c_p + c_u) / (n_p + n_u)
    error = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u)) + 1e-9
    return (c_p / n_p - c_u / n_u) / error > LEAST_Z


def fit(feature: np.ndarray, n: np.ndarray, positive: np.ndarray, size: int, prior: float, epochs: int = 40,
        rate: float = 0.02, decay: float = 2e-4, seed: int = 10) -> tuple[np.ndarray, float]:
    """Minimise the non-negative risk by Adam over blocks drawn from both kinds of rows."""
    draw, starts = np.random.default_rng(seed), np.cumsum(n) - n
    w, b, m, v, mb, vb, t = np.zeros(size), np.log(prior / (1 - prior)), np.zeros(size), np.zeros(size), 0.0, 0.0, 0
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    blocks = max(1, len(unl) // 500)
    for _ in range(epochs):
        for p, u in zip(np.array_split(draw.permutation(pos), blocks), np.array_split(draw.permutation(unl), blocks)):
            p = p if len(p) else pos
            rows = np.concatenate([p, u])
            own = feature[csr_rows(starts[rows], n[rows])]
            s = 1 / (1 + np.exp(-np.clip(margins(w, b, own, n[rows]), -30, 30)))
            sp, su = s[: len(p)], s[len(p):]
            # risks with the logistic loss: of "clean" on toxic rows, of "toxic" on clean rows
            clean_risk = -np.log1p(-su + 1e-12).mean() + prior * np.log1p(-sp + 1e-12).mean()
            if clean_risk >= 0:
                pull = np.concatenate([(prior * (sp - 1) - prior * sp) / len(p), su / len(u)])
            else:  # step back on the part that has become negative
                pull = np.concatenate([prior * sp / len(p), -su / len(u)])
            g = np.bincount(own, np.repeat(pull, n[rows]), size) + decay * w
            t += 1
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            gb = pull.sum()
            mb += 0.1 * (gb - mb)
            vb += 0.001 * (gb * gb - vb)
            b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Model:
    """Fit on about ``positive_rows`` confirmed toxic rows and ``unlabelled_rows`` of all other rows
    (the documented bound). Rows that share an id count as one, with the least of their texts. The
    class prior is the toxic share of the labelled rows."""
    marked = (labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
              .filter("_key IS NOT NULL AND _label IS NOT NULL")
              .groupBy("_key").agg(F.max("_label").alias("_label")))
    toxic, known = marked.agg(F.sum((F.col("_label") == 1).cast("long")), F.count("*")).first()
    nothing = np.zeros(0, np.uint64), np.zeros(0)
    if not toxic:
        return Model(*nothing, -30.0, 0.0)
    prior = min(0.5, toxic / known)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter("_key IS NOT NULL")
    drawn = F.pmod(F.xxhash64(F.col("_key"), F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    share = min(1.0, unlabelled_rows / max(1, rows.count()))
    sure = marked.filter((F.col("_label") == 1) & (drawn < min(1.0, positive_rows / toxic))).select("_key", F.lit(True).alias("_sure"))
    # about positive_rows keys at most, so they are broadcast: texts outside the sample are not shuffled
    sample = rows.withColumn("_drawn", drawn < share).join(F.broadcast(sure), "_key", "left").filter("_sure OR _drawn")
    # one row an id, however many share it
    sample = saved(sample.groupBy(F.col("_key").cast("string").alias("_key")).agg(
        F.min("_text").alias("_text"), F.coalesce(F.max("_sure"), F.lit(False)).alias("_sure"), F.max("_drawn").alias("_drawn")), "sample")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays([pa.array(features(text_bytes(part.column("_text")))[0].view(np.int64))], ["hash"])

    words = (sample.filter("_sure").select("_text").mapInArrow(hashed, "hash long")
             .groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_ROWS).toPandas())
    vocabulary = np.sort(words["hash"].to_numpy(np.int64).view(np.uint64))
    empty = Model(vocabulary, np.zeros(len(vocabulary)), 0.0, prior)
    shared = docs.sparkSession.sparkContext.broadcast(empty)  # at most POSITIVE_ROWS / LEAST_ROWS texts' features

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                at, n = features(text_bytes(part.column("_text")), shared.value)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32),
                                                 pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("_sure"), part.column("_drawn"), lists],
                    ["key", "sure", "drawn", "feature"])

    got = sample.mapInArrow(counted, "key string, sure boolean, drawn boolean, feature array<int>").toPandas()
    got = got.sort_values(["key", "sure"], ignore_index=True)
    # a confirmed row is also part of the mixture if the draw took it
    both = [(x, True) for x in got["feature"][got["sure"]]] + [(x, False) for x in got["feature"][got["drawn"]]]
    if not got["sure"].any() or not got["drawn"].any():
        return Model(*nothing, -30.0, prior)
    positive = np.array([p for _, p in both])
    feature = np.concatenate([x for x, _ in both]).astype(np.int64)
    row = np.repeat(np.arange(len(both)), [len(x) for x, _ in both])
    kept = telling(feature, positive[row], positive, len(vocabulary))
    feature, row = (np.cumsum(kept) - 1)[feature[kept[feature]]], row[kept[feature]]
    w, b = fit(feature, np.bincount(row, minlength=len(both)), positive, int(kept.sum()), prior)
    return Model(vocabulary[kept], w, b, prior)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score of every row from its whole text; null and empty texts get the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded as the sample is

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                s = margins(m.weights, m.bias, *features(text_bytes(part.column(1)), m))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(1 / (1 + np.exp(-np.clip(s, -30, 30))))], [key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, score double")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def op10_toxicity_pu(spark, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = train(docs.filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
