"""Nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. Each block of vectors holds an inverted
file: for every pivot, the vectors that have it among their nearest, with its place in their order.
A query visits the files of its own nearest pivots, adds up footrule agreement, and reranks the
best share of the block by true distance. Blocks are hashed, so each is a fair part of the whole,
and the best of all blocks is a small merge.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardwatch.llm.common import csr_rows, table
from cardwatch.session import saved

NEAREST = 10
#: Pivots, vectors they are chosen from (the bounded sample the index is fitted on), length of an order.
PIVOTS, SAMPLE, ORDER = 256, 2048, 64
#: Share of a block that is reranked, and the least number of its vectors.
SHARE, LEAST = 0.15, 200
#: Vectors of a block; queries that meet a block at a time.
BLOCK, QUERIES = 4096, 4096


def usable(embedding: Column) -> Column:
    """No null, zero or non-finite vector."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~bad & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def spread_out(x: np.ndarray, n: int) -> np.ndarray:
    """n rows, each the farthest from those before it, so that a dense group does not take them all."""
    chosen, far = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def orders(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first; ties to the smaller number."""
    far = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
    return np.argsort(far, 1, kind="stable")[:, :length]


class InvertedFiles:
    """Per pivot, the rows that list it and its place in their order."""

    def __init__(self, order: np.ndarray, pivots: int):
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.rows, self.places = np.divmod(by_pivot, order.shape[1])
        self.starts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
        self.n, self.length = len(order), order.shape[1]

    def agreement(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row to a query, as the part that differs: larger is nearer.

        With absent pivots at place ``length``, the distance is a constant less twice the sum, over
        shared pivots, of length - max(place here, place there).
        """
        lengths = self.starts[order + 1] - self.starts[order]
        at = csr_rows(self.starts[order], lengths)
        worse = np.maximum(self.places[at], np.repeat(np.arange(len(order)), lengths))
        return np.bincount(self.rows[at], self.length - worse, self.n)


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding",
           pivots: int = PIVOTS, order: int = ORDER, share: float = SHARE, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, never the query itself.

    Null, zero and non-finite vectors take no part, nor vectors whose length is not the commonest
    (the longest of equally common ones). Equal vectors keep their k + 1 smallest ids, which hold
    every possible answer. Rows without an id take no part; a query id that repeats is one query
    per distinct vector. An empty side gives an empty result.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v")).filter(
            F.col("id").isNotNull() & usable(F.col("v")))

    rows, asked = clean(vectors), clean(queries).distinct()
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if size is None:
        return spark.createDataFrame([], schema)
    same = F.size("v") == size["d"]
    copies = Window.partitionBy("v").orderBy("id")
    rows = rows.filter(same).withColumn("_c", F.row_number().over(copies)).filter(F.col("_c") <= k + 1).drop("_c")
    rows = saved(rows, "vectors")
    drawn = rows.select("v").groupBy("v").agg(F.xxhash64(F.col("v")).alias("h")).orderBy("h", "v").limit(max(SAMPLE, pivots)).collect()
    centre = spread_out(np.array([r["v"] for r in drawn]), pivots)
    n = rows.count()
    length = min(order, len(centre))
    blocks = max(1, -(-n // block))
    shared = spark.sparkContext.broadcast(centre)  # at most ``pivots`` vectors

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = orders(_matrix(batch.column(1)), shared.value, length).astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * length, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "o"])

    kind = "id long, v array<double>, o array<int>"
    index = rows.mapInArrow(ordered, kind).withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asked = saved(asked.filter(same).mapInArrow(ordered, kind), "queries")
    groups = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    index = index.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(own: pa.Table, others: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not own.num_rows or not others.num_rows:
            return empty
        ids, x = own.column("id").to_numpy(), _matrix(own.column("v").combine_chunks())
        files = InvertedFiles(_order(own), len(shared.value))
        take, found = max(least, int(np.ceil(share * len(ids)))), []
        for query, v, o in zip(others.column("id").to_numpy(), _matrix(others.column("v").combine_chunks()), _order(others)):
            near = np.arange(len(ids))
            if take < len(ids):
                agreed = files.agreement(o)
                near = np.flatnonzero(agreed >= np.partition(agreed, -take)[-take])  # and all that tie
            near = near[ids[near] != query]
            score = np.sqrt(((x[near] - v) ** 2).sum(1))
            best = np.lexsort((ids[near], score))[:k]
            found.append((np.full(len(best), query), ids[near][best], score[best]))
        return pa.table({n: pa.array(np.concatenate(c)) for n, c in zip(empty.schema.names, zip(*found))}).cast(empty.schema)

    near = index.groupBy("b", "g").cogroup(asked.groupBy("b", "g")).applyInArrow(
        meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _order(rows: pa.Table) -> np.ndarray:
    return rows.column("o").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)


def op2_permutation_index(spark, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
