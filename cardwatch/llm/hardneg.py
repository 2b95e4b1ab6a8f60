"""Hard negatives by Four-Russians scoring.

Vectors are whole numbers. A candidate is cut into bit planes, eight dimensions of a plane make one
byte; an anchor has, for every eight dimensions, a table of the sums of all 256 subsets of its
values. The inner product is then a walk from the top plane down: double the sum, add the tables'
entries at the plane's bytes. Nothing is rounded or pruned, every score is exact.

Candidates are packed where they are read, one row per block. Blocks and groups of anchors of
bounded size meet in pairs (a stated query set against all rows); a pair gives its best rows only,
and the best of all pairs is a small merge. The first meeting finds each anchor's positives, the
second its negatives between the bounds that the positives set.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import table
from cardwatch.session import saved

#: Fixed values of the query contract: scale, positives, negatives, bounds in per cent of the positive's score.
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
#: Rows of a packed block, blocks that meet a group of anchors at a time, anchors of a group.
BLOCK, MEETING, ANCHORS = 2048, 2, 8192
#: Anchors whose tables are held together; scores have to stay below the limit.
TOGETHER, LIMIT = 64, 1 << 55


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component x; null for a vector with a null or non-finite one."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(x.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(v * float(scale))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


def bit_planes(x: np.ndarray) -> np.ndarray:
    """(plane, eight dimensions, row) bytes of two's complement rows, lowest plane first."""
    top = int(max(x.max(initial=0), -1 - x.min(initial=0))).bit_length() + 1
    return np.stack([np.packbits((x >> p & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(top)])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(eight dimensions, subset, anchor): the sum of an anchor's values over every subset."""
    by_eight = anchors.T.reshape(-1, 8, len(anchors))
    sums = np.zeros((len(by_eight), 256, len(anchors)), anchors.dtype)
    for j in range(8):
        sums[:, 1 << j:2 << j] = sums[:, :1 << j] + by_eight[:, None, j]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(row, anchor) inner products: the top plane counts negative, then double and add."""
    total = np.zeros((planes.shape[2], sums.shape[2]), sums.dtype)
    for number, plane in enumerate(planes[::-1]):
        total *= 2
        for at, entries in zip(plane, sums):
            if number:
                total += entries[at]
            else:
                total -= entries[at]
    return total


def pack(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, label, x) to one row per block: n, eights, top, reach, and ids, labels, planes as bytes."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def whole_block(batch: pa.Table) -> pa.RecordBatch:
            ids = batch.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            width = int(max(batch.column("x").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(), 1))
            x = matrix(batch.column("x"), -(-width // 8) * 8)[order]
            planes = bit_planes(x)
            cells = [[len(ids)], [planes.shape[1]], [planes.shape[0]], [int(np.abs(x).max(initial=0))],
                     [ids[order].tobytes()], [batch.column("label").to_numpy()[order].tobytes()], [planes.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, PACKED_TYPES)], names=PACKED_NAMES)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= block:
                all_rows = pa.Table.from_batches(held)
                yield whole_block(all_rows.slice(0, block))
                held = all_rows.slice(block).to_batches()
                n -= block
        if n:
            yield whole_block(pa.Table.from_batches(held))

    return rows.mapInArrow(packed, "n int, eights int, top int, reach long, ids binary, labels binary, planes binary")


PACKED_NAMES = ["n", "eights", "top", "reach", "ids", "labels", "planes"]
PACKED_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _blocks(packed: pa.Table, anchors: np.ndarray, own_label: np.ndarray | None = None) -> Iterator[tuple]:
    """Score blocks: ids and labels of rows, numbers of anchors, (row, anchor) scores.

    With the anchors' labels, an anchor is scored with the rows of its label only.
    """
    wide = -(-anchors.shape[1] // 8) * 8
    for row in packed.select(PACKED_NAMES).to_pylist():
        eights = max(row["eights"], wide // 8)
        own = np.zeros((len(anchors), eights * 8), np.int64)
        own[:, :anchors.shape[1]] = anchors
        reach = eights * 8 * (row["reach"] + 1) * int(np.abs(own).max(initial=0))
        if reach >= LIMIT:
            raise ValueError(f"inner products may reach {reach}; scale the vectors to stay below {LIMIT}")
        planes = np.frombuffer(row["planes"], np.uint8).reshape(row["top"], row["eights"], row["n"])
        if reach < 1 << 29:  # the same numbers in half the memory
            own = own.astype(np.int32)
        ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        parts = [(np.arange(len(own)), np.arange(len(ids)))]
        if own_label is not None:
            parts = [(np.flatnonzero(own_label == v), np.flatnonzero(labels == v)) for v in np.unique(own_label)]
        for which, rows in parts:
            cut = np.ascontiguousarray(planes[:, :, rows]) if len(rows) < len(ids) else planes
            for start in range(0, len(which) if len(rows) else 0, TOGETHER):
                at = which[start:start + TOGETHER]
                yield ids[rows], labels[rows], at, scores(cut, subset_sums(own[at])[:row["eights"]])


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, block: int = BLOCK, meeting: int = MEETING, group: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables have id (long), label (long) and x (array of whole numbers, see ``whole``); rows with
    a null in one of them take no part. Shorter vectors count as filled up with zeros. An anchor's
    positives are its best ``positives`` other rows of its label; a positive's negatives are the best
    ``negatives`` rows of other labels whose score is within ``low`` to ``high`` per cent of the
    positive's. Higher scores first, ties by smaller id. Rows with the anchor's own id are never its
    partners; repeated rows count as often as they stand, repeated anchors once. Empty tables give
    an empty result. Scores beyond 55 bits raise an error.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select("id", "label", "x").dropna()

    packed = saved(pack(clean(vectors), block), "packed")
    asked = saved(clean(anchors).distinct().withColumn("key", F.xxhash64("id", "label", "x")), "anchors")
    sizes = packed.agg(F.count("*").alias("blocks")).crossJoin(asked.agg(F.count("*").alias("anchors"))).first()
    slots, groups = max(1, -(-sizes["blocks"] // meeting)), max(1, -(-sizes["anchors"] // group))

    def meetings(asked: DataFrame, best, schema: str) -> DataFrame:
        left = (packed.withColumn("slot", F.pmod(F.xxhash64("ids", "planes"), F.lit(slots)))
                .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
        right = (asked.withColumn("group", F.pmod("key", F.lit(groups)).cast("int"))
                 .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long")))))
        tasks = min(slots * groups, 4096)
        left, right = left.repartition(tasks, "slot", "group"), right.repartition(tasks, "slot", "group")
        return left.groupBy("slot", "group").cogroup(right.groupBy("slot", "group")).applyInArrow(best, schema)

    ranked = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "id")
    first = meetings(asked, _best_positives(positives), "anchor_id long, key long, id long, score long")
    pairs = first.withColumn("p", F.row_number().over(ranked)).filter(F.col("p") <= positives)
    wanted = pairs.groupBy("anchor_id", "key").agg(F.collect_list(F.struct("p", "id", "score")).alias("pairs"))  # few an anchor
    wanted = asked.join(wanted, (F.col("id") == F.col("anchor_id")) & (asked["key"] == wanted["key"])).select(
        "id", "label", "x", asked["key"], "pairs.p", F.col("pairs.id").alias("positive"), F.col("pairs.score").alias("score"))
    keys = ["anchor_id", "key", "p", "positive_id", "positive_score"]
    found = meetings(saved(wanted, "wanted"), _best_negatives(negatives, low, high),
                     "anchor_id long, key long, p int, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _anchor_matrix(asked: pa.Table) -> np.ndarray:
    widest = asked.column("x").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()
    return matrix(asked.column("x"), int(max(widest, 1)))


def _table(columns: list[list[np.ndarray]], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.table({n: pa.array(c).cast(k) for n, k, c in zip(names, kinds, joined)})


def _best_positives(keep: int):
    names, kinds = ["anchor_id", "key", "id", "score"], [pa.int64()] * 4

    def best(packed: pa.Table, asked: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if packed.num_rows and asked.num_rows:
            own, label, key = (asked.column(c).to_numpy() for c in ("id", "label", "key"))
            for ids, _, which, score in _blocks(packed, _anchor_matrix(asked), label):
                for a, at in enumerate(which):
                    rows = np.flatnonzero(ids != own[at])
                    rows = rows[np.argsort(-score[rows, a], kind="stable")][:keep]  # ids ascend within a block
                    for column, values in zip(out, (np.full(len(rows), own[at]), np.full(len(rows), key[at]),
                                                    ids[rows], score[rows, a].astype(np.int64))):
                        column.append(values)
        return _table(out, names, kinds)

    return best


def _best_negatives(keep: int, low: int, high: int):
    names = ["anchor_id", "key", "p", "positive_id", "positive_score", "negative_id", "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]

    def best(packed: pa.Table, asked: pa.Table) -> pa.Table:
        out = [[] for _ in names]
        if packed.num_rows and asked.num_rows:
            own, label, key = (asked.column(c).to_numpy() for c in ("id", "label", "key"))
            pairs = [asked.column(c).to_pylist() for c in ("p", "positive", "score")]
            for ids, labels, which, score in _blocks(packed, _anchor_matrix(asked)):
                for a, at in enumerate(which):
                    bounds = [(-(-low * s // 100), high * s // 100) for s in pairs[2][at]]
                    column = score[:, a].astype(np.int64)
                    inside = (column >= min(b[0] for b in bounds)) & (column <= max(b[1] for b in bounds))
                    rows = np.flatnonzero(inside & (labels != label[at]) & (ids != own[at]))
                    if not len(rows):
                        continue
                    rows = rows[np.argsort(-column[rows], kind="stable")]
                    falling = -column[rows]
                    for p, positive, s, (least, most) in zip(*(c[at] for c in pairs), bounds):
                        begin, end = np.searchsorted(falling, -most), np.searchsorted(falling, -least, "right")
                        taken = rows[begin:max(begin, min(end, begin + keep))]
                        for cells, value in zip(out, (own[at], key[at], p, positive, s)):
                            cells.append(np.full(len(taken), value))
                        out[5].append(ids[taken])
                        out[6].append(column[taken])
        return _table(out, names, kinds)

    return best


def op12_hard_negatives(spark, folder: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        whole(F.col("embedding")).alias("x"))
    return mine(rows, rows.filter(F.col("id") % 100 == 0))


SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r AS a JOIN r AS b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, other_id AS negative_id,
    positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER best <= 10"""
