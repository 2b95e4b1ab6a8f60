"""Exact k nearest neighbours without comparing all pairs.

1. Copies of a vector collapse to one row that keeps the k + 1 smallest ids: no point can need
   more of them, so a vector shared by a third of all rows stays one short row.
2. Space is cut into boxes of about ``leaf_size`` vectors. The cuts come from a bounded sample;
   they steer the load and never the result.
3. Each box finds the best neighbours inside itself. The distance of the (k + 1)-th is an upper
   bound, so a vector has to visit only the boxes that this ball touches.
4. Boxes are visited in rounds, nearest first, twice as many a round. The best found so far are saved
   after a round and shrink the ball, so that boxes farther off drop out unvisited.
5. A visit is one task-sized group: the vectors of one box against the callers from one box.

Squared distances are added column by column in the given order, so that equal inputs give
bit-equal distances everywhere and ties fall to the smaller id.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from cardwatch.session import checkpointed, discard, saved

LEAF_SIZE = 2048
MAX_LEAVES = 16384
SAMPLE_PER_LEAF = 8
#: Distances computed at once; a task holds a handful of arrays of this size.
CHUNK_CELLS = 500_000
#: Boxes a vector visits in the first round.
FIRST_VISITS = 4


@dataclass
class Boxes:
    """Axis-aligned cuts: inner nodes hold (dimension, value), leaves hold their number."""

    dimension: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def count(self) -> int:
        return len(self.low)

    def locate(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while True:
            open_rows = rows[self.leaf[node] < 0]
            if not len(open_rows):
                return self.leaf[node]
            at = node[open_rows]
            goes_left = x[open_rows, self.dimension[at]] < self.value[at]
            node[open_rows] = np.where(goes_left, self.left[at], self.right[at])

    def distance2(self, x: np.ndarray) -> np.ndarray:
        """Lower bound of the squared distance from each vector to each box."""
        total = np.zeros((len(x), self.count))
        for d in range(x.shape[1]):
            column = x[:, d:d + 1]
            gap = np.maximum(np.maximum(self.low[None, :, d] - column, column - self.high[None, :, d]), 0.0)
            total += gap * gap
        return total


def cut_boxes(sample: np.ndarray, leaves: int) -> Boxes:
    """Halve the sample at the median of its widest column until enough boxes exist."""
    width = sample.shape[1]
    nodes, lows, highs = [], [], []
    todo = [(sample, leaves, np.full(width, -np.inf), np.full(width, np.inf), None, None)]
    while todo:
        part, wanted, low, high, parent, side = todo.pop()
        number = len(nodes)
        if parent is not None:
            nodes[parent][side] = number
        cut = None
        if wanted > 1 and len(part) > 1:
            spread = part.max(axis=0) - part.min(axis=0)
            dimension = int(np.argmax(spread))
            ordered = np.unique(part[:, dimension])
            if len(ordered) > 1:
                middle = np.median(part[:, dimension])
                cut = ordered[max(1, np.searchsorted(ordered, middle))]
        if cut is None:
            nodes.append({"dimension": 0, "value": 0.0, "left": 0, "right": 0, "leaf": len(lows)})
            lows.append(low)
            highs.append(high)
            continue
        nodes.append({"dimension": dimension, "value": cut, "left": 0, "right": 0, "leaf": -1})
        below, above = high.copy(), low.copy()
        below[dimension] = cut
        above[dimension] = cut
        under = part[:, dimension] < cut
        todo.append((part[~under], wanted - wanted // 2, above, high, number, "right"))
        todo.append((part[under], wanted // 2, low, below, number, "left"))
    field = lambda name, kind: np.array([n[name] for n in nodes], dtype=kind)
    return Boxes(field("dimension", int), field("value", float), field("left", int),
                 field("right", int), field("leaf", int), np.array(lows), np.array(highs))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype("float64")


def _best(queries: np.ndarray, points: np.ndarray, ids: pd.Series, keep: int, radius=None):
    """Yield arrays (row, distance, id) of the ``keep`` nearest ids of each query vector, by row."""
    sizes = np.array([len(i) for i in ids])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate([np.asarray(i, dtype=np.int64) for i in ids])
    chunk = max(1, CHUNK_CELLS // max(1, len(points)))
    for begin in range(0, len(queries), chunk):
        block = queries[begin:begin + chunk]
        distance = np.zeros((len(block), len(points)))
        for d in range(block.shape[1]):
            gap = block[:, d:d + 1] - points[None, :, d]
            distance += gap * gap
        if len(points) > keep:
            limit = np.partition(distance, keep - 1, axis=1)[:, keep - 1]
        else:
            limit = np.full(len(block), np.inf)
        if radius is not None:
            limit = np.minimum(limit, radius[begin:begin + chunk])
        row, point = np.nonzero(distance <= limit[:, None])
        if not len(row):
            continue
        repeat = sizes[point]
        within = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        found = flat[np.repeat(starts[point], repeat) + within]
        row, far = np.repeat(row, repeat), np.repeat(distance[row, point], repeat)
        order = np.lexsort((found, far, row))
        row, far, found = row[order], far[order], found[order]
        nearest = np.arange(len(row)) - np.searchsorted(row, row) < keep
        yield begin + row[nearest], far[nearest], found[nearest]


def _next_boxes(shared, done: int, visits: int):
    """The boxes at places done, done + 1, ... in order of nearness that a vector's ball still touches."""
    def run(parts):
        cuts = shared.value
        chunk = max(1, CHUNK_CELLS // cuts.count)
        for part in parts:
            for begin in range(0, len(part), chunk):
                rows = part.iloc[begin:begin + chunk]
                far = cuts.distance2(_matrix(rows["x"]))
                far[np.arange(len(rows)), rows["leaf"].to_numpy()] = -1.0  # its own box is first, and done
                touched = far <= rows["radius"].to_numpy()[:, None]
                targets = []
                for distance, near in zip(far, touched):
                    found = np.flatnonzero(near)
                    found = found[np.argsort(distance[found], kind="stable")]
                    targets.append(found[1 + done:1 + done + visits].astype("int32"))
                yield pd.DataFrame({
                    "vid": rows["vid"], "x": rows["x"], "radius": rows["radius"], "source": rows["leaf"], "targets": targets})

    return run


def _visit_rounds(best: DataFrame, placed: DataFrame, shared, keep: int, visited: list[int]) -> DataFrame:
    """Take (vid, x, leaf, radius, best) to the best of all boxes.

    A ball only shrinks, so the boxes it touches keep their places in a vector's order, and each round
    takes up where the last one stopped. The state is saved every round; the one before is removed.
    """
    state, done, visits = saved(best, "nearest"), 0, FIRST_VISITS
    while True:
        asked = state.mapInPandas(
            _next_boxes(shared, done, visits),
            "vid bigint, x array<double>, radius double, source int, targets array<int>")
        calls = saved(asked.select("vid", "x", "radius", "source", F.explode("targets").alias("target")), "calls")
        visited.append(calls.count())
        if not visited[-1]:
            discard(calls)
            return state
        routes = calls.select(F.col("source").alias("caller"), F.col("target").alias("host")).distinct()
        hosts = placed.select("x", "ids", F.col("leaf").alias("host")).join(routes, "host")

        def visit(callers: pd.DataFrame, hosted: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(callers) and len(hosted):
                out = list(_best(_matrix(callers["x"]), _matrix(hosted["x"]), hosted["ids"],
                                 keep, callers["radius"].to_numpy()))
            if not out:
                return pd.DataFrame({"vid": [], "d": [], "i": []})
            row, d, ids = (np.concatenate(c) for c in zip(*out))
            return pd.DataFrame({"vid": callers["vid"].to_numpy()[row], "d": d, "i": ids})

        remote = (
            calls.groupBy("source", "target").cogroup(hosts.groupBy("caller", "host"))
            .applyInPandas(visit, "vid bigint, d double, i bigint")
        )
        nearest = F.row_number().over(Window.partitionBy("vid").orderBy("d", "i"))
        met = (remote.withColumn("_r", nearest).where(F.col("_r") <= keep)
               .groupBy("vid").agg(F.collect_list(F.struct("d", "i")).alias("met")))
        merged = F.slice(F.array_sort(F.concat("best", F.coalesce("met", F.array().cast(best.schema["best"].dataType)))), 1, keep)
        ball = F.when(F.size("best") == keep, F.element_at("best", keep)["d"]).otherwise(float("inf"))
        fresh = saved(
            state.join(met, "vid", "left").withColumn("best", merged).withColumn("radius", ball)
            .select(*best.columns), "nearest")
        discard(state)
        discard(calls)
        state, done, visits = fresh, done + visits, 2 * visits


def nearest_neighbours(
    df: DataFrame, key: str, columns: list[str], k: int = 5, leaf_size: int = LEAF_SIZE,
    visited: list[int] | None = None,
) -> DataFrame:
    """k nearest other rows of every row: (id, rank, neighbour_id, distance2).

    ``key`` is a unique whole number; the columns must be complete. Equal distances rank by
    neighbour id. ``visited`` receives the number of box visits of each round.
    """
    keep = k + 1  # a row finds itself among its neighbours
    # + 0.0 turns -0.0 into 0.0, so that copies compare equal
    points = df.select(
        F.col(key).cast("bigint").alias("id"),
        F.array(*[F.col(c).cast("double") + 0.0 for c in columns]).alias("x"),
    )
    smallest = Window.partitionBy("x").orderBy("id")
    vectors = checkpointed(
        points.withColumn("_r", F.row_number().over(smallest)).where(F.col("_r") <= keep)
        .groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("vid"), "x", "ids")
    )
    count = vectors.count()
    leaves = max(1, min(MAX_LEAVES, count // leaf_size))
    step = max(1, count // (leaves * SAMPLE_PER_LEAF))
    sample = (
        vectors.where(F.pmod(F.xxhash64("vid"), F.lit(step)) == 0).select("x")
        .limit(2 * MAX_LEAVES * SAMPLE_PER_LEAF).toPandas()["x"]
        if leaves > 1 else pd.Series([], dtype=object)
    )
    width = len(columns)
    boxes = cut_boxes(_matrix(sample) if len(sample) else np.zeros((0, width)), leaves)
    shared = df.sparkSession.sparkContext.broadcast(boxes)

    @F.pandas_udf("int")
    def box_of(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.locate(_matrix(x)).astype("int32"))

    placed = vectors.withColumn("leaf", box_of("x"))

    def inside(part: pd.DataFrame) -> pd.DataFrame:
        cuts, x = shared.value, _matrix(part["x"])
        own = int(part["leaf"].iloc[0])
        row, d, ids = (np.concatenate(c) for c in zip(*_best(x, x, part["ids"], keep)))
        last = np.cumsum(np.bincount(row, minlength=len(x)))  # a row finds itself at least
        radius = np.where(np.diff(last, prepend=0) == keep, d[last - 1], np.inf)
        far, found = np.split(d, last[:-1]), np.split(ids, last[:-1])
        best = [[{"d": a, "i": b} for a, b in zip(*pair)] for pair in zip(far, found)]
        return pd.DataFrame({"vid": part["vid"], "x": part["x"], "leaf": own, "radius": radius, "best": best})

    state_type = "vid bigint, x array<double>, leaf int, radius double, best array<struct<d: double, i: bigint>>"
    best = placed.groupBy("leaf").applyInPandas(inside, state_type)
    if boxes.count > 1:
        best = _visit_rounds(best, placed, shared, keep, [] if visited is None else visited)
    by_vector = vectors.select("vid", F.col("x").alias("_x")).join(best, "vid").select("_x", "best")
    others = F.slice(F.filter("best", lambda b: b["i"] != F.col("id")), 1, k)
    return (
        points.join(by_vector, F.col("x") == F.col("_x"))
        .select("id", F.posexplode(others).alias("pos", "b"))
        .select("id", (F.col("pos") + 1).alias("rank"), F.col("b.i").alias("neighbour_id"),
                F.col("b.d").alias("distance2"))
    )
