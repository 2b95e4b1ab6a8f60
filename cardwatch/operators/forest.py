"""Held-out scores of many forests, without their trees.

A search needs to know how a forest scores the rows it left out, not the forest. Rows are cut into bins
and packed once; the trees of all fits are dealt to some tasks, which get the rows once, grow one tree
after the other and keep nothing of it but what it adds to the scores of the held-out rows. These sums
meet per fit. Neither the driver nor a task ever holds a forest, whatever the number and depth of trees.

Trees are those of Spark's forest: weighted Gini gain over binned columns, columns drawn for each node,
counts of drawn rows bound the leaves, and cuts whose leaves predict the same class are dropped. The
draws are functions of (seed, tree), so a lost task redraws the same rows and columns.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardwatch.operators.boosting import BINS, Block

#: Trees dealt together, and tasks for each core.
CHUNK, TURNS = 5, 4
#: Rows of a table that each task may get once; with twenty columns their bins take some 20 MB.
MOST_ROWS = 1 << 20


@dataclass(frozen=True)
class ForestFit:
    """A forest's parameters and the fold that it leaves out; ``columns`` are drawn for each node."""

    trees: int
    depth: int
    least: int
    columns: int
    balanced: bool
    fold: int
    seed: int = 42


def columns_of_node(strategy: str, width: int) -> int:
    """How many columns a node may use, as Spark reads the strategy."""
    if strategy in ("all", "sqrt", "auto"):
        return width if strategy == "all" else math.ceil(math.sqrt(width))
    if strategy in ("log2", "onethird"):
        return max(1, math.ceil(math.log2(width))) if strategy == "log2" else math.ceil(width / 3)
    if "." not in strategy and float(strategy) >= 1:
        return min(int(strategy), width)
    return math.ceil(float(strategy) * width)


def _half_gini(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Half the Gini impurity times the weight of the rows."""
    total = n0 + n1
    return np.divide(n0 * n1, total, out=np.zeros_like(total), where=total > 0)


def tree_scores(bins: np.ndarray, y: np.ndarray, drawn: np.ndarray, out: np.ndarray, fit: ForestFit,
                weights: tuple[float, float], rng: np.random.Generator) -> np.ndarray:
    """Share of class 1 at the leaf that each row of ``out`` reaches in a tree grown on the drawn rows.

    ``bins`` are (column, row), ``drawn`` is how often a row was drawn. The tree grows level by level;
    rows to learn from and rows to score walk down together.
    """
    width, n = bins.shape
    flat, w = bins.reshape(-1), np.array(weights)
    rows, asked = np.flatnonzero(drawn), out
    slot, place = np.zeros(len(rows), np.int64), np.zeros(len(out), np.int64)
    numbers = np.zeros(1, np.int64)  # the open nodes
    counts = [np.bincount(y[rows], drawn[rows], 2)[None, :]]
    ended = np.zeros(len(out), np.int64)
    made, asked_at = 1, np.arange(len(out))
    links = []
    for level in range(fit.depth + 1):
        own = counts[-1] if level == 0 else np.concatenate(counts)[numbers]
        open_ = (own > 0).all(1) & (level < fit.depth)
        keep = np.flatnonzero(open_)
        renumber = np.full(len(numbers), -1)
        renumber[keep] = np.arange(len(keep))
        slot = renumber[slot]
        rows, slot = rows[slot >= 0], slot[slot >= 0]
        m = len(keep)
        if m:
            own = own[keep]
            parts = own * w
            whole = _half_gini(parts[:, 0], parts[:, 1])
            some = np.sort(np.argsort(rng.random((m, width)), 1)[:, :fit.columns], 1)
            best, feature, cut = np.zeros(m), np.full(m, -1), np.zeros(m, np.int64)
            left = np.zeros((m, 2))
            times, pair = drawn[rows], slot * (2 * BINS) + y[rows]
            for j in range(some.shape[1]):
                f = some[:, j]
                cells = np.bincount(pair + 2 * flat[f[slot] * n + rows].astype(np.int64), times, m * 2 * BINS).reshape(m, BINS, 2)
                below = np.cumsum(cells, 1)[:, :-1]
                above = own[:, None, :] - below
                gain = whole[:, None] - _half_gini(*np.moveaxis(below * w, 2, 0)) - _half_gini(*np.moveaxis(above * w, 2, 0))
                usable = (below.sum(2) >= fit.least) & (above.sum(2) >= fit.least) & (below.sum(2) > 0) & (above.sum(2) > 0)
                gain = np.where(usable, gain, -np.inf)
                at = gain.argmax(1)
                found = gain[np.arange(m), at]
                better = found > np.maximum(best, 1e-12 * whole)
                best[better], feature[better], cut[better] = found[better], f[better], at[better]
                left[better] = below[np.flatnonzero(better), at[better]]
            split = feature >= 0
        else:
            split = np.zeros(0, bool)
        child = np.full(len(numbers), -1)
        cutting = keep[split]
        child[cutting] = made + 2 * np.arange(len(cutting))
        links.append((numbers, child))
        here = child[place]
        ended[asked_at[here < 0]] = numbers[place[here < 0]]
        going = here >= 0
        asked_at, asked, place = asked_at[going], asked[going], place[going]
        if not len(cutting):
            break
        counts.append(np.stack([left[split], own[split] - left[split]], 1).reshape(-1, 2))
        numbers = made + np.arange(2 * len(cutting))
        made += 2 * len(cutting)
        node_f, node_cut = np.full(len(child), -1), np.zeros(len(child), np.int64)
        node_f[cutting], node_cut[cutting] = feature[split], cut[split]
        order = np.full(len(child), -1)
        order[cutting] = np.arange(len(cutting))
        old = keep[slot]
        staying = order[old] >= 0
        rows, old = rows[staying], old[staying]
        slot = 2 * order[old] + (flat[node_f[old] * n + rows] > node_cut[old])
        place = 2 * order[place] + (flat[node_f[place] * n + asked] > node_cut[place])
    counts = np.concatenate(counts)
    children = np.full(made, -1)  # the left child, which the right one follows
    parent = np.full(made, -1)
    for nodes, child in links:
        children[nodes] = child
        inner = child >= 0
        parent[child[inner]] = parent[child[inner] + 1] = nodes[inner]
    share = _pruned(counts * w, children, parent)
    return share[ended]


def _pruned(parts: np.ndarray, children: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Share of class 1 for rows that end at a node, where cuts whose leaves predict the same are dropped."""
    predicted = parts[:, 1] > parts[:, 0]
    leaf = children < 0
    for node in np.flatnonzero(~leaf)[::-1].tolist():  # children have larger numbers than their parents
        a = children[node]
        leaf[node] = leaf[a] and leaf[a + 1] and predicted[a] == predicted[a + 1]
    total = parts.sum(1)
    share = np.divide(parts[:, 1], total, out=np.zeros(len(total)), where=total > 0)
    for node in range(1, len(share)):
        if leaf[parent[node]]:
            share[node] = share[parent[node]]
    return share


def _dealt(fits: list[ForestFit], tasks: int) -> list[list[tuple[int, int, int]]]:
    """(fit, first tree, end) for each task: the dearest go first, each to the task that has least."""
    chunks = [(f.columns * min(f.depth, 20) * (min(a + CHUNK, f.trees) - a), i, a, min(a + CHUNK, f.trees))
              for i, f in enumerate(fits) for a in range(0, f.trees, CHUNK)]
    out, load = [[] for _ in range(min(tasks, len(chunks)))], np.zeros(min(tasks, len(chunks)))
    for cost, *chunk in sorted(chunks, reverse=True):
        least = int(load.argmin())
        out[least].append(tuple(chunk))
        load[least] += cost
    return out


def held_out_counts(blocks: DataFrame, fits: list[ForestFit], width: int) -> list[list[int]]:
    """tn, fp, fn, tp of every fit on the rows of its fold. ``blocks`` are those of ``boosting.packed``."""
    spark = blocks.sparkSession
    work = _dealt(fits, TURNS * spark.sparkContext.defaultParallelism)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["task"], []).append(Block(row, width))
        for task, own in held.items():
            ids, y, fold = (np.concatenate([getattr(b, n) for b in own]) for n in ("ids", "y", "fold"))
            bins = np.concatenate([b.bins() for b in own], 1)
            order = np.lexsort((*bins, y, fold, ids))  # whatever order the blocks came in
            y, fold, bins = y[order].astype(np.int64), fold[order], np.ascontiguousarray(bins[:, order])
            sizes = np.bincount(y, minlength=2)
            balance = tuple(len(y) / (2 * s) if s else 1.0 for s in sizes)
            sums: dict[int, np.ndarray] = {}
            for number, first, end in work[task]:
                fit = fits[number]
                kept, out = np.flatnonzero(fold != fit.fold), np.flatnonzero(fold == fit.fold)
                total = sums.setdefault(number, np.zeros(len(out)))
                for tree in range(first, end):
                    rng = np.random.default_rng([fit.seed, tree])
                    drawn = np.zeros(len(y))
                    drawn[kept] = np.bincount(rng.integers(0, len(kept), len(kept)), minlength=len(kept))
                    total += tree_scores(bins, y, drawn, out, fit, balance if fit.balanced else (1.0, 1.0), rng)
            for number, total in sums.items():
                out = y[fold == fits[number].fold].astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([task], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([out.tobytes()], pa.binary())],
                    names=["fit", "task", "sums", "labels"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                totals.setdefault(row["fit"], []).append((row["task"], row["sums"], row["labels"]))
        for fit, parts in totals.items():
            parts.sort(key=lambda p: p[0])  # sums in one order, so that reruns agree
            score = np.sum([np.frombuffer(s, np.float64) for _, s, _ in parts], axis=0) / fits[fit].trees
            y = np.frombuffer(parts[0][2], np.uint8)
            cells = np.bincount(2 * y.astype(np.int64) + (score > 0.5), minlength=4)
            yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([cells.tolist()], pa.list_(pa.int64()))],
                                             names=["fit", "counts"])

    rows = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(len(work) - 1)))).repartitionById(len(work), "task")
    scores = rows.mapInArrow(grown, "fit int, task int, sums binary, labels binary")
    found = scores.repartition(min(len(fits), 64), "fit").mapInArrow(counted, "fit int, counts array<bigint>")
    by_fit = {r["fit"]: r["counts"] for r in found.toArrow().to_pylist()}  # one row a fit
    return [by_fit[i] for i in range(len(fits))]
