"""Boosted trees with second-order leaf values, many fits side by side.

A fit is a set of parameters and a fold that it leaves out. Rows are cut into bins once and packed into
blocks; one pass over the blocks serves a level of the current tree of every fit: each task adds up the
gradients and hessians per (fit, node, feature, bin), the sums of all tasks meet per (fit, node), and the
node's best cut, leaf value and cover come back to the driver, which holds trees and nothing that
grows with the rows. Rows of a node small enough for one task meet there and its subtree comes back whole. A search of many points and folds thus needs as many passes as its largest fit.
A table of few rows needs no passes: each fit is a task that gets the rows once and grows all its trees.
Columns whose bins occur together in few ways, as those derived from one another do, share a code, so that
sums are taken over a handful of codes a row and dealt to the columns' bins afterwards.

Gain of a cut: T(GL)^2 / (HL + L2) + T(GR)^2 / (HR + L2) - T(G)^2 / (H + L2), where T takes L1 off the sum of
gradients; leaf value: -rate * T(G) / (H + L2). Rows and columns of a tree are drawn from (id, tree) and
(tree), so a lost task redraws the same ones. Missing values go to the side that gains more.
"""
from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardwatch.schema import LABEL
from cardwatch.session import discard, saved

#: Bins of a feature, the last one for missing values; rows of a block; codes that columns share at most.
BINS, BLOCK, CODES = 64, 1 << 16, 256
#: A table of at most so many rows has blocks of FEW rows, a code a column, and gradients that are not rounded.
PLAIN, FEW = 1 << 18, 4096
#: Rows from which looking for columns that share a code is worth its time.
SHARED = 1 << 15
#: Trees a fit may be ahead of the saved margins, and bytes of sums that a task holds in a pass.
AHEAD, SUMS = 4, 1 << 28
#: Rows of a node that is finished by one task: they are sent there once, where they take some 10 MB.
SMALL = 1 << 18
#: A table of at most so many times these rows goes whole to the task of a fit, where it takes some 100 MB.
TABLE = 4
#: Fits grown whole by a job, for each core; their scores are told after it.
TURNS = 4
#: A cut has to gain more than this.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Params:
    """Parameters of a fit; ``scale_pos_weight`` None stands for negatives / positives of all rows."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    scale_pos_weight: float | None = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in the order they were opened; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float = 0.0, cover: float = 0.0) -> int:
        for name, cell in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", -1), ("right", -1),
                           ("value", value), ("cover", cover), ("gain", 0.0)):
            getattr(self, name).append(cell)
        return len(self.feature) - 1

    def put(self, node: int, sub: Tree) -> None:
        """Let a leaf become the root of a subtree."""
        place = [node, *(self.add() for _ in sub.feature[1:])]
        for i, at in enumerate(place):
            for name in ("feature", "cut", "missing_left", "value", "cover", "gain"):
                getattr(self, name)[at] = getattr(sub, name)[i]
            for name in ("left", "right"):
                child = getattr(sub, name)[i]
                getattr(self, name)[at] = place[child] if child >= 0 else -1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(getattr(self, n)) for n in ("feature", "cut", "missing_left", "left", "right", "value"))


class Fit:
    """The state of one fit on the driver: finished trees, and the open nodes of the current one."""

    def __init__(self, params: Params, fold: int | None = None, stages: tuple[int, ...] = ()):
        self.params, self.fold = params, fold
        self.stages = {n: None for n in stages}
        self.trees: list[Tree] = []
        self.tree, self.open, self.level, self.rows = None, [], 0, {}

    @property
    def grown(self) -> bool:
        return len(self.trees) >= self.params.n_estimators

    @property
    def report(self) -> int | None:
        """Trees after which a score is due now."""
        n = len(self.trees)
        return n if n in self.stages and self.stages[n] is None and not self.level else None

    @property
    def done(self) -> bool:
        return self.grown and all(v is not None for v in self.stages.values())

    def begin(self, rows: int) -> None:
        if not self.open and not self.grown:
            self.tree, self.level = Tree(), 0
            self.open, self.rows = [self.tree.add()], {0: rows}

    def columns(self, width: int) -> np.ndarray:
        """The columns of the current tree."""
        share, n = self.params.colsample_bytree, len(self.trees)
        if share >= 1:
            return np.arange(width)
        drawn = np.random.default_rng([self.params.seed, n]).permutation(width)
        return np.sort(drawn[: max(1, int(share * width))])

    def split(self, found: dict[int, dict], subtrees: dict[int, Tree] = {}) -> None:
        """Put in subtrees, and open the next level from the best cuts of this one.

        A tree without open nodes is finished; a node that no row reaches stays a leaf.
        """
        following, tree = [], self.tree
        for node in self.open:
            if node in subtrees:
                tree.put(node, subtrees[node])
            best = found.get(node)
            if best is None:
                continue
            if not node:
                tree.value[0], tree.cover[0] = best["value"], best["cover"]
            if best["gain"] <= LEAST_GAIN:
                continue
            tree.feature[node], tree.cut[node], tree.gain[node] = best["feature"], best["cut"], best["gain"]
            tree.missing_left[node] = best["missing_left"]
            for side in ("left", "right"):
                child = tree.add(best[f"{side}_value"], best[f"{side}_cover"])
                getattr(tree, side)[node] = child
                if self.level + 1 < self.params.max_depth and tree.cover[child] >= 2 * self.params.min_child_weight:
                    following.append(child)
                    self.rows[child] = best.get(f"{side}_rows")
        self.open, self.level = following, self.level + 1
        if not following:
            self.trees.append(tree)
            self.tree, self.level, self.rows = None, 0, {}


# Bins and blocks ---------------------------------------------------------------------------------

def bin_edges(df: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of the bins of each column: its values if they are few, else quantiles.

    One pass finds columns with few values (a task stops counting a column's values at ``bins``),
    one more sketches the quantiles of the others.
    """
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0)] * len(columns)
        for batch in batches:
            for i, c in enumerate(columns):
                if len(seen[i]) < bins:
                    x = batch.column(i).to_numpy(zero_copy_only=False)
                    seen[i] = np.unique(np.concatenate([seen[i], x[~np.isnan(x)]]))[:bins]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(columns), dtype=np.int32), [len(s) for s in seen])),
             pa.array(np.concatenate([*seen, np.zeros(0)]))], names=["column", "value"])

    values = wide.mapInArrow(few, "column int, value double").groupBy("column").agg(
        F.slice(F.sort_array(F.collect_set("value")), 1, bins).alias("v"))  # at most ``bins`` a task
    found = {r["column"]: np.array(r["v"]) for r in values.collect()}
    many = [c for i, c in enumerate(columns) if len(found.get(i, ())) >= bins]
    steps = [i / (bins - 1) for i in range(1, bins - 1)]
    sketched = wide.approxQuantile(many, steps, 0.25 / bins) if many else []
    quantiles = dict(zip(many, (np.unique(q) for q in sketched)))
    return [quantiles[c] if c in quantiles else found.get(i, np.zeros(0)) for i, c in enumerate(columns)]


def packed(df: DataFrame, columns: list[str], edges: list[np.ndarray], label: str = LABEL, key: str = "id",
           fold: str | None = None, bins: int = BINS, block: int | None = None) -> DataFrame:
    """Blocks of rows, saved: n, ids, labels, folds, the columns' codes and what they stand for, and margins (empty: all 0)."""
    rows = df.select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"), *[F.col(c).cast("double").alias(c) for c in columns])

    # dealt by id, so that blocks are even and the same whatever the input's partitions are
    count = df.count()
    block = block or (FEW if count <= PLAIN else BLOCK)
    tasks = min(max(1, -(-count // block)), 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, "id").sortWithinPartitions("id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def whole(part: pa.Table) -> pa.RecordBatch:
            cells = [part.column(i).to_numpy() for i in range(part.num_columns)]
            binned = np.stack([np.where(np.isnan(x), bins - 1, np.searchsorted(e, x)) for e, x in zip(edges, cells[3:])])
            blobs = (cells[0].astype(np.int64), cells[1].astype(np.float32), cells[2].astype(np.int32), *coded(binned.astype(np.uint8)))
            return pa.RecordBatch.from_arrays(
                [pa.array([part.num_rows], pa.int32()), *[pa.array([b.tobytes()], pa.binary()) for b in blobs],
                 pa.array([b""], pa.binary())], names=["n", "ids", "labels", "folds", "codes", "owner", "meaning", "margins"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= block:
                table = pa.Table.from_batches(held)
                yield whole(table.slice(0, block))
                held, n = table.slice(block).to_batches(), n - block
        if n:
            yield whole(pa.Table.from_batches(held))

    return saved(rows.mapInArrow(pack, BLOCK_TYPE), "blocks", GROUPS)


#: Blocks are read a row group at a time: some of them, and not all of a task's at once.
GROUPS = {"parquet.block.size": 1 << 22, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 4}
BLOCK_TYPE = "n int, ids binary, labels binary, folds binary, codes binary, owner binary, meaning binary, margins binary"


def coded(bins: np.ndarray, share: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (group, row), the group of each column, and the bin that each code of its group means (column, code).

    Columns join a group while no more than CODES combinations of their bins occur, the one that grows
    least by them; a column may stay alone. Any rows have such codes; few rows keep a group a column.
    """
    width, n = bins.shape
    meaning = np.zeros((width, CODES), np.uint8)
    meaning[:] = np.arange(CODES)
    if n < SHARED or not share:
        return bins, np.arange(width, dtype=np.uint8), meaning
    span, some = int(bins.max()) + 1, slice(None, None, n // 4096)
    used = [int((np.bincount(b, minlength=span) > 0).sum()) for b in bins]
    codes, sizes, owner = [], [], np.zeros(width, np.uint8)
    for done, c in enumerate(order := sorted(range(width), key=lambda c: (-used[c], c))):
        best = None
        for k, own in enumerate(codes):
            if len(np.unique(own[some].astype(np.int32) * span + bins[c][some])) > CODES:
                continue
            seen = np.zeros(CODES * span, bool)
            seen[own.astype(np.int32) * span + bins[c]] = True
            count = int(seen.sum())
            if count <= CODES and (best is None or count - sizes[k] < best[0]):
                best = count - sizes[k], k, count, seen
        if best is None:
            owner[c] = len(codes)
            codes.append(bins[c])
            sizes.append(span)
            continue
        _, k, sizes[k], seen = best
        found = np.flatnonzero(seen)
        for other in order[:done]:
            if owner[other] == k:
                meaning[other, :len(found)] = meaning[other][found // span]
        owner[c], meaning[c, :len(found)] = k, found % span
        codes[k] = (np.cumsum(seen) - 1).astype(np.uint8)[codes[k].astype(np.int32) * span + bins[c]]
    return np.stack(codes), owner, meaning


def uniforms(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each id, another one for each tree."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree + 1) * 0xD1B54A32D192ED03 + seed & (1 << 64) - 1)
    for _ in range(2):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)) / float(1 << 53)


def leaves(tree: tuple[np.ndarray, ...], n: int, goes_left) -> dict[int, np.ndarray]:
    """The rows that end at each node, in order; ``goes_left(node, rows)`` tells for each row (None: all)."""
    feature, _, _, left, right, _ = tree
    out, stack = {}, [(0, None)]
    while stack:
        node, rows = stack.pop()
        if feature[node] < 0:
            out[node] = np.arange(n) if rows is None else rows
            continue
        side = goes_left(node, rows)
        stack += [(int(left[node]), np.flatnonzero(side) if rows is None else rows[side]),
                  (int(right[node]), np.flatnonzero(~side) if rows is None else rows[~side])]
    return out


def reached(tree: tuple[np.ndarray, ...], cells: np.ndarray, missing) -> np.ndarray:
    """The node each row ends at; ``cells`` are (column, row) bins or values, compared with the cuts."""
    feature, cut, missing_left, left, right, _ = tree
    n, flat = cells.shape[1], cells.reshape(-1)
    at = np.zeros(n, np.int64)
    if n > 16 * len(feature):  # rows are parted node by node

        def goes_left(node: int, own: np.ndarray | None) -> np.ndarray:
            x = cells[feature[node]] if own is None else cells[feature[node]][own]
            return np.where(missing(x), missing_left[node], x <= cut[node])

        for node, own in leaves(tree, n, goes_left).items():
            at[own] = node
        return at
    rows, node = np.arange(n), np.zeros(n, np.int64)
    while len(rows):
        inner = feature.take(node) >= 0
        if not inner.all():
            at[rows[~inner]] = node[~inner]
            rows, node = rows[inner], node[inner]
        x = flat.take(feature.take(node) * n + rows)
        goes_left = np.where(missing(x), missing_left.take(node), x <= cut.take(node))
        node = np.where(goes_left, left.take(node), right.take(node))
    return at


class Block:
    """One block's arrays, and the margins of fits on it."""

    def __init__(self, row: dict, width: int):
        self.n = row["n"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.y = np.frombuffer(row["labels"], np.float32).astype(np.float64)
        self.fold = np.frombuffer(row["folds"], np.int32)
        self.codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, self.n)
        self.owner = np.frombuffer(row["owner"], np.uint8)
        self.meaning = np.frombuffer(row["meaning"], np.uint8).reshape(width, CODES)
        self.margins = np.frombuffer(row["margins"], np.float64).reshape(-1, self.n)

    def bins(self, rows=slice(None)) -> np.ndarray:
        """(column, row) bins."""
        return np.stack([m[self.codes[k][rows]] for k, m in zip(self.owner, self.meaning)])

    def leaves(self, tree: tuple, missing: int) -> dict[int, np.ndarray]:
        return leaves(tree, self.n, _sides(tree, self.codes, self.owner, self.meaning, missing))

    def margin(self, fit: int, trees: list[tuple], missing: int) -> np.ndarray:
        total = self.margins[fit].copy() if len(self.margins) else np.zeros(self.n)
        for tree in trees:
            for node, rows in self.leaves(tree, missing).items():
                total[rows] += tree[5][node]
        return total


def _sides(tree: tuple, codes: np.ndarray, owner: np.ndarray, meaning: np.ndarray, missing: int):
    """Which rows of codes go left at a node."""
    feature, cut, missing_left = tree[:3]

    def goes_left(node: int, rows: np.ndarray | None) -> np.ndarray:
        f = feature[node]
        means, own = meaning[f], codes[owner[f]]
        return np.where(means == missing, missing_left[node], means <= cut[node])[own if rows is None else own[rows]]

    return goes_left


# One pass ----------------------------------------------------------------------------------------

class Cells:
    """The bins of all columns behind each other: per column its bins, then one for missing values."""

    def __init__(self, edges: list[np.ndarray], bins: int = BINS):
        self.width, self.missing = len(edges), bins - 1
        sizes = np.array([min(len(e) + 1, bins - 1) for e in edges], dtype=np.int64)  # one more for what lies above
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int64)
        self.count = int(self.starts[-1])
        self.column = np.repeat(np.arange(self.width), sizes + 1)
        self.bin = np.arange(self.count) - self.starts[self.column]
        self.last = self.starts[1:] - 1

    def tables(self, owner: np.ndarray, meaning: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each group of columns its cells, and which of them each code counts for (code, cell)."""
        out = []
        for k in range(int(owner.max()) + 1 if len(owner) else 0):
            own = np.flatnonzero(owner == k)
            at = [np.where(meaning[c] == self.missing, self.last[c], np.minimum(self.starts[c] + meaning[c], self.last[c])) for c in own]
            cells = np.concatenate([np.arange(self.starts[c], self.starts[c + 1]) for c in own])
            place = np.zeros(self.count, np.int64)
            place[cells] = np.arange(len(cells))
            table = np.zeros((CODES, len(cells)))
            for a in at:
                table[np.arange(CODES), place[a]] = 1
            out.append((cells, table))
        return out

    def sums(self, codes: np.ndarray, tables: list, rows: np.ndarray, slot: np.ndarray | None, slots: int, *values: np.ndarray | None
             ) -> np.ndarray:
        """(value, slot, cell) sums of the given rows, whose values are given in their order; None counts rows.

        Groups of columns go one by one, so that what a group needs stays in the cache.
        """
        out = np.zeros((len(values), slots, self.count))
        for own, (cells, table) in zip(codes, tables):
            size = int(own.max()) + 1 if len(own) else 1
            at = own[rows].astype(np.int64)
            if slot is not None:
                at += slot * size
            for o, v in zip(out, values):
                o[:, cells] = np.bincount(at, v, slots * size).reshape(slots, size) @ table[:size]
        return out

    def best_cuts(self, sums: np.ndarray, allowed: np.ndarray, l1: np.ndarray, l2: np.ndarray, least: np.ndarray,
                  rate: np.ndarray, plain: bool) -> list[dict]:
        """The best cut of each node from (g, h, rows) x node x cell; equal gains go to the first column and lowest cut.

        Without the rows their numbers are left out. Unless sums are ``plain``, a column's are told exactly.
        """
        l1, l2, least = l1[:, None], l2[:, None], least[:, None]

        def shrunk(x):
            return np.sign(x) * np.maximum(np.abs(x) - l1, 0)

        def score(x, y):
            return shrunk(x) ** 2 / (y + l2)

        if plain:
            running = np.cumsum(sums, 2)
            below = running - np.where(self.starts[:-1] > 0, running[:, :, self.starts[:-1] - 1], 0.0)[:, :, self.column]
        else:
            below = np.empty_like(sums)  # column by column: other columns leave no trace in a column's sums
            for a, b in zip(self.starts[:-1].tolist(), self.starts[1:].tolist()):
                np.cumsum(sums[:, :, a:b], 2, out=below[:, :, a:b])
        whole = below[:, :, self.last[:1]]
        gone = sums[:, :, self.last][:, :, self.column]
        ways = [below, below + gone] if sums[1][:, self.last].any() else [below]  # missing to the right, to the left
        usable = allowed[:, self.column] & (np.arange(self.count) != self.last[self.column])[None, :]
        gains = []
        with np.errstate(divide="ignore", invalid="ignore"):
            for left in ways:
                right = whole - left
                gain = score(left[0], left[1]) + score(right[0], right[1]) - score(whole[0], whole[1])
                gains.append(np.where((left[1] >= least) & (right[1] >= least) & usable, gain, -np.inf))
            at = np.stack(gains, 2).reshape(sums.shape[1], -1).argmax(1)
            cell, side = np.divmod(at, len(ways))
            node = np.arange(sums.shape[1])
            left = np.stack(ways)[side, :, node, cell].T
            right = whole[:, :, 0] - left

            def value(x):
                return -shrunk(x[0][:, None])[:, 0] / (x[1] + l2[:, 0]) * rate

            out = {"gain": np.stack(gains)[side, node, cell], "feature": self.column[cell], "cut": self.bin[cell], "missing_left": side == 1,
                   "value": np.nan_to_num(value(whole[:, :, 0])), "cover": whole[1, :, 0]}
            for name, x in (("left", left), ("right", right)):
                out |= {f"{name}_value": np.nan_to_num(value(x)), f"{name}_cover": x[1]}
                if len(x) > 2:
                    out[f"{name}_rows"] = np.round(x[2]).astype(np.int64)
        return [dict(zip(out, row)) for row in zip(*(v.tolist() for v in out.values()))]


def _limits(params: list[Params]) -> list[np.ndarray]:
    return [np.array([getattr(p, n) for p in params], float)
            for n in ("reg_alpha", "reg_lambda", "min_child_weight", "learning_rate")]


def grow_here(cells: Cells, coding: tuple, rows: np.ndarray, g: np.ndarray, h: np.ndarray, params: Params, columns: np.ndarray,
              level: int, plain: bool, others: np.ndarray | None = None) -> tuple[Tree, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The subtree of a node whose rows, some of those at hand, are given in order, by the same cuts.

    ``coding`` is codes, owner, meaning and the tables of ``Cells``. Of two siblings only the one of fewer
    rows is summed up, the other is what its parent has beyond it: sums are exact (``_unit``) unless ``plain``.
    Returns each leaf with its rows and those of ``others`` that end there.
    """
    codes, owner, meaning, tables = coding
    fit = Fit(params)
    fit.tree, fit.level = Tree(), level
    fit.open = [fit.tree.add()]
    allowed = np.isin(np.arange(cells.width), columns)[None, :]
    g, h = g[rows], h[rows]
    none = np.zeros(0, np.int64)
    held = {0: (rows, g, h, none if others is None else others)}  # rows, their gradients and hessians, other rows
    sums, pairs, ended = {}, [], []

    def summed(nodes: list[int]) -> np.ndarray:
        own = [held[n] for n in nodes]
        if len(own) == 1:
            return cells.sums(codes, tables, own[0][0], None, 1, *own[0][1:3])
        slot = np.repeat(np.arange(len(own)), [len(o[0]) for o in own])
        return cells.sums(codes, tables, np.concatenate([o[0] for o in own]), slot, len(own),
                          *(np.concatenate([o[i] for o in own]) for i in (1, 2)))

    while not fit.trees:
        opened = list(fit.open)
        if plain:
            sums = dict(zip(opened, np.moveaxis(summed(opened), 1, 0)))
        elif pairs:
            fewer = [min(p[1:], key=lambda n: len(held[n][0])) for p in pairs]
            above, sums = sums, {}
            for (parent, a, b), n, own in zip(pairs, fewer, np.moveaxis(summed(fewer), 1, 0)):
                sums[n], sums[a + b - n] = own, above[parent] - own
        else:
            sums[0] = summed([0])[:, 0]
        found = cells.best_cuts(np.stack([sums[n] for n in opened], 1), np.repeat(allowed, len(opened), 0), *_limits([params] * len(opened)), plain)
        fit.split(dict(zip(opened, found)))
        tree = fit.tree or fit.trees[0]
        goes_left = _sides((tree.feature, tree.cut, tree.missing_left), codes, owner, meaning, cells.missing)
        still, pairs, parted = set(fit.open), [], {}
        for node in opened:
            own = held[node]
            if tree.feature[node] < 0:
                ended.append((node, own[0], own[3]))
                continue
            children = tree.left[node], tree.right[node]
            side, other = goes_left(node, own[0]), goes_left(node, own[3])
            for child, x, y in zip(children, (side, ~side), (other, ~other)):
                x, y = np.flatnonzero(x), np.flatnonzero(y)
                if child not in still:
                    ended.append((child, own[0][x], own[3][y]))
                if still & set(children):
                    parted[child] = (*(v[x] for v in own[:3]), own[3][y])
            if still & set(children):
                pairs.append((node, *children))
        held = parted
    return fit.trees[0], ended


def _unit(rows: int, params: Params) -> float | None:
    """The power of two of which gradients and hessians are multiples; None, and as they are, in a table of few rows.

    Up to TABLE * SMALL rows have exact sums in any order, so equal gains are equal to the last bit
    however a tree is grown; it is 2^-28 for a million rows and a weight of 16.
    """
    if rows <= PLAIN:
        return None
    return 2.0 ** (math.ceil(math.log2(max(1, min(rows, TABLE * SMALL)) * max(1.0, params.scale_pos_weight))) - 52)


def _slopes(margin: np.ndarray, y: np.ndarray, params: Params, unit: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of each row."""
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y == 1, params.scale_pos_weight, 1.0)
    g, h = (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w
    return (g, h) if unit is None else (np.rint(g / unit) * unit, np.maximum(np.rint(h / unit), 1) * unit)


def _counts(margin: np.ndarray, y: np.ndarray) -> list[int]:
    """True negatives, false positives, false negatives, true positives."""
    told, true = margin > 0, y == 1
    return [int((t & u).sum()) for u in (~true, true) for t in (~told, told)]


@dataclass
class Task:
    """What a pass needs of one fit: ``open`` nodes are summed up, the rows of ``small`` ones sent whole."""

    fit: int
    params: Params
    unit: float | None
    fold: int | None
    ahead: list[tuple]
    number: int
    tree: tuple | None
    open: list[int]
    small: list[int]
    level: int
    columns: np.ndarray
    report: bool


SUM_TYPE = "fit int, node int, part long, rows int, cells binary, g binary, h binary, n binary"
CUT_TYPE = "fit int, node int, content string"


def _sums(tasks: list[Task], cells: Cells):
    """Partial sums of a partition per fit and open node, only cells that hold something; rows of small nodes."""
    names = [c.split()[0] for c in SUM_TYPE.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t.fit: np.zeros((3, len(t.open), cells.count)) for t in tasks if t.open}
        counts = {t.fit: np.zeros(4) for t in tasks if t.report}
        part = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, sent = Block(batch.slice(i, 1).to_pylist()[0], cells.width), []
                first = int(block.ids[0])
                part = first if part is None else part
                tables = cells.tables(block.owner, block.meaning)
                for t in tasks:
                    margin = block.margin(t.fit, t.ahead, cells.missing)
                    if t.report:
                        out = block.fold == t.fold
                        counts[t.fit] += _counts(margin[out], block.y[out])
                    if not t.tree:
                        continue
                    used = np.ones(block.n, bool) if t.fold is None else block.fold != t.fold
                    if t.params.subsample < 1:
                        used &= uniforms(block.ids, t.number, t.params.seed) < t.params.subsample
                    g, h = _slopes(margin, block.y, t.params, t.unit)
                    ends = block.leaves(t.tree, cells.missing)
                    for node in t.small:
                        rows = ends[node][used[ends[node]]]
                        if len(rows):
                            sent.append((t.fit, node, first, len(rows), block.bins(rows).tobytes(), g[rows].tobytes(), h[rows].tobytes(), None))
                    if t.open:
                        own = [ends[node][used[ends[node]]] for node in t.open]
                        rows = np.concatenate(own)
                        slot = np.repeat(np.arange(len(own)), [len(o) for o in own]) if len(own) > 1 else None
                        held[t.fit] += cells.sums(block.codes, tables, rows, slot, len(t.open), g[rows], h[rows], None)
                if sent:
                    yield batch_of(sent)
        made = []
        for t in tasks:
            if t.report and part is not None:
                made.append((t.fit, -1, part, -1, None, counts[t.fit].tobytes(), None, None))
            if t.open:
                for i, node in enumerate(t.open):
                    at = np.flatnonzero(held[t.fit][2, i])
                    if len(at):
                        made.append((t.fit, node, part, -1, at.astype(np.int32).tobytes(), *[s[i][at].tobytes() for s in held[t.fit]]))
        if made:
            yield batch_of(made)

    return run


def _cuts(tasks: list[Task], cells: Cells):
    """All partitions' sums, sorted by (fit, node), to one row per node: its best cut, subtree or counts."""
    by_fit = {t.fit: t for t in tasks}

    def decided(keys: list, sums: list) -> pa.RecordBatch:
        own = [by_fit[fit] for fit, _ in keys]
        allowed = np.stack([np.isin(np.arange(cells.width), t.columns) for t in own])
        found = cells.best_cuts(np.stack(sums, 1), allowed, *_limits([t.params for t in own]), all(t.unit is None for t in own))
        return told([(*k, json.dumps({"cut": c})) for k, c in zip(keys, found)])

    def told(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string()))],
                                          names=["fit", "node", "content"])

    def grown(fit: int, node: int, parts: list) -> pa.RecordBatch:
        bins = np.concatenate([np.frombuffer(c, np.uint8).reshape(cells.width, -1) for c, _, _ in parts], 1)
        g, h = (np.concatenate([np.frombuffer(p[i], np.float64) for p in parts]) for i in (1, 2))
        t = by_fit[fit]
        coding = coded(bins, t.unit is not None)
        tree, _ = grow_here(cells, (*coding, cells.tables(*coding[1:])), np.arange(len(g)), g, h, t.params, t.columns, t.level, t.unit is None)
        return told([(fit, node, json.dumps({"tree": asdict(tree)}))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, now, parts, counts = [], [], None, [], np.zeros(4)
        for batch in batches:
            for fit, node, _, rows, at, g, h, n in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (fit, node):
                    if parts:
                        yield grown(*now, parts)
                    elif now and now[1] < 0:
                        yield told([(*now, json.dumps({"counts": counts.astype(int).tolist()}))])
                    if len(keys) >= 256:
                        yield decided(keys, sums)
                        keys, sums = [], []
                    now, parts, counts = (fit, node), [], np.zeros(4)
                    if node >= 0 and rows < 0:
                        keys.append(now)
                        sums.append(np.zeros((3, cells.count)))
                if rows >= 0:
                    parts.append((at, g, h))
                elif node < 0:
                    counts += np.frombuffer(g, np.float64)
                else:
                    for s, values in zip(sums[-1], (g, h, n)):
                        s[np.frombuffer(at, np.int32)] += np.frombuffer(values, np.float64)
        if parts:
            yield grown(*now, parts)
        elif now and now[1] < 0:
            yield told([(*now, json.dumps({"counts": counts.astype(int).tolist()}))])
        if keys:
            yield decided(keys, sums)

    return run


def _advanced(blocks: DataFrame, fits: int, ahead: list[list[tuple]], cells: Cells) -> DataFrame:
    """The blocks with the margins brought up to date."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0], cells.width)
                margins = np.stack([block.margin(f, ahead[f], cells.missing) for f in range(fits)])
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, 1) for c in batch.columns[:-1]], pa.array([margins.tobytes()], pa.binary())], schema=batch.schema)

    return saved(blocks.mapInArrow(run, BLOCK_TYPE), "margins", GROUPS)


def _whole(fits: list[Fit], units: list[float | None], cells: Cells, keep: bool):
    """All blocks of a fit to its trees, a row each if they are kept, and a row of its counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["fit"], []).append(Block(row, cells.width))
        for number, own in held.items():
            own.sort(key=lambda b: b.ids[0])
            fit, made = fits[number], []
            ids, y, fold = (np.concatenate([getattr(b, n) for b in own]) for n in ("ids", "y", "fold"))
            unit = units[number]
            coding = coded(np.concatenate([b.bins() for b in own], 1), unit is not None)
            own.clear()
            coding, margin = (*coding, cells.tables(*coding[1:])), np.zeros(len(y))
            kept = np.ones(len(y), bool) if fit.fold is None else fold != fit.fold
            while not fit.done:
                if fit.report is not None:
                    out = fold == fit.fold
                    fit.stages[fit.report] = _counts(margin[out], y[out])
                    continue
                n, p = len(fit.trees), fit.params
                used = kept & (uniforms(ids, n, p.seed) < p.subsample) if p.subsample < 1 else kept
                rows = np.flatnonzero(used)
                if len(rows):
                    tree, ends = grow_here(cells, coding, rows, *_slopes(margin, y, p, unit), p, fit.columns(cells.width), 0, unit is None,
                                           np.flatnonzero(~used))
                else:
                    tree, ends = Tree(), []
                    tree.add()
                for leaf, *parts in ends:
                    for part in parts:
                        margin[part] += tree.value[leaf]
                fit.trees.append(None)
                if keep:
                    made.append((number, n, json.dumps(asdict(tree))))
            made.append((number, -1, json.dumps(list(fit.stages.values()))))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), (pa.int32(), pa.int32(), pa.string()))],
                                             names=["fit", "node", "content"])

    return run


def _grow_whole(blocks: DataFrame, total: int, fits: list[Fit], cells: Cells, finished, keep: bool) -> None:
    """Grow each fit in a task of its own, a few tasks a core in a job, the largest first."""
    order = sorted(range(len(fits)), key=lambda i: -fits[i].params.n_estimators * fits[i].params.max_depth)
    turn = max(1, int(TURNS * blocks.sparkSession.sparkContext.defaultParallelism))
    for start in range(0, len(order), turn):
        part = order[start:start + turn]
        numbers = blocks.sparkSession.range(0, len(part), 1, len(part)).select(F.col("id").cast("int").alias("fit"))
        dealt = numbers.crossJoin(F.broadcast(blocks))  # few rows, once an executor instead of once a fit
        fresh = [Fit(fits[i].params, fits[i].fold, tuple(fits[i].stages)) for i in part]
        for r in sorted(dealt.mapInArrow(_whole(fresh, [_unit(total, f.params) for f in fresh], cells, keep), CUT_TYPE).toArrow().to_pylist(), key=lambda r: (r["fit"], r["node"])):
            f = fits[part[r["fit"]]]
            if r["node"] < 0:
                f.stages = dict(zip(f.stages, json.loads(r["content"])))
            else:
                f.trees.append(Tree(**json.loads(r["content"])))
        for i in part:
            if finished:
                finished(i)


def grow(blocks: DataFrame, fits: list[Fit], cells: Cells, finished=None, small: int = SMALL, keep: bool = True) -> None:
    """Grow all fits to the end in passes over the blocks.

    A pass takes every fit one level further; the subtree of a node of at most ``small`` rows is grown
    whole where its rows meet, with the same result. ``finished(number)`` is called when a fit has all
    its trees and scores. Margins are saved every few trees and the table they replace is removed, so
    a lost executor costs a re-read of the last one. A table of at most TABLE times ``small`` rows goes to a
    task for each fit; without ``keep`` only the scores of these come back.
    """
    source, known = blocks, [0] * len(fits)
    total = blocks.agg(F.sum("n")).first()[0] or 0
    if 0 < total <= TABLE * small:
        return _grow_whole(blocks, total, fits, cells, finished, keep)
    told = set()
    while True:
        for i, f in enumerate(fits):
            if f.done and i not in told:
                told.add(i)
                if finished:
                    finished(i)
        active = [i for i, f in enumerate(fits) if not f.done]
        if not active:
            break
        if max(len(fits[i].trees) - known[i] for i in active) >= AHEAD:
            ahead = [[t.arrays() for t in f.trees[k:]] for f, k in zip(fits, known)]
            fresh = _advanced(source, len(fits), ahead, cells)
            if source is not blocks:
                discard(source)
            source, known = fresh, [len(f.trees) for f in fits]
        tasks, room = [], SUMS // (24 * cells.count)
        for i in active:
            f = fits[i]
            f.begin(total)
            whole = [n for n in f.open if f.rows[n] <= small]
            summed = [n for n in f.open if f.rows[n] > small]
            if tasks and len(summed) > room:
                continue  # the next pass takes it
            room -= len(summed)
            tasks.append(Task(i, f.params, _unit(total, f.params), f.fold, [t.arrays() for t in f.trees[known[i]:]], len(f.trees),
                              f.tree.arrays() if f.tree else None, summed, whole, f.level, f.columns(cells.width), f.report is not None))
        rows = source.mapInArrow(_sums(tasks, cells), SUM_TYPE)
        cuts = (rows.repartition("fit", "node").sortWithinPartitions("fit", "node", "part")
                .mapInArrow(_cuts(tasks, cells), CUT_TYPE))
        found: dict[int, dict[int, dict]] = {t.fit: {} for t in tasks}
        for r in cuts.toArrow().to_pylist():
            found[r["fit"]][r["node"]] = json.loads(r["content"])
        for t in tasks:
            f, own = fits[t.fit], found[t.fit]
            if t.report:
                f.stages[f.report] = own[-1]["counts"] if -1 in own else [0, 0, 0, 0]
            if f.open:
                f.split({n: c["cut"] for n, c in own.items() if "cut" in c}, {n: Tree(**c["tree"]) for n, c in own.items() if "tree" in c})
    if source is not blocks:
        discard(source)


def positive_weight(blocks: DataFrame) -> float:
    """Negatives / positives over all rows of the blocks; 1 where a class is absent."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = [np.frombuffer(b, np.float32) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(int((v != 1).sum()) for v in y)]),
                                              pa.array([sum(int((v == 1).sum()) for v in y)])], names=["n0", "n1"])

    row = blocks.select("labels").mapInArrow(count, "n0 long, n1 long").agg(F.sum("n0"), F.sum("n1")).first()
    return row[0] / row[1] if row[0] and row[1] else 1.0


# Models ------------------------------------------------------------------------------------------

class BoostedModel:
    """Fitted trees with cuts in the columns' own values."""

    def __init__(self, columns: list[str], trees: list[dict], params: dict):
        self.columns, self.trees, self.params = list(columns), trees, params

    @classmethod
    def of(cls, fit: Fit, columns: list[str], edges: list[np.ndarray]) -> BoostedModel:
        trees = []
        for t in fit.trees:
            cells = asdict(t)
            # the cut after the last edge takes every value that is not missing
            cells["cut"] = [float(edges[f][c]) if f >= 0 and c < len(edges[f]) else float("inf") for f, c in zip(t.feature, t.cut)]
            trees.append(cells)
        return cls(columns, trees, asdict(fit.params))

    def margins(self, x: np.ndarray, trees: int | None = None) -> np.ndarray:
        """Summed leaf values of (column, row) values, of the first trees only if so asked."""
        total = np.zeros(x.shape[1])
        for t in self.trees[:trees]:
            arrays = tuple(np.array(t[n]) for n in ("feature", "cut", "missing_left", "left", "right", "value"))
            total += arrays[5][reached(arrays, x, np.isnan)]
        return total

    def predictions(self, df: DataFrame, keep: list[str] = ("id",), label: str | None = LABEL) -> DataFrame:
        """keep..., label, score = P(class 1), prediction; rows keep their columns' order."""
        shared = df.sparkSession.sparkContext.broadcast(self)  # trees only

        @F.pandas_udf("double")
        def score(cells: pd.Series) -> pd.Series:
            if not len(cells):
                return pd.Series([], dtype="float64")
            x = np.stack(cells.to_numpy()).astype("float64").T
            return pd.Series(1 / (1 + np.exp(-shared.value.margins(np.ascontiguousarray(x)))))

        y = [F.col(label).cast("int").alias("label")] if label and label in df.columns else []
        cells = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.columns])
        scored = df.select(*keep, *y, score(cells).alias("score"))
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))

    def importances(self) -> list[tuple[str, float]]:
        """Share of the gain that each column's cuts brought."""
        total = np.zeros(len(self.columns))
        for t in self.trees:
            for f, gain in zip(t["feature"], t["gain"]):
                if f >= 0:
                    total[f] += gain
        return list(zip(self.columns, (total / total.sum() if total.sum() else total).tolist()))

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns, "params": self.params, "trees": self.trees})

    @classmethod
    def from_json(cls, text: str) -> BoostedModel:
        return cls(**json.loads(text))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per tree, so that no cell holds the whole model."""
        rows = [(-1, json.dumps({"columns": self.columns, "params": self.params}))]
        rows += [(i, json.dumps(t)) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, content string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        rows = spark.read.schema("tree int, content string").parquet(path).orderBy("tree").collect()
        head = json.loads(rows[0].content)
        return cls(head["columns"], [json.loads(r.content) for r in rows[1:]], head["params"])


def resolved(params: Params, weight: float) -> Params:
    return params if params.scale_pos_weight is not None else Params(**{**asdict(params), "scale_pos_weight": weight})


def fit_boosted(df: DataFrame, columns: list[str], params: Params = Params(), label: str = LABEL, key: str = "id",
                bins: int = BINS) -> BoostedModel:
    """One model on all rows. Rows with a null label count as class 0 would: filter them before."""
    edges = bin_edges(df, columns, bins)
    blocks = packed(df, columns, edges, label, key, bins=bins)
    weight = positive_weight(blocks) if params.scale_pos_weight is None else 1.0
    fit = Fit(resolved(params, weight))
    grow(blocks, [fit], Cells(edges, bins))
    discard(blocks)
    return BoostedModel.of(fit, columns, edges)
