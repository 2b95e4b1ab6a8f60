"""Two Bloom filters over a hash column: hashes seen once or more, and hashes seen twice or more.

Tasks fill their own pair; pairs merge by ``twice = twice | other.twice | (once & other.once)``. The
second filter holds every hash that occurs at least twice, and a few others by chance. Its size is
bounded: a fuller filter only lets more unrepeated hashes through to the exact step behind it.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Bits per expected hash; bounds of a filter's size (2^27 bits are 16 MB).
BITS_PER_HASH, LEAST_LOG2, MOST_LOG2 = 16, 20, 27
PROBES, PART, FAN_IN = 3, 1 << 16, 32


def log2_bits(hashes: int, most: int = MOST_LOG2) -> int:
    return min(most, max(LEAST_LOG2, int(hashes * BITS_PER_HASH).bit_length()))


def _places(hashes: np.ndarray, log2: int) -> np.ndarray:
    mask, step = np.uint64((1 << log2) - 1), (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * step) & mask for i in range(PROBES)])


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the uint64 hashes a filter (packed bits) may hold."""
    at = _places(hashes, int(len(bits) * 8).bit_length() - 1)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(0)


def _put(bits: np.ndarray, hashes: np.ndarray, log2: int) -> None:
    at = _places(hashes, log2).ravel()
    np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def add(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    log2 = int(len(once) * 8).bit_length() - 1
    own, n = np.unique(hashes, return_counts=True)
    again = (n > 1) | holds(once, own)
    _put(twice, own[again], log2)
    _put(once, own, log2)


PAIR = "task long, part int, once binary, twice binary"


def _rows(once: np.ndarray, twice: np.ndarray, task: int) -> pa.RecordBatch:
    parts = [i for i in range(0, len(once), PART) if once[i:i + PART].any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([task] * len(parts), pa.int64()), pa.array([i // PART for i in parts], pa.int32()),
         pa.array([once[i:i + PART].tobytes() for i in parts], pa.binary()),
         pa.array([twice[i:i + PART].tobytes() for i in parts], pa.binary())], ["task", "part", "once", "twice"])


def twice_seen(docs: DataFrame, hashes, log2: int) -> np.ndarray:
    """Packed bits of the filter of repeated hashes over all rows.

    hashes(batch) gives arrays of uint64, one array or more for an Arrow batch.
    """
    size = max(1, (1 << log2) // 8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for batch in batches:
            for own in hashes(batch):
                add(once, twice, own)
        yield _rows(once, twice, TaskContext.get().partitionId() // FAN_IN)

    def merge(rows: pa.Table) -> pa.Table:
        once = twice = None
        for o, t in zip(rows.column("once"), rows.column("twice")):
            o, t = (np.frombuffer(x.as_buffer(), np.uint8) for x in (o, t))
            once, twice = (o, t) if once is None else (once | o, twice | t | (once & o))
        return pa.table({"task": pa.array([rows.column("task")[0].as_py() // FAN_IN], pa.int64()),
                         "part": pa.array([rows.column("part")[0].as_py()], pa.int32()),
                         "once": pa.array([once.tobytes()], pa.binary()),
                         "twice": pa.array([twice.tobytes()], pa.binary())})

    tasks, pairs = docs.rdd.getNumPartitions(), docs.mapInArrow(fill, PAIR)
    while tasks > 1:
        pairs, tasks = pairs.groupBy("task", "part").applyInArrow(merge, PAIR), -(-tasks // FAN_IN)
    bits = np.zeros(size, np.uint8)
    for row in pairs.select("part", "twice").toLocalIterator():
        bits[row["part"] * PART: row["part"] * PART + len(row["twice"])] |= np.frombuffer(row["twice"], np.uint8)
    return bits
