"""Helpers shared by the operators: ASCII case, text slices for Arrow functions, hashing."""
from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text an Arrow function works on at a time: its arrays of 8 bytes a byte stay in cache.
SLICE_BYTES = 1 << 18


#: Rows of an Arrow batch between Spark and Python: texts are long, and a batch is held on both sides.
BATCH_ROWS = "1000"


def small_batches(spark) -> None:
    """Set the session's Arrow batches to BATCH_ROWS, if they are larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= int(BATCH_ROWS):
        spark.conf.set(name, BATCH_ROWS)


def table(spark, folder: str, name: str) -> DataFrame:
    """A table of a folder, for operators that read texts."""
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def slices(batch: pa.RecordBatch, column: int | str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, cut where their texts pass the limit; every row comes once."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(start, end - start)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts behind each other as one byte array, and the n+1 offsets."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], ends]).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), applied to every element of an uint64 array."""
    x = x ^ (x >> np.uint64(32))
    for _ in range(2):
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def csr_rows(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, behind each other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)


# Words and hashes over whole byte arrays ----------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words [0-9a-z] and every non-ASCII byte, after LOWER.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Everything but space, tab, line feed, vertical tab, form feed and carriage return.
VISIBLE = np.ones(256, bool)
VISIBLE[[32, 9, 10, 11, 12, 13]] = False

_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _POWERS[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


class SpanHashes:
    """64-bit hash of the elements of any span, equal for equal elements wherever they stand."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        x = self.sums[ends] - self.sums[starts]
        x *= self.down[starts]
        x += (ends - starts).astype(np.uint64)
        return mixed(x)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHashes(data)(starts, ends)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes at every position that has so many."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(up[: len(data)] * data, out=sums[1:])
    x = sums[gram:] - sums[:-gram]
    x *= down[: len(x)]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes of a kind, and the number of words of each text."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kind[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    edge = np.zeros(len(data) + 1, bool)  # a text's first byte begins a word, its end ends one
    edge[offsets] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def row_key(*columns: Column) -> Column:
    """128-bit key of a row's content; rows that are equal in these columns share it.

    Results found per key are joined back without numbering rows, which a repeated task could do
    differently.
    """
    parts = [p for c in columns for p in (c.isNull().cast("string"), F.coalesce(c.cast("string"), F.lit("")))]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))
