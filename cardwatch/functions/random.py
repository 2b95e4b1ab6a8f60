"""Reproducible uniforms: a value depends on the id and the seed only, never on the partition."""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F


def uniform(key: str | Column, seed: int) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of md5(key-seed)."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform_of(key, seed: int) -> float:
    """The same number on the driver."""
    return int(hashlib.md5(f"{key}-{seed}".encode()).hexdigest()[:8], 16) / 4294967296.0
