"""Column functions over numbers: bins, labels, seeded hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_bin(c: Column, n: int = 100) -> Column:
    """Whole part of ``score * n``; the score is rounded first so 0.29 lands in bin 29."""
    return F.floor(F.round(F.round(c, 9) * n, 6)).cast("int")


def edge_bin(c: Column, n_bins: int = 10) -> Column:
    """Number of edges 0, 1/n, .., 1 at or below the value: 1.0 gets bin n + 1."""
    edges = [(c >= F.lit(i / n_bins)).cast("int") for i in range(n_bins + 1)]
    total = edges[0]
    for edge in edges[1:]:
        total = total + edge
    return total


def share_label(percent: Column, floor: float = 7.0) -> Column:
    """A percentage as text, blank for small shares."""
    return F.when(percent < floor, "").otherwise(F.format_string("%.0f%%", percent))


def hash_number(seed: int | str, *keys: Column | str) -> Column:
    """A 32-bit number from md5 of seed and key: the same on every engine and partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(seed: int | str, n: int, *keys: Column | str) -> Column:
    return (hash_number(seed, *keys) % n).cast("int")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
