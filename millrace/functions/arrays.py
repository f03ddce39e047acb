"""Column functions over arrays: padding, encoding, cutting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_pre(c: Column, size: int, fill: int = 0) -> Column:
    """Exactly ``size`` items: fill in front, or the last ``size`` items."""
    return F.slice(F.concat(F.array_repeat(F.lit(fill), size), c), -size, size)


def pad_post(c: Column, size: int, fill: int = 0) -> Column:
    """Exactly ``size`` items: fill behind, or the first ``size`` items."""
    return F.slice(F.concat(c, F.array_repeat(F.lit(fill), size)), 1, size)


def one_hot(index: Column, n_classes: int) -> Column:
    """0/1 array with a single one at ``index`` (from 0)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda i: (i == index).cast("int")
    )


def argmax(c: Column) -> Column:
    """Index (from 0) of the first largest item."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def chunk_text(c: Column, size: int) -> Column:
    """Pieces of exactly ``size`` characters; the rest that fills no piece is left out."""
    n = F.floor(F.length(c) / size).cast("int")
    return F.when(
        n > 0,
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: c.substr(i * size + 1, F.lit(size))),
    ).otherwise(F.array().cast("array<string>"))
