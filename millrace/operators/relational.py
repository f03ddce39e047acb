"""Selection, key lookups, joins and set operations over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    """Equi-join that keeps both key columns, so a one-sided row shows a null on the other side.

    No broadcast hint: adaptive execution sees the real size of either side and decides.
    """
    return left.join(right, left[left_key] == right[right_key], how)


def key_lookup(df: DataFrame, **keys) -> DataFrame:
    """Rows whose columns equal all given values; the filter reaches the Parquet scan."""
    for name, value in keys.items():
        df = df.where(F.col(name) == value)
    return df


def column_slice(df: DataFrame, n: int, rows: int | None = None, order: list[Column] = ()) -> DataFrame:
    """First and last ``n`` columns, optionally the first ``rows`` rows in a given order."""
    names = df.columns[:n] + [c for c in df.columns[-n:] if c not in df.columns[:n]]
    if rows is not None:
        df = df.orderBy(*order).limit(rows)
    return df.select(*names)


def pair_key(first: Column, second: Column) -> Column:
    return F.concat_ws(" ", first.cast("string"), second.cast("string"))


def swap_key(pairs: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """(key, (first, second)) to ((first, second), key)."""
    return pairs.select(first, second, key)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks."""
    return left.subtract(right)


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of all parts by column name, repeats kept."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def known_words(words: DataFrame, vocabulary: DataFrame, key: str = "word") -> DataFrame:
    return words.join(vocabulary, key, "left_semi")


def drop_listed(words: DataFrame, listed: list[str], key: str = "word") -> DataFrame:
    """Words outside a fixed list; the list is code, not data, so broadcasting it is bounded."""
    fixed = words.sparkSession.createDataFrame([(w,) for w in listed], f"{key} string")
    return words.join(F.broadcast(fixed), key, "left_anti")
