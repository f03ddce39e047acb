"""Counting and summing per key. All of it is partial aggregation, one shuffle, final aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by_key(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def group_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """The values of each key, repeats as a number.

    A list per key would put a hot key's rows in one task and one row. The group stays
    a set of rows ``(key, value, repeats)``, combined before the shuffle.
    """
    return df.groupBy(key, value).agg(F.count("*").alias("repeats"))


def sum_grouped(grouped: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sum over the groups that ``group_values`` made."""
    return grouped.groupBy(key).agg(F.sum(F.col(value) * F.col("repeats")).alias(name))


def top_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The k rows of largest ``by``, ties by key: a bounded heap per task, no global sort."""
    return df.orderBy(F.desc(by), *[F.asc(t) for t in ties]).limit(k)


def bottom_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.asc(by), *[F.asc(t) for t in ties]).limit(k)


def frequent(df: DataFrame, key: str, more_than: int) -> DataFrame:
    return count_by_key(df, key).where(F.col("n") > more_than)


def distinct_by_group(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Distinct values per group. Spark dedupes (group, value) before it counts per group, so a hot
    group is spread over tasks by its values."""
    return df.groupBy(group).agg(F.countDistinct(value).alias(name))


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Each key's count and its fraction of all rows."""
    counts = count_by_key(df, key)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the least and the largest value, empty bins shown."""
    spread = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = spread.getField("lo"), spread.getField("hi")
    place = F.when(hi > lo, F.floor((F.col(value) - lo) / (hi - lo) * bins)).otherwise(0)
    counts = (
        df.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """(table, column, ordinal, n_rows, n_filled, n_distinct), one row per column: plain counts in one row, distinct
    values by 16-byte hashes."""
    return _filled(df, table).join(distinct_values(df, table), ["table", "ordinal"]).select(
        "table", "column", "ordinal", "n_rows", "n_filled", "n_distinct"
    )


def distinct_values(df: DataFrame, table: str) -> DataFrame:
    """(table, ordinal, n_distinct) of every column, exact.

    What is shuffled is a column's number and 16 bytes of md5 per distinct value of a task: no text. A hot
    value is combined before the shuffle and a column with many values spreads over them.
    """
    cells = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.unhex(F.md5(_as_text(F.col(f.name), f.dataType))).alias("value"))
        for i, f in enumerate(df.schema.fields, 1)
    ])
    found = df.select(F.explode(cells).alias("c")).select("c.*").where("value is not null").distinct()
    counted = found.groupBy("ordinal").agg(F.count("*").alias("n"))
    names = _ordinals(df)
    return names.join(counted, "ordinal", "left").select(
        F.lit(table).alias("table"), "ordinal", F.coalesce("n", F.lit(0)).alias("n_distinct")
    )


def column_sketches(df: DataFrame, table: str, log2_buckets: int = 12) -> DataFrame:
    """(table, column, ordinal, n_rows, n_filled, estimate, sketch): counts and sketches in one scan that shuffles one
    row per task.

    The HyperLogLog sketches of several tables or days merge with ``hll_union``. Their standard error is
    1.04 / sqrt(2 ^ log2_buckets), 1.6 % at 12.
    """
    cells = [
        F.struct(
            F.count(F.col(f.name)).alias("n_filled"),
            F.hll_sketch_agg(F.unhex(F.md5(_as_text(F.col(f.name), f.dataType))), log2_buckets).alias("sketch"),
        )
        for f in df.schema.fields
    ]
    counts = df.agg(F.count("*").alias("n_rows"), F.array(*cells).alias("cells"))
    each = counts.select("n_rows", F.posexplode("cells").alias("place", "c"))
    return each.join(_ordinals(df), F.col("place") + 1 == F.col("ordinal")).select(
        F.lit(table).alias("table"), "column", "ordinal", "n_rows", "c.n_filled",
        F.hll_sketch_estimate("c.sketch").alias("estimate"), "c.sketch",
    )


def _ordinals(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(df.columns, 1)], "ordinal int, column string")


def _filled(df: DataFrame, table: str) -> DataFrame:
    """(table, ordinal, column, n_rows, n_filled): rows and non-null values."""
    counts = df.agg(F.count("*").alias("n"), F.array(*[F.count(F.col(c)) for c in df.columns]).alias("filled"))
    each = counts.select("n", F.posexplode("filled").alias("place", "n_filled"))
    return each.join(_ordinals(df), F.col("place") + 1 == F.col("ordinal")).select(
        F.lit(table).alias("table"), "ordinal", "column", F.col("n").alias("n_rows"), "n_filled"
    )


def _as_text(c: Column, data_type) -> Column:
    kind = data_type.typeName()
    return F.to_json(c) if kind in ("array", "map", "struct") else c.cast("string")
