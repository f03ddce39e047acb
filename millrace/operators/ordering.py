"""Global numbering and running totals without a one-task window.

A window with no partition key moves the whole table to one task. Here the rows are
range-sorted over all tasks and stored with their partition number; only one total per
partition is accumulated in one place, so that step is bounded by the number of partitions.
The stored copy is what makes it safe: partition numbers cannot change when a task is re-run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import new_folder

_WITHIN_PARTITION = (1 << 33) - 1  # low bits of monotonically_increasing_id


def store(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sorted_and_stored(df: DataFrame, order: list[Column]) -> DataFrame:
    placed = df.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(_WITHIN_PARTITION).alias("_place"),
    )
    return store(placed, "ordered")


def _before(per_part: DataFrame, columns: list[str]) -> DataFrame:
    """Sum of all earlier partitions; one row per partition goes in."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in columns]
    )


def number_rows(df: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Add the 0-based (or ``start``-based) position of each row in the given order."""
    stored = _sorted_and_stored(df, order)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("n"))
    return (
        stored.join(F.broadcast(_before(sizes, ["n"])), "_part")
        .withColumn(name, F.col("_before_n") + F.col("_place") + start)
        .drop("_part", "_place", "_before_n")
    )


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, str]) -> DataFrame:
    """Add running sums: ``totals`` maps the new column's name to the summed column."""
    stored = _sorted_and_stored(df, order)
    columns = list(totals.values())
    sizes = stored.groupBy("_part").agg(*[F.sum(c).alias(c) for c in columns])
    so_far = (
        Window.partitionBy("_part")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = stored.join(F.broadcast(_before(sizes, columns)), "_part")
    for name, column in totals.items():
        joined = joined.withColumn(name, F.col(f"_before_{column}") + F.sum(column).over(so_far))
    return joined.drop("_part", "_place", *[f"_before_{c}" for c in columns])
