"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.operators.ordering import store  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int | None = None) -> DataFrame:
    """``fn`` on each Arrow batch, or on its slices of at most ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = rows or max(batch.num_rows, 1)
            for start in range(0, batch.num_rows, step):
                if (out := fn(batch.slice(start, step))) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """Strings of a column, null as empty."""
    return [x or "" for x in column.to_pylist()]
