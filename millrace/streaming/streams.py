"""A text stream filtered by a keyword, and its sentiment as the texts come.

A stream takes a set number of files per micro-batch. Where it stands is in the caller's checkpoint folder: a query
that is started again on it goes on behind the last finished batch, and a batch that was cut off is done again as it
was planned, over its own output. So rows come out once each, however often the query was stopped.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.language import SentimentModel
from millrace.session import new_folder


def text_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def keyword_stream(stream: DataFrame, keyword: str, text: str = "text") -> DataFrame:
    return stream.where(F.lower(F.col(text)).contains(keyword.lower()))


def _trigger(seconds: int | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def write_stream(stream: DataFrame, folder: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Rows to Parquet files, each exactly once; ``seconds`` polls, none drains what is there."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(seconds))
        .start(folder)
    )


def stream_sentiment(
    stream: DataFrame,
    model: SentimentModel,
    keys: list[str],
    folder: str,
    checkpoint: str,
    text: str = "text",
    seconds: int | None = None,
) -> StreamingQuery:
    """Score each micro-batch with the model's tables. A batch run twice overwrites its own
    folder, so a restart leaves no row twice."""

    def score(batch: DataFrame, batch_id: int) -> None:
        model.score(batch, keys, text).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(seconds))
        .start()
    )


def drained(query: StreamingQuery) -> None:
    """Wait until a draining stream has read everything; its failure is raised here."""
    query.awaitTermination()


def stopped_after(query: StreamingQuery, batches: int, poll: float = 0.2) -> int:
    """Stop a polling stream once it has finished ``batches`` more micro-batches with rows; gives the last one's number.

    The query may be inside its next batch by then: that one is planned in the checkpoint and done by the next start.
    """
    seen: set[int] = set()
    try:
        while len(seen) < batches and query.isActive:
            seen |= {p["batchId"] for p in query.recentProgress if p["numInputRows"] > 0}
            time.sleep(poll)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return max(seen, default=-1)


def stream_folders(spark: SparkSession) -> tuple[str, str]:
    return new_folder(spark, "stream-out"), new_folder(spark, "stream-checkpoint")
