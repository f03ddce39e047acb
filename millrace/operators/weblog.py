"""Web-server log analytics with a reject path."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.logs import LOG_FIELDS, log_parts, log_size, log_time
from millrace.operators.ordering import store


def parse_access_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """All lines with their nine fields and ``ok``: false where the line, its time or its size
    cannot be read. One pass, nothing is thrown away."""
    # explode of one item: filters on the fields stay above it, so the pattern runs once per line
    parts = lines.select(F.col(line).alias("line"), F.explode(F.array(log_parts(F.col(line)))).alias("p"))
    matched = F.size("p") == len(LOG_FIELDS)
    raw = parts.select("line", matched.alias("matched"), *[
        F.when(matched, F.col("p")[i]).alias(name) for i, name in enumerate(LOG_FIELDS)
    ])
    typed = raw.withColumns({
        "date_time": log_time(F.col("date_time")),
        "response_code": F.col("response_code").try_cast("int"),
        "content_size": log_size(F.col("content_size")),
    })
    ok = F.col("matched") & F.col("date_time").isNotNull() & F.col("content_size").isNotNull()
    return typed.withColumn("ok", ok).drop("matched")


def valid_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where("ok").select(*LOG_FIELDS)


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("ok")).select("line")


def parse_report(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count("*").alias("n_lines"),
        F.count_if("ok").alias("n_parsed"),
        F.count_if(~F.col("ok")).alias("n_failed"),
    )


def failure_report(parsed: DataFrame, n: int = 20, line: str = "line") -> DataFrame:
    """(status, n, place, line): lines parsed and failed, and the first ``n`` failed lines in order of their text.

    The lines are read and parsed once. Each task counts its own and keeps its n least failed lines; what leaves a
    task is a row per status, and a batch of failed lines is the most that is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, least = {"parsed": 0, "failed": 0}, []
        for batch in batches:
            failed = batch.column(1).drop_null().to_pylist()
            counts["failed"] += len(failed)
            counts["parsed"] += batch.num_rows - len(failed)
            # as bytes, the order Spark sorts strings in
            least = heapq.nsmallest(n, least + failed, key=str.encode)
        yield pa.RecordBatch.from_pylist(
            [{"status": s, "n": c, "sample": least if s == "failed" else []} for s, c in counts.items()],
            pa.schema([("status", pa.string()), ("n", pa.int64()), ("sample", pa.list_(pa.string()))]),
        )

    narrow = parsed.select("ok", F.when(~F.col("ok"), F.coalesce(line, F.lit(""))).alias("failed"))
    # stored: small, and read once for the counts and once for the lines
    parts = store(narrow.mapInArrow(run, "status string, n long, sample array<string>"), "parse-report")
    counts = parts.groupBy("status").agg(F.sum("n").alias("n"))
    first = parts.select("status", F.explode("sample").alias("line")).orderBy("line").limit(n)
    placed = first.select("status", "line", F.row_number().over(Window.orderBy("line")).cast("long").alias("place"))
    return counts.join(placed, "status", "left").select("status", "n", "place", "line")


def with_status(logs: DataFrame, code: int) -> DataFrame:
    return logs.where(F.col("response_code") == code)


def not_ok(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("response_code") != 200)


def with_day(logs: DataFrame) -> DataFrame:
    return logs.withColumn("day", F.dayofmonth("date_time"))


def with_hour(logs: DataFrame) -> DataFrame:
    return logs.withColumn("hour", F.hour("date_time"))


def size_stats(logs: DataFrame) -> DataFrame:
    """Average (whole number), least and largest content size."""
    return logs.agg(
        F.expr("sum(content_size) div count(content_size)").alias("avg_size"),
        F.min("content_size").alias("min_size"),
        F.max("content_size").alias("max_size"),
    )


def requests_per_host_day(logs: DataFrame) -> DataFrame:
    """Requests per distinct host for each day, whole-number division."""
    return with_day(logs).groupBy("day").agg(
        F.expr("count(*) div count(distinct host)").alias("requests_per_host")
    )
