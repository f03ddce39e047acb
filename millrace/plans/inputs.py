"""The jobs' inputs, derived from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import hash_bucket, hash_number
from millrace.operators.weblog import parse_access_log, valid_logs
from millrace.operators.words import record_tokens
from millrace.plans.registry import Tables


def log_lines(t: Tables) -> DataFrame:
    """One Common Log Format line per event; some sizes are '-', some lines miss their quotes."""
    code = (
        F.when(F.col("event_type") == "error", "404")
        .when(F.col("event_type") == "click", "302")
        .when(F.col("event_type") == "signup", "304")
        .otherwise("200")
    )
    size = F.when(F.col("event_id") % 11 == 0, "-").otherwise(
        (F.col("value") * 100).cast("bigint").cast("string")
    )
    request = F.concat(
        F.lit("GET /p/"), F.regexp_extract("props", r"(\d+)", 1), F.lit(".html HTTP/1.0")
    )
    quoted = F.when(F.col("event_id") % 97 == 0, request).otherwise(
        F.concat(F.lit('"'), request, F.lit('"'))
    )
    return t.events.select(
        F.concat_ws(
            " ",
            F.concat(F.lit("u"), F.col("user_id"), F.lit(".example.com")),
            F.lit("-"),
            F.lit("-"),
            F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" -0400]")),
            quoted,
            code,
            size,
        ).alias("value")
    )


def parsed_logs(t: Tables) -> DataFrame:
    return parse_access_log(log_lines(t))


def logs(t: Tables) -> DataFrame:
    return valid_logs(parsed_logs(t))


# The same log as columns of ``events``, for SQL that does not repeat the parsing.
SQL_LOG = """
log AS (
  SELECT event_id, 'u' || user_id || '.example.com' AS host, date_trunc('second', ts) AS date_time,
         '/p/' || regexp_extract(props, '(\\d+)', 1) || '.html' AS endpoint,
         CASE event_type WHEN 'error' THEN 404 WHEN 'click' THEN 302 WHEN 'signup' THEN 304
              ELSE 200 END AS response_code,
         CASE WHEN event_id % 11 = 0 THEN 0 ELSE CAST(trunc(value * 100) AS BIGINT) END AS content_size
  FROM events WHERE event_id % 97 <> 0)
"""


# The catalogue's documents come in two sides by their source.
SIDE = "CASE WHEN source < 'src2' THEN 'a' ELSE 'b' END"


def records(t: Tables) -> DataFrame:
    """(doc_id, side, gold_key, tokens) of all documents; the same key on both sides marks a
    known duplicate."""
    return record_tokens(t.documents.select(
        "doc_id", "text", F.expr(SIDE).alias("side"), F.md5(F.lower(F.trim("text"))).alias("gold_key")
    ))


def scored(t: Tables) -> DataFrame:
    """Labels with a score in [0, 1] that leans towards the label, in two named sets."""
    mixed = (hash_number(11, "doc_id") % 6501 + F.col("quality") * 3500) / 10000
    return t.labels.select(
        "doc_id",
        F.when(hash_bucket(5, 10, "doc_id") < 2, "testing").otherwise("training").alias("dataset"),
        F.col("quality").alias("y"),
        mixed.alias("score"),
        (mixed >= 0.5).cast("int").alias("p"),
    )


def sql_hash(seed: int | str, key: str) -> str:
    """``hash_number`` in DuckDB."""
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


SQL_SCORED = f"""
scored AS (
  SELECT doc_id, CASE WHEN {sql_hash(5, 'doc_id')} % 10 < 2 THEN 'testing' ELSE 'training' END AS dataset,
         quality AS y, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p
  FROM (SELECT *, CAST({sql_hash(11, 'doc_id')} % 6501 + quality * 3500 AS DOUBLE) / 10000 AS score
        FROM labels))
"""

CHURN_FEATURES = "n_view n_click n_error n_signup mean_value max_value".split()
CHURN_BOUND = 200.0


def churn(t: Tables) -> DataFrame:
    """One row per user: activity counts, mean and largest value; the label says whether any
    purchase went above a fixed bound."""
    counts = [
        F.count_if(F.col("event_type") == kind).cast("double").alias(f"n_{kind}")
        for kind in ("view", "click", "error", "signup")
    ]
    high = (F.col("event_type") == "purchase") & (F.col("value") > CHURN_BOUND)
    return t.events.groupBy("user_id").agg(
        *counts,
        F.avg("value").alias("mean_value"),
        F.max("value").alias("max_value"),
        F.max(high.cast("int")).alias("label"),
    )


SQL_CHURN = f"""
churn AS (
  SELECT user_id,
         CAST(count(*) FILTER (event_type = 'view') AS DOUBLE) AS n_view,
         CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) AS n_click,
         CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) AS n_error,
         CAST(count(*) FILTER (event_type = 'signup') AS DOUBLE) AS n_signup,
         avg(value) AS mean_value, max(value) AS max_value,
         max(CASE WHEN event_type = 'purchase' AND value > {CHURN_BOUND} THEN 1 ELSE 0 END) AS label
  FROM events GROUP BY user_id)
"""

SQL_TOKENS = "list_filter(regexp_split_to_array(lower({c}), '\\W+'), lambda x: x <> '')"
