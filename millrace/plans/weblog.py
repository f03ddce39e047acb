"""Log analytics over the lines rendered from ``events``."""

from pyspark.sql import functions as F

from millrace.functions.logs import log_size, log_time
from millrace.operators import aggregates as agg
from millrace.operators import weblog
from millrace.operators.relational import set_difference
from millrace.plans.inputs import SQL_LOG, log_lines, logs, parsed_logs
from millrace.plans.registry import query


@query("parse_access_log", f"""
WITH {SQL_LOG}
SELECT host, '-' AS client_identd, '-' AS user_id, date_time, 'GET' AS method, endpoint,
       'HTTP/1.0' AS protocol, response_code, content_size, TRUE AS ok
FROM log
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, -1, -1, FALSE FROM events WHERE event_id % 97 = 0
""")
def parse_access_log(t):
    return parsed_logs(t).drop("line").fillna(-1, ["response_code", "content_size"])


@query("parse_report", """
SELECT count(*) AS n_lines, count(*) FILTER (event_id % 97 <> 0) AS n_parsed,
       count(*) FILTER (event_id % 97 = 0) AS n_failed FROM events
""")
def parse_report(t):
    return weblog.parse_report(parsed_logs(t))


_FAILED = """
failed AS (
  SELECT 'u' || user_id || '.example.com - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] GET /p/'
         || regexp_extract(props, '(\\d+)', 1) || '.html HTTP/1.0 '
         || CASE event_type WHEN 'error' THEN '404' WHEN 'click' THEN '302' WHEN 'signup' THEN '304' ELSE '200' END || ' '
         || CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(CAST(trunc(value * 100) AS BIGINT) AS VARCHAR) END AS line
  FROM events WHERE event_id % 97 = 0)
"""


@query("parse_failures", f"""
WITH {_FAILED}, n AS (SELECT count(*) FILTER (event_id % 97 <> 0) AS n_parsed, count(*) FILTER (event_id % 97 = 0) AS n_failed FROM events)
SELECT 'failed' AS status, n_failed AS n, place, line FROM n,
  (SELECT line, row_number() OVER (ORDER BY encode(line)) AS place FROM failed) WHERE place <= 20
UNION ALL SELECT 'parsed', n_parsed, 0, '' FROM n
""")
def parse_failures(t):
    """Lines parsed and failed, with the first twenty that failed."""
    return weblog.failure_report(parsed_logs(t), 20).fillna({"place": 0, "line": ""})


@query("filter_status", f"WITH {SQL_LOG} SELECT host, endpoint, response_code FROM log WHERE response_code <> 200")
def filter_status(t):
    return weblog.not_ok(logs(t)).select("host", "endpoint", "response_code")


@query("count_by_key", f"WITH {SQL_LOG} SELECT response_code, count(*) AS n FROM log GROUP BY 1")
def count_by_key(t):
    return agg.count_by_key(logs(t), "response_code")


@query("global_count", f"WITH {SQL_LOG} SELECT count(*) AS n FROM log")
def global_count(t):
    return logs(t).agg(F.count("*").alias("n"))


@query("distinct_values", f"WITH {SQL_LOG} SELECT DISTINCT endpoint FROM log WHERE response_code = 404")
def distinct_values(t):
    return weblog.with_status(logs(t), 404).select("endpoint").distinct()


@query("count_distinct", f"WITH {SQL_LOG} SELECT count(DISTINCT host) AS n_hosts FROM log")
def count_distinct(t):
    return logs(t).agg(F.countDistinct("host").alias("n_hosts"))


@query("distinct_by_group", f"""
WITH {SQL_LOG} SELECT CAST(day(date_time) AS INTEGER) AS day, count(DISTINCT host) AS n_hosts FROM log GROUP BY 1
""")
def distinct_by_group(t):
    return agg.distinct_by_group(weblog.with_day(logs(t)), "day", "host", "n_hosts")


@query("size_stats", f"""
WITH {SQL_LOG}
SELECT CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size, min(content_size) AS min_size,
       max(content_size) AS max_size FROM log
""")
def size_stats(t):
    return weblog.size_stats(logs(t))


@query("requests_per_host_day", f"""
WITH {SQL_LOG}
SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) // count(DISTINCT host) AS requests_per_host FROM log GROUP BY 1
""")
def requests_per_host_day(t):
    return weblog.requests_per_host_day(logs(t))


@query("share_of_total", f"""
WITH {SQL_LOG}
SELECT response_code, count(*) AS n, round(count(*) / (SELECT count(*) FROM log), 9) AS share
FROM log GROUP BY 1
""")
def share_of_total(t):
    return agg.share_of_total(logs(t), "response_code").withColumn("share", F.round("share", 9))


@query("share_label", f"""
WITH {SQL_LOG}, s AS (
  SELECT response_code, 100.0 * count(*) / (SELECT count(*) FROM log) AS pct FROM log GROUP BY 1)
SELECT response_code, CASE WHEN pct < 7 THEN '' ELSE format('{{:.0f}}%', pct::DOUBLE) END AS label FROM s
""")
def share_label(t):
    from millrace.functions.numbers import share_label as label

    shares = agg.share_of_total(logs(t), "response_code")
    return shares.select("response_code", label(F.col("share") * 100).alias("label"))


def _top_sql(key, k, where="TRUE"):
    return f"""
WITH {SQL_LOG}
SELECT {key}, count(*) AS n FROM log WHERE {where} GROUP BY 1 ORDER BY n DESC, 1 LIMIT {k}
"""


def _top(frame, key, k):
    return agg.top_k(agg.count_by_key(frame, key), k, "n", key)


@query("top_endpoints", _top_sql("endpoint", 10))
def top_endpoints(t):
    return _top(logs(t), "endpoint", 10)


@query("top_error_endpoints", _top_sql("endpoint", 10, "response_code <> 200"))
def top_error_endpoints(t):
    return _top(weblog.not_ok(logs(t)), "endpoint", 10)


@query("top_404_endpoints", _top_sql("endpoint", 20, "response_code = 404"))
def top_404_endpoints(t):
    return _top(weblog.with_status(logs(t), 404), "endpoint", 20)


@query("top_404_hosts", _top_sql("host", 25, "response_code = 404"))
def top_404_hosts(t):
    return _top(weblog.with_status(logs(t), 404), "host", 25)


@query("top_404_days", f"""
WITH {SQL_LOG} SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n FROM log WHERE response_code = 404
GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5
""")
def top_404_days(t):
    return _top(weblog.with_day(weblog.with_status(logs(t), 404)), "day", 5)


@query("sort_by_key", f"""
WITH {SQL_LOG} SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n FROM log GROUP BY 1 ORDER BY 1
""")
def sort_by_key(t):
    return agg.count_by_key(weblog.with_day(logs(t)), "day").orderBy("day")


@query("errors_by_day", f"""
WITH {SQL_LOG} SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n FROM log WHERE response_code = 404
GROUP BY 1 ORDER BY 1
""")
def errors_by_day(t):
    return agg.count_by_key(weblog.with_day(weblog.with_status(logs(t), 404)), "day").orderBy("day")


@query("errors_by_hour", f"""
WITH {SQL_LOG} SELECT CAST(hour(date_time) AS INTEGER) AS hour, count(*) AS n FROM log WHERE response_code = 404
GROUP BY 1 ORDER BY 1
""")
def errors_by_hour(t):
    return agg.count_by_key(weblog.with_hour(weblog.with_status(logs(t), 404)), "hour").orderBy("hour")


@query("frequent_hosts", f"""
WITH {SQL_LOG} SELECT host, count(*) AS n FROM log GROUP BY 1 HAVING count(*) > 10
""")
def frequent_hosts(t):
    return agg.frequent(logs(t), "host", 10)


@query("take_n", f"""
WITH {SQL_LOG} SELECT host FROM log GROUP BY 1 HAVING count(*) > 10 ORDER BY 1 LIMIT 20
""")
def take_n(t):
    return agg.frequent(logs(t), "host", 10).select("host").orderBy("host").limit(20)


@query("set_difference", f"""
WITH {SQL_LOG}
SELECT DISTINCT endpoint FROM log WHERE response_code = 404 AND hour(date_time) = 3
EXCEPT SELECT endpoint FROM log WHERE response_code = 200 AND hour(date_time) = 4
""")
def set_difference_query(t):
    by_hour = weblog.with_hour(logs(t))
    missing = by_hour.where("response_code = 404 and hour = 3").select("endpoint")
    found = by_hour.where("response_code = 200 and hour = 4").select("endpoint")
    return set_difference(missing, found)


@query("log_time", "SELECT event_id, date_trunc('second', ts) AS date_time FROM events")
def log_time_query(t):
    text = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    return t.events.select("event_id", log_time(F.concat(text, F.lit(" -0400"))).alias("date_time"))


@query("log_size", """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 0 ELSE CAST(trunc(value * 100) AS BIGINT) END AS size
FROM events
""")
def log_size_query(t):
    raw = F.when(F.col("event_id") % 11 == 0, "-").otherwise(
        (F.col("value") * 100).cast("bigint").cast("string")
    )
    return t.events.select("event_id", log_size(raw).alias("size"))


@query("day_hour_parts", "SELECT event_id, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events")
def day_hour_parts(t):
    return t.events.select("event_id", F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"))


@query("group_values", "SELECT event_type, value, count(*) AS repeats FROM events GROUP BY 1, 2")
def group_values(t):
    return agg.group_values(t.events, "event_type", "value")


@query("sum_grouped", "SELECT event_type, round(sum(value), 4) AS total FROM events GROUP BY 1")
def sum_grouped(t):
    grouped = agg.group_values(t.events, "event_type", "value")
    return agg.sum_grouped(grouped, "event_type", "value", "total").withColumn(
        "total", F.round("total", 4)
    )
