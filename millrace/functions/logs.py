"""Column functions over web-server log lines in the Common Log Format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The nine fields of a log line, in their order, and the line's pattern.
LOG_FIELDS = (
    "host client_identd user_id date_time method endpoint protocol response_code content_size"
).split()
LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(.*?)" (\d{3}) (\S+)'
)
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def log_parts(line: Column) -> Column:
    """The nine raw fields as an array; another length means the line does not match.

    The pattern runs once per line: it rewrites the line to its fields with a newline between
    them, which no field can hold, and the split takes them apart.
    """
    fields = "\n".join(f"${i}" for i in range(1, 10))
    return F.split(F.regexp_replace(line, LOG_PATTERN + r".*$", fields), "\n")


def log_time(c: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss`` to a zone-free timestamp, null when it is no date."""

    def number(start: int, length: int) -> Column:
        return F.substring(c, start, length).try_cast("int")

    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(c, 4, 3))
    month = F.when(month > 0, month.cast("int"))
    return F.try_make_timestamp_ntz(
        number(8, 4), month, number(1, 2), number(13, 2), number(16, 2), number(19, 2)
    )


def log_size(c: Column) -> Column:
    """``-`` counts as 0 bytes; anything else not a number is null."""
    return F.when(c == "-", F.lit(0).cast("bigint")).otherwise(c.try_cast("bigint"))
