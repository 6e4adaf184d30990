"""Access logs in the common log format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.binding import computed_once

# Fixed value: the nine fields of a log line. Anchored at the start only.
CLF_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'
)

# Fixed value: the month names of the format.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

FIELDS = (
    "host", "client_id", "user_id", "date_time", "method", "endpoint", "protocol", "status", "size",
)

_SEPARATOR = "\n"  # never part of a line


def clf_time(text: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss zone`` to a wall-clock time, null if impossible.

    The zone is ignored and the session's time zone plays no part.
    """
    month = F.create_map(*[F.lit(x) for i, name in enumerate(MONTHS, 1) for x in (name, i)])

    def number(start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    return F.try_make_timestamp_ntz(
        number(8, 4),
        F.try_element_at(month, F.substring(text, 4, 3)),
        number(1, 2),
        number(13, 2),
        number(16, 2),
        number(19, 2),
    )


def clf_size(text: Column) -> Column:
    """Content size in bytes; ``-`` means 0, other text that is no number gives null."""
    exact = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
    return F.when(text == "-", F.lit(0).cast("bigint")).otherwise(exact)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add the nine fields and ``ok`` to a table of raw lines.

    One replacement turns a matching line into its groups, so the pattern runs
    once per line and not once per field, and a filter on a field reads the
    finished column. A line counts as bad when it does not match, names no real
    time, or has a size that is no number; its fields are then null.
    """
    groups = _SEPARATOR.join(f"${i}" for i in range(1, 10))
    pieces = F.split(F.regexp_replace(F.col(line), f"(?s){CLF_PATTERN}.*", groups), _SEPARATOR)
    split = computed_once(lines, _pieces=pieces)
    text = {
        name: F.try_element_at("_pieces", F.lit(i)) for i, name in enumerate(FIELDS, 1)
    }
    typed = {
        **text,
        "date_time": clf_time(text["date_time"]),
        "status": text["status"].try_cast("int"),
        "size": clf_size(text["size"]),
    }
    bound = computed_once(
        split,
        lines.columns,
        _matched=F.coalesce(F.size("_pieces") == len(FIELDS), F.lit(False)),
        **{f"_{name}": column for name, column in typed.items()},
    )
    ok = F.col("_matched") & F.col("_date_time").isNotNull() & F.col("_size").isNotNull()
    return bound.select(
        *lines.columns, ok.alias("ok"), *[F.when(ok, F.col(f"_{name}")).alias(name) for name in FIELDS]
    )


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """Text files of log lines, parsed: columns ``line``, ``ok`` and the nine fields."""
    return parse_lines(spark.read.text(path).withColumnRenamed("value", "line"))


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter("ok").select(*[c for c in parsed.columns if c not in ("line", "ok")])


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("ok")).select(*[c for c in parsed.columns if c not in (*FIELDS, "ok")])


def parse_report(parsed: DataFrame) -> DataFrame:
    """One row: lines read, lines parsed, lines failed; one pass over the data."""
    return parsed.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("ok").alias("n_parsed"),
        F.count_if(~F.col("ok")).alias("n_failed"),
    )
