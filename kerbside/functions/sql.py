"""SQL functions for queries over the registered views. They are SQL expressions, which Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from kerbside.functions.time import BUCKET_ORIGIN_SECONDS

_SECONDS = "(unix_date(CAST({t} AS DATE)) * 86400L + hour({t}) * 3600 + minute({t}) * 60 + second({t}))"
_WIDTH = """(extract(DAY FROM width) * 86400L + extract(HOUR FROM width) * 3600
    + extract(MINUTE FROM width) * 60 + CAST(extract(SECOND FROM width) AS INT))"""
_SINCE = f"({_SECONDS.format(t='ts')} - {BUCKET_ORIGIN_SECONDS}L)"

FUNCTIONS = {
    # Text of a time by a pattern of %Y, %m, %d, %H, %M, %S and %%; other directives fail, other letters stand for themselves.
    "strftime": """(ts TIMESTAMP_NTZ, pattern STRING) RETURNS STRING RETURN if(
        regexp_like(pattern, '%([^YmdHMS%]|$)') AND NOT regexp_like(pattern, '^([^%]|%[YmdHMS%])*$'),
        raise_error(concat('unknown directive in ', pattern)),
        array_join(transform(regexp_extract_all(pattern, '(%[YmdHMS%]|[^%]+)', 1), part -> CASE part
          WHEN '%Y' THEN date_format(ts, 'yyyy') WHEN '%m' THEN date_format(ts, 'MM') WHEN '%d' THEN date_format(ts, 'dd')
          WHEN '%H' THEN date_format(ts, 'HH') WHEN '%M' THEN date_format(ts, 'mm') WHEN '%S' THEN date_format(ts, 'ss')
          WHEN '%%' THEN '%' ELSE part END), ''))""",
    # Start of the fixed bucket that holds a time.
    "time_bucket": f"""(width INTERVAL DAY TO SECOND, ts TIMESTAMP_NTZ) RETURNS TIMESTAMP_NTZ RETURN
        TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0,
        {BUCKET_ORIGIN_SECONDS}L + {_SINCE} - pmod({_SINCE}, {_WIDTH}))""",
    # Full hours of the clock crossed between two times.
    "hour_boundaries": """(a TIMESTAMP_NTZ, b TIMESTAMP_NTZ) RETURNS BIGINT RETURN
        datediff(CAST(b AS DATE), CAST(a AS DATE)) * 24L + hour(b) - hour(a)""",
    # Two decimals, scaled first.
    "round2": "(x DOUBLE) RETURNS DOUBLE RETURN round(x * 100D, 0) / 100D",
}


def register_functions(spark: SparkSession) -> None:
    """Make the functions known to this session."""
    for name, definition in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition}")
