"""Scalar column functions (P2-P4, P6-P8, P14, N2-N5 rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ts) -> Column:
    """Epoch seconds (long) -> timestamp."""
    return F.timestamp_seconds(as_col(ts))


def event_date(ts) -> Column:
    """Timestamp -> date (session zone, UTC by contract)."""
    return F.to_date(as_col(ts))


def hour_of_day(ts) -> Column:
    """Timestamp -> 0..23 (UTC), as BIGINT."""
    return F.hour(as_col(ts)).cast("bigint")


def iso_datetime(ts) -> Column:
    """Timestamp -> ISO-8601 text with a ``Z`` suffix, second resolution."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def log_return(price, prev) -> Column:
    """ln(price/prev) when prev > 0, else 0.0.

    When prev > 0 but the current price is 0, negative or null the result is
    NULL (the logarithm is undefined), not 0.0.
    """
    p, q = as_col(price), as_col(prev)
    return (F.when(q.isNotNull() & (q > 0),
                   F.when(p > 0, F.log(p / q)))
            .otherwise(F.lit(0.0)))


def change_pct(price, prev) -> Column:
    """(price - prev) / prev * 100 when prev > 0, else 0.0."""
    p, q = as_col(price), as_col(prev)
    return (F.when(q.isNotNull() & (q > 0), (p - q) / q * 100.0)
            .otherwise(F.lit(0.0)))


def sample_stddev(n, s, q) -> Column:
    """Sample standard deviation from count, sum and sum of squares.

    NULL for fewer than two values (like ``stddev_samp``); tiny negative
    variances from rounding are clamped to zero.
    """
    n, s, q = as_col(n), as_col(s), as_col(q)
    var = (q - s * s / n) / (n - 1)
    return F.when(n >= 2, F.sqrt(F.greatest(var, F.lit(0.0))))


def quote_value(field) -> Column:
    """Quote field text to double; missing, null and non-numeric become 0.0."""
    return F.coalesce(as_col(field).try_cast("double"), F.lit(0.0))


def round6(c) -> Column:
    """Comparison rounding for metrics: round(x + 1e-9, 6), no negative zero."""
    return F.round(as_col(c) + F.lit(1e-9), 6) + F.lit(0.0)


def round2(c) -> Column:
    """Comparison rounding for sums."""
    return F.round(as_col(c), 2) + F.lit(0.0)


# --- P14 KPI formatting -------------------------------------------------------

def money(c) -> Column:
    """``$#,##0.00``; NULL stays NULL (the reference shows the price always)."""
    c = as_col(c)
    return F.when(c.isNotNull(),
                  F.concat(F.when(c < 0, F.lit("-$")).otherwise(F.lit("$")),
                           F.format_number(F.abs(c), 2)))


def money0(c) -> Column:
    """``$#,##0`` or ``N/A`` on null."""
    c = as_col(c)
    return F.coalesce(
        F.when(c.isNotNull(),
               F.concat(F.when(c < 0, F.lit("-$")).otherwise(F.lit("$")),
                        F.format_number(F.abs(c), 0))),
        F.lit("N/A"))


def fixed6(c) -> Column:
    """Six decimals without grouping, or ``N/A`` on null."""
    c = as_col(c)
    # format_string renders NULL as the text "null": test for null first
    return F.coalesce(F.when(c.isNotNull(), F.format_string("%.6f", c)), F.lit("N/A"))


def display_time(iso_text) -> Column:
    """ISO datetime text (``...Z``) -> ``yyyy-MM-dd HH:mm:ss``, ``N/A`` when it is not one."""
    t = F.try_to_timestamp(F.regexp_replace(as_col(iso_text), "Z$", ""))
    return F.coalesce(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit("N/A"))
