"""Column expressions (all built-in Spark functions, JVM-side, codegen'd)."""

from volspark.functions.columns import (  # noqa: F401
    as_col,
    change_pct,
    event_date,
    event_time,
    hour_of_day,
    iso_datetime,
    log_return,
    money,
    money0,
    fixed6,
    display_time,
    quote_value,
    round6,
    round2,
    sample_stddev,
)
