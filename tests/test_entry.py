"""Driver contract: entry runs, every analytics query has a name-matched oracle."""

import __spark_entry__ as E
from volspark.plans import queries as analytics


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_price" in df.columns and "record_count" in df.columns


def test_every_analytics_query_has_an_oracle():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert set(analytics.registry()) <= set(sql)


def test_small_queries_run_at_smoke_scale(spark):
    from conftest import SF
    q = E.queries()
    for name in ("candle_hour", "latest_n", "quote_flatten", "tick_serialize", "feed_health"):
        assert q[name](spark, SF).count() > 0, name
