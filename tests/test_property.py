"""Property: the bucketed engine equals the literal RANGE-window form."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from volspark.operators.metrics import STANDIN_24H, tick_metrics, tick_metrics_window

STEPS = st.sampled_from([0, 1, 59, 60, 3599, 3600, 3601, 86399, 86400, 86401, 200000])
PRICES = st.one_of(st.none(), st.sampled_from([0.0, -2.0]),
                   st.floats(min_value=0.01, max_value=1000, allow_nan=False))
ROWS = st.lists(st.tuples(STEPS, PRICES, st.integers(0, 2)), min_size=1, max_size=40)
COLS = ["log_return", "price_change_pct", "volatility_1h", "volatility_24h",
        "price_ma_1h", "price_ma_24h", *STANDIN_24H]


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 1e-9 * max(1.0, abs(b))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, keyed=st.booleans(), start=st.sampled_from([0, 86400 * 3 - 1, 7199]))
def test_engine_equals_window(spark, rows, keyed, start):
    t, data = start, []
    for i, (step, price, sym) in enumerate(rows):
        t += step
        data.append((t, price, i, sym if keyed else 0))
    df = spark.createDataFrame(data, "timestamp long, price double, seq long, symbol long")
    keys = ("symbol",) if keyed else ()
    a = {r.seq: r for r in tick_metrics(df, keys, extra=STANDIN_24H).collect()}
    b = {r.seq: r for r in tick_metrics_window(df, keys, extra=STANDIN_24H).collect()}
    assert a.keys() == b.keys()
    for k in b:
        for c in COLS:
            assert same(a[k][c], b[k][c]), (k, c, a[k][c], b[k][c], data)
