"""Day partials: merged statistics, the exact threshold from stored sketches, reads of new dates only."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from volspark import sinks
from volspark.operators import analysis as A
from volspark.operators import partials as P
from volspark.operators.quantile import quantile_disc
from volspark.plans.jobs import incremental_analysis
from volspark.session import scratch_path
from volspark.sources.files import read_history

COLUMNS = ("event_time timestamp, date date, datetime string, price double, volatility_1h double, "
           "volatility_24h double, volume24h double, high24h double, low24h double")


def history(spark, days, n=150, seed=1, offset=0.0):
    """``n`` rows a day; volatility grows with the day, with nulls and many equal values."""
    rng = random.Random(seed)
    rows = []
    for d in days:
        for _ in range(n):
            t = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d, seconds=rng.randrange(86400))
            v = rng.choice([None, 1e9 + d, 1e9 + d + rng.random(), 1e9 + 3.0]) if d % 7 else None
            rows.append((t, t.date(), str(t), rng.choice([None, rng.uniform(1, 9)]), rng.choice([None, rng.random()]),
                         v if v is None else v + offset, 1.0, 2.0, 0.5))
    return spark.createDataFrame(rows, COLUMNS)


def close(got, want, key):
    got, want = ({r[key]: r.asDict() for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for k, row in want.items():
        assert got[k].keys() == row.keys()
        for c, x in row.items():
            assert got[k][c] == (pytest.approx(x, rel=1e-9, abs=1e-6) if isinstance(x, float) else x), (k, c)


def test_partials_give_the_batch_results(spark):
    df = history(spark, range(15)).persist()
    partials = P.day_partials(df).persist()
    assert partials.count() <= 15 * 24
    # values of 1e9 that differ by less than 1: a difference of sums of squares would lose the spread
    close(P.daily_stats(partials), A.daily_stats(df), "date")
    close(P.hourly_pattern(partials), A.hourly_pattern(df), "hour_of_day")


@pytest.mark.parametrize("q", [0.0, 0.005, 0.5, 0.9, 0.99, 1.0])
def test_the_threshold_is_exact_and_reads_the_dates_of_the_band(spark, q):
    df = history(spark, range(40), 60)
    got = P.spike_threshold(df, P.day_partials(df), q).first().quantile
    assert got == quantile_disc(df, "volatility_24h", q).first().quantile
    band = P.threshold_band(P.day_partials(df), q).first()
    dates, _ = P.band_dates(P.day_partials(df), band.lo, band.hi)
    if q > 0.5:             # all days have some low values; high ones only the last days
        assert dates.count() < 20


def test_no_values(spark):
    df = history(spark, [0, 7], 20)                     # volatility is null on these days
    assert P.spike_threshold(df, P.day_partials(df), 0.99).first().quantile is None
    empty = df.where("false")
    assert P.daily_stats(P.day_partials(empty)).collect() == []
    assert P.spike_threshold(empty, P.day_partials(empty), 0.99).first().quantile is None


def test_a_band_that_misses_the_rank_fails_loudly(spark):
    df = history(spark, range(1, 4))
    n = df.where("volatility_24h is not null").count()
    for band, below in (((n, 0.0, 1.0), 0), ((n, 2e9, 3e9), 0), ((n, 1e9, 2e9), n)):
        with pytest.raises(Exception, match="missed rank"):
            quantile_disc(df, "volatility_24h", 0.5, band=band, below=below).collect()


def test_only_new_and_changed_dates_are_read(spark):
    hist, state, out_dir = (scratch_path(spark, n) for n in ("hist", "state", "out"))
    sinks.write_history(history(spark, range(10)), hist)
    incremental_analysis(spark, hist, state, out_dir)

    def written():
        return {d: sorted(os.stat(os.path.join(state, d, f)).st_mtime_ns for f in os.listdir(os.path.join(state, d)))
                for d in os.listdir(state) if d.startswith("date=")}

    before = written()
    sinks.write_history(history(spark, [10]), hist)
    sinks.write_history(history(spark, [4], seed=9, offset=50.0), hist)        # written anew
    out = incremental_analysis(spark, hist, state, out_dir, changed=[datetime.date(2024, 1, 5)])
    after = written()
    assert {d for d in after if after[d] != before.get(d)} == {"date=2024-01-05", "date=2024-01-11"}
    whole = read_history(spark, hist)
    close(spark.read.parquet(out["daily_stats"]), A.daily_stats(whole), "date")
    close(spark.read.parquet(out["hourly_pattern"]), A.hourly_pattern(whole), "hour_of_day")
    want = A.spike_threshold(whole).first().quantile
    assert spark.read.parquet(out["threshold"]).first().quantile == want
    spikes = spark.read.parquet(out["volatility_spikes"])
    assert spikes.count() == whole.where(F.col("volatility_24h") > want).count() > 0
    assert spikes.where(F.col("volatility_24h") <= want).count() == 0


def test_new_dates_reach_the_scan_as_a_partition_filter(spark):
    hist = scratch_path(spark, "hist")
    sinks.write_history(history(spark, range(3), 20), hist)
    one = P.day_partials(read_history(spark, hist).where(F.col("date").isin([datetime.date(2024, 1, 2)])))
    assert len(read_history(spark, hist).where(F.col("date") == datetime.date(2024, 1, 2)).inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [(date" in plan
