"""Mergeable partial results per date and hour: analyses that read only what is new.

``day_partials`` reduces metrics to one row per (date, hour): counts, sums, extremes,
the moments (count, mean, M2) of ``volatility_24h`` and a KLL sketch of its
distribution. Stored beside the history, partitioned by date, they answer the
batch analyses without the history: a new date costs a read of that date.

* daily statistics and the hour-of-day pattern merge the rows; moments merge by the
  pairwise rule (no difference of large sums);
* the spike threshold stays exact: the merged sketch gives a band of values around
  the asked rank, dates whose values all lie below or above it count from their
  partials, and one scan of the other dates finds the value (``band_dates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.functions import hour_of_day
from volspark.operators.quantile import quantile_disc

VOLATILITY = "volatility_24h"
SKETCH_K = 4096             # rank error of a merged sketch about 0.13 %
BAND = 0.01                 # of the ranks, on both sides of the asked one


def day_partials(metrics: DataFrame, time_col: str = "event_time") -> DataFrame:
    """One row per (date, hour_of_day) of tick metrics."""
    v = F.col(VOLATILITY).cast("double")
    return (metrics.withColumn("hour_of_day", hour_of_day(time_col)).groupBy("date", "hour_of_day").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("price").alias("prices"), F.sum("price").alias("price_sum"),
        F.min("price").alias("price_min"), F.max("price").alias("price_max"),
        F.sum("volume24h").alias("volume_sum"),
        F.count("volatility_1h").alias("vol_1h_n"), F.sum("volatility_1h").alias("vol_1h_sum"),
        F.count(v).alias("vol_n"), F.avg(v).alias("vol_mean"),
        (F.var_pop(v) * F.count(v)).alias("vol_m2"), F.min(v).alias("vol_min"), F.max(v).alias("vol_max"),
        F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("vol_sketch")))


def _moments(parts: Column) -> Column:
    """(n, mean, m2) of an array of partials (at most 24 a date), merged pair by pair."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
                        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))

    return F.aggregate(F.filter(parts, lambda p: p["n"] > 0), zero, merge)


def daily_stats(partials: DataFrame) -> DataFrame:
    """A1 from partials: the columns of ``analysis.daily_stats``."""
    part = F.struct("hour_of_day", F.col("vol_n").alias("n"), F.col("vol_mean").alias("mean"), F.col("vol_m2").alias("m2"))
    days = partials.groupBy("date").agg(
        (F.sum("price_sum") / F.nullif(F.sum("prices"), F.lit(0))).alias("avg_price"),
        F.max("price_max").alias("max_price"), F.min("price_min").alias("min_price"),
        F.max("vol_max").alias("max_vol"), F.min("vol_min").alias("min_vol"),
        F.sum("volume_sum").alias("total_volume"), F.sum("records").alias("record_count"),
        F.array_sort(F.collect_list(part)).alias("parts"))
    m = F.col("m")
    return days.withColumn("m", _moments(F.col("parts"))).select(
        "date", "avg_price", "max_price", "min_price",
        F.when(m["n"] > 0, m["mean"]).alias("avg_vol"), "max_vol", "min_vol",
        F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1))).alias("std_vol"), "total_volume", "record_count")


def hourly_pattern(partials: DataFrame) -> DataFrame:
    """A2 from partials: the columns of ``analysis.hourly_pattern``."""
    mean = lambda total, n: F.sum(total) / F.nullif(F.sum(n), F.lit(0))
    return (partials.withColumn("vol_sum", F.col("vol_mean") * F.col("vol_n")).groupBy("hour_of_day").agg(
        mean("vol_1h_sum", "vol_1h_n").alias("avg_vol_1h"), mean("vol_sum", "vol_n").alias("avg_vol_24h"),
        F.sum("records").alias("record_count")))


def threshold_band(partials: DataFrame, q: float) -> DataFrame:
    """One row (n, lo, hi): how many values there are, and a band around rank ``q`` of them."""
    some = partials.where("vol_n > 0")
    merged = some.agg(F.sum("vol_n").alias("n"), F.min("vol_min").alias("least"), F.max("vol_max").alias("most"),
                      F.kll_merge_agg_double("vol_sketch").alias("s"))
    at = lambda rank: F.kll_sketch_get_quantile_double("s", F.lit(rank))
    lo = at(q - BAND) if q > BAND else F.col("least")
    hi = at(q + BAND) if q + BAND < 1 else F.col("most")
    # no values: no row of the sketch to ask
    return merged.select(F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") > 0, lo).alias("lo"),
                         F.when(F.col("n") > 0, hi).alias("hi"))


def band_dates(partials: DataFrame, lo: float, hi: float) -> tuple[DataFrame, DataFrame]:
    """(dates that have values in the band, one row ``below``: values of all other dates under it)."""
    days = partials.groupBy("date").agg(F.sum("vol_n").alias("n"), F.min("vol_min").alias("least"),
                                        F.max("vol_max").alias("most"))
    meets = (F.col("most") >= lo) & (F.col("least") <= hi)
    below = days.where(F.col("most") < lo).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("below"))
    return days.where(meets).select("date"), below


def spike_threshold(history: DataFrame, partials: DataFrame, q: float) -> DataFrame:
    """A4: one-row ``quantile``, exact, from one scan of the dates that the band meets.

    The driver gets the band (three numbers), the count below it and the dates.
    """
    band = threshold_band(partials, q).first()
    if not band.n:
        return history.sparkSession.createDataFrame([(None,)], "quantile double")
    dates, below = band_dates(partials, band.lo, band.hi)
    meets = [r.date for r in dates.collect()]
    # rows without a date are a partition of their own
    wanted = F.col("date").isin([d for d in meets if d is not None])
    if None in meets:
        wanted = wanted | F.col("date").isNull()
    return quantile_disc(history.where(wanted), VOLATILITY, q, band=(band.n, band.lo, band.hi), below=below.first().below)
