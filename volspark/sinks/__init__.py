"""Sinks (S7-S10): every write is idempotent for its unit of work.

* history: Parquet partitioned by ``date``; dynamic partition overwrite so a
  re-run or replay replaces the partitions it touches instead of appending
  duplicates; with a zone map (rows and least and greatest time of each file)
  beside it on request;
* dashboard staging: JSON lines (null fields are omitted by the JSON writer,
  so readers use ``DASHBOARD_SCHEMA``);
* analysis results: Parquet, overwrite;
* candles: snappy Parquet partitioned by (symbol, interval), or by a hash of them
  when they are many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from volspark.schemas import DASHBOARD_COLUMNS
from volspark.session import keep
from volspark.sources.files import path_exists, sub_folders, zones_path


def write_history(df: DataFrame, path: str, partition_cols=("date",), *,
                  mode: str = "overwrite") -> None:
    """Date-partitioned history; overwrite is per partition (dynamic).

    Rows are rebalanced by the partition columns first: a date goes to one
    writing task, or to several of the session's advisory size when it is large,
    so the number of files follows the data, not tasks x dates.
    """
    (df.hint("rebalance", *[F.col(c) for c in partition_cols]).write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))


def write_zoned_history(df: DataFrame, path: str, zone_col: str = "timestamp", *, max_rows: int = 0,
                        mode: str = "overwrite") -> None:
    """S7 with a zone map: files of a date hold stretches of ``zone_col``, listed beside the history.

    Rows are split by ranges of (date, ``zone_col``), a crowded date over several
    tasks, and written in that order, in files of at most ``max_rows`` rows (0: no
    bound). Then the dates that were written are read once more, one narrow
    column, for (file, rows, low, high): ``rows`` counts those with a value. A
    failure in between leaves zones that do not name the date's files, which
    ``read_latest`` sees; it then reads whole dates.
    """
    written = Observation()
    (df.observe(written, F.collect_set("date").alias("dates"))
       .repartitionByRange(F.col("date"), F.col(zone_col)).sortWithinPartitions("date", zone_col)
       .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows)
       .partitionBy("date").parquet(path))
    dates = written.get.get("dates") or []
    if not dates:
        return
    history = df.sparkSession.read.schema(df.schema).option("basePath", path).parquet(
        *[f"{path}/date={d}" for d in sorted(dates)])
    zones = (history.select("date", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), zone_col)
             .groupBy("date", "file").agg(F.count(zone_col).alias("rows"), F.min(zone_col).alias("low"),
                                          F.max(zone_col).alias("high")))
    write_history(zones, zones_path(path))


def write_dashboard(df: DataFrame, path: str, *, mode: str = "append") -> None:
    """The 13 dashboard columns as JSON lines."""
    df.select(*DASHBOARD_COLUMNS).write.mode(mode).json(path)


def write_result(df: DataFrame, path: str) -> None:
    """An analysis result, replaced as a whole."""
    df.write.mode("overwrite").parquet(path)


SERIES = ["symbol", "interval"]
MAX_SERIES_FOLDERS = 1000        # series up to which a new table has a folder for each
SERIES_BUCKETS = 256
SERIES_BUCKET = "series_bucket"


def series_bucket() -> Column:
    return F.pmod(F.xxhash64(*SERIES), F.lit(SERIES_BUCKETS)).cast("int")


def write_candles(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Snappy Parquet, one directory per (symbol, interval).

    A table that begins with more than ``MAX_SERIES_FOLDERS`` series has
    ``SERIES_BUCKETS`` directories instead, by a hash of the series, with the rows in
    the order of (symbol, interval, timestamp): folders and files then follow the data,
    not the number of series. A table keeps the form it began with. In both forms
    overwriting replaces the series that ``df`` has and no others. ``df`` is read more
    than once, so it should be stored.
    """
    spark = df.sparkSession
    begun = path_exists(spark, path) and sub_folders(spark, path)
    if begun:
        many = any(name.startswith(SERIES_BUCKET + "=") for name in begun)
    else:
        many = df.select(*SERIES).distinct().limit(MAX_SERIES_FOLDERS + 1).count() > MAX_SERIES_FOLDERS
    places = [SERIES_BUCKET] if many else SERIES
    if many:
        if begun and mode == "overwrite":
            df = df.unionByName(keep(_bucket_mates(df, path), "bucket-mates"))
        df = df.withColumn(SERIES_BUCKET, series_bucket())
    df = df.hint("rebalance", *[F.col(c) for c in places])
    if many:
        df = df.sortWithinPartitions(SERIES_BUCKET, *SERIES, "timestamp")
    (df.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*places).parquet(path))


def _bucket_mates(df: DataFrame, path: str) -> DataFrame:
    """The stored rows that share a bucket with a series of ``df`` and belong to none of them."""
    series = df.select(*[F.col(c).alias(f"_{c}") for c in SERIES]).distinct()
    touched = [r[0] for r in df.select(series_bucket()).distinct().collect()]      # SERIES_BUCKETS at most
    stored = df.sparkSession.read.parquet(path).where(F.col(SERIES_BUCKET).isin(touched)).drop(SERIES_BUCKET)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SERIES]
    return stored.join(series, same, "left_anti")
