"""File sources (S2-S5) for batch and streaming reads, and the volume audit."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volspark.schemas import TICK_SCHEMA

CORRUPT = "_corrupt_record"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _json_reader(reader, schema: T.StructType):
    # PERMISSIVE keeps a malformed line as an all-null row with its text in
    # CORRUPT; a bad line never drops the rest of its file.
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    return (reader.schema(full).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def read_json_ticks(spark: SparkSession, path: str, schema: T.StructType = TICK_SCHEMA) -> DataFrame:
    """A directory of JSON-lines tick files (blank lines skipped)."""
    return _json_reader(spark.read, schema).json(path)


def stream_json_ticks(spark: SparkSession, path: str, schema: T.StructType = TICK_SCHEMA,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """S2 streaming form (file source; Kafka in production, see ``kafka``)."""
    r = _json_reader(spark.readStream, schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path)


def read_history(spark: SparkSession, path: str, date_from=None, date_to=None) -> DataFrame:
    """S3: the date-partitioned Parquet history; date bounds prune partitions."""
    df = spark.read.parquet(path)
    if date_from is not None:
        df = df.filter(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(F.col("date") <= F.lit(date_to).cast("date"))
    return df


def stored_dates(spark: SparkSession, path: str) -> list[datetime.date]:
    """The ``date=`` partitions of a history, newest first (folder names only, no file is read).

    The partition of rows without a date is not among them.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted((datetime.date.fromisoformat(n[5:]) for n in names
                   if n.startswith("date=") and n != "date=" + NULL_PARTITION), reverse=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the ``column=value`` folders right below ``path``, which may be a pattern; none if there is no such path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/*=*")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return [s.getPath().getName() for s in found or []]


def zones_path(path: str) -> str:
    """Where the zone map of a history is (see ``sinks.write_zoned_history``)."""
    return path.rstrip("/") + "_zones"


def file_zones(spark: SparkSession, path: str, dates: list[datetime.date]) -> list[Row] | None:
    """(date, file, rows, low, high) of every file of these dates; None unless the zone map names exactly those."""
    where = zones_path(path)
    if not dates or not path_exists(spark, where):
        return None
    zones = read_history(spark, where).where(F.col("date").isin(dates)).collect()     # one row a file of these dates
    listed = spark.read.option("basePath", path).parquet(*[f"{path}/date={d}" for d in dates]).inputFiles()
    named = {f"date={z.date}/{z.file}" for z in zones}
    return zones if named == {"/".join(f.split("/")[-2:]) for f in listed} else None


def _newest(zones: list[Row], n: int) -> list[Row]:
    """The files that can hold one of the ``n`` greatest values, when they hold that many.

    Files whose least value is ``bound`` or more hold ``n`` rows, so the n-th
    greatest value is no less than that, and neither is any file that matters.
    """
    zones, held, bound = [z for z in zones if z.rows], 0, None
    for zone in sorted(zones, key=lambda z: z.low, reverse=True):
        held, bound = held + zone.rows, zone.low
        if held >= n:
            break
    return [z for z in zones if z.high >= bound]


def read_latest(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The newest date partitions of a history that hold at least ``n`` rows (all when it has fewer).

    Widens from the newest date, doubling the number of dates; only the dates
    returned are read by the caller, whatever the length of the history. Where a
    zone map covers these dates, no row is counted and only the files that can
    hold one of the ``n`` latest rows are returned.
    """
    dates, take = stored_dates(spark, path), 1
    while True:
        found = read_history(spark, path, dates[:take][-1] if dates else None)
        zones = file_zones(spark, path, dates[:take])
        if zones is not None and sum(z.rows for z in zones) >= n > 0:
            return spark.read.schema(found.schema).option("basePath", path).parquet(
                *[f"{path}/date={z.date}/{z.file}" for z in _newest(zones, n)])
        if take >= len(dates) or zones is None and found.count() >= n:
            return found
        take *= 2


def read_candle_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed candle responses -> (symbol, interval, body, polled_at).

    Either one JSON document per line under ``symbol=<s>/interval=<i>/`` directories, or,
    for many series, JSON lines of ``{"symbol":..,"interval":..,"body":..}``, any number
    of series to a file; a line that is no JSON counts as a response that is none.
    ``polled_at`` is the time of the file, which orders polls of the same candle."""
    polled_at = F.col("_metadata.file_modification_time").alias("polled_at")
    if sub_folders(spark, path):
        return spark.read.option("basePath", path).text(path).select(
            "symbol", "interval", F.col("value").alias("body"), polled_at)
    body = F.coalesce("body", CORRUPT, F.raise_error(F.lit("a landed line has no response body")))
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in ("symbol", "interval", "body")])
    return _json_reader(spark.read, schema).json(path).select("symbol", "interval", body.alias("body"), polled_at)


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Landed quote polls as JSON lines of ``{"timestamp":..,"body":..}``."""
    schema = "timestamp long, body string, seq long"
    return spark.read.schema(schema).json(path)


def storage_volume(spark: SparkSession, path: str, min_gb: float) -> DataFrame:
    """Total bytes under ``path`` (recursive), in GB, against ``min_gb``.

    ``binaryFile`` with only ``length`` selected lists files without reading
    their content; one aggregate sums them.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("length"))
    gb = F.col("total_bytes") / F.lit(float(1024 ** 3))
    return (files.agg(F.count(F.lit(1)).alias("files"),
                      F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
                 .withColumn("total_gb", gb)
                 .withColumn("meets_minimum", gb >= F.lit(min_gb))
                 .withColumn("shortfall_gb", F.greatest(F.lit(min_gb) - gb, F.lit(0.0))))
