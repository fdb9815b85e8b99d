"""Session helpers.

Library code never builds or configures a session: every function takes the
caller's DataFrames. The helpers here are for tests, the bench and the driver
entry point, plus the one place that decides where scratch output may go.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. UTC is part of the contract: dates and
# hour-of-day are defined in UTC (the reference labels its output UTC).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

_scratch_homes: set[str] = set()     # scratch folders registered for removal

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # dynamic overwrite keeps history/stream sinks idempotent per partition
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "volspark") -> SparkSession:
    """A local session for tests and benchmarks (never used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")   # call sites of every expression
    )
    for k, v in {**REQUIRED_CONF, **RECOMMENDED_CONF}.items():
        builder = builder.config(k, v)
    if os.environ.get("VOLSPARK_EVENTLOG"):        # profiling: stage times on disk
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", os.environ["VOLSPARK_EVENTLOG"])
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the settings results depend on to a caller's session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, as a URI or path.

    On a cluster the setting is required: a driver-local folder would be
    invisible to the executors, so an unset value raises. A session with a
    ``local`` master (tests, benchmarks) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    local = sc.master == "local" or sc.master.startswith("local[")
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not local:
            raise ValueError("spark.checkpoint.dir is not set: name a folder that "
                             "the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="volspark-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return (root.removeprefix("file://") if local else root).rstrip("/")


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Make folder ``path`` and have the JVM remove it when the application ends."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's own scratch folder on shared storage.

    The application folder is removed when the application ends.
    """
    home = f"{checkpoint_root(spark)}/volspark-scratch/{spark.sparkContext.applicationId}"
    if home not in _scratch_homes:
        _delete_on_exit(spark, home)
        _scratch_homes.add(home)
    return f"{home}/{name}-{uuid.uuid4().hex[:12]}"


def keep(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage with a column-pruned, splittable table that survives the loss
    of any executor; later passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of an intermediate that several jobs read (see :func:`keep`)."""
    return keep(df, "materialized")
