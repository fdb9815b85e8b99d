"""Kafka source and sink options.

The Kafka connector jar is not part of this environment, so only the option
building and the value encoding are exercised here; with the connector on the
classpath these functions run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(bootstrap: str, topic: str, *, starting_offsets: str = "latest",
                   fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None
                   ) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_ticks_stream(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Stream of Kafka records; ``value`` holds the tick JSON.

    (partition, offset) is kept: it is the tie-breaker ``seq`` for ticks with
    equal timestamps (N7).
    """
    df = spark.readStream.format("kafka").options(**source_options(bootstrap, topic, **kw)).load()
    seq = F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")
    return df.select(F.col("value").cast("string").alias("value"), seq.alias("seq"))


def sink_options(bootstrap: str, topic: str, *, compression: str = "gzip",
                 acks: str = "all") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.compression.type": compression,
        "kafka.acks": acks,
    }


def to_kafka_value(df: DataFrame, columns=None) -> DataFrame:
    """S6 encode: one JSON object per row in ``value``."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def write_ticks(df: DataFrame, bootstrap: str, topic: str, **kw) -> None:
    """Batch write of ticks to Kafka (gzip, acks=all)."""
    to_kafka_value(df).write.format("kafka").options(**sink_options(bootstrap, topic, **kw)).save()
