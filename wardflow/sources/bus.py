"""Messages from a bus (Kafka or the Kafka endpoint of an event hub)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every record once: from the first one kept, and an error when some are gone. Callers may opt out.
BUS_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def read_bus(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Streaming reader over a topic; needs Spark's Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    for key, value in {**BUS_DEFAULTS, "subscribe": topic, **options}.items():
        reader = reader.option(key, value)
    return reader.load()


def messages_from(df: DataFrame, value: str = "value", source: str | None = None) -> DataFrame:
    """Any frame with message text in one column, shaped like file rows.

    A bus record takes the place of a file, so splitting and parsing go on as
    they do for files. The record's own timestamp is kept when it has one.
    """
    text = F.col(value).cast("string")
    sent = F.col("timestamp").cast("timestamp") if "timestamp" in df.columns else F.current_timestamp()
    origin = F.col("topic") if "topic" in df.columns else F.lit(source).cast("string")
    return df.select(
        F.md5(F.concat(text, sent.cast("string"))).alias("file_id"),
        text.alias("raw_content"),
        origin.alias("source_file"),
        sent.alias("file_modification_time"),
        F.current_timestamp().alias("ingested_at"),
    )
