"""Kafka topics. Needs the Spark Kafka package on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bourseloom.functions.codec import encode

PASS_THROUGH = ["topic", "partition", "offset", "timestamp"]


def topic_stream(
    spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """A topic as a stream of ``value`` plus position columns; the checkpoint keeps the offsets."""
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select("value", *PASS_THROUGH)


def topic_table(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds now, as a batch."""
    return spark.read.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic,
           "startingOffsets": "earliest", "endingOffsets": "latest"}
    ).load().select("value", *PASS_THROUGH)


def write_topic(df: DataFrame, servers: str, topic: str, key: str | None = None) -> int:
    """Rows as JSON messages, and how many were sent; ``key`` keeps one key's messages in order."""
    sent = Observation()
    messages = encode(df, key).observe(sent, F.count(F.lit(1)).alias("sent"))
    messages.write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic}
    ).save()
    return sent.get["sent"]
