"""The transaction topic as a stream. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Where a new stream starts, and a rate limit (records per micro-batch) to choose.
STARTING_OFFSETS = "latest"
RECORDS_PER_BATCH = 100


def login_options(
    mechanism: str, protocol: str, login_module: str, user: str, password: str
) -> dict[str, str]:
    """Options for a broker that asks for a login; the values come from the caller."""
    return {
        "kafka.sasl.mechanism": mechanism,
        "kafka.security.protocol": protocol,
        "kafka.sasl.jaas.config": (
            f'{login_module} required username="{user}" password="{password}";'
        ),
    }


def stream_options(
    servers: str,
    topic: str,
    starting_offsets: str = STARTING_OFFSETS,
    records_per_batch: int | None = None,
    login: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of `message_stream`; without `records_per_batch` a micro-batch takes what is there."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **(login or {}),
    }
    if records_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(records_per_batch)
    return options


def message_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Messages of a topic, as the binary `value` column the parsers read."""
    return spark.readStream.format("kafka").options(**options).load().select("value")
