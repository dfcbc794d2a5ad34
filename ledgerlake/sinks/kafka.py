"""Messages to a topic. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def publish(
    messages: DataFrame, servers: str, topic: str, login: Mapping[str, str] | None = None
) -> None:
    """Send each `value` without a key; every executor task sends its own partition."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .options(**(login or {}))
        .option("topic", topic)
        .save()
    )
