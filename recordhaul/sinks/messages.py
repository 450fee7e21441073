"""Messages to a broker or to files."""

from __future__ import annotations

from pyspark.sql import DataFrame

# How messages are batched, compressed and acknowledged.
PRODUCER_OPTIONS = {
    "kafka.compression.type": "snappy",
    "kafka.batch.size": "51200",
    "kafka.linger.ms": "10",
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
}


def broker_write_options(servers: str, **more: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **PRODUCER_OPTIONS, **more}


def write_broker(messages: DataFrame, options: dict[str, str]) -> None:
    """Send ``topic, partition, key, value`` (needs Spark's Kafka connector)."""
    wanted = messages.select("topic", "partition", "key", "value")
    wanted.write.format("kafka").options(**options).save()


def write_message_files(messages: DataFrame, folder: str) -> None:
    messages.write.mode("append").parquet(folder)
