"""Kafka message source.

The Kafka connector jar is not bundled; ``kafka_stream`` works wherever
``spark-sql-kafka`` is on the classpath. Only the message value is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

DEFAULT_TOPIC = "spans"
DEFAULT_GROUP_ID = "spans"

Servers = str | Sequence[str] | Callable[[], str | Sequence[str]]


def resolve_servers(servers: Servers | None) -> str:
    """S3: a static list, a comma string, or a supplier evaluated once."""
    if servers is None:
        return ""
    if callable(servers):
        servers = servers()
    if isinstance(servers, str):
        return servers.strip()
    return ",".join(s.strip() for s in servers if s and s.strip())


@dataclass(frozen=True)
class KafkaSettings:
    """Empty values mean unset; servers are required.

    ZooKeeper broker discovery is not built: it is a driver-side client call
    with no data work; pass the bootstrap servers instead.
    """

    bootstrap_servers: Servers | None = None
    topic: str = DEFAULT_TOPIC
    group_id: str = DEFAULT_GROUP_ID
    starting_offsets: str = "latest"
    extra: tuple[tuple[str, str], ...] = ()

    def options(self) -> dict[str, str]:
        servers = resolve_servers(self.bootstrap_servers)
        if not servers:
            raise ValueError("bootstrap servers are required")
        opts = {
            "kafka.bootstrap.servers": servers,
            "subscribe": (self.topic or DEFAULT_TOPIC).strip(),
            "kafka.group.id": (self.group_id or DEFAULT_GROUP_ID).strip(),
            "startingOffsets": self.starting_offsets,
        }
        opts.update(dict(self.extra))
        return opts


def kafka_stream(spark: SparkSession, settings: KafkaSettings) -> DataFrame:
    """Receiver-less stream of one topic; only ``value`` is kept."""
    return spark.readStream.format("kafka").options(**settings.options()).load().select("value")


def kafka_batch(spark: SparkSession, settings: KafkaSettings, ending_offsets: str = "latest") -> DataFrame:
    """Batch backfill over the same topic."""
    opts = settings.options()
    opts["startingOffsets"] = "earliest" if opts["startingOffsets"] == "latest" else opts["startingOffsets"]
    opts["endingOffsets"] = ending_offsets
    return spark.read.format("kafka").options(**opts).load().select("value")
