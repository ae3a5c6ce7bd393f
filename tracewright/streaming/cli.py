"""Command line for the streaming job (J1-J6), configured by properties.

    python -m tracewright --source=kafka --kafka.bootstrap-servers=host:9092 \\
        --sink=parquet --sink.path=/data/spans --dead-letter.path=/data/dead \\
        --checkpoint=/shared/ckpt/spans --finagle.enabled=true --finagle.adjust-issue343=true

Properties (``--key=value``; empty values mean unset):

    master                  Spark master (default: whatever the launcher set, else local[*])
    conf.<spark key>        Spark conf entries, merged over the defaults (never replacing them)
    batch-duration          micro-batch interval in ms (default 10000)
    log-level               level of the ``tracewright`` logger (default info)
    source                  kafka | files
    kafka.bootstrap-servers comma list (required for kafka)
    kafka.topic             topic (default ``spans``)
    kafka.group-id          consumer group (default ``spans``)
    files.path              directory of message files (parquet with a ``value`` column)
    files.format            parquet | orc | binaryFile (default parquet)
    files.max-per-trigger   files per micro-batch (default: all there are)
    sink                    parquet | orc | json | jdbc | console | elasticsearch | cassandra
    sink.path               output path for file sinks
    sink.option.<key>       options handed to the sink format
    dead-letter.path        parquet folder for undecodable messages and failed writes
    checkpoint              checkpoint location (default: under spark.checkpoint.dir)
    fail-fast               check the sink before starting (default true)
    available-now           drain what is there, then stop (default false)
    filter.services         comma list: only spans with an endpoint of one of these services
    merge.*, finagle.*, normalize.*, prune.*, scrub.*, sample.*, rekey.*
                            adjusters (see ``operators.adjust.adjusters_from_settings``)
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from tracewright.functions.spans import of_services
from tracewright.operators.adjust import SETTINGS, adjusters_from_settings
from tracewright.session import build_session
from tracewright.sources.files import message_stream
from tracewright.sources.kafka import DEFAULT_GROUP_ID, DEFAULT_TOPIC, KafkaSettings, kafka_stream
from tracewright.streaming.job import DEFAULT_BATCH_INTERVAL_MS, JobConfig, StreamingJob
from tracewright.streaming.sinks import SinkConfig


def parse_properties(argv: Sequence[str]) -> dict[str, str]:
    """``--a.b=c`` pairs (or ``--flag`` for true) into a dict; blanks are dropped."""
    props: dict[str, str] = {}
    for arg in argv:
        if not arg.startswith("--"):
            raise ValueError(f"expected --key=value, got {arg!r}")
        key, sep, value = arg[2:].partition("=")
        value = value.strip() if sep else "true"
        if value:
            props[key.strip()] = value
    return props


def _flag(props: dict[str, str], key: str, default: bool) -> bool:
    return props.get(key, str(default)).strip().lower() == "true"


def _prefixed(props: dict[str, str], prefix: str) -> dict[str, str]:
    return {k[len(prefix):]: v for k, v in props.items() if k.startswith(prefix)}


def config_from_properties(props: dict[str, str]) -> tuple[dict[str, str], JobConfig]:
    """(Spark conf to merge, job config). Raises ``ValueError`` on bad input."""
    source = props.get("source", "kafka")
    if source == "kafka":
        settings = KafkaSettings(
            bootstrap_servers=props.get("kafka.bootstrap-servers"),
            topic=props.get("kafka.topic", DEFAULT_TOPIC),
            group_id=props.get("kafka.group-id", DEFAULT_GROUP_ID),
        )
        settings.options()  # validates now: servers are required

        def src(spark):
            return kafka_stream(spark, settings)

    elif source == "files":
        path = props.get("files.path")
        if not path:
            raise ValueError("files.path is required for the files source")
        fmt = props.get("files.format", "parquet")
        per_trigger = int(props["files.max-per-trigger"]) if props.get("files.max-per-trigger") else None

        def src(spark):
            return message_stream(spark, path, fmt, per_trigger)

    else:
        raise ValueError(f"unknown source {source!r}; expected kafka or files")

    sink = SinkConfig(props.get("sink", "parquet"), props.get("sink.path"), _prefixed(props, "sink.option."))
    dead = SinkConfig("parquet", props["dead-letter.path"]) if props.get("dead-letter.path") else None
    settings = {k: v for k, v in props.items() if k.startswith(SETTINGS)}
    services = [s.strip() for s in props.get("filter.services", "").split(",") if s.strip()]
    config = JobConfig(
        source=src,
        sink=sink,
        adjusters=adjusters_from_settings(settings),
        dead_letter_sink=dead,
        span_filter=(lambda: of_services(services)) if services else None,
        batch_interval_ms=int(props.get("batch-duration", DEFAULT_BATCH_INTERVAL_MS)),
        checkpoint_location=props.get("checkpoint"),
        available_now=_flag(props, "available-now", False),
        fail_fast=_flag(props, "fail-fast", True),
        log_level=props.get("log-level", "info"),
    )
    return _prefixed(props, "conf."), config


def main(argv: Sequence[str] | None = None) -> int:
    props = parse_properties(sys.argv[1:] if argv is None else argv)
    conf, config = config_from_properties(props)
    spark = build_session(props.get("master"), app_name="tracewright-job", conf=conf)
    job = StreamingJob(spark, config).start()
    try:
        job.await_termination()
        if job.query is not None and job.query.exception() is not None:
            raise RuntimeError(str(job.query.exception()))
    finally:
        job.close()
    return 0
