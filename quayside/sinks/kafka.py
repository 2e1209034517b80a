"""Keyed topic sink (K11, K12) as an option map."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quayside import constants as C
from quayside.sources.streams import SECURITY_KEYS

PRODUCER_DEFAULTS = {
    "kafka.acks": C.PRODUCER_ACKS,
    "kafka.retries": str(C.PRODUCER_RETRIES),
    "kafka.batch.size": str(C.PRODUCER_BATCH_BYTES),
    "kafka.linger.ms": str(C.PRODUCER_LINGER_MS),
    "kafka.delivery.timeout.ms": str(C.PRODUCER_DELIVERY_TIMEOUT_MS),
    "kafka.request.timeout.ms": str(C.PRODUCER_REQUEST_TIMEOUT_MS),
    "kafka.max.block.ms": str(C.PRODUCER_MAX_BLOCK_MS),
    "kafka.buffer.memory": str(C.PRODUCER_BUFFER_BYTES),
    "kafka.connections.max.idle.ms": str(C.PRODUCER_MAX_IDLE_MS),
    "kafka.retry.backoff.ms": str(C.PRODUCER_RETRY_BACKOFF_MS),
    "kafka.socket.connection.setup.timeout.ms": str(C.PRODUCER_CONNECTION_SETUP_MS),
}


def producer_options(props: dict) -> dict:
    opts = {"kafka.bootstrap.servers": props["bootstrap.servers"], **PRODUCER_DEFAULTS}
    for k, v in props.items():
        if k.startswith("kafka."):
            opts[k] = str(v)
    if props.get("security.protocol"):
        for k in SECURITY_KEYS:
            opts[f"kafka.{k}"] = props.get(k, "")
    limit, least = (int(opts[f"kafka.{k}.ms"]) for k in ("delivery.timeout", "request.timeout"))
    if limit < least + int(opts["kafka.linger.ms"]):
        raise ValueError("the client refuses a delivery timeout below linger + request timeout")
    return opts


def write_topic(messages: DataFrame, props: dict) -> None:
    """Batch write of ``topic, key, value``. A failed send fails the task and
    so the job (K12); nothing is swallowed."""
    messages.select("topic", "key", "value").write.format("kafka").options(**producer_options(props)).save()
