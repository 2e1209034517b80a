"""Stream sources as option maps.

No broker or shard-stream connector ships with this image, so the readers
only assemble the options for ``spark.readStream.format("kafka")``; the start
position rule is also applied to tables with an arrival column, which is how
it is tested.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.constants import DEFAULT_START_POSITION, START_POSITIONS as POSITIONS

SECURITY_KEYS = ("security.protocol", "sasl.mechanism", "sasl.jaas.config")


def kafka_options(props: dict) -> dict:
    """One topic, value only; the three security options are passed only when
    ``security.protocol`` is present, and then together. Starts at ``earliest`` unless ``props`` names a
    start position. Offsets that the broker no longer holds fail the query: nothing is skipped."""
    opts = {
        "kafka.bootstrap.servers": props["bootstrap.servers"],
        "subscribe": props["topic"],
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if "start.position" in props:
        del opts["startingOffsets"]
        opts |= kafka_start_options(resolve_start_position(props))
    if props.get("group.id"):
        opts["kafka.group.id"] = props["group.id"]
    if props.get("security.protocol"):
        for k in SECURITY_KEYS:
            opts[f"kafka.{k}"] = props.get(k, "")
    return opts


def text_messages(raw: DataFrame) -> DataFrame:
    """DataFrame[partition, offset, arrival_ts, partition_key, value] of a Kafka frame. Null values are
    skipped and counted: metric ``null_values`` of the observation ``kafka_text`` in each batch's progress."""
    counted = raw.observe("kafka_text", F.count_if(F.col("value").isNull()).alias("null_values"))
    return (counted.where(F.col("value").isNotNull())
            .select(F.col("partition").cast("int"), F.col("offset"),
                    F.col("timestamp").cast("timestamp_ntz").alias("arrival_ts"),
                    F.col("key").cast("string").alias("partition_key"),
                    F.col("value").cast("string").alias("value")))


def read_kafka_text(spark: SparkSession, props: dict) -> DataFrame:
    """The topic of ``props`` as a stream of text messages."""
    return text_messages(spark.readStream.format("kafka").options(**kafka_options(props)).load())


# --- S4: start position -------------------------------------------------------

def resolve_start_position(props: dict, lenient: bool = False) -> dict:
    """Exact, case-sensitive match; default LATEST. AT_TIMESTAMP needs
    ``start.timestamp`` (ISO-8601 text or epoch seconds). Unknown names raise
    unless ``lenient`` (then LATEST, as the reference silently does)."""
    pos = props.get("start.position", DEFAULT_START_POSITION)
    if pos not in POSITIONS:
        if not lenient:
            raise ValueError(f"unknown start.position {pos!r}; expected one of {POSITIONS}")
        pos = "LATEST"
    spec = {"position": pos}
    if pos == "AT_TIMESTAMP":
        raw = props.get("start.timestamp")
        if raw is None:
            raise ValueError("start.position AT_TIMESTAMP needs start.timestamp")
        spec["timestamp"] = parse_start_timestamp(raw)
    return spec


def parse_start_timestamp(raw: str) -> dt.datetime:
    text = str(raw).strip()
    try:
        secs = float(text)
        return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=secs)
    except ValueError:
        pass
    parsed = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return parsed


def kafka_start_options(spec: dict) -> dict:
    if spec["position"] == "AT_TIMESTAMP":
        ms = int((spec["timestamp"] - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
        return {"startingTimestamp": str(ms)}
    return {"startingOffsets": "earliest" if spec["position"] == "TRIM_HORIZON" else "latest"}


def apply_start_position(messages: DataFrame, spec: dict, arrival_col: str = "arrival_ts") -> DataFrame:
    """Batch form over a table of already-arrived records. AT_TIMESTAMP is a
    filter Parquet can push down; TRIM_HORIZON keeps everything; LATEST keeps
    nothing that has already arrived."""
    if spec["position"] == "AT_TIMESTAMP":
        ts = spec["timestamp"].isoformat(sep=" ")
        return messages.where(F.col(arrival_col) >= F.expr(f"TIMESTAMP_NTZ'{ts}'"))
    if spec["position"] == "TRIM_HORIZON":
        return messages
    return messages.where(F.lit(False))


# --- S11: generated messages --------------------------------------------------

def rate_stream(spark: SparkSession, rows_per_second: int = 100) -> DataFrame:
    """Counter 0, 1, 2, ... with a send time, at most ``rows_per_second`` (one per 10 ms)."""
    return (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
            .select(F.col("value").alias("idx"), F.col("timestamp").cast("timestamp_ntz").alias("send_ts")))
