"""Keyed outgoing messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import epoch_micros, epoch_millis, from_epoch_micros, message_text
from quayside.constants import PRODUCER_SPACING_MS as SPACING_MS  # one per 10 ms: at most 100 per second


def outgoing_messages(counter: DataFrame, topic: str, idx_col: str = "idx", send_col: str = "send_ts",
                      with_key: bool = True) -> DataFrame:
    """``Message <i> at <epoch_ms>`` with a random UUID key (M8)."""
    cols = [F.lit(topic).alias("topic")]
    if with_key:
        cols.append(F.expr("uuid()").alias("key"))
    cols += [F.col(idx_col).alias("idx"),
             message_text(F.col(idx_col), epoch_millis(send_col)).alias("value")]
    return counter.select(*cols)


def paced_counter(source: DataFrame, idx_col: str, start_ts_col: str) -> DataFrame:
    """Batch form of the producer loop: message ``i`` is sent ``i * 10 ms``
    after the first send time, which keeps the 100-per-second ceiling."""
    start = source.select(F.min(start_ts_col)).scalar()
    start_us = epoch_micros(start)
    send = from_epoch_micros(start_us + F.col(idx_col) * (SPACING_MS * 1000))
    return source.select(F.col(idx_col).alias("idx"), send.alias("send_ts"))
