"""Message landing and stream-to-lake operators.

Input is a message DataFrame ``[partition, offset, arrival_ts, partition_key,
value]`` (see ``sources.standins.message_stream`` / ``sources.streams``). The
arrival column is an argument: streaming wrappers pass processing time, tests
pass stored times, so batch results repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import (
    bytes_outcome, date_text, epoch_micros, framed, from_epoch_micros, is_json, json_outcome, truncate_to_millis, with_is_json,
    with_json_scalar,
)
from quayside.constants import INACTIVITY_SECONDS, MAX_PART_BYTES, ROLL_MINUTES
from quayside.plans import running_sum


def framed_messages(messages: DataFrame, framing: str = "line") -> DataFrame:
    """P1 + K1 layout: the text each message becomes and its ``date=`` folder."""
    return messages.select("partition", "offset", date_text("arrival_ts").alias("date"),
                           framed("value", framing).alias("value"))


def line_bytes(value_col: str = "value", framing: str = "line"):
    """Bytes a message takes in a text file: UTF-8 text plus the sink's newline."""
    return F.octet_length(framed(value_col, framing)) + F.lit(1)


def date_bucket_counts(messages: DataFrame, framing: str = "line") -> DataFrame:
    """Messages and bytes per ``date=yyyy-MM-dd`` folder."""
    return (messages.groupBy(date_text("arrival_ts").alias("date"))
            .agg(F.count(F.lit(1)).alias("n_messages"),
                 F.sum(line_bytes("value", framing)).alias("n_bytes")))


def lake_rows(messages: DataFrame, path: str = "$.timestamp", mode: str = "permissive",
              arrival_col: str = "arrival_ts") -> DataFrame:
    """M4 rows: payload, ts = CAST(JSON_VALUE(payload, path) AS BIGINT),
    processing_timestamp (milliseconds), partition_date."""
    proc = truncate_to_millis(arrival_col)
    rows = with_json_scalar(messages.select("value", arrival_col), "value", path, "_text", "ts", mode)
    return rows.select(
        F.col("value").alias("payload"),
        F.col("ts"),
        proc.alias("processing_timestamp"),
        date_text(proc).alias("partition_date"),
    )


def json_values(messages: DataFrame, path: str = "$.timestamp", id_cols=("source", "id")) -> DataFrame:
    """The scalar text at ``path`` (null for objects, arrays, missing, bad JSON)."""
    return with_json_scalar(messages, "value", path, "json_value").select(*id_cols, "json_value")


def json_timestamps(messages: DataFrame, path: str = "$.timestamp", id_cols=("source", "id")) -> DataFrame:
    """P4 permissive: BIGINT or null."""
    return with_json_scalar(messages, "value", path, "_text", "ts").select(*id_cols, "ts")


def json_rejects(messages: DataFrame, path: str = "$.timestamp", id_cols=("source", "id")) -> DataFrame:
    """Bad-row side output of P4: a scalar is present but is not a whole number.

    The two columns are emitted through a one-row ``inline`` (a Generate): a
    filter on generator output cannot be pushed below it, so Catalyst does not
    copy the whole JSON chain into a Filter and evaluate it twice per row."""
    rows = with_json_scalar(messages, "value", path, "json_value", "_ts")
    once = rows.select(*id_cols, F.inline(F.array(F.struct(F.col("json_value").alias("_jv"),
                                                            F.col("_ts").alias("_jts")))))
    return (once.where(F.col("_jv").isNotNull() & F.col("_jts").isNull())
            .select(*id_cols, F.col("_jv").alias("json_value")))


def json_validity(messages: DataFrame, id_cols=("source", "id")) -> DataFrame:
    """P10: is the whole text one JSON value."""
    return with_is_json(messages, "value", "is_json").select(*id_cols, "is_json")


def json_outcomes(messages: DataFrame, id_cols=("source", "id")) -> DataFrame:
    """P10 with the texts that the parser cannot decide kept apart (``undecided``)."""
    return messages.select(*id_cols, json_outcome("value").alias("outcome"))


def json_exact(messages: DataFrame, path: str = "$.timestamp", id_cols=("id",)) -> DataFrame:
    """P3, P4 and P10 of one text side by side: the scalar as written, its BIGINT, validity."""
    return with_json_scalar(messages, "value", path, "json_value", "ts", valid_out="is_json").select(*id_cols, "json_value", "ts", "is_json")


def byte_outcomes(messages: DataFrame, id_cols=("source", "id")) -> DataFrame:
    """P10 from the bytes on: ``not_utf8``, ``json``, ``not_json`` or ``undecided``."""
    return messages.select(*id_cols, bytes_outcome("value").alias("outcome"))


def peek_first_records(messages: DataFrame, n: int = 10) -> DataFrame:
    """From the oldest record of the first shard, the first ``n``
    records with the JSON check. Plans as TakeOrderedAndProject (top-n per task).

    The JSON check is one expression in the final projection, so the planner
    folds it into TakeOrderedAndProject and evaluates it on the ``n`` kept rows only.
    """
    first_shard = messages.select(F.min("partition")).scalar()
    return (messages.where(F.col("partition") == first_shard)
            .orderBy("offset").limit(n)
            .select("partition", "offset", "arrival_ts", "partition_key", F.col("value").alias("data"),
                    is_json("value").alias("is_json")))


def start_counts(messages: DataFrame) -> DataFrame:
    """Records per shard with first and last offset (what a start position yields)."""
    return (messages.groupBy("partition")
            .agg(F.count(F.lit(1)).alias("n_records"), F.min("offset").alias("first_offset"),
                 F.max("offset").alias("last_offset")))


# --- K3: roll by age -------------------------------------------------------------

def _window_start(arrival_col: str, seconds: int):
    width = seconds * 1_000_000
    return from_epoch_micros(F.floor(epoch_micros(arrival_col) / width) * width)


def roll_by_age(messages: DataFrame, minutes: int = ROLL_MINUTES, framing: str = "line") -> DataFrame:
    """One file per ``date`` and aligned ``minutes`` window (a plain group-by,
    partially aggregated before the shuffle)."""
    return (messages
            .groupBy(date_text("arrival_ts").alias("date"),
                     _window_start("arrival_ts", minutes * 60).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("n_messages"),
                 F.sum(line_bytes("value", framing)).alias("n_bytes"),
                 F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")))


# --- K4: roll on inactivity --------------------------------------------------------

def roll_on_inactivity(messages: DataFrame, gap_seconds: int = INACTIVITY_SECONDS, framing: str = "line") -> DataFrame:
    """A new part starts in a date when the gap to the previous message is at
    least ``gap_seconds``.

    Only the first message of a ``gap``-wide time bucket can start a part (any
    later one is closer than ``gap`` to its predecessor in the same bucket), and
    it does exactly when the previous non-empty bucket of the date ended ``gap``
    or more before it (a non-adjacent one always did). So rows are first
    aggregated per bucket (partial aggregation, skew-safe), and the ordering work
    is one window over buckets only: at most 86400 / gap of them per date,
    whatever the row count.
    """
    gap = gap_seconds * 1_000_000
    us = epoch_micros("arrival_ts")
    buckets = (messages
               .groupBy(date_text("arrival_ts").alias("date"), F.floor(us / gap).alias("bucket"))
               .agg(F.min(us).alias("min_us"), F.max(us).alias("max_us"),
                    F.count(F.lit(1)).alias("n"), F.sum(line_bytes("value", framing)).alias("bytes"),
                    F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")))
    # previous non-empty bucket of the same date; if it is not adjacent, the gap is already > gap
    by_date = Window.partitionBy("date").orderBy("bucket")
    flagged = buckets.withColumn("prev_max_us", F.lag("max_us").over(by_date)).withColumn(
        "starts", (F.col("prev_max_us").isNull() | (F.col("min_us") - F.col("prev_max_us") >= gap)).cast("int"))
    parts = flagged.withColumn("part_no", F.sum("starts").over(by_date.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return (parts.groupBy("date", "part_no")
            .agg(F.sum("n").alias("n_messages"), F.sum("bytes").alias("n_bytes"),
                 from_epoch_micros(F.min("min_us")).alias("first_ts"),
                 from_epoch_micros(F.max("max_us")).alias("last_ts")))


# --- K5: roll by size ----------------------------------------------------------------

def assign_size_parts(messages: DataFrame, max_bytes: int = MAX_PART_BYTES, minutes: int = ROLL_MINUTES,
                      framing: str = "line") -> DataFrame:
    """Per message: ``part_no = floor(bytes before it in its (date, window) / max_bytes)``,
    ordered by (arrival, offset). Fixed bins, parallel and repeatable."""
    rows = messages.select(
        "offset", "arrival_ts",
        date_text("arrival_ts").alias("date"),
        _window_start("arrival_ts", minutes * 60).alias("window_start"),
        line_bytes("value", framing).cast("bigint").alias("bytes"))
    summed = running_sum(rows, ["date", "window_start"], ["arrival_ts", "offset"], "bytes", "running")
    return summed.withColumn("part_no", F.call_function("div", F.col("running") - F.col("bytes"), F.lit(max_bytes).cast("bigint")))


def roll_by_size(messages: DataFrame, max_bytes: int = MAX_PART_BYTES, minutes: int = ROLL_MINUTES,
                 framing: str = "line") -> DataFrame:
    parts = assign_size_parts(messages, max_bytes, minutes, framing)
    return (parts.groupBy("date", "window_start", "part_no")
            .agg(F.count(F.lit(1)).alias("n_messages"), F.sum("bytes").alias("n_bytes"),
                 F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")))
