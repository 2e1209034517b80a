"""Start functions: each wraps a pure ``DataFrame -> DataFrame`` operator.

Only these wrappers supply processing time (``localtimestamp()``); the
operators take the arrival column as an argument, so batch runs repeat. Every
start function needs a checkpoint folder of its own, kept across restarts. No
watermark is set: none of the pipelines keeps event-time state (the reference
runs without watermarks too).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.constants import SKIPPED_OPERATIONS
from quayside.operators import cdc, ingest, producer
from quayside.sinks import files, index
from quayside.sinks.retry import with_backoff
from quayside.sources.streams import rate_stream


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_text_landing(messages: DataFrame, path: str, checkpoint: str,
                       framing: str = "line", trigger: str | None = "2 minutes",
                       max_records: int | None = None, use_processing_time: bool = True) -> StreamingQuery:
    """T1 (raw landing): message stream -> ``date=`` folders of text. The trigger
    interval closes files like the reference's roll-by-age (K3). The folder is the
    date of processing, or with ``use_processing_time=False`` of arrival."""
    src = messages.withColumn("arrival_ts", F.localtimestamp()) if use_processing_time else messages
    framed = ingest.framed_messages(src, framing)
    return _trigger(files.text_landing_writer(framed, path, checkpoint, max_records), trigger).start()


def start_lake_append(messages: DataFrame, target: str, checkpoint: str,
                      path: str = "$.timestamp", mode: str = "permissive", fmt: str = "parquet",
                      trigger: str | None = "5 seconds", use_processing_time: bool = True) -> StreamingQuery:
    """T1 (stream to lake): JSON field, processing time in milliseconds,
    partition date; appended to a partitioned table. See ``start_lake_rejects`` for the
    messages whose field is no whole number."""
    src = messages.withColumn("arrival_ts", F.localtimestamp()) if use_processing_time else messages
    w = _trigger(files.lake_append_writer(ingest.lake_rows(src, path, mode), target, checkpoint, fmt), trigger)
    return w.toTable(target) if fmt == "iceberg" else w.start()


def start_lake_rejects(messages: DataFrame, target: str, checkpoint: str, path: str = "$.timestamp",
                       trigger: str | None = "5 seconds") -> StreamingQuery:
    """P4's side output as a second query over the same source: messages that carry a scalar at
    ``path`` which is no whole number (``partition, offset, json_value``), appended to a Parquet folder.
    It needs a checkpoint of its own."""
    rejects = ingest.json_rejects(messages, path, id_cols=("partition", "offset"))
    w = rejects.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return _trigger(w.outputMode("append"), trigger).start()


def start_index_upsert(changes: DataFrame, root: str, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
    """Change stream -> keyed index kept as one partition per micro-batch; read it with
    ``sinks.index.index_state``. A replayed batch replaces itself."""
    w = changes.writeStream.foreachBatch(lambda batch, batch_id: index.write_changes(batch, batch_id, root))
    return _trigger(w.option("checkpointLocation", checkpoint), trigger).start()


#: keyed state lives in RocksDB on the executors' disks, with changes uploaded per batch
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def start_keyed_upsert(changes: DataFrame, key: str, order_cols: Sequence[str], checkpoint: str, write: Callable[[DataFrame, int], None],
                       trigger: str | None = "5 seconds", skipped: Sequence[str] = SKIPPED_OPERATIONS, **retry) -> StreamingQuery:
    """T2 with keyed state: the newest image per key is kept in the state store, and ``write(rows, batch_id)``
    gets, per micro-batch, the current images of the keys that the batch touched, one row each.

    A change that arrives late does not replace a newer image: its key comes out again with the image it
    had. Deletes are skipped. State is one image per key, never history; it is held in RocksDB and
    recovered from the checkpoint, so a restart goes on where the query stopped; a batch that is replayed
    after a failure gives the same rows with the same number. ``write`` is retried with exponential
    backoff (``retry``: arguments of ``sinks.retry.with_backoff``)."""
    newest = cdc.latest_image(cdc.skip_operations(changes, skipped), key, order_cols)
    w = newest.writeStream.outputMode("update").foreachBatch(with_backoff(write, **retry))
    spark = changes.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:  # a query takes its settings from the session when it starts
        return _trigger(w.option("checkpointLocation", checkpoint), trigger).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_connector_upsert(changes: DataFrame, props: dict, key: str, order_cols: Sequence[str], checkpoint: str,
                           trigger: str | None = "5 seconds", fmt: str = index.CONNECTOR, **retry) -> StreamingQuery:
    """T2 through the index connector: each micro-batch's newest documents, by key; a failed write is tried
    again with exponential backoff (``retry``: arguments of ``sinks.retry.with_backoff``)."""
    write = with_backoff(lambda batch, _: index.write_documents(batch, props, key, order_cols, fmt), **retry)
    return _trigger(changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), trigger).start()


def start_producer(spark: SparkSession, topic: str, sink_format: str, options: dict,
                   checkpoint: str, rows_per_second: int = 100,
                   trigger: str | None = "1 second", query_name: str | None = None) -> StreamingQuery:
    """T4: counter source at most 100 per second -> ``Message <i> at <ms>`` with a
    UUID key. For Kafka pass ``sink_format="kafka"`` and ``sinks.kafka.producer_options(...)``."""
    msgs = producer.outgoing_messages(rate_stream(spark, rows_per_second), topic).drop("idx")
    w = (msgs.writeStream.format(sink_format).options(**options)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()
