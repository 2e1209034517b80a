"""Streaming wrappers over file sources: restart, no duplicates, batch == stream."""

import datetime as dt
import inspect
import os

import pytest
from pyspark.sql import functions as F

from quayside.operators import cdc, ingest
from quayside.sinks import index
from quayside.sources import standins
from quayside.streaming import pipelines

SMALL = "/root/testdata/sf0.001"
MSG_SCHEMA = "partition int, offset long, arrival_ts timestamp_ntz, partition_key string, value string"


def _land_inputs(spark, root, n_files=3):
    msgs = standins.message_stream(spark, SMALL)
    for i in range(n_files):
        msgs.where(F.col("offset") % n_files == i).coalesce(1).write.mode("overwrite").parquet(f"{root}/in/f{i}")
    return msgs


def _stream(spark, root, pattern):
    return (spark.readStream.schema(MSG_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(f"{root}/{pattern}"))


def test_lake_append_restart_and_new_files(spark, scratch):
    msgs = _land_inputs(spark, scratch, 2)
    ckpt, out = f"{scratch}/ckpt", f"{scratch}/lake"
    src = _stream(spark, scratch, "in")
    q = pipelines.start_lake_append(src, out, ckpt, path="$.k", trigger="availableNow", use_processing_time=False)
    q.awaitTermination()
    first = spark.read.parquet(out)
    expected = ingest.lake_rows(msgs, path="$.k")
    assert first.count() == msgs.count()
    assert first.select("payload", "ts", "processing_timestamp", "partition_date").exceptAll(expected).count() == 0
    # restart with the same checkpoint and no new input: nothing is added
    q = pipelines.start_lake_append(_stream(spark, scratch, "in"), out, ckpt, path="$.k", trigger="availableNow",
                                    use_processing_time=False)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == msgs.count()
    # a new file: only its rows are added
    msgs.limit(5).coalesce(1).write.parquet(f"{scratch}/in/f9")
    q = pipelines.start_lake_append(_stream(spark, scratch, "in"), out, ckpt, path="$.k", trigger="availableNow",
                                    use_processing_time=False)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == msgs.count() + 5


def test_text_landing_blank_lines(spark, scratch):
    _land_inputs(spark, scratch, 1)
    q = pipelines.start_text_landing(_stream(spark, scratch, "in"), f"{scratch}/text", f"{scratch}/ck",
                                     framing="blank_line", trigger="availableNow")
    q.awaitTermination()
    back = spark.read.text(f"{scratch}/text")
    n = standins.message_stream(spark, SMALL).count()
    assert back.where(F.col("value") != "").count() == n and back.where(F.col("value") == "").count() == n
    assert any(d.startswith("date=") for d in os.listdir(f"{scratch}/text"))


def test_index_upsert_stream_equals_one_shot(spark, scratch):
    log = standins.change_log(spark, SMALL)
    days = [r[0] for r in log.select(F.to_date("change_ts")).distinct().orderBy(F.lit(1)).collect()]
    # land the log as one file per day, newest day first, so older changes arrive late
    for i, d in enumerate(sorted(days, reverse=True)):
        log.where(F.to_date("change_ts") == F.lit(d)).coalesce(1).write.parquet(f"{scratch}/log/{i:03d}")
    src = (spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{scratch}/log"))
    root, ck = f"{scratch}/index", f"{scratch}/ck"
    want = cdc.latest_image(cdc.skip_operations(log), "key", ["change_ts", "position"])

    def state():
        return index.index_state(spark, root, "key", ["change_ts", "position"]).select(*want.columns)

    pipelines.start_index_upsert(src, root, ck, trigger="availableNow").awaitTermination()
    assert state().count() == want.count() and state().exceptAll(want).count() == 0
    # a replayed batch replaces its own partition, a restart adds nothing
    rows = spark.read.parquet(root).count()
    index.write_changes(spark.read.parquet(f"{root}/batch_id=0"), 0, root)
    pipelines.start_index_upsert(src, root, ck, trigger="availableNow").awaitTermination()
    assert spark.read.parquet(root).count() == rows and state().exceptAll(want).count() == 0
    # a later file with an older and a newer change
    first = want.orderBy("key").first()
    older = [(first.key, "u", dt.datetime(2000, 1, 1), -1, 0.0, "older")]
    newer = [(first.key, "u", dt.datetime(2100, 1, 1), 10 ** 9, 1.0, "newer")]
    spark.createDataFrame(older, log.schema).coalesce(1).write.parquet(f"{scratch}/log/998")
    pipelines.start_index_upsert(src, root, ck, trigger="availableNow").awaitTermination()
    assert state().exceptAll(want).count() == 0
    spark.createDataFrame(newer, log.schema).coalesce(1).write.parquet(f"{scratch}/log/999")
    pipelines.start_index_upsert(src, root, ck, trigger="availableNow").awaitTermination()
    assert {r.key: r.note for r in state().collect()}[first.key] == "newer"


def test_lake_rejects_and_restart(spark, scratch):
    rows = [(0, i, dt.datetime(2024, 1, 1), "k", v) for i, v in enumerate(['{"k":1}', '{"k":"x"}', '{"k":1.5}', "bad", '{"o":1}'])]
    spark.createDataFrame(rows, MSG_SCHEMA).coalesce(1).write.parquet(f"{scratch}/in/f0")
    for _ in range(2):
        src = _stream(spark, scratch, "in")
        pipelines.start_lake_rejects(src, f"{scratch}/rejects", f"{scratch}/ck", path="$.k", trigger="availableNow").awaitTermination()
        assert sorted((r.offset, r.json_value) for r in spark.read.parquet(f"{scratch}/rejects").collect()) == [(1, "x"), (2, "1.5")]


def test_text_landing_restart_and_dates(spark, scratch):
    _land_inputs(spark, scratch, 1)
    n = standins.message_stream(spark, SMALL).count()
    for _ in range(2):
        pipelines.start_text_landing(_stream(spark, scratch, "in"), f"{scratch}/now", f"{scratch}/ck1", trigger="availableNow").awaitTermination()
        assert spark.read.text(f"{scratch}/now").count() == n
    assert len([d for d in os.listdir(f"{scratch}/now") if d.startswith("date=")]) <= 2  # the day of processing
    pipelines.start_text_landing(_stream(spark, scratch, "in"), f"{scratch}/then", f"{scratch}/ck2", trigger="availableNow", use_processing_time=False).awaitTermination()
    assert len([d for d in os.listdir(f"{scratch}/then") if d.startswith("date=")]) > 20


def test_checkpoints_are_required(spark):
    for start in (pipelines.start_text_landing, pipelines.start_lake_append, pipelines.start_lake_rejects, pipelines.start_index_upsert, pipelines.start_connector_upsert):
        assert inspect.signature(start).parameters["checkpoint"].default is inspect.Parameter.empty


def test_connector_batch(spark, scratch):
    rows = [(1, "c", dt.datetime(2024, 1, 1), 1, 1.0, "a"), (1, "u", dt.datetime(2024, 1, 1), 2, 2.0, "b"), (2, "d", dt.datetime(2024, 1, 1), 3, 3.0, "c")]
    batch = spark.createDataFrame(rows, "key long, op string, change_ts timestamp_ntz, position long, amount double, note string")
    docs = index.newest_documents(batch, "key", ["change_ts", "position"]).collect()
    assert [(r.doc_id, r.version) for r in docs] == [("1", 2)] and '"note":"b"' in docs[0].document
    options = index.index_options({"hosts": "h", "index": "i"}, "doc_id", "version")
    assert options["es.mapping.version.type"] == "external_gte" and options["es.write.operation"] == "index"


def test_shared_folder_is_required_beyond_local_masters():
    from types import SimpleNamespace

    from quayside.session import checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))


def test_producer_rate_and_format(spark, scratch):
    import re
    import time

    q = pipelines.start_producer(spark, "events-out", "memory", {}, f"{scratch}/ck", rows_per_second=100,
                                 trigger="1 second", query_name="produced")
    try:  # the rate source never runs dry, so wait for progress instead of processAllAvailable()
        deadline = time.time() + 60
        while time.time() < deadline and not [p for p in q.recentProgress if p.get("numInputRows", 0) > 0]:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = spark.sql("select * from produced").collect()
    assert rows, "no messages produced"
    assert all(r.topic == "events-out" for r in rows)
    assert all(re.fullmatch(r"Message \d+ at \d{13}", r.value) for r in rows)
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", r.key) for r in rows)
    assert len({r.key for r in rows}) == len(rows)


def test_producer_and_index_options():
    from quayside.sinks import kafka
    opts = kafka.producer_options({"bootstrap.servers": "b:9092"})
    assert opts["kafka.acks"] == "all" and opts["kafka.retries"] == "3" and opts["kafka.linger.ms"] == "10"
    assert opts["kafka.request.timeout.ms"] == "2000" and opts["kafka.max.block.ms"] == "2000"
    with pytest.raises(ValueError):
        kafka.producer_options({"bootstrap.servers": "b:9092", "kafka.request.timeout.ms": 30000})
    assert opts["kafka.delivery.timeout.ms"] == "10000" and opts["kafka.batch.size"] == "16384"
    es = index.index_options({"hosts": "h:9200", "index": "assets"}, "f_id")
    assert es["es.mapping.id"] == "f_id" and es["es.batch.size.entries"] == "1000"
    assert es["es.batch.write.retry.count"] == "20"


def test_lake_table_created_once_then_appended(spark):
    from quayside.sinks import files
    rows = ingest.lake_rows(standins.message_stream(spark, SMALL), path="$.k")
    name = "quayside_lake_rows_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        files.lake_append(rows, name, fmt="parquet", as_table=True)
        files.lake_append(rows, name, fmt="parquet", as_table=True)
        assert spark.table(name).count() == 2 * rows.count()
        parts = spark.sql(f"SHOW PARTITIONS {name}").count()
        assert parts == rows.select("partition_date").distinct().count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


LOG = "key long, op string, change_ts timestamp_ntz, position long, amount double, note string"
T0 = dt.datetime(2024, 1, 1)


def test_keyed_state_restart_late_and_failed_writes(spark, scratch):
    """Only touched keys come out, late changes lose, a failed batch is replayed with its number."""
    seen, fail, slept = [], [], []

    def write(rows, batch_id):
        if fail:
            raise fail.pop()
        seen.append((batch_id, sorted((r.key, r.note) for r in rows.collect())))

    def land(name, *rows):
        spark.createDataFrame([(k, op, T0, p, 1.0, note) for k, op, p, note in rows], LOG).coalesce(1).write.parquet(f"{scratch}/log/{name}")

    def go(**retry):
        src = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{scratch}/log")
        q = pipelines.start_keyed_upsert(src, "key", ["change_ts", "position"], f"{scratch}/ck", write, "availableNow", sleep=slept.append, **retry)
        q.awaitTermination()

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    land("a", (1, "c", 1, "one"), (2, "c", 2, "two"), (2, "u", 5, "two b"), (3, "d", 6, "gone"))
    go()
    assert seen == [(0, [(1, "one"), (2, "two b")])]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    land("b", (2, "u", 3, "late"), (4, "c", 7, "four"))  # restart: key 2 keeps its newer image, key 1 does not come again
    go()
    assert seen[1:] == [(1, [(2, "two b"), (4, "four")])]
    land("c", (1, "u", 8, "one b"))
    fail += [OSError("busy")] * 3
    go()
    assert slept == [0.5, 1.0, 2.0] and seen[2:] == [(2, [(1, "one b")])]
    land("d", (4, "u", 9, "four b"))
    fail += [OSError("down")] * 3
    with pytest.raises(Exception, match="down"):
        go(retries=2)
    assert len(seen) == 3
    fail.clear()
    go()  # the same batch again
    assert seen[3:] == [(3, [(4, "four b")])]
    progress = os.listdir(f"{scratch}/ck/state/0/0")
    assert any(n.endswith((".changelog", ".zip")) for n in progress)


def test_backoff_doubles_then_fails():
    from quayside.sinks.retry import seconds, waits, with_backoff
    slept, calls = [], []

    def write(n):
        calls.append(n)
        if len(calls) <= n:
            raise OSError(len(calls))
        return "done"

    assert with_backoff(write, sleep=slept.append)(4) == "done" and slept == [0.5, 1.0, 2.0, 4.0] and len(calls) == 5
    calls.clear(), slept.clear()
    with pytest.raises(OSError) as e:
        with_backoff(write, sleep=slept.append)(99)
    assert len(calls) == 21 and e.value.args == (21,) and slept == waits() == [0.5 * 2**i for i in range(20)]
    calls.clear(), slept.clear()
    with pytest.raises(OSError):
        with_backoff(write, fatal=(OSError,), sleep=slept.append)(5)
    assert len(calls) == 1 and not slept
    assert waits(5, 1.0, longest=3.0) == [1.0, 2.0, 3.0, 3.0, 3.0] and seconds("500ms") == 0.5 and seconds("2min") == 120.0 and seconds("1s") == 1.0


def test_compacted_index_reads_base_and_later_batches(spark, scratch):
    root = f"{scratch}/index"
    rows = lambda *r: spark.createDataFrame([(k, op, T0, p, 1.0, note) for k, op, p, note in r], LOG)
    state = lambda: {r.key: r.note for r in index.index_state(spark, root, "key", ["position"]).collect()}
    index.write_changes(rows((1, "c", 1, "a"), (2, "c", 2, "b")), 0, root)
    index.write_changes(rows((1, "u", 5, "c"), (2, "d", 6, "x")), 1, root)
    assert index.compact_index(spark, root, "key", ["position"]) == 1 and state() == {1: "c", 2: "b"}
    assert index.compact_index(spark, root, "key", ["position"]) == 1  # nothing new
    index.write_changes(rows((1, "u", 4, "late"), (3, "c", 7, "d")), 2, root)
    assert state() == {1: "c", 2: "b", 3: "d"}
    plan = index.index_state(spark, root, "key", ["position"])._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any("batch_id" in f and "> 1)" in f for f in filters)
    # a base that was not finished does not count
    os.makedirs(f"{root}-base/through=2")
    assert index.base_through(spark, root) == 1 and index.compact_index(spark, root, "key", ["position"]) == 2
    index.write_changes(rows((1, "u", 4, "late"), (3, "c", 7, "d")), 2, root)  # replay of a batch the base holds
    assert state() == {1: "c", 2: "b", 3: "d"}
    assert index.expire(spark, root) == 3 and state() == {1: "c", 2: "b", 3: "d"}
    index.write_changes(rows((1, "u", 9, "e")), 3, root)
    assert state() == {1: "e", 2: "b", 3: "d"}
