"""Landing, rolling plans, peek and start positions."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.operators import ingest
from quayside.sources import streams
from quayside.sinks import files


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "partition int, offset long, arrival_ts timestamp_ntz, partition_key string, value string")


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def test_roll_on_inactivity_gap_rules(spark):
    secs = [0, 10, 39.999999, 69.999999, 100, 100, 200]  # 29.99s gap stays, exactly 30s opens, ties stay
    rows = [(0, i, T0 + dt.timedelta(seconds=s), "k", "m") for i, s in enumerate(secs)]
    rows.append((0, 99, dt.datetime(2024, 1, 2, 0, 0, 5), "k", "m"))      # next date starts its own part
    out = ingest.roll_on_inactivity(_msgs(spark, rows), 30).orderBy("date", "part_no").collect()
    assert [(r.date, r.part_no, r.n_messages) for r in out] == [
        ("2024-01-01", 0, 3), ("2024-01-01", 1, 1), ("2024-01-01", 2, 2), ("2024-01-01", 3, 1),
        ("2024-01-02", 0, 1)]


def test_roll_on_inactivity_matches_brute_force(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    msgs = ev.select(F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("arrival_ts"),
                     F.lit("k").alias("partition_key"), F.col("props").alias("value"))
    ours = ingest.roll_on_inactivity(msgs, 30).toPandas()
    pdf = ev.select("ts", "event_id").toPandas().sort_values(["ts", "event_id"])
    pdf["date"] = pdf.ts.dt.strftime("%Y-%m-%d")
    gap = pdf.groupby("date").ts.diff()
    pdf["start"] = gap.isna() | (gap >= pd.Timedelta(seconds=30))
    pdf["part_no"] = pdf.groupby("date").start.cumsum() - 1
    brute = pdf.groupby(["date", "part_no"]).size().reset_index(name="n")
    m = ours.merge(brute, on=["date", "part_no"], how="outer")
    assert len(m) == len(brute) == len(ours)
    assert (m.n_messages == m.n).all()


def test_roll_by_size_bins(spark):
    rows = [(0, i, T0 + dt.timedelta(seconds=i), "k", "x" * 9) for i in range(5)]  # 10 bytes each with newline
    parts = ingest.assign_size_parts(_msgs(spark, rows), max_bytes=25, minutes=2).orderBy("offset").collect()
    assert [r.part_no for r in parts] == [0, 0, 0, 1, 1]


def test_blank_line_framing_file_content(spark, scratch):
    rows = [(0, 0, T0, "k", "m1"), (0, 1, T0, "k", "m2")]
    framed = ingest.framed_messages(_msgs(spark, rows).coalesce(1), "blank_line")
    files.write_text_by_date(framed, scratch, mode="overwrite")
    folder = os.path.join(scratch, "date=2024-01-01")
    data = b"".join(open(os.path.join(folder, f), "rb").read() for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    assert data == b"m1\n\nm2\n\n"


def test_peek_first_shard_first_ten(spark):
    rows = [(p, o, T0, str(p), '{"a":1}' if o % 2 else "not json") for p in (2, 1, 3) for o in range(15)]
    out = ingest.peek_first_records(_msgs(spark, rows), 10).orderBy("offset").collect()
    assert len(out) == 10 and {r.partition for r in out} == {1}
    assert [r.offset for r in out] == list(range(10))
    assert [r.is_json for r in out] == [bool(o % 2) for o in range(10)]


def test_start_position_rules():
    assert streams.resolve_start_position({}) == {"position": "LATEST"}
    assert streams.resolve_start_position({"start.position": "TRIM_HORIZON"})["position"] == "TRIM_HORIZON"
    with pytest.raises(ValueError):
        streams.resolve_start_position({"start.position": "trim_horizon"})
    assert streams.resolve_start_position({"start.position": "trim_horizon"}, lenient=True)["position"] == "LATEST"
    with pytest.raises(ValueError):
        streams.resolve_start_position({"start.position": "AT_TIMESTAMP"})
    spec = streams.resolve_start_position({"start.position": "AT_TIMESTAMP", "start.timestamp": "2024-01-15T00:00:00Z"})
    assert spec["timestamp"] == dt.datetime(2024, 1, 15)
    assert streams.kafka_start_options(spec) == {"startingTimestamp": str(1705276800000)}
    assert streams.kafka_start_options({"position": "LATEST"}) == {"startingOffsets": "latest"}


def test_start_position_filter_is_pushed(spark):
    from quayside.sources import standins
    spec = streams.resolve_start_position({"start.position": "AT_TIMESTAMP", "start.timestamp": "2024-01-15T00:00:00"})
    df = streams.apply_start_position(standins.message_stream(spark, "/root/testdata/sf0.001"), spec)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00)]" in plan


def test_kafka_options_security_rule():
    base = {"bootstrap.servers": "b:9092", "topic": "t", "group.id": "g"}
    opts = streams.kafka_options(base)
    assert opts["startingOffsets"] == "earliest" and "kafka.security.protocol" not in opts
    assert opts["failOnDataLoss"] == "true"
    at = streams.kafka_options({**base, "start.position": "AT_TIMESTAMP", "start.timestamp": "2024-01-15T00:00:00Z"})
    assert at["startingTimestamp"] == "1705276800000" and "startingOffsets" not in at
    assert streams.kafka_options({**base, "start.position": "LATEST"})["startingOffsets"] == "latest"
    sec = streams.kafka_options({**base, "security.protocol": "SASL_SSL", "sasl.mechanism": "SCRAM-SHA-512",
                                 "sasl.jaas.config": "x"})
    assert sec["kafka.security.protocol"] == "SASL_SSL" and sec["kafka.sasl.jaas.config"] == "x"


def test_null_values_are_counted(spark):
    from pyspark.sql import Observation
    raw = spark.createDataFrame([(0, 1, T0, bytearray(b"k"), bytearray(b"v")), (0, 2, T0, None, None), (1, 3, T0, None, None)],
                                "partition int, offset long, timestamp timestamp, key binary, value binary")
    assert [(r.offset, r.value) for r in streams.text_messages(raw).collect()] == [(1, "v")]
    seen = Observation("nulls")
    raw.observe(seen, F.count_if(F.col("value").isNull()).alias("null_values")).collect()
    assert seen.get == {"null_values": 2}
    assert "null_values" in streams.text_messages(raw)._jdf.queryExecution().toString()


def test_lake_rows_ms_truncation(spark):
    rows = [(0, 0, dt.datetime(2024, 1, 1, 23, 59, 59, 999999), "k", '{"timestamp":"17"}')]
    r = ingest.lake_rows(_msgs(spark, rows)).collect()[0]
    assert r.ts == 17 and r.processing_timestamp == dt.datetime(2024, 1, 1, 23, 59, 59, 999000)
    assert r.partition_date == "2024-01-01"
