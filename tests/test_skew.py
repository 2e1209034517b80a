"""One key holding a third of all rows: results stay exact and whole."""

import datetime as dt
import random

import pandas as pd
from quayside.operators import cdc, ingest

T0 = dt.datetime(2024, 1, 1)


def _skewed_log(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for pos in range(n):
        key = 0 if pos % 3 == 0 else rnd.randint(1, 200)        # key 0 has a third of the rows
        op = rnd.choice(["c", "u", "u", "d"])
        rows.append((key, op, T0 + dt.timedelta(seconds=rnd.randint(0, 5000)), pos, float(pos)))
    return rows, spark.createDataFrame(rows, "key long, op string, change_ts timestamp_ntz, position long, amount double")


def test_latest_image_with_hot_key(spark):
    rows, log = _skewed_log(spark)
    ours = {r.key: r.position for r in cdc.latest_image(cdc.skip_operations(log), "key", ["change_ts", "position"]).collect()}
    pdf = pd.DataFrame(rows, columns=["key", "op", "change_ts", "position", "amount"])
    pdf = pdf[pdf.op != "d"].sort_values(["change_ts", "position"]).groupby("key").tail(1)
    assert ours == dict(zip(pdf.key, pdf.position))


def test_bulk_batches_with_hot_partition(spark):
    rows = [(0 if i % 3 == 0 else i % 4, i, "x" * (i % 50)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "p long, k long, document string")
    ours = {(r.p, r.batch_no): r.n_actions for r in
            cdc.bulk_batches(docs, "p", ["k"], max_actions=700, max_bytes=9000).collect()}
    pdf = pd.DataFrame(rows, columns=["p", "k", "document"]).sort_values(["p", "k"])
    pdf["bytes"] = pdf.document.str.len()
    pdf["rank"] = pdf.groupby("p").cumcount() + 1
    pdf["running"] = pdf.groupby("p").bytes.cumsum()
    pdf["batch"] = [max((r - 1) // 700, (run - b) // 9000) for r, run, b in zip(pdf["rank"], pdf.running, pdf.bytes)]
    brute = pdf.groupby(["p", "batch"]).size().to_dict()
    assert ours == brute
    assert sum(ours.values()) == 6000                          # nothing dropped


def test_roll_by_size_hot_window(spark):
    # every message in one (date, 2-minute window): the hot group of K5
    rows = [(0, i, T0 + dt.timedelta(microseconds=i), "k", "m" * (i % 7)) for i in range(4000)]
    msgs = spark.createDataFrame(rows, "partition int, offset long, arrival_ts timestamp_ntz, partition_key string, value string")
    parts = ingest.assign_size_parts(msgs, max_bytes=1000).select("offset", "part_no").toPandas().set_index("offset")
    sizes = pd.Series([(i % 7) + 1 for i in range(4000)])
    before = sizes.cumsum() - sizes
    assert (parts.sort_index().part_no.values == (before // 1000).values).all()
    assert len(parts) == 4000
