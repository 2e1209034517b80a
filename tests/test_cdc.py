"""Change-data cases of FIXTURES.md section 4."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types

from quayside import schemas
from quayside.operators import cdc

T = dt.datetime(2024, 1, 1)
LOG_SCHEMA = "key long, op string, change_ts timestamp_ntz, position long, amount double"


def _log(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def _state(df):
    return {r.key: (r.op, r.amount) for r in df.collect()}


def test_upsert_cases(spark):
    rows = [
        (1, "c", T, 1, 10.0),                                   # insert
        (2, "c", T, 2, 20.0), (2, "u", T + dt.timedelta(1), 3, 21.0),   # insert + update
        (3, "c", T, 4, 30.0), (3, "d", T + dt.timedelta(1), 5, 30.0),   # insert + delete: stays
        (4, "d", T, 6, 40.0), (4, "c", T + dt.timedelta(1), 7, 41.0),   # delete + re-insert
        (5, "c", T, 9, 50.0), (5, "u", T, 8, 51.0),             # equal change_ts: position decides
    ]
    latest = cdc.latest_image(cdc.skip_operations(_log(spark, rows)), "key", ["change_ts", "position"])
    assert _state(latest) == {1: ("c", 10.0), 2: ("u", 21.0), 3: ("c", 30.0), 4: ("c", 41.0), 5: ("c", 50.0)}


def test_only_listed_operations_go(spark):
    rows = [(1, None, T, 1, 1.0), (2, "d", T, 2, 2.0), (3, "x", T, 3, 3.0)]
    assert sorted(r.key for r in cdc.skip_operations(_log(spark, rows)).collect()) == [1, 3]


def _envelope(**fields):
    return json.dumps(fields)


def test_change_envelopes(spark):
    image = {f.name: "1" for f in schemas.ASSET_RECORD.fields} | {"f_type": 3, "f_action": 4, "f_id": 18446744073709551615, "f_fee": "0.000000000000000001", "f_symbol": "BTC"}
    texts = [_envelope(op="c", before=None, after=image, ts_ms=1700000000123, position=7), _envelope(op="d", before=image | {"f_symbol": "old"}, after=None, ts_ms=1, position=8),
             _envelope(op="u", before=image, after=image | {"f_symbol": "new"}, ts_ms=2, position=9), "not json", None, "{}", _envelope(op="u", before=None, after=None), _envelope(after=image)]
    messages = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset long, value string")
    rows = sorted(cdc.decode_envelopes(messages).collect(), key=lambda r: r.position)
    assert [(r.op, r.f_symbol) for r in rows] == [("c", "BTC"), ("d", "old"), ("u", "new")]
    assert rows[0].f_id == Decimal("18446744073709551615") and rows[0].f_fee == Decimal("0.000000000000000001")
    assert rows[0].change_ts == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert [f.dataType for f in cdc.decode_envelopes(messages).schema.fields[3:]] == [f.dataType for f in schemas.ASSET_RECORD.fields]
    assert sorted(r.offset for r in cdc.envelope_rejects(messages).collect()) == [3, 4, 5, 6, 7]
    assert [r.position for r in cdc.skip_operations(cdc.decode_envelopes(messages)).orderBy("position").collect()] == [7, 9]


def test_snapshot_then_log_no_gap_no_double(spark):
    snap = spark.createDataFrame([(1, 1.0, "s"), (2, 2.0, "s")], "key long, amount double, note string")
    log = spark.createDataFrame([(2, "u", 0, 2.5, "l"), (2, "u", 0, 2.5, "l"), (3, "c", 1, 3.0, "l"), (1, "d", 2, 0.0, "l")],
                                "key long, op string, position long, amount double, note string")
    out = {r.key: (r.amount, r.op) for r in cdc.snapshot_plus_log(snap, log, "key").collect()}
    assert out == {1: (1.0, "r"), 2: (2.5, "u"), 3: (3.0, "c")}


def test_decimal_ids_and_plain_text(spark):
    df = spark.createDataFrame([(Decimal("18446744073709551615"), Decimal("0")), (Decimal("-7"), Decimal("1.5"))],
                               "f_id decimal(20,0), f_amount decimal(36,18)")
    mods = {r.f_id: r.partition_key for r in cdc.mod_partition_key(df, "f_id", 4).collect()}
    assert mods[Decimal("-7")] == -3 and mods[Decimal("18446744073709551615")] == 3
    doc = cdc.json_documents(df, "f_id").orderBy("doc_id").collect()
    assert doc[1].doc_id == "18446744073709551615"
    assert '"f_amount":"0.000000000000000000"' in doc[1].document
    raw = cdc.json_documents(df, "f_id", decimals="raw").orderBy("doc_id").collect()
    assert '"f_amount":0E-18' in raw[1].document


def test_conform_types_and_not_null(spark):
    row = {f.name: 1 for f in schemas.ASSET_RECORD.fields}
    row["f_symbol"] = "BTC"
    df = spark.createDataFrame([row]).select(*[f.name for f in schemas.ASSET_RECORD.fields])
    out = cdc.conform(df)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schemas.ASSET_RECORD.fields]
    bad = df.withColumn("f_fee", F.lit(None).cast("double"))
    with pytest.raises(Exception):
        cdc.conform(bad).collect()


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert [(r.k, r.n_rows) for r in cdc.duplicate_keys(df, "k").collect()] == [(1, 2)]


def test_bulk_batches_bins(spark):
    docs = spark.createDataFrame([(0, i, "x" * 100) for i in range(2500)], "p long, k long, document string")
    out = {r.batch_no: r.n_actions for r in cdc.bulk_batches(docs, "p", ["k"], max_actions=1000, max_bytes=10**9).collect()}
    assert out == {0: 1000, 1: 1000, 2: 500}
    out = {r.batch_no: r.n_actions for r in cdc.bulk_batches(docs, "p", ["k"], max_actions=10**6, max_bytes=1000).collect()}
    assert out[0] == 10 and len(out) == 250


def test_chunk_plans_and_predicates(spark):
    from quayside.sources import snapshot
    dense = spark.range(0, 10_000).withColumnRenamed("id", "k")
    even = snapshot.plan_chunks(dense, "k", 2000).orderBy("chunk").collect()
    assert [(r.low, r.high, r.n_rows) for r in even] == [(i * 2000, i * 2000 + 1999, 2000) for i in range(5)]
    sparse = spark.range(0, 10_000).where("id % 3 != 0").withColumnRenamed("id", "k")
    uneven = snapshot.plan_chunks(sparse, "k", 2000).orderBy("chunk").collect()
    assert [r.n_rows for r in uneven] == [2000, 2000, 2000, 666]
    preds = snapshot.jdbc_chunk_predicates(snapshot.plan_chunks(sparse, "k", 500), "k", max_partitions=4)
    assert len(preds) == 4
    covered = sparse.where(" OR ".join(f"({p})" for p in preds)).count()
    assert covered == sparse.count()
    opts = snapshot.jdbc_chunk_options(0, 9999, 10, 2000)
    assert opts["numPartitions"] == "5" and opts["fetchsize"] == "2000"
    with pytest.raises(ValueError):
        snapshot.jdbc_chunk_options(0, 9999, 4, 2000)


def test_incremental_snapshot_by_chunk(spark):
    """Five chunks, each read at its own time, while a log runs: against a simulated table."""
    import random
    rnd = random.Random(8)
    table = {k: (float(k), "start") for k in range(50) if k % 7}
    log, states = [], [dict(table)]
    for position in range(1, 301):
        key = 33 if position % 3 == 0 else rnd.randint(-3, 55)  # one key holds a third of the log, some lie outside all chunks
        op = "d" if rnd.random() < 0.2 and key in table else "u" if key in table else "c"
        image = (position * 1.0, f"p{position}")
        log.append((key, op, position, *image))
        if op == "d":
            del table[key]
        else:
            table[key] = image
        states.append(dict(table))
    chunks = [(i, 10 * i, 20 + 50 * i, 60 + 50 * i) for i in range(5)]  # chunk 2 of 0..4 is read while positions 120 to 160 pass
    chunk_of = lambda k: min(max(k // 10, 0), 4)
    read = []
    for i, _, low, high in chunks:
        for k, image in states[rnd.randint(low, high)].items():
            if chunk_of(k) == i:
                read.append((k, *image))
    r = spark.createDataFrame(read, "key long, amount double, note string")
    g = spark.createDataFrame(log, "key long, op string, position long, amount double, note string")
    c = spark.createDataFrame(chunks, "chunk int, low long, low_position long, high_position long")
    # deletes are skipped: a key that was read, or changed since, keeps its last image
    want, at_high = {}, {}
    for i, _, low, high in chunks:
        rows = {k: (a, n) for k, a, n in read if chunk_of(k) == i}
        for key, op, position, *image in log:
            if chunk_of(key) == i and op != "d" and position > low:
                rows[key] = tuple(image)
            if position == high:
                at_high |= rows
        want |= rows
    first = {x.key: (x.amount, x.note) for x in cdc.chunk_rows(r, g, c, "key").collect()}
    assert first == at_high
    after = cdc.chunk_changes(g, c, "key").orderBy("position").collect()
    assert all(x.position > 60 + 50 * chunk_of(x.key) and x.op != "d" for x in after)
    for x in after:
        first[x.key] = (x.amount, x.note)
    assert first == want == {x.key: (x.amount, x.note) for x in cdc.incremental_snapshot(r, g, c, "key").collect()}


def test_locate(spark):
    from quayside.plans import locate
    starts = spark.createDataFrame([(None, "a"), ("d", "b"), ("m", "c"), ("x", "e")], "s string, name string")
    rows = spark.createDataFrame([(w, 1) for w in ["", "a", "d", "da", "lzz", "m", "w", "x", "zz"]] + [(None, 1)], "k string, s int")
    got = {r.k: r.at.name for r in locate(rows, "k", starts, "s", "at", rows_per_bucket=2).collect()}
    assert got == {None: "a", "": "a", "a": "a", "d": "b", "da": "b", "lzz": "b", "m": "c", "w": "c", "x": "e", "zz": "e"}


@pytest.mark.parametrize("kind,make", [("string", lambda i: f"key'{i:04d}"), ("decimal(20,2)", lambda i: Decimal(i) / 4 + 10**15), ("date", lambda i: dt.date(2001, 1, 1) + dt.timedelta(days=3 * i)),
                                       ("timestamp_ntz", lambda i: dt.datetime(2001, 1, 1) + dt.timedelta(seconds=7 * i))])
def test_chunks_of_any_key_type(spark, kind, make):
    from quayside.sources import snapshot
    df = spark.createDataFrame([(make(i),) for i in range(1000)] + [(make(5),)] * 30, f"k {kind}")
    chunks = snapshot.plan_chunks(df, "k", 200).orderBy("chunk").collect()
    assert [r.n_rows for r in chunks] == [200] * 5 + [30] and chunks[0].low == make(0) and chunks[-1].high == make(999)
    predicates = snapshot.jdbc_chunk_predicates(snapshot.plan_chunks(df, "k", 200), "k", max_partitions=50)
    assert len(predicates) == 6 and _reads(df, predicates) == [r.n_rows for r in chunks]


def test_damaged_envelopes(spark):
    image = {f.name: "1" if isinstance(f.dataType, types.DecimalType) else 1 if isinstance(f.dataType, types.ShortType) else "s" for f in schemas.ASSET_RECORD.fields}
    good = dict(op="u", before=image, after=image, ts_ms=1, position=5)
    cases = [(json.dumps(good), None), (json.dumps(good) + "}", "not_an_envelope"), (json.dumps(good) + ',"x":1', "not_an_envelope"), (json.dumps(good) + "],[" + json.dumps(good), "not_an_envelope"),
             (json.dumps(good) + '],"_qs_envelopes":[' + json.dumps(good), "not_an_envelope"), ("", "not_an_envelope"), ("null", "not_an_envelope"), ("3", "not_an_envelope"), ("[]", "not_an_envelope"),
             ("  " + json.dumps(good) + "\n", None), (json.dumps(good | {"after": image | {"f_type": "abc"}}), "bad_value"), (json.dumps(good | {"after": image | {"f_type": 70000}}), "bad_value"),
             (json.dumps(good | {"position": "x"}), "bad_value"), (json.dumps(good | {"before": 7}), "bad_value"), (json.dumps(good | {"after": image | {"f_id": "1" * 30}}), "bad_value"),
             (json.dumps(good | {"after": None}), "no_image"), (json.dumps(good | {"op": "d", "before": None}), "no_image"), (json.dumps(good | {"op": "d", "after": None}), None),
             (json.dumps(good | {"op": "t"}), "bad_operation"), (json.dumps(good | {"op": None}), "bad_operation"), (json.dumps(good | {"after": {k: v for k, v in image.items() if k != "f_fee"}}), "null_column"),
             (json.dumps({k: v for k, v in good.items() if k != "position"}), "no_position"), (json.dumps(good | {"ts_ms": None}), "no_time"), ("{}", "bad_operation"), (json.dumps(good | {"more": {"f_id": 1}}), None)]
    df = spark.createDataFrame([(i, t, "kept") for i, (t, _) in enumerate(cases)], "id int, value string, reason string").withColumnRenamed("reason", "note")
    bad = {r.id: r.reason for r in cdc.envelope_rejects(df).collect()}
    for i, (text, want) in enumerate(cases):
        assert bad.get(i) == want, text
    assert cdc.decode_envelopes(df).count() == sum(w is None for _, w in cases)
    for plan in (cdc.decode_envelopes(df), cdc.envelope_rejects(df)):
        assert plan._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def _reads(df, predicates):
    return [df.where(p).count() for p in predicates]


def test_chunk_predicates_read_every_row_once(spark):
    from quayside.sources import snapshot
    rows = [(k,) for k in [1] * 10 + [2] * 12 + list(range(3, 11))] + [(None,)] * 3
    df = spark.createDataFrame(rows, "k long")
    for chunk, most in ((5, 100), (5, 3), (1, 100), (50, 100)):
        predicates = snapshot.jdbc_chunk_predicates(snapshot.plan_chunks(df, "k", chunk), "k", max_partitions=most)
        assert len(predicates) <= most and sum(_reads(df, predicates)) == 33
        late = spark.createDataFrame([(-7,), (4,), (99,), (None,)], "k long")  # inserted after planning
        assert sum(_reads(late, predicates)) == 4
    sparse = spark.createDataFrame([(10 * i,) for i in range(40)], "k long")
    predicates = snapshot.jdbc_chunk_predicates(snapshot.plan_chunks(sparse, "k", 5), "k", max_partitions=100)
    assert _reads(spark.range(-5, 500).withColumnRenamed("id", "k"), predicates) == [55, 50, 50, 50, 50, 50, 50, 150]


def test_text_keys_are_quoted(spark):
    from quayside.sources import snapshot
    df = spark.createDataFrame([("a'b",), ("c",), ("d",), ("d",)], "k string")
    chunks = df.groupBy("k").count().selectExpr("ascii(k) - 97L as chunk", "k as low", "k as high", "count as n_rows")
    predicates = snapshot.jdbc_chunk_predicates(chunks, "k", max_partitions=10)
    assert sum(_reads(df, predicates)) == 4 and len(predicates) == 3


def test_factor_is_exact(spark):
    from quayside.sources import snapshot
    low = 10 ** 19
    assert snapshot.is_even(low, low + 1999, 2000) and not snapshot.is_even(low, low + 2000, 2000)
    keys = spark.createDataFrame([(Decimal(low + i),) for i in range(2000)], "k decimal(20,0)")
    chunks = snapshot.plan_chunks(keys, "k", 500).orderBy("chunk").collect()
    assert [(int(r.low) - low, int(r.high) - low, r.n_rows) for r in chunks] == [(500 * i, 500 * i + 499, 500) for i in range(4)]
    wide = spark.createDataFrame([(-2 ** 63,), (2 ** 63 - 1,)], "k long")
    assert snapshot.plan_chunks(wide, "k", 2000).count() == 1
    assert snapshot.even_chunks(wide, "k", 2 ** 62).orderBy("chunk").collect()[-1].chunk == 3


def test_hot_key_spans_chunks(spark):
    from quayside.sources import snapshot
    df = spark.createDataFrame([(7,)] * 1000 + [(i,) for i in range(2000)], "k long")
    chunks = snapshot.uneven_chunks(df, "k", 300).orderBy("chunk").collect()
    assert [r.n_rows for r in chunks] == [300] * 10
    assert [(r.low, r.high) for r in chunks[:4]] == [(0, 7), (7, 7), (7, 7), (7, 199)]
