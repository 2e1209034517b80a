"""Load-run statistics (FIXTURES.md section 6)."""

from quayside.operators import metrics


def _log(spark, rows):
    return spark.createDataFrame(rows, "latency_ms double, status string")


def test_index_rule_percentiles_1_to_100(spark):
    out = metrics.latency_summary(_log(spark, [(float(i), "success") for i in range(1, 101)])).first()
    assert (out.p50, out.p95, out.p99) == (51.0, 96.0, 100.0)
    assert out.n == 100 and out.min_ms == 1.0 and out.max_ms == 100.0 and abs(out.avg_ms - 50.5) < 1e-9


def test_index_rule_1_to_4_and_one_row(spark):
    assert metrics.latency_summary(_log(spark, [(float(i), "success") for i in range(1, 5)])).first().p50 == 3.0
    one = metrics.latency_summary(_log(spark, [(7.0, "success")])).first()
    assert (one.p50, one.p95, one.p99) == (7.0, 7.0, 7.0)


def test_errors_only(spark):
    rows = [(5.0, "error: boom"), (6.0, "timeout: slow")]
    out = metrics.latency_summary(_log(spark, rows)).first()
    assert out.p50 is None and not out.n
    t = metrics.throughput_summary(_log(spark, rows), 1200).first()
    assert t.total_queries == 0 and t.n_errors == 2 and t.success_rate_compat is None and t.success_rate == 0.0


def test_success_rate_as_written_and_corrected(spark):
    rows = [(1.0, "success")] * 3 + [(1.0, "error: x")] * 5
    t = metrics.throughput_summary(_log(spark, rows), 1200).first()
    assert round(t.success_rate_compat, 2) == -66.67 and t.success_rate == 37.5
    assert abs(t.actual_qps - 3 / 1200) < 1e-12


def test_status_classes(spark):
    rows = [(1.0, "success"), (1.0, "timeout: late"), (1.0, "error: x"), (1.0, "error: y")]
    got = {r.status_class: r.n for r in metrics.status_counts(_log(spark, rows)).collect()}
    assert got == {"success": 1, "timeout": 1, "error": 2}


def test_csv_export(spark, scratch):
    from quayside.sources import standins
    log = standins.result_log(spark, "/root/testdata/sf0.001")
    metrics.write_csv(log, scratch + "/csv")
    back = spark.read.option("header", True).csv(scratch + "/csv")
    assert back.columns == list(metrics.CSV_COLUMNS) and back.count() == log.count()


def test_selection_by_bits_equals_sorting(spark):
    import datetime as dt
    import random
    from decimal import Decimal

    from quayside.plans import index_percentiles
    rnd = random.Random(4)
    cases = {"double": [rnd.choice([rnd.uniform(-1, 1), rnd.uniform(-1e300, 1e300), 0.0, -0.0, 5e-324, -5e-324, float("inf"), float("-inf"), 7.25]) for _ in range(900)],
             "float": [1.5, -2.25, 0.0, 3.0] * 5, "long": [rnd.choice([2**63 - 1, -2**63, 0, -1, rnd.randint(-10**18, 10**18)]) for _ in range(300)],
             "decimal(18,2)": [Decimal(rnd.randint(-10**9, 10**9)) / 100 for _ in range(200)], "date": [dt.date(1960, 1, 1) + dt.timedelta(days=rnd.randint(0, 30000)) for _ in range(99)],
             "timestamp_ntz": [dt.datetime(1969, 12, 31) + dt.timedelta(microseconds=rnd.randint(0, 10**12)) for _ in range(50)]}
    ps = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    for kind, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"v {kind}")
        n, got = index_percentiles(df, "v", ps)
        held = sorted(values)
        assert n == len(held)
        assert got == [held[int(len(held) * p)] if int(len(held) * p) < len(held) else None for p in ps], kind
    _, nan = index_percentiles(spark.createDataFrame([(float("nan"),), (1.0,)], "v double"), "v", [0.0, 0.5])
    assert nan[0] == 1.0 and nan[1] != nan[1]
    assert index_percentiles(spark.createDataFrame([], "v double"), "v", [0.5]) == (0, [None])
