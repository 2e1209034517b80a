"""The range-split running sum against a brute-force pandas computation."""

import random
from decimal import Decimal

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.plans import bucketed, n_buckets, running_sum


def _brute(pdf, group, order, value):
    pdf = pdf.sort_values(group + order)
    pdf["expect"] = pdf.groupby(group)[value].cumsum() if group else pdf[value].cumsum()
    return pdf


def test_hot_group_split_over_partitions(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c", "d"])
        rows.append((i, g, rnd.randint(0, 50), rnd.random()))
    df = spark.createDataFrame(rows, "id long, g string, b long, x double")
    out = running_sum(df, ["g"], ["id"], ["b", "x"], ["rb", "rx"], rows_per_bucket=300).toPandas()
    exp = _brute(pd.DataFrame(rows, columns=["id", "g", "b", "x"]), ["g"], ["id"], "b")
    expx = _brute(pd.DataFrame(rows, columns=["id", "g", "b", "x"]), ["g"], ["id"], "x")
    m = out.merge(exp[["id", "expect"]], on="id").merge(expx[["id", "expect"]].rename(columns={"expect": "ex"}), on="id")
    assert len(m) == 3000
    assert (m.rb == m.expect).all()
    assert ((m.rx - m.ex).abs() < 1e-9).all()


def test_global_running_count_and_nulls(spark):
    rows = [(i, None if i % 7 == 0 else i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v long")
    out = running_sum(df, [], ["id"], "v", "r", rows_per_bucket=80).orderBy("id").toPandas()
    exp = pd.Series([r[1] or 0 for r in rows]).cumsum()
    assert list(out.r) == list(exp)


def test_decimals_stay_exact(spark):
    df = spark.createDataFrame([(i, Decimal("0.1")) for i in range(1000)], "id long, v decimal(20,1)")
    last = running_sum(df, [], ["id"], "v", "r", rows_per_bucket=150).orderBy(F.desc("id")).first()
    assert last.r == Decimal("100.0")


def test_null_groups_and_null_order_values(spark):
    rows = [("a", None, 1), (None, 3, 5), (None, 1, 7), ("a", 2, 2), (None, None, 11)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {(r.g, r.o): r.s for r in running_sum(df, ["g"], ["o"], "v", "s", rows_per_bucket=2).collect()}
    assert got == {("a", None): 1, ("a", 2): 3, (None, None): 11, (None, 1): 18, (None, 3): 23}


def test_empty(spark):
    assert running_sum(spark.createDataFrame([], "id long, v long"), [], ["id"], "v", "r").count() == 0


def test_buckets_keep_their_size_as_rows_grow(spark):
    largest = []
    for rows in (20_000, 400_000):
        df = spark.range(rows).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as g")
        cut = bucketed(df, ["g", "id"], rows_per_bucket=2_000)
        sizes = [r["count"] for r in cut.groupBy("_qs_bucket").count().collect()]
        hot = cut.where("g = 'hot'").select("_qs_bucket").distinct().count()
        assert sum(sizes) == rows and hot >= len(sizes) // 4
        largest.append(max(sizes))
    assert max(largest) < 3 * 2_000
    assert n_buckets(10**12, 200) == 10**6 and n_buckets(0, 200) == 1 and n_buckets(10_000, 200) == 3 and n_buckets(10**6, 8) == 8


def test_any_orderable_type(spark):
    import datetime as dt
    kinds = {"string": lambda i: f"k{i:05d}", "date": lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i), "decimal(30,2)": lambda i: Decimal(i) / 100 + 10**20,
             "binary": lambda i: i.to_bytes(4, "big"), "timestamp": lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(seconds=i), "boolean": lambda i: bool(i)}
    for kind, make in kinds.items():
        n = 2 if kind == "boolean" else 400
        df = spark.createDataFrame([(make(i), i) for i in range(n)], f"o {kind}, v long")
        got = {r.v: r.s for r in running_sum(df, [], ["o"], "v", "s", rows_per_bucket=50).collect()}
        assert got == {i: i * (i + 1) // 2 for i in range(n)}, kind


def test_equals_window_on_real_table(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = running_sum(ev, ["event_type"], ["ts", "event_id"], "user_id", "r")
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    b = ev.withColumn("r2", F.sum("user_id").over(w))
    assert a.join(b.select("event_id", "r2"), "event_id").where("r != r2").count() == 0
    assert a.count() == ev.count()


def test_input_is_made_once(spark):
    """Counting and sampling for the cut points must not run the input again."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for rb in batches:
            made.add(rb.num_rows)
            yield rb

    df = spark.range(20_000).mapInArrow(count, "id long").selectExpr("id % 3 as g", "id as o", "id as v")
    out = running_sum(df, ["g"], ["o"], "v", "s", rows_per_bucket=3_000)
    assert out.agg(F.sum("v")).first()[0] == sum(range(20_000))
    assert made.value == 20_000


def test_the_first_copy_of_the_rows_goes(spark):
    import glob

    from quayside.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/*ordered-*"))
    assert bucketed(spark.range(10), ["id"]).count() == 10
    assert [p.rsplit("/", 1)[1].split("-")[0] for p in set(glob.glob(f"{folder}/*ordered-*")) - before] == ["ordered"]


def test_long_whole_decimals_keep_their_order(spark):
    """Neighbours that share their nearest double, both signs, null, and ties broken by the next column."""
    big = [s * (10**19 + i) for s in (1, -1) for i in range(40)] + [2**53 + i for i in range(5)] + [0, None, 1, 1]
    rows = [(None if o is None else Decimal(o), f"t{i:03d}", 1 + i) for i, o in enumerate(big)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "o decimal(20,0), t string, v long")
    got = {r.t: r.s for r in running_sum(df, [], ["o", "t"], "v", "s", rows_per_bucket=7).collect()}
    upto, want = 0, {}
    for o, t, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        upto += v
        want[t] = upto
    assert got == want
