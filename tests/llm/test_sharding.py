import collections
import math
import random
import zlib

from helpers import empty, frame, prose

from quayside.llm import queries, sharding

SMALL = "/root/testdata/sf0.001"


def _places(df):
    return [(r.place.shard, r.place.slot, r.doc_id, r.text) for r in df.collect()]


def _exact(places, shards):
    slots = collections.defaultdict(list)
    for s, slot, *_ in places:
        slots[s].append(slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_exact_sizes_and_gapless_slots(spark):
    rnd = random.Random(1)
    docs = frame(spark, [prose(rnd, 5) for _ in range(205)] + [None, "", "x" * 200_000])
    out = sharding.shuffle_shards(docs, 16)
    assert out.columns == [*docs.columns, "place"]
    got = _places(out)
    _exact(got, 16)
    assert sorted(g[2] for g in got) == list(range(208))


def test_repeated_rows_each_get_a_place(spark):
    docs = spark.createDataFrame([(1, "a")] * 60 + [(None, None)] * 41, "doc_id long, place string")
    got = [(r.place_.shard, r.place_.slot) for r in sharding.shuffle_shards(docs, 16).collect()]
    assert len(got) == len(set(got)) == 101
    _exact(got, 16)


def test_same_result_for_other_partitioning(spark):
    docs = frame(spark, [f"t{i}" for i in range(300)]).drop("m")
    a = sorted(_places(sharding.shuffle_shards(docs.repartition(7), 5)))
    b = sorted(_places(sharding.shuffle_shards(docs.repartition(3, "text"), 5)))
    assert a == b


def test_empty(spark):
    assert sharding.shuffle_shards(empty(spark), 16).count() == 0


def test_matrix_has_exact_margins_and_the_right_spread(spark):
    blocks = spark.createDataFrame([(b, 40) for b in range(50)], "block long, n long")
    cells = []
    for seed in range(4):
        rows = sharding.draw_matrix(blocks, 4, 11, seed).collect()
        counts = [[b - a for a, b in zip([0, *r.upto], r.upto)] for r in rows]
        assert all(sum(c) == 40 for c in counts)
        assert [sum(c) for c in zip(*counts)] == [500] * 4
        cells += [x for c in counts for x in c]
    variance = sum((x - 10) ** 2 for x in cells) / len(cells)
    # hypergeometric: n p (1-p) (N-n)/(N-1)
    assert math.isclose(variance, 40 * 0.25 * 0.75 * (2000 - 40) / 1999, rel_tol=0.25)


def test_shards_are_mixed(spark):
    docs = frame(spark, [f"t{i}" for i in range(1600)]).drop("m")
    got = _places(sharding.shuffle_shards(docs, 16))
    means = [sum(g[2] for g in got if g[0] == s) / 100 for s in range(16)]
    assert all(abs(m - 799.5) < 200 for m in means)


def test_query(spark):
    rows = queries.QUERIES["op1_sharding"](spark, SMALL).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(text)
    for r in rows:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    _exact([(r.shard, r.slot) for r in rows], 16)


def test_plan_has_no_python(spark):
    plan = sharding.shuffle_shards(frame(spark, ["a", "b"])).selectExpr("place")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_equal_rows_do_not_fill_a_block(spark):
    import math

    from pyspark.sql import functions as F
    from quayside.llm.common import packed
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS a", "if(id % 3 = 0, null, cast(id AS string)) AS b")
    parts = math.isqrt(30_000)
    rows = sharding.number_copies(df.select(packed(df), F.xxhash64(F.lit(1), "a", "b").alias("k1"), F.xxhash64(F.lit(2), "a", "b").alias("k2")), max(16, parts // 4), 5)
    blocks = [r["count"] for r in rows.groupBy(F.pmod(F.shiftrightunsigned("k1", 8), F.lit(parts))).count().collect()]
    assert sum(blocks) == 30_000 and max(blocks) < 2 * 30_000 / parts
    got = [(r.a, r.b, r.place.shard, r.place.slot) for r in sharding.shuffle_shards(df, 8).collect()]
    again = [(r.a, r.b, r.place.shard, r.place.slot) for r in sharding.shuffle_shards(df.repartition(5), 8).collect()]
    assert sorted(got, key=str) == sorted(again, key=str) and len(got) == 30_000
    for s in range(8):
        assert sorted(g[3] for g in got if g[2] == s) == list(range(3750))
    assert sum(g[1] is None for g in got) == 10_000 and all(1000 < sum(g[1] is None for g in got if g[2] == s) < 1500 for s in range(8))
