import math

import numpy as np
from helpers import DOCS  # noqa: F401  (puts the folder on the path)

from quayside.llm import posting_ann, queries

KIND = "vec_id long, embedding array<float>, label int"


def brute(ids, x, asked, k):
    out = {}
    for q in asked:
        s = np.zeros(len(ids))
        for j in range(x.shape[1]):
            s += x[:, j] * x[ids.index(q), j]
        order = [i for i in np.lexsort([ids, -s]) if ids[i] != q][:k]
        out[q] = [(ids[i], s[i]) for i in order]
    return out


def _got(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_edge_vectors_and_ties(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(60, 4)).astype(np.float32)
    rows = [(i, x[i % 20].tolist(), 0) for i in range(60)]  # every vector three times
    rows += [(100, None, 0), (101, [0.0] * 4, 0), (102, [1.0, None, 0.0, 0.0], 0), (103, [math.nan, 1.0, 0.0, 0.0], 0), (104, [math.inf, 1.0, 0.0, 0.0], 0), (105, [1.0, 2.0], 0), (106, [], 0), (None, [1.0] * 4, 0), (7, rows[7][1], 3)]
    data = spark.createDataFrame(rows, KIND)
    got = _got(posting_ann.search(data, data, k=5, per_list=8))
    want = brute(list(range(60)), np.array([r[1] for r in rows[:60]], np.float32).astype(float), range(60), 5)
    assert set(got) == set(range(60))
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.9
    for q in got:
        s = dict(want[q])
        assert len(got[q]) == 5
        assert all(abs(v - s[i]) < 1e-12 for i, v in got[q] if i in s)
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))


def test_every_list_within_the_ratio_is_searched(spark):
    x = np.random.default_rng(6).normal(size=(800, 16)).astype(np.float32)
    data = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], KIND)
    asked = range(0, 800, 40)
    got = _got(posting_ann.search(data, data.where("vec_id % 40 = 0"), k=20, per_list=2, replicas=1, ratio=100.0))
    want = brute(list(range(800)), x.astype(float), asked, 20)
    assert {q: [v for v, _ in got[q]] for q in got} == {q: [v for v, _ in want[q]] for q in want}


def test_fewer_candidates_than_k(spark):
    data = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(7)], KIND)
    got = _got(posting_ann.search(data, data, k=20, per_list=2))
    assert all([v for v, _ in got[q]] == [i for i in range(6, -1, -1) if i != q] if q else len(got[q]) == 6 for q in range(7))


def test_empty_and_unusable(spark):
    none = spark.createDataFrame([], KIND)
    assert posting_ann.search(none, none).count() == 0
    bad = spark.createDataFrame([(1, None, 0), (2, [0.0, 0.0], 0)], KIND)
    assert posting_ann.search(bad, bad).count() == 0


def test_hot_list_is_cut_into_blocks(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [1.0, 0.0, 0.0], 0) for i in range(400)] + [(400 + i, rnd.normal(size=3).tolist(), 0) for i in range(400)]
    data = spark.createDataFrame(rows, KIND)
    got = _got(posting_ann.search(data, data.where("vec_id % 100 = 0"), k=10, per_list=16, shard=50))
    assert set(got) == set(range(0, 800, 100)) and all(len(v) == 10 for v in got.values())
    assert [v for v, _ in got[100]][:1] and all(s >= 1.0 for _, s in got[100])


def test_recall_and_scores_of_the_query(spark):
    base = "/root/testdata/sf0.1"
    rows = sorted(((r.vec_id, r.embedding) for r in spark.read.parquet(f"{base}/embeddings.parquet").collect()))
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], np.float32).astype(float)
    got = _got(queries.QUERIES["op3_posting_ann"](spark, base))
    want = brute(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want)
    assert all(len(v) == 20 for v in got.values())
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.95


def test_recall_at_many_lists(spark):
    """Vectors without any structure, the hardest case: some 500 lists, of which the fitted ratio leaves out most."""
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(16000, 24)).astype(np.float32)
    data = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], KIND)
    asked = list(range(0, 16000, 200))
    got = _got(posting_ann.search(data, data.where("vec_id % 200 = 0"), k=20, per_list=32))
    y = x.astype(float)
    hits = []
    for q in asked:
        s = y @ y[q]
        s[q] = -np.inf
        hits.append(len({v for v, _ in got[q]} & set(np.argsort(-s)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_fitted_ratio_prunes():
    rnd = np.random.default_rng(4)
    middle = rnd.normal(size=(40, 16)) * 4
    x = middle[rnd.integers(0, 40, 8000)] + rnd.normal(size=(8000, 16)) * 0.3
    longest = float((x * x).sum(1).max())
    c = posting_ann.fit_centroids(posting_ann._lifted(x, longest), 100)
    ratio, usual = posting_ann.fit_ratio(x, longest, c, 10, 0.95, 3, 1.15, 0.5)
    d = np.sqrt(posting_ann._distances(np.concatenate([x[:500], np.zeros((500, 1))], axis=1), c))
    assert (d <= ratio * np.maximum(d.min(1), np.sqrt(usual))[:, None]).mean() < 0.25


def test_results_are_written_out_in_portions(spark, monkeypatch):
    best = posting_ann.Best(2)
    at = best.rows(np.array([7, 9]))
    best.merge(at[[0, 0, 0, 1]], np.array([1, 2, 3, 1]), np.array([0.5, 0.7, 0.7, 0.1]))
    best.merge(at[[0, 1, 1]], np.array([3, 1, 4]), np.array([0.7, 0.1, 0.1]))
    rows = [tuple(r.values()) for rb in best.take() for r in rb.to_pylist()]
    assert rows == [(7, 2, 0.7), (7, 3, 0.7), (9, 1, 0.1), (9, 4, 0.1)] and not best.row


def test_regions_hold_every_list():
    c = np.random.default_rng(1).normal(size=(300, 5))
    w = np.arange(300)
    groups = posting_ann.regions(c, w, 2000)
    assert sorted(np.concatenate(groups).tolist()) == list(range(300)) and all(w[g].sum() <= 2000 for g in groups)
