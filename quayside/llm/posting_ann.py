"""Nearest neighbours by largest inner product over balanced posting lists.

Vectors get one more component that makes all lengths equal to the longest, queries get a 0
there; then the largest inner product is the smallest Euclidean distance. Centroids are fitted by
k-means on a bounded sample (``per_list`` vectors a list on average, ``sample_per_list`` sampled vectors
for each list, at most ``max_lists`` lists), and a list that gathers more than ``BALANCE`` times its
share of the sample is split in two, as often as that helps. Each vector goes to the list of its
nearest centroid and, as a boundary vector, to up to ``replicas`` - 1 others whose centroid is nearly
as close (``closure``) and not close to a list chosen before (``apart``).

A query finds its lists by a best-first walk through a neighbour graph of the centroids, held in
memory, and keeps those whose centroid's distance is within ``ratio`` of the nearest one's (or of the
sample's median such distance, if that is larger: a query on a centroid reads its surroundings too), and at
least so many that ``least`` x k vectors are searched. The walk begins with ``breadth`` centroids and is
widened until one that it found lies outside the ratio, or all are found. Unless it is given, the
ratio is fitted: vectors of the sample are asked for their neighbours inside the sample, and the
ratio is the smallest that reads a list of ``recall`` of these (true neighbours are closer than
those of a sample and lie in nearer lists, so this errs towards more lists).

Lists are laid in shards of about ``shard`` postings, lists with centroids in the same region together;
a longer list is cut into shards of its own by a hash of the id, and a query visits all of them, so a
list that draws a third of all rows is spread over tasks. A task streams its shards, vectors before
queries; it holds one shard, and the best k so far of up to ``HELD`` queries, which it writes out
whenever more come. What it finds in one shard raises the bar for the next. Scores are inner products
of the original vectors in double precision, summed in the order of the components.

What is broadcast: centroids, their graph and each list's place, at most ``max_lists`` rows. The sample
passes through the driver; it is bounded by ``max_lists`` x ``sample_per_list`` vectors.

Defined results: vectors that are null, empty, all zero, or hold a null or non-finite component take
no part, neither do those whose dimension is not the most common one (the smaller of equally
common). Rows that repeat a vec_id count once (the smallest embedding); rows without a vec_id take no
part. Equal scores go to the smaller vec_id. With fewer than k candidates a query gets them all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import discard, quoted, shared_folder, ship, shuffle_partitions, stored, table

BALANCE = 2.0
HELD = 1 << 15
ENTRIES = 32


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of x to rows of c."""
    return np.maximum((x * x).sum(1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(1)[None, :], 0.0)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def _means(x: np.ndarray, c: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        own = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        n = np.bincount(own, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def fit_centroids(x: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Centroids of the sample ``x``; lists far above their share are split."""
    rng = np.random.default_rng(seed)
    c = _means(x, x[rng.choice(len(x), min(lists, len(x)), replace=False)], 8)
    for _ in range(4):
        own = _nearest(x, c)
        heavy = np.flatnonzero(np.bincount(own, minlength=len(c)) > BALANCE * len(x) / len(c))
        more = []
        for h in heavy:
            mine = x[own == h]
            ends = np.unique(mine, axis=0)
            if len(ends) > 1:
                pair = _means(mine, ends[[0, -1]], 4)
                c[h] = pair[0]
                more.append(pair[1])
        if not more:
            break
        c = np.concatenate([c, more])
    return np.unique(c, axis=0)


def neighbour_graph(c: np.ndarray, degree: int = 24, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Links of each centroid, as offsets and targets: its nearest others, all that count it among
    theirs (so that a centroid apart from the rest is found), and a few random ones."""
    rng = np.random.default_rng(seed)
    n = len(c)
    near = np.concatenate([np.argsort(_distances(c[i:i + 1024], c), axis=1, kind="stable")[:, 1:degree + 1] for i in range(0, n, 1024)])
    ring = np.stack([(np.arange(n) + 1) % n, (np.arange(n) - 1) % n], 1)
    out = np.concatenate([near, ring, rng.integers(0, n, (n, 4))], axis=1)
    a, b = np.repeat(np.arange(n), out.shape[1]), out.ravel()
    links = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.searchsorted(links // n, np.arange(n + 1)), links % n


def walk(q: np.ndarray, c: np.ndarray, graph: tuple[np.ndarray, np.ndarray], breadth: int) -> tuple[list[int], list[float]]:
    """Best-first walk from some centroids all over: the ``breadth`` nearest ones found, nearest first."""
    cuts, links = graph
    seen = np.zeros(len(c), bool)
    new = np.unique(np.linspace(0, len(c) - 1, ENTRIES).astype(int))
    todo, best = [], []
    while True:
        seen[new] = True
        for e, i in zip(((q - c[new]) ** 2).sum(1).tolist(), new.tolist()):
            if len(best) < breadth or e < -best[0][0]:
                heapq.heappush(todo, (e, i))
                heapq.heappush(best, (-e, i))
                if len(best) > breadth:
                    heapq.heappop(best)
        d, at = heapq.heappop(todo) if todo else (np.inf, 0)
        if not np.isfinite(d) or (len(best) >= breadth and d > -best[0][0]):
            break
        new = links[cuts[at]:cuts[at + 1]]
        new = new[~seen[new]]
    order = sorted((-e, i) for e, i in best)
    return [i for _, i in order], [e for e, _ in order]


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), dimension)


def choose_lists(x: np.ndarray, c: np.ndarray, between: np.ndarray | None, replicas: int, closure: float, apart: float) -> list[list[int]]:
    """The lists of each vector, nearest first."""
    d = _distances(x, c)
    near = np.argsort(d, axis=1, kind="stable")[:, :4 * replicas]
    dn = np.take_along_axis(d, near, 1)
    out = []
    for at, far in zip(near.tolist(), dn.tolist()):
        chosen: list[int] = []
        for j, e in zip(at, far):
            if chosen and (e > closure * closure * far[0] or len(chosen) == replicas):
                break
            if all((between[j, k] if between is not None else ((c[j] - c[k]) ** 2).sum()) > apart * apart * e for k in chosen):
                chosen.append(j)
        out.append(chosen)
    return out


def _between(c: np.ndarray) -> np.ndarray | None:
    return _distances(c, c) if len(c) <= 4096 else None


def fit_ratio(x: np.ndarray, longest: float, c: np.ndarray, k: int, recall: float, replicas: int, closure: float, apart: float, asked: int = 256) -> tuple[float, float]:
    """The smallest distance ratio with which ``recall`` of the k nearest inside the sample ``x`` are in
    a list that is read, and the median distance to the nearest centroid, below which no query's
    distance counts."""
    q = x[np.linspace(0, len(x) - 1, min(asked, len(x))).astype(int)]
    wide = _lifted(x, longest)
    between, need = _between(c), []
    to = np.concatenate([_distances(np.append(row, 0.0)[None, :], c) for row in q]) if len(q) else np.zeros((0, len(c)))
    usual = float(np.median(to.min(1))) if len(q) else 0.0
    for row, d in zip(q, to):
        score = x @ row
        n = min(k + 1, len(x))
        near = np.argpartition(-score, n - 1)[:n]
        lists = choose_lists(wide[near], c, between, replicas, closure, apart)
        need += [d[held].min() / max(d.min(), usual, 1e-300) for i, held in zip(near, lists) if not np.array_equal(x[i], row)]
    return (float(np.sqrt(np.quantile(need, recall))) * (1 + 1e-9) if need else np.inf), usual


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that makes all squared lengths ``longest``."""
    return np.concatenate([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0.0))[:, None]], axis=1)


def regions(c: np.ndarray, weight: np.ndarray, most: float) -> list[np.ndarray]:
    """Centroids in groups of at most ``most`` in weight (or one centroid), by halving along the
    direction of greatest spread."""
    todo, done = [np.arange(len(c))], []
    while todo:
        at = todo.pop()
        if len(at) == 1 or weight[at].sum() <= most:
            done.append(at)
            continue
        spread = c[at] - c[at].mean(0)
        direction = np.linalg.svd(spread.T @ spread)[0][:, 0]
        by = at[np.argsort(spread @ direction, kind="stable")]
        half = int(np.clip(np.searchsorted(np.cumsum(weight[by]), weight[by].sum() / 2) + 1, 1, len(by) - 1))
        todo += [by[half:], by[:half]]
    return done


def _assigned(model, dimension: int, replicas: int, closure: float, apart: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, _, longest = model.value
        between = _between(c)
        for rb in batches:
            lists = []
            for b in range(0, rb.num_rows, 2048):
                lists += choose_lists(_lifted(_matrix(rb.column("v").slice(b, 2048), dimension), longest), c, between, replicas, closure, apart)
            yield pa.RecordBatch.from_arrays([rb.column("id"), rb.column("v"), pa.array(lists, pa.list_(pa.int32()))], names=["id", "v", "lists"])

    return run


def _probes(model, places, dimension: int, breadth: int, ratio: float, usual: float, least: int):
    """One row per query and shard, with the lists of that shard the query reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, graph, _ = model.value
        first, shards, held = places.value
        for rb in batches:
            q = np.concatenate([_matrix(rb.column("v"), dimension), np.zeros((rb.num_rows, 1))], axis=1)
            row, shard, lists = [], [], []
            for i in range(len(q)):
                wide = breadth
                while True:
                    found, d = walk(q[i], c, graph, wide)
                    inside, chosen = 0, []
                    for j, e in zip(found, d):
                        if inside >= least and e > ratio * ratio * max(d[0], usual):
                            break
                        chosen.append(j)
                        inside += held[j]
                    # all that were found are kept: there may be more within the ratio
                    if len(chosen) < len(found) or wide >= len(c):
                        break
                    wide *= 2
                visits: dict[int, list[int]] = {}
                for j in chosen:
                    for s in range(first[j], first[j] + shards[j]):
                        visits.setdefault(s, []).append(j)
                row += [i] * len(visits)
                shard += visits.keys()
                lists += visits.values()
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), rb.column("id").take(take), rb.column("v").take(take), pa.array(lists, pa.list_(pa.int32()))], names=["shard", "id", "v", "lists"])

    return run


class Best:
    """The best k so far of the queries a task has met."""

    def __init__(self, k: int):
        self.k, self.row = k, {}
        self.score, self.id = np.full((0, k), -np.inf), np.zeros((0, k), np.int64)

    def rows(self, queries: np.ndarray) -> np.ndarray:
        """Places of the queries' results; new queries get a place."""
        at = np.array([self.row.setdefault(q, len(self.row)) for q in queries.tolist()], np.int64)
        new = len(self.row) - len(self.score)
        if new > 0:
            new = max(new, len(self.score))
            self.score = np.concatenate([self.score, np.full((new, self.k), -np.inf)])
            self.id = np.concatenate([self.id, np.zeros((new, self.k), np.int64)])
        return at

    def merge(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take in pairs (place, vector, score); a vector met before counts once."""
        old = np.unique(at)
        at = np.concatenate([at, np.repeat(old, self.k)])
        ids, scores = np.concatenate([ids, self.id[old].ravel()]), np.concatenate([scores, self.score[old].ravel()])
        by = np.lexsort([ids, -scores, at])
        by = by[scores[by] > -np.inf]
        at, ids, scores = at[by], ids[by], scores[by]
        once = np.ones(len(at), bool)
        once[1:] = (at[1:] != at[:-1]) | (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
        at, ids, scores = at[once], ids[once], scores[once]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        keep = place < self.k
        self.id[at[keep], place[keep]], self.score[at[keep], place[keep]] = ids[keep], scores[keep]

    def take(self) -> Iterator[pa.RecordBatch]:
        queries = np.array(list(self.row), np.int64)
        for b in range(0, len(queries), 4096):
            r, j = np.nonzero(self.score[b:min(b + 4096, len(queries))] > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(queries[b + r]), pa.array(self.id[b + r, j]), pa.array(self.score[b + r, j])], names=["query_id", "vec_id", "score"])
        self.__init__(self.k)


def _compare(best: Best, ids: np.ndarray, v: np.ndarray, cuts: np.ndarray, names: np.ndarray, asked: np.ndarray, q: np.ndarray, lists: pa.Array) -> None:
    """Hold some queries against the lists they read in one shard, whose vectors lie by list."""
    at = best.rows(asked)
    slack = 1e-14 * v.shape[1] * np.sqrt((q * q).sum(1)) * np.sqrt((v * v).sum(1).max(initial=0.0))
    bar = best.score[at, best.k - 1] - slack  # what the rough score of a new result has to reach
    who = np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy(zero_copy_only=False))
    where = np.searchsorted(names, lists.flatten().to_numpy(zero_copy_only=False))
    pairs_q, pairs_v = [], []
    by = np.argsort(where, kind="stable")
    who, where = who[by], where[by]
    for group in np.split(np.arange(len(who)), np.flatnonzero(np.diff(where)) + 1):
        if not len(group) or where[group[0]] >= len(names):
            continue
        a, b = cuts[where[group[0]]], cuts[where[group[0]] + 1]
        mine = who[group]
        rough = q[mine] @ v[a:b].T
        rough[asked[mine][:, None] == ids[None, a:b]] = -np.inf
        level = bar[mine]
        if b - a > best.k:
            level = np.maximum(level, np.partition(rough, b - a - best.k, axis=1)[:, b - a - best.k] - 2 * slack[mine])
        r, j = np.nonzero((rough >= level[:, None]) & (rough > -np.inf))
        pairs_q.append(mine[r])
        pairs_v.append(a + j)
    if not pairs_q:
        return
    r, j = np.concatenate(pairs_q), np.concatenate(pairs_v)
    for b in range(0, len(r), 1 << 18):
        rr, jj = r[b:b + (1 << 18)], j[b:b + (1 << 18)]
        exact = np.zeros(len(rr))
        for d in range(v.shape[1]):
            exact += q[rr, d] * v[jj, d]
        best.merge(at[rr], ids[jj], exact)


def _searched(k: int, dimension: int):
    """Rows sorted by shard, vectors first: the best k of every query inside this partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, shard, ready = Best(k), None, False
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ids = v = cuts = names = None
        for rb in batches:
            where, kind = rb.column("shard").to_numpy(), rb.column("kind").to_numpy()
            ends = np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *ends.tolist()], [*ends.tolist(), rb.num_rows]):
                if a == b:
                    continue
                if where[a] != shard:
                    shard, ready, parts = where[a], False, []
                part = rb.slice(a, b - a)
                x, own = _matrix(part.column("v"), dimension), part.column("id").to_numpy()
                if kind[a] == 0:
                    parts.append((own, x, part.column("lists").flatten().to_numpy()))
                elif parts:
                    if not ready:
                        held = np.concatenate([p[2] for p in parts])
                        by = np.argsort(held, kind="stable")
                        ids, v = np.concatenate([p[0] for p in parts])[by], np.concatenate([p[1] for p in parts])[by]
                        names, first = np.unique(held[by], return_index=True)
                        cuts, ready = np.append(first, len(by)), True
                    for i in range(0, len(x), 512):
                        _compare(best, ids, v, cuts, names, own[i:i + 512], x[i:i + 512], part.column("lists").slice(i, 512))
                        if len(best.row) > HELD:
                            yield from best.take()
        yield from best.take()

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors that take part, one row per id, components as they were."""
    v = quoted(vector_col)
    fine = vectors.select(quoted(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return fine.where(finite).groupBy("id").agg(F.min("v").alias("v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", per_list: int = 128, max_lists: int = 16_384, sample_per_list: int = 48,
           replicas: int = 3, closure: float = 1.15, apart: float = 0.5, breadth: int = 64, ratio: float | None = None, recall: float = 0.95, least: int = 4, shard: int = 4_096) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` nearest of ``vectors`` for each of ``queries``
    (same columns), a vector with the query's own id left out."""
    spark = ship(vectors.sparkSession)
    path = shared_folder(spark, "vectors")
    usable(vectors, id_col, vector_col).write.parquet(path)
    base = spark.read.parquet(path)
    common = base.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], empty)
    dimension = common["n"]
    base = base.where(F.size("v") == dimension)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, longest = base.agg(F.count("*"), F.max(square)).first()
    lists = int(min(max_lists, max(1, total // per_list)))
    share = min(1.0, lists * sample_per_list / total)  # ids are unique here, so the bound holds
    sample = base.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(share * (1 << 40)) + 1).orderBy("id").select("v").toArrow()["v"].combine_chunks()
    x = _matrix(sample, dimension)
    c = fit_centroids(_lifted(x, longest), lists) if len(x) else np.zeros((1, dimension + 1))
    usual = 0.0
    if ratio is None:
        ratio, usual = fit_ratio(x, longest, c, k, recall, replicas, closure, apart)
    model = spark.sparkContext.broadcast((c, neighbour_graph(c), longest))
    kind = base.schema["v"].dataType.simpleString()
    postings = stored(base.mapInArrow(_assigned(model, dimension, replicas, closure, apart), f"id long, v {kind}, lists array<int>"), "postings")
    discard(spark, path)
    held, own = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
    for r in postings.select(F.posexplode("lists").alias("p", "list")).groupBy("list").agg(F.count("*").alias("n"), F.count_if(F.col("p") == 0).alias("own")).collect():  # a row per list
        held[r.list], own[r.list] = r.n, r.own
    shards = np.maximum(1, -(-held // shard))
    first, next_ = np.zeros(len(c), np.int64), 0
    for j in np.flatnonzero(shards > 1).tolist():
        first[j], next_ = next_, next_ + shards[j]
    short = np.flatnonzero(shards == 1)
    for group in regions(c[short], held[short], shard) if len(short) else []:
        first[short[group]], next_ = next_, next_ + 1
    places = spark.createDataFrame([(i, int(f), int(n)) for i, (f, n) in enumerate(zip(first, shards))], "list int, first int, shards int")  # a row per list
    data = postings.select("id", "v", F.explode("lists").alias("list")).join(F.broadcast(places), "list").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("shards"))).cast("int").alias("shard"), F.lit(0).alias("kind"), "id", "v", F.array("list").alias("lists"))
    width = shuffle_partitions(spark)
    asked = usable(queries, id_col, vector_col).where(F.size("v") == dimension).repartition(width, F.xxhash64("id"))  # walks are dear: spread them
    table_ = spark.sparkContext.broadcast((first.tolist(), shards.tolist(), own.tolist()))
    probes = asked.mapInArrow(_probes(model, table_, dimension, breadth, ratio, usual, least * (k + 1)), f"shard int, id long, v {kind}, lists array<int>")
    both = data.unionByName(probes.select("shard", F.lit(1).alias("kind"), "id", "v", "lists")).repartition(width, "shard").sortWithinPartitions("shard", "kind")
    found = both.mapInArrow(_searched(k, dimension), "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3(spark, sf_dir: str) -> DataFrame:
    """Registered query: the 20 nearest of all vectors for every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))
