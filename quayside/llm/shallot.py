"""Exact Lloyd clustering of integer vectors with Shallot search.

Each round assigns every vector to the nearest centroid (squared Euclidean distance in 64-bit
integers; ties: the smaller number) and moves every centroid to the floor of its vectors' mean;
a centroid without vectors stays. The search per vector:

* a vector carries its centroid, the second-nearest one, an upper bound of the distance to the
  first and a lower bound of the distance to all others. Centroid moves widen the bounds; while
  they stay apart, or the upper bound is below half the gap to the nearest other centroid, the vector
  is not looked at. A crossed upper bound is made exact once before a search starts;
* a search begins at the closer of the two remembered centroids and walks that one's neighbours by
  growing distance. Only neighbours within (distance to the start + distance to the second best) can
  change the first two places; that ball shrinks with every better second best;
* bounds are doubles rounded outwards; what survives them is compared as integers, so the result
  equals a plain scan of all centroids.

On Spark: every pass maps over rows, with the centroids (``k`` x dimension, both parameters) in the
closure, and writes the rows with their bounds to the shared folder, which cuts the lineage; the pass
before is deleted then. Sums per centroid are taken per task, then added as decimals; only
``k`` x dimension numbers come to the driver. Nothing is grouped by vector or shuffled by row, so a
vector that fills a third of the table is spread like any other.

Components lie within ``LIMIT`` (else an error is raised: distances would not fit into 64 bits).
Fewer vectors than centroids: as many centroids as vectors. Repeated rows are clustered one by one
and count one by one. An empty table gives an empty result. Other columns pass through, whatever
their names; the result column is ``nearest`` (``nearest_`` if taken).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import discard, free_name, packed, quoted, shared_folder, ship, table, unpacked

LIMIT = 1 << 26
OUT, IN = 1 + 1e-12, 1 - 1e-12


class Centroids:
    """Centroids of one round: integers, gaps between them, neighbours by growing gap, and how the
    bounds of the round before have to be widened."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None = None):
        self.now, k = now, len(now)
        self.gap = np.sqrt([(((now - c) ** 2).sum(axis=1)) for c in now]).reshape(k, k) * IN
        self.near = np.argsort(self.gap + np.where(np.eye(k, dtype=bool), -1.0, 0.0), axis=1, kind="stable")
        apart = self.gap + np.where(np.eye(k, dtype=bool), np.inf, 0.0)
        self.half = apart.min(axis=1, initial=np.inf) / 2
        self.moved = np.zeros(k) if before is None else np.sqrt(((now - before) ** 2).sum(axis=1)) * OUT
        by = np.argsort(self.moved)
        self.others = np.full(k, self.moved[by[-1]] if k else 0.0)  # greatest move of all others
        if k:
            self.others[by[-1]] = self.moved[by[-2]] if k > 1 else 0.0

    def distance(self, x: np.ndarray, which: np.ndarray | int) -> np.ndarray:
        return ((x - self.now[which]) ** 2).sum(axis=1)

    def search(self, x: np.ndarray, own: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """Bring the four state arrays of the vectors ``x`` up to date; returns the number of distances
        that were computed."""
        if len(self.now) == 1:
            own[:], second[:], lower[:] = 0, 0, np.inf
            return 0
        upper += self.moved[own]
        lower -= self.others[own]
        at = np.flatnonzero(upper >= np.maximum(lower, self.half[own]))
        first = self.distance(x[at], own[at])
        work = len(at)
        upper[at] = np.sqrt(first) * OUT
        crossed = upper[at] >= np.maximum(lower[at], self.half[own[at]])
        at, first = at[crossed], first[crossed]
        a, b = own[at], second[at]
        other = self.distance(x[at], b)
        work += len(at)
        swap = (other < first) | ((other == first) & (b < a))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        best, next_ = np.where(swap, other, first), np.where(swap, first, other)
        start, known, reach = a.copy(), b.copy(), np.sqrt(best) * OUT
        by = np.argsort(start, kind="stable")
        for group in np.split(by, np.flatnonzero(np.diff(start[by])) + 1):
            if not len(group):
                continue
            c = start[group[0]]
            for j in self.near[c, 1:]:
                group = group[self.gap[c, j] <= reach[group] + np.sqrt(next_[group]) * OUT]
                if not len(group):
                    break
                tried = group[known[group] != j]
                d = self.distance(x[at[tried]], j)
                work += len(tried)
                wins = (d < best[tried]) | ((d == best[tried]) & (j < a[tried]))
                places = ~wins & ((d < next_[tried]) | ((d == next_[tried]) & (j < b[tried])))
                w, p = tried[wins], tried[places]
                next_[w], b[w] = best[w], a[w]
                best[w], a[w] = d[wins], j
                next_[p], b[p] = d[places], j
        own[at], second[at] = a, b
        upper[at], lower[at] = np.sqrt(best) * OUT, np.sqrt(next_) * IN
        return work


STATE = [("own", T.IntegerType()), ("second", T.IntegerType()), ("upper", T.DoubleType()), ("lower", T.DoubleType())]


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _assign(centroids: Centroids, dim: int, known: bool, exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if not rb.num_rows:
                continue
            x = _matrix(rb.column("components"), dim)
            if known:
                own, second, upper, lower = (rb.column(c).to_numpy(zero_copy_only=False).copy() for c, _ in STATE)
            else:
                own, second = np.zeros(len(x), np.int32), np.ones(len(x), np.int32)
                upper, lower = np.full(len(x), np.inf), np.zeros(len(x))
            centroids.search(x, own, second, upper, lower)
            out = [rb.column("row"), rb.column("components"), pa.array(own), pa.array(second), pa.array(upper), pa.array(lower)]
            names = ["row", "components", *(c for c, _ in STATE)]
            if exact:
                out, names = out + [pa.array(centroids.distance(x, own))], [*names, "distance"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def _sums(k: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for rb in batches:
            x, own = _matrix(rb.column("components"), dim), rb.column("own").to_numpy(zero_copy_only=False)
            by = np.argsort(own, kind="stable")
            first = np.flatnonzero(np.diff(own[by], prepend=-1))
            total[own[by][first]] += np.add.reduceat(x[by], first, axis=0) if len(by) else 0
            count += np.bincount(own, minlength=k)
        here = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32)), pa.array(count[here]), pa.array(total[here].tolist(), pa.list_(pa.int64()))], names=["own", "n", "sums"])

    return run


def _means(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of each centroid's vectors; a centroid without vectors stays."""
    k, dim = centroids.shape
    part = rows.select("components", "own").mapInArrow(_sums(k, dim), "own int, n long, sums array<long>")
    wide = T.DecimalType(38, 0)
    each = part.select("own", "n", F.posexplode("sums").alias("at", "s")).groupBy("own", "at")
    out = centroids.copy()
    for r in each.agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("s").cast(wide)).alias("s")).collect():  # k x dim rows
        out[r.own, r["at"]] = int(r.s) // int(r.n)
    return out


def cluster(vectors: DataFrame, vector_col: str, dim: int, initial: list[list[int]], rounds: int) -> DataFrame:
    """``vectors`` (integer arrays of ``dim`` components within ``LIMIT``, no nulls) with a struct column
    ``nearest``: cluster, distance (squared) and centroid, after ``rounds`` rounds and a last
    assignment."""
    spark = ship(vectors.sparkSession)
    large = F.exists(quoted(vector_col), lambda v: F.abs(v.cast("long")) > LIMIT)
    checked = F.when(large, F.raise_error(F.lit(f"a component lies beyond {LIMIT}"))).otherwise(quoted(vector_col)).cast("array<int>")
    rows = vectors.select(packed(vectors, vector_col), checked.alias("components"))
    kinds = T.StructType([*rows.schema.fields, *(T.StructField(c, t) for c, t in STATE)])
    now = np.array(initial, np.int64).reshape(-1, dim)
    before, path = None, None
    for turn in range(rounds + 1):
        last = turn == rounds
        schema = T.StructType([*kinds.fields, *([T.StructField("distance", T.LongType())] if last else [])])
        new = shared_folder(spark, f"shallot-{turn}")
        rows.mapInArrow(_assign(Centroids(now, before), dim, turn > 0, last), schema).write.parquet(new)
        rows = spark.read.schema(schema).parquet(new)
        if path:
            discard(spark, path)
        path = new
        if not last:
            before, now = now, _means(rows, now)
    held = spark.createDataFrame([(i, c) for i, c in enumerate(now.tolist())], "own int, centroid array<long>")  # k rows
    found = rows.join(F.broadcast(held), "own")
    return found.select(*unpacked(vectors, vector_col, "components"), F.struct(F.col("own").alias("cluster"), "distance", "centroid").alias(free_name(vectors, "nearest")))


def integer_vectors(table_: DataFrame, vector_col: str, dim: int, scale: int) -> DataFrame:
    """Rows whose vector has exactly ``dim`` components, none null or non-finite, with the vector as
    ``floor(scale * x)``."""
    v = quoted(vector_col)
    whole = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    scaled = F.transform(v, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-2.0 * LIMIT)), F.lit(2.0 * LIMIT))))
    return table_.where((F.size(v) == dim) & whole).withColumn(vector_col, scaled)


def first_by_hash(vectors: DataFrame, vector_col: str, id_col: str, prefix: str, k: int) -> list[list[int]]:
    """The vectors of the ``k`` rows whose ``prefix`` and id have the smallest sha256, in its order (a null
    id counts as an empty one; rows of one id go by their vectors)."""
    name = F.concat(F.lit(prefix), F.coalesce(quoted(id_col).cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name.cast("binary"), 256).alias("h"), quoted(vector_col).alias("v")).orderBy("h", "v").limit(k).collect()
    return [r.v for r in rows]


K, ROUNDS, DIM, SCALE = 40, 5, 64, 256


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: 40 clusters of all 64-component vectors after five rounds."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", DIM, SCALE)
    found = cluster(vectors, "embedding", DIM, first_by_hash(vectors, "embedding", "vec_id", "2:", K), ROUNDS)
    rows = found.select("vec_id", "nearest.cluster", "nearest.distance", F.array_join("nearest.centroid", ",").alias("c"))
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # K rows
    total = rows.agg(F.sum("distance").alias("inertia"))
    return rows.join(F.broadcast(sums), "cluster").join(F.broadcast(total)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.col("c").cast("binary"), 256).alias("centroid_sha256"))


def oracle(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> str:
    """DuckDB SQL for ``op11``: all distances in every round."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dim}),
     parts AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, v FROM kept),
     c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS c, v FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {k}))"""]
    for t in range(rounds + 1):
        d = "list_sum(list_transform(range(1, " + str(dim + 1) + "), lambda i: (p.v[i] - m.v[i]) * (p.v[i] - m.v[i])))::BIGINT"
        steps.append(f"a{t} AS MATERIALIZED (SELECT r, vec_id, v, b.c AS c, b.d AS d FROM (SELECT p.r, any_value(p.vec_id) AS vec_id, any_value(p.v) AS v, min(struct_pack(d := {d}, c := m.c)) AS b FROM parts p, c{t} m GROUP BY p.r))")
        if t < rounds:
            steps.append(f"""c{t + 1} AS MATERIALIZED (SELECT m.c, coalesce(n.v, m.v) AS v FROM c{t} m LEFT JOIN
      (SELECT c, list(x ORDER BY i) AS v FROM (SELECT c, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS x FROM a{t}, range(1, {dim + 1}) AS g(i) GROUP BY c, i) GROUP BY c) n USING (c))""")
    return f"""
WITH {", ".join(steps)}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m USING (c)"""
