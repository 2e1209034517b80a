"""Near-duplicate classes by DartMinHash signatures and banded joining.

A document is a weighted set: its word shingles (five words) with their counts. Darts are a
Poisson process of rate 1 over (shingle, weight, rank), a fixed function of hashes: the weight
axis is cut into strips [0,1), [1,2), [2,4), ..., and in each strip the ranks of the darts are a
sum of hashed exponential gaps. A document's darts are those under its weights with a rank below
t / (its total weight), about t of them. Each dart falls to one of k coordinates; the earliest
per coordinate is the signature. Two documents agree on a coordinate with a probability equal to
their weighted Jaccard similarity. Where t leaves a coordinate empty, t is doubled.

Signatures are cut into bands. Documents with equal word sequences are one node. In each bucket
of a band every node is paired with two centres of the bucket (two aggregates with partial
aggregation, joined back, so a hot bucket splits), never with all others. Pairs are checked
exactly (weighted Jaccard of the shingle counts >= threshold). Buckets that then hold more than
one class get new centres, for ``rounds`` turns in all; these turns only make classes large early.

All nodes of the buckets that are still mixed go through an exact prefix-filter join: a node's
shingles are put in one global order, rare ones first (counts in ``CELLS`` hashed cells, so the
order needs no shuffle), and a pair at the threshold must share one of each one's first
size - threshold * size + 1. The first common shingle also bounds the overlap by what follows it
in either node; pairs below the bound are dropped in the join, the rest is checked exactly. So
every pair that shares a bucket is either in one class, ruled out or checked. After each turn its
verified links, as links between classes, are closed to larger classes by alternating stars.

With 24 bands of 5, a pair of similarity 0.8 shares no band with probability 7e-5, and of 0.9
with 5e-10.

Defined results: null texts and texts without a word are classes of their own (class_id =
doc_id). A class's id is its smallest doc_id (null only if all are null). Rows repeated as a
whole share one class. Extra columns are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import mix64, packed, quoted, ship, stored, table, unpacked
from quayside.llm.shingles import batches_of_words, digests, shingle_sets

_GOLD = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 18


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k signature values of weighted sets given as sorted (doc, element, weight) rows; rows
    of documents without elements stay 0."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n)
    todo, darts = np.flatnonzero(total > 0), k * (np.log(k) + 2.5)
    while len(todo):
        chosen = np.zeros(n, bool)
        chosen[todo] = True
        mine = chosen[doc]
        d, e, w = doc[mine], element[mine], weight[mine].astype(np.float64)
        reach = np.zeros(n)
        reach[todo] = darts / total[todo]
        best = np.full(n * k, np.inf)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        strip, low, width = 0, 0.0, 1.0
        while len(d):
            at, rank, seed, x = d, np.zeros(len(d)), mix64(e + np.uint64(strip * int(_GOLD) % (1 << 64))), w
            j = 0
            while len(at):
                j += 1
                h = mix64(seed + np.uint64(j))
                rank = rank - np.log(_unit(h)) / width
                live = rank < reach[at]
                at, rank, seed, x, h = at[live], rank[live], seed[live], x[live], h[live]
                h = mix64(h ^ _GOLD)
                under = low + _unit(mix64(h + np.uint64(1))) * width <= x if strip else slice(None)
                cell = at[under] * k + (h[under] % np.uint64(k)).astype(np.int64)
                np.minimum.at(best, cell, rank[under])
                found.append((cell, rank[under], h[under]))
            strip, low, width = strip + 1, low + width, max(1.0, low + width)
            more = w > low
            d, e, w = d[more], e[more], w[more]
        cell, rank, value = (np.concatenate(c) for c in zip(*found))
        first = rank == best[cell]
        flat = np.zeros(n * k, np.uint64)
        flat[cell[first]] = mix64(value[first])
        full = np.isfinite(best.reshape(n, k)[todo]).all(axis=1)
        out[todo[full]] = flat.reshape(n, k)[todo[full]]
        todo, darts = todo[~full], darts * 2
    return out


def _signed(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            text = rb.column("text")
            for first, counts, words in batches_of_words(text):
                n = len(counts)
                doc, shingle, weight = shingle_sets(counts, words, size)
                signature = dart_signatures(doc, shingle, weight, n, bands * rows)
                key = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], n, 0)
                for r in range(rows):
                    key = mix64(key * _GOLD + signature[:, r::rows])
                flat = pa.array(key.astype(np.int64).ravel())
                has = counts > 0
                offsets = pa.array(np.arange(0, (n + 1) * bands, bands), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rb.column("id").slice(first, n), rb.column("th").slice(first, n), pa.array(digests(counts, words), pa.binary()), pa.ListArray.from_arrays(offsets, flat, mask=pa.array(~has))],
                    names=["id", "th", "node", "bands"])

    return run


def _shingled(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            wanted = rb.column("node").to_pylist()
            for first, counts, words in batches_of_words(rb.column("text")):
                doc, shingle, weight = shingle_sets(counts, words, size)
                cuts = np.searchsorted(doc, np.arange(len(counts) + 1))
                names = digests(counts, words)
                rows = [(name, np.repeat(shingle[a:b], weight[a:b]).tobytes()) for name, want, a, b in zip(names, wanted[first:], cuts[:-1].tolist(), cuts[1:].tolist()) if name == want]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["node", "shingles"])

    return run


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted multisets written with repetition."""
    both = np.concatenate([a, b])
    values, inverse = np.unique(both, return_inverse=True)
    x = np.bincount(inverse[:len(a)], minlength=len(values))
    y = np.bincount(inverse[len(a):], minlength=len(values))
    return float(np.minimum(x, y).sum() / max(1, np.maximum(x, y).sum()))


def _checked(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            left, right = rb.column("sa"), rb.column("sb")
            keep = [i for i in range(rb.num_rows) if weighted_jaccard(np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)) >= threshold]
            yield pa.RecordBatch.from_arrays([rb.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], names=["a", "b"])

    return run


def _pairs(entries: DataFrame, turn: int) -> DataFrame:
    """Rows (band, h, node, root) of shared buckets: each node with its bucket's two centres for
    this turn, where they are not in one class yet; each pair once."""
    order = F.xxhash64("node", "band", F.lit(turn))
    centres = entries.groupBy("band", "h").agg(*[F.struct(f("node", order).alias("node"), f("root", order).alias("root")).alias(n) for n, f in (("low", F.min_by), ("high", F.max_by))])
    # written first: a join of two exchanges can split a hot bucket, a join of an aggregate cannot
    met = entries.join(stored(centres, "centres"), ["band", "h"]).select("node", "root", F.explode(F.array("low", "high")).alias("c")).where("root <> c.root")
    return met.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()


def _elements(shingles) -> np.ndarray:
    """A sorted multiset written with repetition as distinct elements."""
    a = np.frombuffer(shingles.as_buffer(), np.uint64)
    again = (np.arange(len(a)) - np.searchsorted(a, a)).astype(np.uint64)
    return np.where(again > 0, mix64(a ^ again * _GOLD), a)


def _cell(elements: np.ndarray) -> np.ndarray:
    return (mix64(elements) % np.uint64(CELLS)).astype(np.int64)


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(CELLS, np.int64)
    for rb in batches:
        for x in rb.column("shingles"):
            np.add.at(seen, _cell(_elements(x)), 1)
    cell = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(seen[cell])], names=["cell", "n"])


def _prefixes(tally, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = tally.value
        for rb in batches:
            for b in range(0, rb.num_rows, 256):
                part = rb.slice(b, 256)
                row, found, rest, sizes = [], [], [], []
                for i, x in enumerate(part.column("shingles")):
                    e = _elements(x)
                    n = len(e) - int(np.ceil(threshold * len(e) - 1e-6)) + 1
                    e = e[np.lexsort([e, counts[_cell(e)]])]
                    n = max(0, min(n, len(e)))
                    row.append(np.full(n, i))
                    found.append(e[:n])
                    rest.append(len(e) - np.arange(n))
                    sizes.append(np.full(n, len(e)))
                take = pa.array(np.concatenate(row))
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in (found, rest, sizes)]
                yield pa.RecordBatch.from_arrays([part.column("node").take(take), part.column("root").take(take), *columns], names=["node", "root", "e", "rest", "size"])

    return run


def _rest(open_: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of the nodes (node, root) that are not in one class and that the prefix filter
    cannot rule out."""
    held = stored(sets.join(open_, "node"), "open-nodes")
    tally = np.zeros(CELLS, np.int64)
    for r in held.mapInArrow(_tallied, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most one row per cell
        tally[r["cell"]] = r["n"]
    order = held.sparkSession.sparkContext.broadcast(tally)
    prefixes = stored(held.mapInArrow(_prefixes(order, threshold), "node binary, root binary, e long, rest long, size long"), "prefixes")

    def within(rest, size, other):
        """The overlap left from here on can be enough for the other's size."""
        return rest * (1.0 + threshold) >= threshold * (size + other) - 1e-6

    # elements of one class, and rows that no other row of the element is small enough for, go first
    by = prefixes.groupBy("e").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min("size").alias("small")).where("x <> y").select("e", "small")
    live = stored(prefixes.join(stored(by, "open-elements"), "e").where(within(F.col("rest"), F.col("size"), F.col("small"))).drop("small"), "live-prefixes")
    a = live.select("e", *[F.col(c).alias(f"a_{c}") for c in ("node", "root", "rest", "size")])
    b = live.select("e", *[F.col(c).alias(f"b_{c}") for c in ("node", "root", "rest", "size")])
    can = within(F.col("a_rest"), F.col("a_size"), F.col("b_size")) & within(F.col("b_rest"), F.col("b_size"), F.col("a_size"))
    met = a.join(b, (a["e"] == b["e"]) & (F.col("a_node") < F.col("b_node")) & (F.col("a_root") != F.col("b_root")) & can)
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): alternating large and small stars until
    nothing changes; every round is written to the shared folder."""
    now, seen = stored(edges.select("a", "b").where("a <> b"), "stars"), None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        now = stored(small, "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """The classes (node, root) after further links (a, b): stars run over the links between
    classes only, each class being its root."""
    if roots is None:
        return stored(connected(links), "roots")
    ends = links
    for end in ("a", "b"):
        root = roots.select(F.col("node").alias(end), F.col("root").alias("up"))
        ends = ends.join(root, end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
    moved = stored(connected(ends), "moved-roots")
    old = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return stored(old.unionAll(moved.join(roots.select("node"), "node", "left_anti").select("node", "root")), "roots")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, bands: int = 24, rows: int = 5, size: int = 5, rounds: int = 2) -> DataFrame:
    """One row per row of ``docs``: id (doc_id), th (xxhash64 of the text), class_id, class_rows
    (rows in the class) and name (the class's internal name; null without words)."""
    ship(docs.sparkSession)
    plain = docs.select(quoted(id_col).cast("long").alias("id"), F.xxhash64(quoted(text_col)).alias("th"), quoted(text_col).alias("text"))
    signed = stored(plain.mapInArrow(_signed(bands, rows, size), "id long, th long, node binary, bands array<long>"), "darts")
    nodes = signed.where("node is not null").groupBy("node").agg(F.min(F.struct("id", "th")).alias("rep"), F.any_value("bands").alias("bands"))
    entries = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    full = stored(entries.groupBy("band", "h").count().where("count > 1").select("band", "h"), "full-buckets")
    shared = stored(entries.join(full, ["band", "h"]).select("band", "h", "node"), "buckets")
    wanted = nodes.select("node", "rep").join(shared.select("node").distinct(), "node")
    # by id and text: rows that only share an id, or have none, do not meet
    texts = plain.join(wanted, plain["id"].eqNullSafe(wanted["rep.id"]) & (F.coalesce(plain["th"], F.lit(0)) == wanted["rep.th"])).select("node", "text")
    sets = stored(texts.mapInArrow(_shingled(size), "node binary, shingles binary").dropDuplicates(["node"]), "shingles")
    roots = None
    for turn in range(rounds + 1):
        active = shared.withColumn("root", F.col("node"))
        if turn:
            active = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            mixed = active.groupBy("band", "h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("band", "h")
            active = active.join(stored(mixed, "mixed-buckets"), ["band", "h"])
        if turn < rounds:
            pairs = _pairs(active, turn)
        else:
            open_ = stored(active.select("node", "root").distinct(), "open")
            if open_.isEmpty():
                break
            pairs = _rest(open_, sets, threshold)
        met = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        found = stored(met.mapInArrow(_checked(threshold), "a binary, b binary"), "links")
        roots = _merged(roots, found)
    rooted = signed.select("id", "th", "node").join(roots, "node", "left").select("id", "th", F.coalesce("root", "node").alias("name"))
    # written first: a join of two exchanges can split a hot class, a join of an aggregate cannot
    least = stored(rooted.where("name is not null").groupBy("name").agg(F.min("id").alias("class_id"), F.count("*").alias("class_rows")), "class-ids")
    return rooted.join(least, "name", "left").select("id", "th", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows"), "name")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with one row left per class (that of the smallest doc_id; any one of
    its repeats); rows without words all stay."""
    found = stored(classes(docs, id_col, text_col, **how), "classes")
    best = found.where("name is not null").groupBy("name").agg(F.min_by("th", F.struct(F.coalesce("id", F.lit(2 ** 63 - 1)), "th")).alias("th"), F.min("id").alias("id"))
    rows = found.where("name is not null").groupBy("id", "th").agg(F.count("*").alias("times"))
    rows = rows.select(F.col("id").alias("_i"), F.col("th").alias("_t"), "times")
    best = best.join(rows, best["id"].eqNullSafe(rows["_i"]) & (best["th"] == rows["_t"])).select("id", "th", "times")
    bare = found.where("name is null").groupBy("id", "th").agg(F.lit(1).cast("long").alias("times"))
    keys = best.unionByName(bare).select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("times").alias("_times"))
    row = docs.select(packed(docs), quoted(id_col).cast("long").alias("id"), F.xxhash64(quoted(text_col)).alias("th"))
    kept = row.join(keys, row["id"].eqNullSafe(keys["_id"]) & (row["th"] == keys["_th"]))
    once = kept.where("_times = 1").select("row").unionAll(kept.where("_times > 1").groupBy("id", "th").agg(F.any_value("row").alias("row")).select("row"))
    return once.select(*unpacked(docs))


def op2(spark, sf_dir: str) -> DataFrame:
    """Registered query: every document with its near-duplicate class."""
    return classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "class_rows")
