"""Periodic runs of words, found by the branching-tandem test over an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at
least ``max(least, repeats * q)`` words that no neighbouring word extends keeping the period.

Method, for a slice of documents at once (numpy; words of different documents never compare equal,
so no match crosses documents, and a slice gives what its documents give one by one):

* suffix array and inverse (ISA) by prefix doubling over words; the ranks of every doubling level
  stay, so LCP values and extensions to the left come from a descent over the levels;
* LCP intervals are index ranges of the suffix array, found as previous and next smaller LCP values
  over a table of range minima: no tree nodes are built. An interval with several children is taken
  apart at its leftmost border first, so every pair of suffixes is parted exactly once;
* at a border of depth d only the suffixes i of the smaller side are tried: is ISA[i + d] or
  ISA[i - d] on the other side? Then a square of period d branches there, and ends where a run
  ends. The smaller sides hold at most n log n suffixes together;
* each such square is rotated to the left, in power-of-two steps, as long as it stays a square. The
  rotations reach from the start of a run to its end; squares with the same stretch merge to one
  run of the smallest period.

Every document is a row of its own, so Spark splits the work by rows and nothing is shuffled; equal
texts are worked on where they lie. Memory: some 150 bytes per word of a slice; a slice is
``SLICE_BYTES`` of text, or one document if that is longer.

Words are maximal stretches without ASCII white space. Null text: no words, ``collapsed`` null.
Empty text: no words, ``collapsed`` empty. Other columns pass through, whatever their names; the
result column is ``periodic`` (``periodic_`` if taken).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import free_name, packed, quoted, ship, table, unpacked

SLICE_BYTES = 1 << 20
TESTS = 1 << 21
LEAST, REPEATS = 6, 4


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and for k = 0, 1, ... the ranks of all positions by their first 2^k symbols
    (positions with equal ranks agree in them); index n stands for the end."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    held = symbols[order]
    first = np.ones(n + 1, bool)
    first[1:n] = held[1:] != held[:-1]
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first[:n], np.arange(n), 0))
    levels, step = [rank.copy()], 1
    while True:
        open_ = np.flatnonzero(~(first[:-1] & first[1:]))  # slots of groups of several suffixes
        if not len(open_):
            return order, levels
        at = order[open_]
        key = rank[at].astype(np.int64) * (n + 2) + rank[np.minimum(at + step, n)] + 1
        by = np.argsort(key)
        key, at = key[by], at[by]
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        order[open_], first[open_] = at, new
        rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        levels.append(rank.copy())
        step *= 2


def neighbours_lcp(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """``lcp[r]``: symbols shared by suffixes ``order[r - 1]`` and ``order[r]``; -1 at both ends."""
    n = len(order)
    x, y = order[:-1], order[1:]
    shared = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        shared += (rank[x + shared] == rank[y + shared]).astype(np.int64) << k
    lcp = np.full(n + 1, -1, np.int32)
    lcp[1:n] = shared
    return lcp


def borders(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every r with ``lcp[r] > 0``, and the first and last slot of the stretch it parts: the LCP
    interval of depth ``lcp[r]``, cut at borders of the same depth further left."""
    m = len(lcp)
    mins, k = [lcp], 0
    while mins[k].max(initial=-1) > 0 and 2 << k <= m:
        wide = np.full(m, -1, np.int32)
        wide[:m - (1 << k)] = np.minimum(mins[k][:m - (1 << k)], mins[k][1 << k:])
        mins.append(wide)
        k += 1
    r = np.flatnonzero(lcp > 0)
    depth = lcp[r]
    left, right = r.copy(), r + 1
    for k in range(len(mins) - 1, -1, -1):
        before = np.maximum(left - (1 << k), 0)  # a range with slot 0 never qualifies, its LCP is -1
        left -= (mins[k][before] > depth).astype(np.int64) << k
        right += (mins[k][np.minimum(right, m - 1)] >= depth).astype(np.int64) << k
    return r, left - 1, right - 1


def branching_squares(order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every branching square."""
    n = len(order)
    slot = np.full(n + 1, -1, np.int64)
    slot[order] = np.arange(n)
    r, low, high = borders(lcp)
    on_left = r - low <= high - r + 1
    begin = np.where(on_left, low, r)
    size = np.where(on_left, r - low, high - r + 1)
    other_low, other_high = np.where(on_left, r, low), np.where(on_left, high, r - 1)
    ends = np.cumsum(size)
    starts, periods = [], []
    a = 0
    while a < len(r):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + TESTS, side="right")))
        reps = size[a:b]
        which = np.repeat(np.arange(a, b), reps)
        i = order[begin[which] + np.arange(len(which)) - np.repeat(ends[a:b] - reps - (ends[a - 1] if a else 0), reps)]
        depth = lcp[r[which]].astype(np.int64)
        after = slot[np.minimum(i + depth, n)]
        hit = (after >= other_low[which]) & (after <= other_high[which])
        before = np.where(i >= depth, slot[np.maximum(i - depth, 0)], -1)
        back = (before >= other_low[which]) & (before <= other_high[which])
        starts += [i[hit], i[back] - depth[back]]
        periods += [depth[hit], depth[back]]
        a = b
    empty = np.zeros(0, np.int64)
    return np.concatenate(starts or [empty]), np.concatenate(periods or [empty])


def runs_of(symbols: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and smallest period of every run, by start, then end."""
    order, levels = suffix_ranks(symbols)
    start, period = branching_squares(order, neighbours_lcp(order, levels))
    end = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):  # rotate to the left
        before = start - (1 << k)
        same = (before >= 0) & (levels[k][np.maximum(before, 0)] == levels[k][np.maximum(before, 0) + period])
        start = np.where(same, before, start)
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    keep &= end - start >= np.maximum(least, repeats * period)
    return start[keep], end[keep], period[keep]


def _slice(texts: list[bytes | None], least: int, repeats: int) -> list[pa.Array]:
    """``n_words``, ``runs`` and ``collapsed`` of some documents."""
    words = [t.split() if t else [] for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    flat = [w for held in words for w in held]
    drop = np.zeros(len(flat), bool)
    start = length = period = np.zeros(0, np.int64)
    if flat:
        of = np.repeat(np.arange(len(texts)), sizes)
        names = pa.array(flat, pa.binary()).dictionary_encode()
        symbols = of * len(names.dictionary) + names.indices.to_numpy()
        start, end, period = runs_of(symbols, least, repeats)
        length = end - start
        change = np.zeros(len(flat) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        drop = np.cumsum(change[:-1]) > 0
        by = np.lexsort((period, start))
        start, length, period = start[by], length[by], period[by]
    doc = np.searchsorted(cuts, start, side="right") - 1
    per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))]).astype(np.int32)
    runs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start - cuts[doc], length, period)], ["start", "length", "period"])
    kept = []
    for i, t in enumerate(texts):
        part = drop[cuts[i]:cuts[i + 1]]
        held = [words[i][j] for j in np.flatnonzero(~part)] if part.any() else words[i]
        kept.append(None if t is None else b" ".join(held).decode())
    return [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(per_doc), runs), pa.array(kept, pa.string())]


def _cut(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows, each of at most ``most`` in total or of one row."""
    first, total = 0, np.cumsum(sizes)
    while first < len(sizes):
        end = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + most, side="right")))
        yield first, end
        first = end


def _mapped(least: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            sizes = pc.fill_null(pc.binary_length(rb.column("text")), 0).to_numpy(zero_copy_only=False)
            for first, end in _cut(sizes, SLICE_BYTES):
                texts = rb.column("text").slice(first, end - first).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([rb.column("row").slice(first, end - first), *_slice(texts, least, repeats)],
                                                 names=["row", "n_words", "runs", "collapsed"])

    return run


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def find_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with a struct column ``periodic``: ``n_words``, ``runs`` (start, length, period, by start,
    then period; starts count words from 0) and ``collapsed``, the words joined by one space without
    those that some run holds after its first period."""
    if repeats < 2:
        raise ValueError("a run holds at least two periods")
    ship(docs.sparkSession)
    row = docs.select(packed(docs), quoted(text_col).alias("text"))
    schema = T.StructType([row.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    out = row.mapInArrow(_mapped(least, repeats), schema)
    return out.select(*unpacked(docs), F.struct("n_words", "runs", "collapsed").alias(free_name(docs, "periodic")))


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        hashes = rb.column("h").to_pylist()
        sizes = pc.fill_null(pc.binary_length(rb.column("text")), 0).to_numpy(zero_copy_only=False)
        for first, end in _cut(sizes, SLICE_BYTES):
            texts = rb.column("text").slice(first, end - first).to_pylist()
            for j, h in enumerate(hashes[first:end]):
                words = texts[j].encode().split() if texts[j] and h is not None and h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[j] = b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)]).decode()
            yield pa.RecordBatch.from_arrays([rb.column("doc_id").slice(first, end - first), pa.array(texts, pa.string())], names=["doc_id", "text"])


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; of a tenth of the documents, picked by crc32 of the id (a null id: never),
    the words from some place on repeat a period."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    return rows.mapInArrow(_planted, T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())]))


def op13(spark, sf_dir: str) -> DataFrame:
    """Registered query: the runs of every whole document, with periods planted in a tenth of them."""
    found = find_runs(planted(table(spark, sf_dir, "documents")))
    runs = F.col("periodic.runs")
    # greatest length first, then smallest start, then period
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), (-longest["s"]).alias("start"), longest["length"].alias("length"), (-longest["p"]).alias("period"),
                        F.call_function("div", 1000 * longest["length"], -longest["p"]).alias("exponent_milli"),
                        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.coalesce("periodic.collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))
