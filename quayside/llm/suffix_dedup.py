"""Repeated-substring removal by prefix doubling over sampled text positions.

Every byte covered by a ``length``-byte string that also starts earlier (smaller doc_id, or the
same document and an earlier start) is removed. Method: prefix doubling. The name (rank) of a
position stands for its first L bytes; the name for 2L comes from the pair (name at p, name at
p+L). Positions whose name nobody shares drop out; L grows until ``length``.

Three steps keep this near-linear in shuffled bytes:

1. *Sampled positions.* Inside each document, doubling gives the names of all 32-byte strings.
   Of the 32-byte strings inside any ``length``-byte string, the one with the smallest hash is
   its anchor, so equal strings have equal anchors at equal distance. One record per anchor
   stands for the run of positions that share it. Pairs (32-byte name, name of the whole
   context that the run can reach) are shuffled by name and sorted: unshared names drop out,
   and of runs with equal context all but the earliest are repeats, whole.
2. *Narrowing.* Runs that share the name but not the context are reranked at growing offsets to
   the right (55, 77, ``length``) and left (23, 46, 68); the offset at which a run becomes unique
   bounds the positions that can still be repeats.
3. *The rest by position.* For those positions the pair (50-byte name at p, 50-byte name at
   p+50) is sorted; all but the earliest of equal pairs are repeats.

Hot strings: each map batch sends one record per (name, context) and settles its other copies
itself, so a string found in a third of all rows costs one record per batch, not per row.
Names are 64-bit hashes taken in pairs (name and context, or 96 bits in step 3).

Memory: a bucket holds about one byte per text byte divided by 4 x ``spark.sql.shuffle.partitions``;
set that so that a partition gets at most a few hundred MB of text, as for any shuffle.

Defined results: null and empty texts, and texts shorter than ``length``, lose nothing. A null
doc_id sorts after all others. Rows that repeat both doc_id and text get the same result: none
of them is earlier than another. Rows sharing a doc_id with different texts are ordered by start
alone, and equal starts are no repeats. Any other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import doc_bytes, free_name, mix64, packed, quoted, ship, shuffle_partitions, stored, table, unpacked

GRAM = 32
LEVELS = 3
SLICE = 1 << 20
LOW_BITS = np.uint64(22)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_NULL_ID = np.iinfo(np.int64).max


def _double(h: np.ndarray, by: int) -> np.ndarray:
    """Names for L+by bytes from names for L bytes: the pair (name at p, name at p+by)."""
    n = len(h) - by
    return mix64(h[:n] * _GOLD + h[by:])


def names(a: np.ndarray, length: int) -> np.ndarray:
    """Names of all ``length``-byte strings of ``a`` by doubling (the last step may overlap)."""
    h, have = mix64((a.astype(np.uint64) + np.uint64(1)) * _GOLD), 1
    while have < length:
        by = min(have, length - have)
        h, have = _double(h, by), have + by
    return h


def _window_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest hash in each window of ``width`` (leftmost of ties)."""
    mask = (np.uint64(1) << LOW_BITS) - np.uint64(1)
    key = (mix64(h) & ~mask) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span < width:
        by = min(span, width - span)
        key = np.minimum(key[:len(key) - by], key[by:])
        span += by
    return (key & mask).astype(np.int64)


def _slices(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(first doc, end doc, first byte, end byte, first start, end start): whole short documents
    together, long documents in pieces that overlap by what a context can reach."""
    reach, first, n = length + GRAM, 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1
        if end > first:
            yield first, end, int(offsets[first]), int(offsets[end]), int(offsets[first]), int(offsets[end])
        else:
            lo, hi, end = int(offsets[first]), int(offsets[first + 1]), first + 1
            for p in range(lo, hi, SLICE):
                yield first, end, max(lo, p - length), min(hi, p + SLICE + 2 * reach), p, min(hi, p + SLICE)
        first = end


def _runs(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[dict[str, np.ndarray]]:
    """Per slice: for each run of starts with one anchor its document, first start, number of
    starts, and the anchor's name, context name and level names."""
    width = length - GRAM + 1
    rights = [55 * length // 100, 77 * length // 100, length]
    lefts = [(width - 1) // 3, 2 * (width - 1) // 3, width - 1]
    for d0, d1, b0, b1, p0, p1 in _slices(offsets, length):
        if b1 - b0 < length:
            continue
        starts, ends = offsets[d0:d1] - b0, offsets[d0 + 1:d1 + 1] - b0
        h = names(data[b0:b1], GRAM)
        idx = _window_argmin(h, width)
        mark = np.zeros(len(idx) + 2, np.int32)
        lo, hi = np.maximum(starts, p0 - b0), np.minimum(ends - length + 1, p1 - b0)
        some = hi > lo
        if not some.any():
            continue
        np.add.at(mark, lo[some], 1)
        np.add.at(mark, hi[some], -1)
        valid = np.cumsum(mark)[:len(idx)] > 0
        change = np.ones(len(idx) + 1, bool)
        change[1:-1] = (idx[1:] != idx[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(change[:-1] & valid)
        last = np.flatnonzero(change[1:] & valid)
        anchor = idx[first]
        doc = np.searchsorted(ends, first, side="right")
        ds, de = starts[doc], ends[doc]
        ds, de = np.maximum(ds, 0), np.minimum(de, b1 - b0)
        a0, a1 = np.maximum(anchor - (width - 1), ds), np.minimum(anchor + length, de)
        context = mix64(h[a0] + (a1 - a0).astype(np.uint64) * _GOLD + (anchor - a0).astype(np.uint64))
        for o in range(GRAM, width - 1 + length, GRAM):
            context = mix64(context * _GOLD + h[np.minimum(a0 + o, a1 - GRAM)])
        levels = np.zeros((len(first), 2 * LEVELS), np.uint8)
        for k, size in enumerate(rights):
            inside = anchor + size <= de
            name = h[anchor]
            for o in range(GRAM, size, GRAM):
                name = mix64(name * _GOLD + h[np.minimum(np.minimum(anchor + o, anchor + size - GRAM), len(h) - 1)])
            levels[:, k] = np.where(inside, name % np.uint64(255) + np.uint64(1), 0)
        for k, size in enumerate(lefts):
            inside = anchor - size >= ds
            name = h[np.maximum(anchor - size, 0)]
            for o in range(GRAM, size, GRAM):
                name = mix64(name * _GOLD + h[np.maximum(np.minimum(anchor - size + o, anchor), 0)])
            levels[:, LEVELS + k] = np.where(inside, name % np.uint64(255) + np.uint64(1), 0)
        yield {"doc": doc + d0, "start": first + b0 - offsets[doc + d0], "count": last - first + 1,
               "back": anchor - first, "name": h[anchor], "context": context, "levels": levels}


def _first_of(keys: list[np.ndarray], position: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sort by keys then position. Returns the order and (in sorted order)
    whether the row lies after the first position of its key."""
    order = np.lexsort([*position[::-1], *keys[::-1]])
    new = np.ones(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] = new[1:] & (s[1:] == s[:-1])
    new[1:] = ~new[1:]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = np.zeros(len(order), bool)
    for p in position:
        s = p[order]
        later |= s != s[begin]
    return order, later


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _send(bucket: np.ndarray, columns: dict[str, np.ndarray], kind: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket that holds the columns as binary values."""
    order = np.argsort(bucket, kind="stable")
    sorted_buckets = bucket[order]
    cuts = np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1]]) if len(order) else []
    ends = np.r_[cuts[1:], len(order)] if len(order) else []
    held = {k: np.ascontiguousarray(v[order]) for k, v in columns.items()}
    rows = [(int(sorted_buckets[b]), kind, b"".join((len(p := held[k][b:e].tobytes()).to_bytes(8, "little") + p) for k in held)) for b, e in zip(cuts, ends)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "payload"])


_SENT = "bucket int, kind int, payload binary"
_RUN = {"name": np.uint64, "context": np.uint64, "doc": np.int64, "mark": np.uint32, "start": np.uint32, "shape": np.uint8}
_SPOT = {"name": np.uint64, "extra": np.uint32, "doc": np.int64, "mark": np.uint32, "start": np.uint32}
_SPAN = {"doc": np.int64, "mark": np.uint32, "start": np.uint32, "end": np.uint32}


def _packed(columns: dict[str, np.ndarray], kinds: dict[str, type]) -> dict[str, np.ndarray]:
    return {k: columns[k].astype(t, copy=False) for k, t in kinds.items()}


def _unpacked(payload: bytes, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, t in kinds.items():
        size = int.from_bytes(payload[at:at + 8], "little")
        out[k] = np.frombuffer(payload, t, size // np.dtype(t).itemsize, at + 8)
        at += 8 + size
    return out


def _spans_of(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict[str, np.ndarray]:
    """Spans merged where they touch or overlap inside one document."""
    order = np.lexsort([start, mark, doc])
    doc, mark, start, end = doc[order], mark[order], start[order].astype(np.int64), end[order].astype(np.int64)
    if not len(doc):
        return {"doc": doc, "mark": mark, "start": start, "end": end}
    other = np.r_[True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])]
    group = np.cumsum(other)
    lift = np.maximum.accumulate(end + group * (1 << 33)) - group * (1 << 33)
    new = other.copy()
    new[1:] |= start[1:] > lift[:-1]
    cut = np.flatnonzero(new)
    last = np.r_[cut[1:] - 1, len(doc) - 1]
    return {"doc": doc[cut], "mark": mark[cut], "start": start[cut], "end": lift[last]}


def _ids(rb: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return rb.column("k").to_numpy(zero_copy_only=False), rb.column("m").to_numpy(zero_copy_only=False).astype(np.uint32)


def _map_runs(length: int, buckets: int):
    """Step 1 on one batch: its earliest run per (name, context) goes out, its other copies are settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            data, offsets = doc_bytes(rb.column("text"))
            ids, marks = _ids(rb)
            parts = []
            for r in _runs(data, offsets, length):
                shape = np.concatenate([r["back"][:, None].astype(np.uint8), (r["back"] - r["count"] + 1)[:, None].astype(np.uint8), r["levels"]], axis=1)
                parts.append({"name": r["name"], "context": r["context"], "doc": ids[r["doc"]], "mark": marks[r["doc"]], "start": r["start"], "count": r["count"], "shape": shape})
            if not parts:
                continue
            c = _joined(parts)
            order, later = _first_of([c["name"], c["context"]], [c["doc"], c["start"] + c["shape"][:, 0]])
            c = {k: v[order] for k, v in c.items()}
            spans = _spans_of(c["doc"][later], c["mark"][later], c["start"][later], c["start"][later] + c["count"][later] - 1 + length)
            yield from _send((spans["doc"] % buckets).astype(np.int32), _packed(spans, _SPAN), 1)
            c = {k: v[~later] for k, v in c.items()}
            yield from _send((c["name"] % np.uint64(buckets)).astype(np.int32), _packed(c, _RUN), 0)

    return run


def _rows(kind: int, s: dict[str, np.ndarray]) -> pa.Table:
    n = len(s["doc"])
    return pa.table({"kind": pa.array(np.full(n, kind, np.int32)), "k": pa.array(s["doc"].astype(np.int64)), "m": pa.array(s["mark"].astype(np.int64)),
                     "s": pa.array(s["start"].astype(np.int64)), "e": pa.array(s["end"].astype(np.int64))})


_FOUND = "kind int, k long, m long, s long, e long"


def _split(group: pa.Table) -> tuple[list[bytes], list[bytes]]:
    kind, payload = group.column("kind").to_pylist(), group.column("payload").to_pylist()
    return [p for k, p in zip(kind, payload) if k == 0], [p for k, p in zip(kind, payload) if k == 1]


def _level_bound(name: np.ndarray, levels: np.ndarray, bounds: list[int]) -> np.ndarray:
    """How far each row can agree with another row of its name, by the levels that both share."""
    bound = np.full(len(name), bounds[0])
    for k in range(levels.shape[1]):
        keys = [name, *(levels[:, j] for j in range(k + 1))]
        order = np.lexsort(keys[::-1])
        same = np.ones(len(order) - 1, bool)
        for key in keys:
            s = key[order]
            same &= s[1:] == s[:-1]
        shared = np.zeros(len(order), bool)
        shared[1:] |= same
        shared[:-1] |= same
        hit = np.zeros(len(order), bool)
        hit[order] = shared
        hit &= levels[:, k] > 0
        bound[hit] = bounds[k + 1]
    return bound


def _reduce_runs(length: int):
    width = length - GRAM + 1
    rights = [55 * length // 100, 77 * length // 100, length]
    lefts = [(width - 1) // 3, 2 * (width - 1) // 3, width - 1]

    def run(group: pa.Table) -> pa.Table:
        runs, spans = _split(group)
        out = [_rows(1, _joined([_unpacked(p, _SPAN) for p in spans]))] if spans else []
        if runs:
            parts = []
            for p in runs:
                u = _unpacked(p, _RUN)
                u["shape"] = u["shape"].reshape(-1, 2 + 2 * LEVELS)
                parts.append(u)
            c = _joined(parts)
            back, least = c["shape"][:, 0].astype(np.int64), c["shape"][:, 1].astype(np.int64)
            start = c["start"].astype(np.int64)
            order, later = _first_of([c["name"], c["context"]], [c["doc"], start + back])
            o = order[later]
            found = _spans_of(c["doc"][o], c["mark"][o], start[o], start[o] + back[o] - least[o] + length)
            out.append(_rows(1, found))
            # one row per context; names with a single context are settled
            o = order[~later]
            name = c["name"][o]
            context = c["context"][o]
            fresh = np.r_[True, (name[1:] != name[:-1])]
            cls = np.r_[True, (name[1:] != name[:-1]) | (context[1:] != context[:-1])]
            gid = np.cumsum(fresh) - 1
            open_ = np.bincount(gid, weights=cls)[gid] > 1
            o = o[open_]
            if len(o):
                one = np.r_[True, (c["name"][o][1:] != c["name"][o][:-1]) | (c["context"][o][1:] != c["context"][o][:-1])]
                reps = o[one]
                right = _level_bound(c["name"][reps], c["shape"][reps, 2:2 + LEVELS], [rights[0] - 1, rights[1] - 1, length - 1, length])
                left = _level_bound(c["name"][reps], c["shape"][reps, 2 + LEVELS:], [lefts[0] - 1, lefts[1] - 1, lefts[2] - 1, width - 1])
                at = np.cumsum(one) - 1
                d_lo = np.maximum(least[o], length - right[at])
                d_hi = np.minimum(back[o], left[at])
                keep = d_hi >= d_lo
                o, d_lo, d_hi = o[keep], d_lo[keep], d_hi[keep]
                anchor = start[o] + back[o]
                out.append(_rows(0, {"doc": c["doc"][o], "mark": c["mark"][o], "start": anchor - d_hi, "end": anchor - d_lo + 1}))
        return pa.concat_tables(out) if out else _rows(1, {k: np.zeros(0, t) for k, t in _SPAN.items()})

    return run


def _map_spots(length: int, buckets: int):
    """Open positions of a document: pairs (50-byte name at p, 50-byte name at p+50)."""
    half = (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            data, offsets = doc_bytes(rb.column("text"))
            ids, marks = _ids(rb)
            ss, ee = rb.column("ss").to_pylist(), rb.column("ee").to_pylist()
            parts = []
            for i, (s, e) in enumerate(zip(ss, ee)):
                text, merged = data[offsets[i]:offsets[i + 1]], _spans_of(np.zeros(len(s), np.int64), np.zeros(len(s), np.int64), np.array(s, np.int64), np.array(e, np.int64))
                # neighbouring open runs share one pass over their bytes
                s, e = merged["start"], merged["end"]
                group = np.cumsum(np.r_[True, s[1:] > e[:-1] + length])
                for g in range(1, group[-1] + 1):
                    own = np.flatnonzero(group == g)
                    b = int(s[own[0]])
                    h = names(text[b:int(e[own[-1]]) + length - 1], half)
                    p = np.concatenate([np.arange(s[j], e[j]) for j in own])
                    n0, n1 = h[p - b], h[p - b + length - half]
                    parts.append({"name": mix64(n0 * _GOLD + n1), "extra": (mix64(n1 + n0 * np.uint64(3)) >> np.uint64(32)),
                                  "doc": np.full(len(p), ids[i]), "mark": np.full(len(p), marks[i]), "start": p})
            if not parts:
                continue
            c = _joined(parts)
            order, later = _first_of([c["name"], c["extra"]], [c["doc"], c["start"]])
            c = {k: v[order] for k, v in c.items()}
            spans = _spans_of(c["doc"][later], c["mark"][later], c["start"][later], c["start"][later] + length)
            yield from _send((spans["doc"] % buckets).astype(np.int32), _packed(spans, _SPAN), 1)
            c = {k: v[~later] for k, v in c.items()}
            yield from _send((c["name"] % np.uint64(buckets)).astype(np.int32), _packed(c, _SPOT), 0)

    return run


def _reduce_spots(length: int):
    def run(group: pa.Table) -> pa.Table:
        spots, spans = _split(group)
        out = [_rows(1, _joined([_unpacked(p, _SPAN) for p in spans]))] if spans else []
        if spots:
            c = _joined([_unpacked(p, _SPOT) for p in spots])
            order, later = _first_of([c["name"], c["extra"]], [c["doc"], c["start"]])
            o = order[later]
            out.append(_rows(1, _spans_of(c["doc"][o], c["mark"][o], c["start"][o], c["start"][o].astype(np.int64) + length)))
        return pa.concat_tables(out) if out else _rows(1, {k: np.zeros(0, t) for k, t in _SPAN.items()})

    return run


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _cut_type(as_text: bool) -> T.StructType:
    return T.StructType([*(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("spans", _SPANS)])


def _cut(as_text: bool):
    """Merge a document's spans and cut them out of its bytes."""
    kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string() if as_text else pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            data, offsets = doc_bytes(rb.column("text"))
            ss, ee = rb.column("ss").to_pylist(), rb.column("ee").to_pylist()
            out = []
            for i, (s, e) in enumerate(zip(ss, ee)):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                m = _spans_of(np.zeros(len(s or ()), np.int64), np.zeros(len(s or ()), np.int64), np.array(s or (), np.int64), np.array(e or (), np.int64))
                starts, ends = m["start"].tolist(), m["end"].tolist()
                pieces = [text[a:b] for a, b in zip([0, *ends], [*starts, len(text)])]
                kept = "".join(p.decode("utf-8", "ignore") for p in pieces) if as_text else b"".join(pieces)
                out.append({"n_bytes": len(text), "n_removed": len(text) - sum(map(len, pieces)), "n_spans": len(starts), "kept": kept, "spans": [{"start": a, "end": b} for a, b in zip(starts, ends)]})
            yield pa.RecordBatch.from_arrays([rb.column("row"), rb.column("text"), pa.array(out, kind)], names=["row", "text", "c"])

    return run


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """All rows of ``docs`` with a struct column ``cut`` (``cut_`` if taken): n_bytes, n_removed, n_spans (maximal removed
    runs), kept (the remaining bytes; with ``as_text`` the text they hold, without characters that
    a span cuts through) and spans (byte offsets in the input text). ``length`` must be 68 to 159. See the module text for the method and the edge cases."""
    if not 68 <= length <= 159:
        raise ValueError("length must be 68 to 159 bytes")
    buckets = 4 * shuffle_partitions(ship(docs.sparkSession))
    keyed = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(_NULL_ID)).alias("k"), F.crc32(F.coalesce(quoted(text_col), F.lit("")).cast("binary")).alias("m"),
                        quoted(text_col).alias("text"), packed(docs, text_col))
    sent = keyed.select("k", "m", "text").mapInArrow(_map_runs(length, buckets), _SENT)
    first = stored(sent.groupBy("bucket").applyInArrow(_reduce_runs(length), _FOUND), "suffix-runs")
    # both joins below read one exchange of the documents: the same columns, dealt by the same keys
    open_runs = keyed.join(_lists(first.where("kind = 0")), ["k", "m"])
    spots = open_runs.mapInArrow(_map_spots(length, buckets), _SENT)
    second = spots.groupBy("bucket").applyInArrow(_reduce_spots(length), _FOUND)
    spans = _lists(first.where("kind = 1").unionByName(second.where("kind = 1")))
    joined = keyed.join(spans, ["k", "m"], "left")
    cut = joined.mapInArrow(_cut(as_text), joined.select("row", "text").schema.add("c", _cut_type(as_text)))
    return cut.select(*unpacked(docs, text_col), F.col("c").alias(free_name(docs, "cut")))


def _lists(found: DataFrame) -> DataFrame:
    return found.groupBy("k", "m").agg(F.collect_list("s").alias("ss"), F.collect_list("e").alias("ee"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Registered query: digests of what is left of every document."""
    c = F.col("cut")
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", c["n_bytes"].alias("n_bytes"), c["n_removed"].alias("n_removed"), c["n_spans"].alias("n_spans"), F.sha2(c["kept"], 256).alias("kept_sha256"))
