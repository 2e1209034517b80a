"""Benchmark decontamination with an Aho-Corasick automaton over normalised item windows.

Words are runs of characters other than ASCII non-alphanumerics, with A-Z lower-cased. An item's
windows are its runs of ``window`` consecutive words (an item of fewer words is one window). The
automaton holds every window once, as words joined by blanks with a blank at either end; a
document is normalised the same way and scanned once. Matches are counted in words and mapped
back to byte offsets of the original text.

The items are grouped into blocks of at most ``block_bytes`` of text; each block is collected and
broadcast by itself, and a task holds the automaton of one block at a time, so memory is bounded
whatever the size of the benchmark (with one block, the usual case, it is built once per worker).

Defined results: null and empty texts have no words and no hits; items without a word have no
window; an item's null id counts as "". Item ids are compared as strings and listed once each.
Repeated rows each get their own result. Extra columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import free_name, packed, quoted, ship, table, unpacked

_WORD = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
_CLEAN = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if _WORD[c] else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


def build(items: list[tuple[str, str]], window: int) -> tuple[ahocorasick.Automaton, list[tuple[int, int, list[str]]]]:
    """The automaton and per window its letters, its words and the items that have it."""
    windows: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = [w.decode("latin-1") for w in words_of(text.encode())]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i:i + window]
            windows.setdefault(f" {' '.join(part)} ", (len(part), set()))[1].add(item)
    automaton, listed = ahocorasick.Automaton(), []
    for key in sorted(windows):
        n, ids = windows[key]
        automaton.add_word(key, len(listed))
        listed.append((len(key), n, sorted(ids)))
    if listed:
        automaton.make_automaton()
    return automaton, listed


def scan(clean: str, automaton: ahocorasick.Automaton, listed: list[tuple[int, int, list[str]]]) -> tuple[list[tuple[int, int]], set[str]]:
    """(first word, end word) of each occurrence, and the items found, in a normalised text."""
    found = list(automaton.iter(clean)) if listed else []
    if not found:
        return [], set()
    blanks = np.flatnonzero(np.frombuffer(clean.encode("latin-1"), np.uint8) == 0x20)
    begin = np.searchsorted(blanks, [end - listed[k][0] + 1 for end, k in found]).tolist()
    return [(b, b + listed[k][1]) for b, (_, k) in zip(begin, found)], {i for k in {k for _, k in found} for i in listed[k][2]}


_BUILT: dict[tuple[str, int], tuple] = {}


def _scan_all(blocks: list, window: int):
    def automaton_of(i: int):
        key = (blocks[i].value[0], window)
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = build(blocks[i].value[1], window)
        return _BUILT[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            texts = [(t or "").encode() for t in rb.column("text").to_pylist()]
            clean = [f" {b' '.join(words_of(t)).decode('latin-1')} " for t in texts]
            spans: list[list[tuple[int, int]]] = [[] for _ in texts]
            items: list[set[str]] = [set() for _ in texts]
            for b in range(len(blocks)):
                automaton, listed = automaton_of(b)
                for i, c in enumerate(clean):
                    s, ids = scan(c, automaton, listed)
                    if s:
                        spans[i] += s
                        items[i] |= ids
            out = []
            for text, c, s, ids in zip(texts, clean, spans, items):
                n = c.count(" ") - 1 if len(c) > 2 else 0
                hit, marks = 0, []
                if s:
                    cover = np.zeros(n + 1, np.int64)
                    np.add.at(cover, [a for a, _ in s], 1)
                    np.add.at(cover, [e for _, e in s], -1)
                    covered = np.diff(np.r_[0, (np.cumsum(cover[:n]) > 0).astype(np.int8), 0])
                    first, end = np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)
                    hit = int((end - first).sum())
                    inside = np.diff(np.r_[0, _WORD[np.frombuffer(text, np.uint8)].astype(np.int8), 0])
                    starts, ends = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
                    marks = [{"start": int(starts[a]), "end": int(ends[e - 1])} for a, e in zip(first, end)]
                out.append({"n_words": n, "n_hit": hit, "items": sorted(ids), "spans": marks})
            yield pa.RecordBatch.from_arrays([rb.column("row"), rb.column("text"), pa.array(out, _FOUND_ARROW)], names=["row", "text", "found"])

    return run


_FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
                       T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with a struct column ``found`` (``found_`` if taken): n_words, n_hit (words inside
    an occurrence of a window), items (ids whose windows occur, sorted as strings) and spans (byte
    offsets in the original text of the maximal runs of hit words)."""
    spark = ship(docs.sparkSession)
    wanted = items.select(F.coalesce(quoted(item_id).cast("string"), F.lit("")).alias("i"), quoted(item_text).alias("t")).where("t is not null")
    total = wanted.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = 1 + total // block_bytes
    blocks = []
    for b in range(n_blocks):
        part = [(r["i"], r["t"]) for r in wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == b).toLocalIterator()]
        blocks.append(spark.sparkContext.broadcast((uuid.uuid4().hex, part)))
    row = docs.select(packed(docs, text_col), quoted(text_col).alias("text"))
    out = row.mapInArrow(_scan_all(blocks, window), T.StructType([*row.schema.fields, T.StructField("found", _FOUND)]))
    return out.select(*unpacked(docs, text_col), F.col("found").alias(free_name(docs, "found")))


def op9(spark, sf_dir: str) -> DataFrame:
    """Registered query: benchmark hits of every document."""
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    f = F.col("found")
    return found.select("doc_id", f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"), F.size(f["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(f["items"], ","), 256).alias("items_sha256"), (f["n_hit"] > 0).alias("contaminated"))
