"""Byte-level BPE: encoding with a segment tree over adjacent pair ranks, and decoding.

A text is cut at its special tokens, then into pretokens by the vocabulary's published pattern.
For each pretoken a segment tree holds the merge rank of every adjacent pair in its leaves; each
inner node holds the smaller child, the left one of equals, so the root yields the leftmost
lowest-rank pair. A merge rewrites at most three leaves and their paths (logarithmic updates);
encoding ends when the root holds no rank. Pretokens whose lengths fall in the same power of two
are worked off together, one numpy row each, so a step merges one pair in every one of them.
Pretokens already met are kept in a table of bounded size; a full table is emptied, which costs
time and never changes a result.

The vocabulary file is read on the driver from a path given as a parameter and broadcast (its
size is fixed by the file, a few MB). Works for files whose pre-tokenizer and decoder are
ByteLevel with the standard pattern, without prefix space and without a normalizer; others raise.

Defined results: a null text counts as empty; empty texts have no ids and decode to "". Texts are
encoded whole, however long. Extra columns pass through.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import free_name, packed, quoted, ship, table, unpacked

#: Fixed value: the published split pattern of byte-level BPE vocabularies (white space spelled out).
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
NONE = np.int32(1 << 30)
KEPT = 200_000
SLICE = 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, reversed: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks, ids and bytes of a vocabulary file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        pre, dec = spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
        model = spec["model"]
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or dec.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        letters = byte_letters()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        if any(t.get(k) for t in spec.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special tokens that strip, normalise or match whole words are not supported")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for piece, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in piece)
        for piece, i in self.special.items():
            self.bytes[i] = piece.encode()
        self.of_byte = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE where a side is missing (-1) or the pair is no merge."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_all(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of byte strings of 2 to ``width`` bytes (a power of two), one segment tree each."""
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces])
        ids = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width)[None, :] < sizes[:, None]
        ids[:, :width][inside] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        nxt = np.tile(np.arange(1, width + 2), (n, 1))
        prev = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int32)  # ranks; node 1 is the root, leaf i is width + i
        tree[:, width:] = self.rank(ids[:, :-1], ids[:, 1:])
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            node = np.ones(len(live), np.int64)
            top = tree[live, 1]
            while node[0] < width:  # down to the leftmost leaf with the root's rank
                node = 2 * node + (tree[live, 2 * node] != top)
            i = node - width
            j = nxt[live, i]
            k = nxt[live, j]
            ids[live, i] = self.merged[top]
            ids[live, j] = -1
            nxt[live, i] = k
            has = k <= width
            prev[live[has], k[has]] = i[has]
            after = np.where(k < width, ids[live, np.minimum(k, width)], -1)
            h = prev[live, i]
            before = np.where(h >= 0, ids[live, np.maximum(h, 0)], -1)
            for leaf, rank in ((j, np.full(len(live), NONE)), (i, self.rank(ids[live, i], after)), (h, self.rank(before, ids[live, i]))):
                ok = leaf >= 0
                row, at = live[ok], leaf[ok] + width
                tree[row, at] = rank[ok]
                while len(at) and at[0] > 1:
                    at = at >> 1
                    tree[row, at] = np.minimum(tree[row, 2 * at], tree[row, 2 * at + 1])
            live = live[tree[live, 1] < NONE]
        flat, held = ids[:, :width], ids[:, :width] >= 0
        cuts = np.cumsum(held.sum(axis=1))
        return np.split(flat[held].astype("<u4"), cuts[:-1])

    def learn(self, pieces: set[str]) -> None:
        """Encode pretokens and keep their ids as little-endian bytes."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            raw = p.encode()
            by_width.setdefault(1 << max(1, (len(raw) - 1).bit_length()), []).append((p, raw))
        for width, group in by_width.items():
            step = max(1, (1 << 18) // width)
            for b in range(0, len(group), step):
                part = group[b:b + step]
                for (p, _), ids in zip(part, self.merge_all([raw for _, raw in part], width)):
                    self.known[p] = ids.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > KEPT:
            self.known.clear()
        cut = []
        for text in texts:
            parts = [text] if self.cut is None else self.cut.split(text)
            cut.append([(self.special[p], None) if i % 2 else (None, self.pattern.findall(p)) for i, p in enumerate(parts)])
        new: set[str] = set()
        for parts in cut:
            for _, pieces in parts:
                if pieces:
                    new.update(pieces)
        new.difference_update(self.known)
        self.learn(new)
        known = self.known.__getitem__
        return [b"".join(i.to_bytes(4, "little") if p is None else b"".join(map(known, p)) for i, p in parts) for parts in cut]

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}


def _both(source, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = source.value
        vocabulary = _LOADED.get(text)
        if vocabulary is None:
            _LOADED.clear()
            vocabulary = _LOADED[text] = Vocabulary(text)
        for rb in batches:
            column = rb.column("text")
            first, n = 0, rb.num_rows
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            while first < n:
                end = max(first + 1, first + int(np.searchsorted(np.cumsum(sizes[first:]), SLICE, side="right")))
                ids = vocabulary.encode([t or "" for t in column.slice(first, end - first).to_pylist()])
                out = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([vocabulary.decode(i) for i in ids], pa.string())]
                yield pa.RecordBatch.from_arrays([rb.column(c).slice(first, end - first) for c in columns] + out, names=[*columns, "n_tokens", "ids", "decoded"])
                first = end

    return run


def encode_decode(docs: DataFrame, vocabulary_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``tokens`` (``tokens_`` if taken): n_tokens, ids (little-endian
    unsigned 32-bit integers in one binary value) and decoded (the text those ids decode to)."""
    spark = ship(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())
    row = docs.select(packed(docs, text_col), quoted(text_col).alias("text"))
    schema = T.StructType([*row.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    out = row.mapInArrow(_both(source, ["row", "text"]), schema)
    return out.select(*unpacked(docs, text_col), F.struct("n_tokens", "ids", "decoded").alias(free_name(docs, "tokens")))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10(spark, sf_dir: str) -> DataFrame:
    """Registered query: digests of every document's ids and of what they decode to."""
    found = encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), default_vocabulary())
    return found.select("doc_id", "tokens.n_tokens", F.sha2("tokens.ids", 256).alias("ids_sha256"), F.sha2(F.col("tokens.decoded").cast("binary"), 256).alias("decoded_sha256"))
