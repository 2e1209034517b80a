"""Words, word shingles and their hashes for a whole Arrow batch at once.

Words are runs of characters other than ASCII non-alphanumerics, lower-cased (every non-ASCII
character is a word character). A document of at least ``size`` words has one shingle per window
of ``size`` words; a shorter document with words has one shingle of all its words; others have none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quayside.llm.common import doc_bytes, mix64

SLICE, DOCS = 1 << 20, 1024  # bytes and documents worked on at a time (one whole document at least)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_WORD = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLD)


def _powers(n: int, base: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and hash of each word of a byte array (which has a separator at its
    document borders or is cut there by the caller)."""
    inside = _WORD[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up = _powers(len(data), _BASE)
    down = _powers(len(data), pow(_BASE, -1, 1 << 64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTER[data] * up)])
    return first, end, mix64((total[end] - total[first]) * (down[first] if len(first) else down[:0]) + (end - first).astype(np.uint64) * _GOLD)


def batches_of_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice of documents: the first document, the word count of each, and all word hashes."""
    _, sizes = doc_bytes(column)
    first, n = 0, len(sizes) - 1
    while first < n:
        end = min(first + DOCS, max(first + 1, int(np.searchsorted(sizes, sizes[first] + SLICE, side="right")) - 1))
        data, offsets = doc_bytes(pc.utf8_lower(column.slice(first, end - first)))
        part, cuts = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        # a separator between documents keeps their words apart
        spaced = np.full(len(part) + end - first, 32, np.uint8)
        spaced[np.arange(len(part)) + np.repeat(np.arange(end - first), np.diff(cuts))] = part
        start, _, words = word_hashes(spaced)
        yield first, np.bincount(np.searchsorted(cuts[1:] + np.arange(1, end - first + 1), start, side="right"), minlength=end - first), words
        first = end


def shingle_sets(counts: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (index into ``counts``), shingle and multiplicity, sorted by document and shingle."""
    n = len(counts)
    doc = np.repeat(np.arange(n), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    h = np.zeros(len(words), np.uint64)
    left = counts[doc] - place
    for k in range(size):
        nxt = np.zeros(len(words), np.uint64)
        nxt[:len(words) - k] = words[k:]
        h = np.where(left > k, mix64(h * _GOLD + nxt + np.uint64(k)), h)
    take = (left >= size) | ((place == 0) & (counts[doc] < size))
    doc, h = doc[take], h[take]
    order = np.lexsort([h, doc])
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    cut = np.flatnonzero(new)
    return doc[cut], h[cut], np.diff(np.r_[cut, len(doc)])


def digests(counts: np.ndarray, words: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each document's word sequence; None without words."""
    ends = np.cumsum(counts)
    return [hashlib.blake2b(words[e - c:e].tobytes(), digest_size=16).digest() if c else None for c, e in zip(counts.tolist(), ends.tolist())]
