"""Language identification by cross-parsing entropy over suffix automata.

Per language a suffix automaton is built over a bounded sample of its labelled text. A text is
parsed against each automaton into phrases: from the root, follow the text until no transition
exists (the longest match), then begin the next phrase there. A language's cost is its number of
phrases times log2 of the length of its sample (the bits that name a phrase); fewest bits win.

Text is lower-cased; each letter of the samples is a symbol of its own, all other letters are one
symbol that no sample holds, and each run of other characters is one separator. Parsing is a
table walk: a missing transition is replaced by the root's, with the phrase counted in the low
bits of the entry. The ``LETTERS`` most frequent letters of all samples have dense columns;
transitions by the others (most of a CJK alphabet) are sorted (state, symbol) keys that are
searched where such a symbol occurs, so the alphabet is not bounded. Texts are cut into segments of ``SEGMENT`` symbols that are parsed side by
side, one numpy step for the i-th symbol of every segment; a cut ends a phrase in every language
alike, so whole texts count.

The sample is bounded by two parameters: at most ``docs_per_lang`` documents per language, chosen
by a hash of the doc_id (of the text without one; repeated ids and such texts count once), and
``chars_per_lang`` symbols: of each document one stretch, of one length for all that are long enough, at
a place given by its hash. Memory: below 16 MB for a language's dense table at the default bound, and below 2 MB for its keys.

Defined results: ``und`` with score 0.0 for null texts, empty texts and texts without a letter.
Equal costs go to the language first in sorted order. Rows with null lang or null text are never
learned from. With nothing to learn from, every text is ``und``. The score is the winner's share
when each language weighs 2^-bits: near 1/2 for an open choice between two, near 1 for long texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import bounded_sample, crc_bucket, doc_bytes, free_name, packed, quoted, ship, table, unpacked

SEGMENT = 256
BESIDE = 8_192
WIDTH = 64
PAD, SEPARATOR, RARE = 63, 0, 62  # symbols from WIDTH on have no column
LETTERS = 61
SLICE = 2 << 20


@lru_cache(1)
def _lowered() -> np.ndarray:
    """For each code point its lower-cased code point if it is a letter, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters as code points with 0 between runs of them, and the offsets per text."""
    part = data[offsets[0]:offsets[-1]]
    points = np.frombuffer(str(part, "utf-8").encode("utf-32-le"), np.uint32)
    chars = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])[offsets - offsets[0]]
    low = _lowered()[points]
    letter = low > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    # a separator that only ends the text before it is dropped with its text's border
    begin = chars[:-1][chars[:-1] < len(points)]
    keep[begin] = letter[begin]
    return low[keep], np.concatenate([[0], np.cumsum(keep)])[chars]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


def parse_table(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry [state * WIDTH + symbol]: 4 * next state + phrases that end here; for symbols without
    a column the sorted keys state << 32 | symbol and their entries (a state's, or else the root's
    at state -1)."""
    states = suffix_automaton(symbols)
    out = np.full((len(states), WIDTH), 2, np.int32)  # a symbol the sample lacks: ends a phrase and is one
    wide = {-1 << 32 | c: 4 * s + 1 for c, s in states[0].items() if c >= WIDTH}
    for c, s in states[0].items():
        if c < WIDTH:
            out[:, c] = 4 * s + 1
    for i, row in enumerate(states):
        for c, s in row.items():
            if c < WIDTH:
                out[i, c] = 4 * s
            else:
                wide[i << 32 | c] = 4 * s
    out[:, PAD] = 0
    keys = sorted(wide)
    return out.ravel(), np.array(keys, np.int64), np.array([wide[k] for k in keys], np.int32)


def _searched(state: np.ndarray, symbol: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Entries for symbols without a column."""
    out = np.full(len(state), 2, np.int32)
    if len(keys):
        for at in (np.full(len(state), -1, np.int64), state.astype(np.int64)):
            key = at << 32 | symbol
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            out = np.where(keys[place] == key, values[place], out)
    return out


def phrases(symbols: np.ndarray, offsets: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Phrases of each text (rows) by each table (columns)."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    per = -(-sizes // SEGMENT)
    doc = np.repeat(np.arange(n), per)
    place = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * SEGMENT
    start = offsets[doc] + place
    left = np.minimum(sizes[doc] - place, SEGMENT)
    out = np.zeros((n, len(tables)), np.int64)
    step = np.arange(SEGMENT)[:, None]
    for b in range(0, len(doc), BESIDE):  # so many segments side by side: bounded memory for long texts
        own, length = doc[b:b + BESIDE], left[None, b:b + BESIDE]
        at = np.minimum(start[None, b:b + BESIDE] + step, len(symbols) - 1)
        grid = np.where(step < length, symbols[at], PAD).astype(np.int32)
        wide = [(w, row[w].astype(np.int64)) for row in grid for w in [np.flatnonzero(row >= WIDTH)]]
        grid[grid >= WIDTH] = RARE
        for k, (entries, keys, values) in enumerate(tables):
            v, cost = np.zeros(len(own), np.int32), np.ones(len(own), np.int32)
            for row, (w, symbol) in zip(grid, wide):
                found = _searched(v[w] >> 2, symbol, keys, values) if len(w) else None
                v &= -4
                v <<= 4
                v += row
                v = entries.take(v)
                if found is not None:
                    v[w] = found
                cost += v & 3
            out[:, k] += np.bincount(own, weights=cost, minlength=n).astype(np.int64)
    return out


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", docs_per_lang: int = 200, chars_per_lang: int = 32768) -> tuple[np.ndarray, list[str], list[tuple[np.ndarray, np.ndarray, np.ndarray]], list[int]]:
    """Code points of the alphabet, languages, their parse tables and sample lengths."""
    known = docs.where(quoted(lang_col).isNotNull() & quoted(text_col).isNotNull())
    known = known.select(quoted(lang_col).cast("string").alias("lang"), quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    place = F.pmod("h", F.greatest(F.lit(1), F.char_length("text") - chars_per_lang + 1)).cast("int") + 1
    chosen = bounded_sample(known, "lang", "id", docs_per_lang).select("lang", "h", F.substring("text", place, F.lit(chars_per_lang)).alias("text")).orderBy("lang", "h")
    samples: dict[str, list[tuple[int, np.ndarray]]] = {}
    for r in chosen.toLocalIterator():
        data = np.frombuffer(r["text"].encode(), np.uint8)
        samples.setdefault(r["lang"], []).append((r["h"], normalised(data, np.array([0, len(data)]))[0]))
    streams = {}
    for lang, texts in samples.items():
        # an equal allowance for each document, raised until the bound is met or the texts are used up
        allowance = min((a for a in (256 << i for i in range(20)) if sum(min(len(t), a) for _, t in texts) >= chars_per_lang), default=chars_per_lang)
        starts = [h % max(1, len(t) - allowance + 1) for h, t in texts]
        streams[lang] = np.concatenate([np.r_[t[s:s + allowance], np.uint32(0)] for s, (_, t) in zip(starts, texts)])[:chars_per_lang]
    streams = {k: streams[k] for k in sorted(streams) if (streams[k] > 0).any()}
    values, counts = np.unique(np.concatenate([*streams.values(), np.zeros(0, np.uint32)]), return_counts=True)
    counts, values = counts[values > 0], values[values > 0]
    alphabet = values[np.lexsort([values, -counts])]
    index = _index(alphabet)
    return alphabet, list(streams), [parse_table(index[s].tolist()) for s in streams.values()], [len(s) for s in streams.values()]


def _index(alphabet: np.ndarray) -> np.ndarray:
    out = np.full(0x110000, RARE, np.int32)
    out[alphabet[:LETTERS]] = np.arange(1, min(len(alphabet), LETTERS) + 1)
    out[alphabet[LETTERS:]] = np.arange(WIDTH, WIDTH + max(0, len(alphabet) - LETTERS))
    out[0] = SEPARATOR
    return out


def _predict(model, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, langs, tables, sizes = model.value
        index, bits = _index(alphabet), np.log2(np.maximum(np.array(sizes, float), 2.0))
        for rb in batches:
            data, offsets = doc_bytes(rb.column("text"))
            pred, score, first, n = [], [], 0, len(offsets) - 1
            while first < n:
                end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1)
                points, cuts = normalised(data, offsets[first:end + 1])
                has = np.add.reduceat(np.r_[points > 0, False], np.minimum(cuts[:-1], len(points))) * (np.diff(cuts) > 0) > 0
                if not langs:
                    has[:] = False
                cost = phrases(index[points], cuts, tables) * bits if langs else np.zeros((end - first, 1))
                best = cost.argmin(axis=1)
                with np.errstate(under="ignore"):
                    share = 1.0 / np.exp2(np.maximum(cost.min(axis=1, keepdims=True) - cost, -1000.0)).sum(axis=1)
                pred += [langs[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())]
                score.append(np.where(has, share, 0.0))
                first = end
            yield pa.RecordBatch.from_arrays([rb.column(c) for c in columns] + [pa.array(pred, pa.string()), pa.array(np.concatenate([*score, np.zeros(0)]))], names=[*columns, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, training: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", **bounds) -> DataFrame:
    """``docs`` with a struct column ``language`` (``language_`` if taken): lang_pred and score."""
    spark = ship(docs.sparkSession)
    model = spark.sparkContext.broadcast(learn(training, text_col, lang_col, id_col, **bounds))
    row = docs.select(packed(docs, text_col), quoted(text_col).alias("text"))
    schema = T.StructType([*row.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = row.mapInArrow(_predict(model, ["row", "text"]), schema)
    return out.select(*unpacked(docs, text_col), F.struct("lang_pred", "score").alias(free_name(docs, "language")))


def op8(spark, sf_dir: str) -> DataFrame:
    """Registered query: the language of every document, learned from the folds other than 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = crc_bucket("doc_id", 4)
    found = identify(docs.select("doc_id", "text"), docs.where(fold != 2))
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "language.lang_pred", "language.score")
