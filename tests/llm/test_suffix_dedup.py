import hashlib
import random

import pytest
from helpers import empty, frame, prose

from quayside.llm import queries, suffix_dedup

SMALL = "/root/testdata/sf0.001"


def brute(rows, length=100):
    """doc_id, text -> (n_bytes, n_removed, n_spans, kept); rows in any order."""
    first, out = {}, []
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for p in range(len(b) - length + 1):
            key = b[p:p + length]
            first[key] = min(first.get(key, (i, p)), (i, p))
    for i, b in raw:
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (i, p):
                cover[p:p + length] = b"\1" * length
        spans = sum(c and (k == 0 or not cover[k - 1]) for k, c in enumerate(cover))
        out.append((i, len(b), sum(cover), spans, bytes(x for x, c in zip(b, cover) if not c)))
    return out


def _got(df):
    return sorted((r.doc_id, r.cut.n_bytes, r.cut.n_removed, r.cut.n_spans, bytes(r.cut.kept)) for r in df.collect())


def _texts(seed):
    rnd = random.Random(seed)
    passages = [prose(rnd, n) for n in (18, 25, 40, 80)] + ["é" * 70, "ab" * 90, "x" * 500]
    texts = []
    for _ in range(60):
        parts = [prose(rnd, rnd.randint(0, 40)) for _ in range(rnd.randint(1, 4))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            cut = rnd.randint(0, len(p) // 3)
            parts.insert(rnd.randrange(len(parts) + 1), p[cut:])
        texts.append(rnd.choice([" ", "", "\n"]).join(parts))
    return texts + [None, "", "short", texts[3], texts[3], "y" * 99, "y" * 100, "y" * 101]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    texts = _texts(seed)
    out = suffix_dedup.remove_repeats(frame(spark, texts))
    assert _got(out) == sorted(brute(list(enumerate(texts))))


@pytest.mark.parametrize("length", [68, 159])
def test_other_lengths(spark, length):
    texts = _texts(4)
    assert _got(suffix_dedup.remove_repeats(frame(spark, texts), length)) == sorted(brute(list(enumerate(texts)), length))


def test_long_text_in_pieces(spark, monkeypatch):
    rnd = random.Random(6)
    passage = prose(rnd, 60)
    texts = [prose(rnd, 900) + passage + prose(rnd, 700) + passage[7:] + "z" * 3000, passage, prose(rnd, 30)]
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    step = list(suffix_dedup._map_runs(100, 4)([_batch(texts)]))
    assert step  # pieces of 1000 bytes; the whole is compared below, where pieces are of the usual size
    runs = [r for r in suffix_dedup._runs(*_bytes(texts), 100)]
    monkeypatch.undo()
    whole = [r for r in suffix_dedup._runs(*_bytes(texts), 100)]
    key = lambda parts: {(int(d), int(s) + k, int(s) + int(b), int(n), int(c)) for p in parts for d, s, b, m, n, c in zip(p["doc"], p["start"], p["back"], p["count"], p["name"], p["context"]) for k in range(m)}
    assert key(runs) == key(whole)
    assert _got(suffix_dedup.remove_repeats(frame(spark, texts))) == sorted(brute(list(enumerate(texts))))


def _bytes(texts):
    import pyarrow as pa

    from quayside.llm.common import doc_bytes

    return doc_bytes(pa.array(texts, pa.string()))


def _batch(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts, pa.string())], names=["k", "m", "text"])


def test_repeated_ids_and_null_ids(spark):
    rnd = random.Random(9)
    text = prose(rnd, 60)
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "unlike " + prose(rnd, 40)), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text, r.cut.n_removed) for r in suffix_dedup.remove_repeats(docs).collect())
    n = len(text.encode())
    want = sorted([(False, 1, text, 0), (False, 1, text, 0), (False, 2, text, n), (True, 0, text, n), (True, 0, rows[4][1], 0), (False, 3, "", 0)])
    assert got == want


def test_text_form_drops_split_characters(spark):
    body = "é" * 120
    docs = frame(spark, ["a" + body, "b" + body + "end"])
    got = {r.doc_id: r.cut.kept for r in suffix_dedup.remove_repeats(docs, as_text=True).collect()}
    assert got[1] == "bend"
    assert got[0].startswith("aé") and "�" not in got[0]


def test_hot_passage(spark):
    rnd = random.Random(10)
    passage = prose(rnd, 50)
    texts = [prose(rnd, 12) + " " + passage + " " + prose(rnd, 12) for _ in range(300)]
    assert _got(suffix_dedup.remove_repeats(frame(spark, texts))) == sorted(brute(list(enumerate(texts))))


def test_empty(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op6_suffix_dedup"](spark, SMALL).collect())
    assert got == sorted((i, n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, n, gone, spans, kept in brute(rows))
