"""Periodic runs against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import empty, frame, prose

from quayside.llm import periodic_runs as pr

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, least=6, repeats=4):
    """Every period in turn: stretches where words q apart agree; smaller periods win."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and (i, j + q) not in found:
                found[(i, j + q)] = q
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, repeats * q))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rnd = random.Random(3)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "x " * 400, "a b " * 7 + "a", "a b a b " * 4, "a\x1fb a\x1fb " * 3 + "c"]
    for _ in range(150):
        out.append(" ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 120))))
        q = rnd.randint(1, 9)
        block = prose(rnd, q)
        out.append(" ".join([prose(rnd, rnd.randint(0, 9)), *[block] * rnd.randint(2, 9), prose(rnd, rnd.randint(0, 9)), *["z"] * rnd.randint(0, 9)]))
    # periods inside periods
    inner = "p q " * 4 + "r "
    out += [inner * 5, ("a a a a a a b " * 5 + "c ") * 4]
    return out + [out[-1], out[-1]]


def ascii_words(t):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_equals_definition(spark):
    all_ = texts()
    got = {r.k: r for r in pr.find_runs(frame(spark, all_)).collect()}
    assert len(got) == len(all_)
    for i, t in enumerate(all_):
        words = ascii_words(t)
        runs = plain_runs(words)
        found = got[i].periodic
        assert [(r.start, r.length, r.period) for r in found.runs] == sorted(runs, key=lambda r: (r[0], r[2])), t
        assert found.n_words == len(words)
        assert found.collapsed == (None if t is None else plain_collapsed(words, runs))


@pytest.mark.parametrize("least,repeats", [(2, 2), (9, 3)])
def test_other_thresholds(spark, least, repeats):
    some = [t for t in texts() if t and len(t) < 300][:60]
    got = {r.k: r.periodic for r in pr.find_runs(frame(spark, some), least=least, repeats=repeats).collect()}
    for i, t in enumerate(some):
        assert sorted((r.start, r.length, r.period) for r in got[i].runs) == plain_runs(ascii_words(t), least, repeats), t
    with pytest.raises(ValueError):
        pr.find_runs(frame(spark, some), repeats=1)


def test_slices_do_not_matter(monkeypatch):
    some = [None if t is None else t.encode() for t in texts()]
    whole = [a.to_pylist() for a in pr._slice(some, 6, 4)]
    single = [sum((pr._slice([t], 6, 4)[c].to_pylist() for t in some), []) for c in range(3)]
    assert whole == single
    monkeypatch.setattr(pr, "TESTS", 7)
    assert whole == [a.to_pylist() for a in pr._slice(some, 6, 4)]


def test_very_long_text():
    words = np.tile(np.arange(1000), 300)
    start, end, period = pr.runs_of(words)
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [300000], [1000])
    start, end, period = pr.runs_of(np.zeros(200000, np.int64))
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [200000], [1])


def test_empty_table(spark):
    assert pr.find_runs(empty(spark)).collect() == []


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = pr.op13(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    planted = 0
    for r in rows:
        words = ascii_words(docs[r.doc_id])
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n > 3000:
            continue  # the plain form is quadratic
        runs = sorted(plain_runs(words), key=lambda x: (x[0], x[2]))
        assert r.n_runs == len(runs)
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2])) if runs else (None, None, None)
        assert (r.start, r.length, r.period) == top
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert planted > 5


def test_null_id_is_not_planted(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = spark.createDataFrame([(None, text)], "doc_id long, text string")
    assert [tuple(r) for r in pr.planted(rows).collect()] == [(None, text)]
