import collections
import random

import numpy as np
from helpers import WORD, empty, frame, prose

from quayside.llm import dart_minhash


def _weights(text):
    w = WORD.findall((text or "").lower())
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def _similar(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute_classes(texts, threshold=0.8):
    sets = [_weights(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and _similar(sets[i], sets[j]) >= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def _texts(seed=3):
    rnd = random.Random(seed)
    texts = []
    for _ in range(12):
        words = prose(rnd, rnd.randint(60, 200)).split()
        for _ in range(rnd.randint(1, 6)):
            copy = list(words)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = "other" + str(rnd.randint(0, 99))
            texts.append(" ".join(copy))
    common = prose(rnd, 60)  # a passage that many otherwise different texts share
    texts += [common + " " + prose(rnd, 90) for _ in range(25)]
    texts += [None, None, "", "", "?!", "one two", "One, two!", "one two three", prose(rnd, 20_000)]
    rnd.shuffle(texts)
    return texts


def test_classes_against_brute_force(spark):
    texts = _texts()
    got = {r.id: r.class_id for r in dart_minhash.classes(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def _family(rnd, pairs):
    """Documents of one template: mates are similar, most others are not, but share their buckets."""
    template = prose(rnd, 160).split()
    texts = []
    for i in range(pairs):
        own = [f"own{i}x{j}" for j in range(rnd.randint(22, 30))]
        for side in "ab":
            words = template + own
            for j in range(3 if side == "b" else 0):
                words[rnd.randrange(40 * j, 40 * j + 40)] = f"mark{i}{side}{j}"
            texts.append(" ".join(words))
    return texts


def test_templated_family_against_brute_force(spark):
    texts = _family(random.Random(17), 150)
    want = brute_classes(texts)
    assert len(set(want)) > 100 and len(set(want)) < 200
    got = {r.id: r.class_id for r in dart_minhash.classes(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_dissimilar_crowd_needs_no_checks(spark):
    rnd = random.Random(18)
    texts = _family(rnd, 200)[::2]
    want = brute_classes(texts)
    got = {r.id: r.class_id for r in dart_minhash.classes(frame(spark, texts), rounds=1).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_large_group_of_copies_is_one_class(spark):
    rnd = random.Random(5)
    words = prose(rnd, 150).split()
    texts = [" ".join(words)] * 150
    for i in range(150):
        copy = list(words)
        copy[rnd.randrange(150)] = f"w{i}"
        texts.append(" ".join(copy))
    texts += [prose(rnd, 40) for _ in range(100)]
    got = {r.id: (r.class_id, r.class_rows) for r in dart_minhash.classes(frame(spark, texts)).collect()}
    assert all(got[i] == (0, 300) for i in range(300))
    assert all(got[i] == (i, 1) for i in range(300, 400))


def test_keep_one_keeps_one_row_of_each_class(spark):
    texts = _texts(8)
    docs = frame(spark, texts)
    docs = docs.unionAll(docs.where("doc_id < 10")).unionAll(docs.where("doc_id = 11").selectExpr("cast(null as long) as doc_id", *docs.columns[1:]))
    want = {c for i, c in enumerate(brute_classes(texts)) if _weights(texts[i])}
    kept = dart_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if _weights(r.text)]
    assert sorted(ids) == sorted(want)
    bare = [r for r in kept.collect() if not _weights(r.text)]
    assert len(bare) == sum(not _weights(r.text) for r in docs.collect())


def test_empty(spark):
    assert dart_minhash.classes(empty(spark)).count() == 0
    assert dart_minhash.keep_one(empty(spark)).count() == 0


def test_connected_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {}
    for a, b in edges:
        if a != b:
            old = {root.get(a, a), root.get(b, b)}
            low = min(old)
            for n in [*root, a, b]:
                if root.get(n, n) in old:
                    root[n] = low
    got = {r.node: r.root for r in dart_minhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root


def test_signatures_estimate_weighted_jaccard():
    rnd = np.random.default_rng(1)
    a = np.sort(rnd.choice(1 << 60, 300, replace=False).astype(np.uint64))
    wa, wb = rnd.integers(1, 9, 300), rnd.integers(1, 9, 300)
    k = 2000
    sig = dart_minhash.dart_signatures(np.repeat([0, 1], 300), np.concatenate([a, a]), np.concatenate([wa, wb]), 2, k)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / k)


def test_rows_without_ids_meet_by_text(spark):
    """Many near copies without an id, or under one id: as fast as with ids, and the same classes."""
    import time
    rnd = random.Random(5)
    words = prose(rnd, 80).split()
    texts = [" ".join(words + [f"own{i}"]) for i in range(1500)]
    spent = {}
    for name, ids in (("own", range(1500)), ("none", [None] * 1500), ("one", [7] * 1500)):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        began = time.time()
        rows = dart_minhash.classes(df).collect()
        spent[name] = time.time() - began
        assert len(rows) == 1500 and {r.class_rows for r in rows} == {1500} and len({r.name for r in rows}) == 1
    assert max(spent["none"], spent["one"]) < 2 * spent["own"] + 2
