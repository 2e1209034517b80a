import random

import numpy as np
from helpers import DOCS, empty, frame, prose

from quayside.llm import cross_parsing, queries

SMALL = "/root/testdata/sf0.01"
STEMS = {"aa": ("lo", "ra", "mi", "ten", "sol"), "bb": ("xu", "qua", "zeh", "pij", "wö"), "cc": ("чи", "ра", "то", "ми", "сле")}


def _labelled(spark, n=60, seed=1):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, 60, STEMS[lang]), lang, "s", 0) for i, lang in enumerate([*STEMS] * n)]
    return spark.createDataFrame(rows, DOCS)


def _phrases(text, sample):
    """Greedy longest matches by substring search; a symbol the sample lacks is a phrase."""
    n = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in sample:
            j += 1
        n, i = n + 1, max(j - 1, i + 1)
    return n


def test_phrases_against_substring_search(monkeypatch):
    monkeypatch.setattr(cross_parsing, "BESIDE", 7)
    rnd = random.Random(3)
    sample = "".join(rnd.choice("abcd ") for _ in range(400))
    texts = ["".join(rnd.choice("abcd e") for _ in range(n)) for n in (0, 1, 5, 255, 256, 257, 700, 9000)]
    code = {c: i for i, c in enumerate(" abcde")}
    table = cross_parsing.parse_table([code[c] for c in sample])
    symbols = np.array([code[c] for t in texts for c in t], np.uint8)
    got = cross_parsing.phrases(symbols, np.cumsum([0, *map(len, texts)]), [table])[:, 0].tolist()
    cut = cross_parsing.SEGMENT
    want = [sum(_phrases(t[i:i + cut], sample) for i in range(0, len(t), cut)) for t in texts]
    # a segment that begins with a symbol the sample lacks counts one phrase more: the one it opened with
    extra = [sum(t[i] not in sample for i in range(0, len(t), cut)) for t in texts]
    strange = [sum(c not in sample and (k % cut) + 1 < min(cut, len(t) - k // cut * cut) for k, c in enumerate(t)) for t in texts]
    assert all(abs(g - w) <= e + s for g, w, e, s in zip(got, want, extra, strange))
    known = [k for k, t in enumerate(texts) if all(c in sample for c in t)]
    assert all(got[k] == want[k] for k in known)


def test_automaton_accepts_exactly_the_substrings():
    rnd = random.Random(4)
    sample = [rnd.randint(0, 2) for _ in range(60)]
    states = cross_parsing.suffix_automaton(sample)
    inside = {tuple(sample[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for _ in range(2000):
        word = tuple(rnd.randint(0, 3) for _ in range(rnd.randint(1, 6)))
        at = 0
        for c in word:
            at = states[at].get(c)
            if at is None:
                break
        assert (at is not None) == (word in inside)
    assert len(states) <= 2 * 60


def test_held_out_texts(spark):
    rnd = random.Random(7)
    texts, want = [], []
    for lang, stems in STEMS.items():
        for n in (3, 10, 100, 5000):
            texts.append(prose(rnd, n, stems).upper())
            want.append(lang)
    texts += [None, "", "12 34 !?", "日本"]
    docs = frame(spark, texts)
    out = cross_parsing.identify(docs, _labelled(spark))
    assert out.columns == [*docs.columns, "language"]
    got = {r.doc_id: r.language for r in out.collect()}
    assert [got[i].lang_pred for i in range(12)] == want
    assert [(got[i].lang_pred, got[i].score) for i in (12, 13, 14)] == [("und", 0.0)] * 3
    assert got[15].lang_pred in STEMS and 0 < got[15].score <= 1


def test_many_scripts_and_a_pair_of_large_alphabets(spark):
    rnd = random.Random(9)
    alphabets = {"la": "abcdefghijklmnopqrstuvwxyzàâçéèêëîïôùûüÿœæ", "cy": "абвгдежзийклмнопрстуфхцчшщъыьэюяіїєґ", "gr": "αβγδεζηθικλμνξοπρστυφχψωάέήίόύώ", "gs": "αβγδεζηθικλμνξοπρστυφχψωάέήίόύώ"}
    alphabets |= {x: "".join(chr(0x4E00 + 7 * i) for i in range(600)) for x in ("zh", "zi")}
    stems = {lang: ["".join(rnd.choice(letters) for _ in range(2)) for _ in range(400)] for lang, letters in alphabets.items()}
    training = spark.createDataFrame([(i, prose(rnd, 60, stems[lang]), lang, "s", 0) for i, lang in enumerate([*stems] * 40)], DOCS)
    want = [lang for lang in stems for _ in range(8)]
    docs = frame(spark, [prose(rnd, 40, stems[lang]) for lang in want])
    got = {r.doc_id: r.language.lang_pred for r in cross_parsing.identify(docs, training).collect()}
    assert [got[i] for i in range(len(want))] == want


def test_symbols_without_a_column_parse_as_others():
    rnd = random.Random(10)
    sample, text = [rnd.randint(0, 9) for _ in range(300)], np.array([rnd.randint(0, 10) for _ in range(3000)])
    wide = lambda x: x + 95 * (x > 4)
    cuts = np.array([0, 3, 3, 900, 3000])
    plain = cross_parsing.phrases(text, cuts, [cross_parsing.parse_table(sample)])
    assert plain.tolist() == cross_parsing.phrases(wide(text), cuts, [cross_parsing.parse_table([wide(x) for x in sample])]).tolist()


def test_nothing_learned_and_empty_tables(spark):
    docs = frame(spark, ["abc", None])
    none = spark.createDataFrame([(1, "abc", None, "s", 3), (2, None, "en", "s", 0)], DOCS)
    for training in (empty(spark), none):
        assert {(r.language.lang_pred, r.language.score) for r in cross_parsing.identify(docs, training).collect()} == {("und", 0.0)}
    assert cross_parsing.identify(empty(spark), _labelled(spark, 3)).count() == 0


def test_normalised_text():
    data = "Ab  c!".encode() + "".encode() + "É-É".encode() + b"..x"
    points, cuts = cross_parsing.normalised(np.frombuffer(data, np.uint8), np.array([0, 6, 6, 11, 14]))
    parts = ["".join(chr(p) if p else "_" for p in points[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    assert parts[0].rstrip("_") == "ab_c" and parts[1] == "" and parts[2] == "é_é" and parts[3].strip("_") == "x"


def test_query_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_cross_parsing"](spark, SMALL).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_rows_without_ids_are_sampled_and_bounded(spark):
    rnd = random.Random(3)
    rows = [(None, prose(rnd, 12, STEMS[lang]), lang, "s", 0) for lang in [*STEMS] * 400]
    training = spark.createDataFrame(rows, DOCS)
    docs = frame(spark, [prose(rnd, 30, s) for s in STEMS.values()])
    alphabet, langs, _, sizes = cross_parsing.learn(training, docs_per_lang=50, chars_per_lang=4000)
    assert langs == sorted(STEMS) and all(0 < n <= 4000 for n in sizes)
    got = {r.doc_id: r.language.lang_pred for r in cross_parsing.identify(docs, training, docs_per_lang=50).collect()}
    assert [got[i] for i in range(len(STEMS))] == list(STEMS)


def test_equal_costs_go_to_the_first_language(spark):
    training = spark.createDataFrame([(1, "abc def", "zz", "s", 0), (2, "abc def", "aa", "s", 0)], DOCS)
    assert cross_parsing.identify(frame(spark, ["abc def"]), training).first().language.lang_pred == "aa"


def test_samples_reach_into_long_texts(spark):
    """Of a text longer than the allowance a stretch at a hashed place is read, not always its beginning."""
    training = spark.createDataFrame([(i, "aaaa " * 2000 + "bbbb " * 2000, "x", "s", 0) for i in range(40)], DOCS)
    alphabet, _, _, _ = cross_parsing.learn(training, docs_per_lang=40, chars_per_lang=8000)
    assert set(map(chr, alphabet.tolist())) == {"a", "b"}
