import random

from helpers import WORD, empty, frame, prose

from quayside.llm import decontaminate


def _words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    wins = {}
    for i, t in items:
        w = _words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = _words(t), set(), set()
        for key, ids in wins.items():
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k:k + len(key)]) == key:
                    hit.update(range(k, k + len(key)))
                    found |= ids
        out.append((len(w), len(hit), sorted(found)))
    return out


def _case(seed):
    rnd = random.Random(seed)
    items = [(i, prose(rnd, n)) for i, n in enumerate((30, 12, 10, 9, 3, 1, 11))] + [(7, ""), (8, None), (9, "?!")]
    items += [(10, items[0][1]), (11, "Élan VITAL " + prose(rnd, 9))]
    texts = [prose(rnd, rnd.randint(0, 60)) for _ in range(30)]
    for i, t in items:
        for _ in range(3):
            w = (t or "").split()
            a = rnd.randint(0, max(0, len(w) - 10))
            part = " ".join(w[a:a + rnd.randint(8, 25)])
            texts.append(f"{prose(rnd, 7)}, {part.upper() if rnd.random() < .3 and part.isascii() else part.replace(' ', rnd.choice([' ', ' -- ', chr(10)]))}. {prose(rnd, 7)}")
    return items, texts + [None, "", "  ", items[0][1] + " " + items[0][1], items[5][1], texts[-1], prose(rnd, 20_000) + " " + items[1][1]]


def _got(out):
    return [(r.found.n_words, r.found.n_hit, list(r.found["items"])) for r in sorted(out.collect(), key=lambda r: r.doc_id)]


def _items(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark):
    for seed in (1, 2):
        items, texts = _case(seed)
        docs = frame(spark, texts)
        out = decontaminate.find_contamination(docs, _items(spark, items))
        assert out.columns == [*docs.columns, "found"]
        assert _got(out) == [(n, h, sorted(map(str, f))) for n, h, f in brute(texts, items)]


def test_blocks_give_the_same(spark):
    items, texts = _case(3)
    one = _got(decontaminate.find_contamination(frame(spark, texts), _items(spark, items)))
    assert _got(decontaminate.find_contamination(frame(spark, texts), _items(spark, items), block_bytes=200)) == one


def test_spans_lie_in_the_original(spark):
    item = "Der Fluß, die Straße und das große Haus sind alt geworden heute"
    text = "é -- vorher: «" + item.replace(" ", "  ") + "» nachher"
    out = decontaminate.find_contamination(frame(spark, [text]), _items(spark, [(1, item)])).first()
    (span,) = out.found.spans
    raw = text.encode()[span.start:span.end].decode()
    assert _words(raw) == ["«der", "fluß", *_words(item)[2:-1], "heute»"] or raw.replace("  ", " ").endswith("heute»") or raw.replace("  ", " ") in item
    assert out.found.n_hit >= 10


def test_empty(spark):
    assert decontaminate.find_contamination(empty(spark), _items(spark, [(1, "a b")])).count() == 0
    out = decontaminate.find_contamination(frame(spark, ["a b", None]), _items(spark, []))
    assert _got(out) == [(2, 0, []), (0, 0, [])]


def test_null_and_repeated_items(spark):
    out = decontaminate.find_contamination(frame(spark, ["alpha beta gamma"]), _items(spark, [(None, "beta"), (2, "gamma"), (2, "alpha"), (3, None)]))
    assert _got(out) == [(3, 3, ["", "2"])]
