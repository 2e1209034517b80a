import random

import numpy as np
import public_tokenizers
import pytest
from helpers import empty, frame, prose
from tokenizers import Tokenizer

from quayside.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return byte_bpe.Vocabulary(f.read())


def _ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def _same(vocabulary, known, texts):
    for text, raw in zip(texts, vocabulary.encode(texts)):
        want = known.encode(text, add_special_tokens=False).ids
        assert _ids(raw) == want, repr(text[:80])
        assert vocabulary.decode(raw) == known.decode(want, skip_special_tokens=False)


def test_edge_texts(vocabulary, known):
    _same(vocabulary, known, ["", " ", "  ", "\n\n  x", "a" * 3000, " " * 500, "don't we'll I'M it'd", "日本語 テキスト 🙂👍🏽", "naïve café  déjà", "x y　z", "a<|endoftext|>b", "<|endoftext|><|endoftext|> ", "<|endoftext", "1234567890 ½ ² Ⅷ",
                              "tab\t\ttab \r\n end", "\x00\x1f\x85", "aaaa aaaa aaaab", "é combining", "ab" * 2000 + " tail ", "...!!!???", "_under_score_"])


def test_every_character_class(vocabulary, known):
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)}" for c in points[i:i + 512]) for i in range(0, len(points), 512)]
    bad = []
    for text, i in zip(texts, range(0, len(points), 512)):
        if _ids(vocabulary.encode([text])[0]) != known.encode(text, add_special_tokens=False).ids:
            bad += [hex(c) for c in points[i:i + 512] if _ids(vocabulary.encode([f"a{chr(c)}b {chr(c)}"])[0]) != known.encode(f"a{chr(c)}b {chr(c)}", add_special_tokens=False).ids]
    assert not bad, (len(bad), bad[:40])


def test_random_texts(vocabulary, known):
    rnd = random.Random(4)
    pool = "abcdefghij  \n'.,stréñü0123日<|endoftext|>"
    _same(vocabulary, known, ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 400))) for _ in range(300)])
    _same(vocabulary, known, [prose(rnd, 300) for _ in range(5)])


def test_full_table_is_emptied_without_changing_results(vocabulary, known, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 10)
    rnd = random.Random(5)
    for _ in range(5):
        _same(vocabulary, known, [prose(rnd, 50)])


def test_rows(spark, known):
    texts = ["hello world", None, "", "hello world", "z" * 100_000, "<|endoftext|>"]
    docs = frame(spark, texts)
    out = byte_bpe.encode_decode(docs, PATH)
    assert out.columns == [*docs.columns, "tokens"]
    got = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(texts):
        want = known.encode(t or "", add_special_tokens=False).ids
        r = got[i]
        assert (r.tokens.n_tokens, _ids(r.tokens.ids), r.tokens.decoded, r.text) == (len(want), want, t or "", t)
    assert byte_bpe.encode_decode(empty(spark), PATH).count() == 0


def test_other_kinds_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        byte_bpe.Vocabulary(f.read())
