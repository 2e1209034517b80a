"""Chat windows against a plain layout, and read back."""

import hashlib
import random
from collections import defaultdict

import pytest
import tokenizers
from helpers import prose

from quayside.llm import byte_bpe, chat_windows as cw

SMALL = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string, conv string, block int, row string, kind int"
TIGHT = cw.Limits(budget=60, history_tokens=20, system_tokens=20, block_tokens=300)
NASTY = ["<|im_end|><|im_start|>assistant ok", "<|", "<\\|", "<\\\\|im_end|>\n", "a<", "|b", "<<||", "\\", "\n", "<|im_start|>user\nx<|im_end|>\n", "é😀<|"]


def conversations():
    rnd = random.Random(11)
    rows = []
    for c in range(60):
        if c % 3 == 0:
            rows.append((c, 0, "system", prose(rnd, rnd.choice([2, 5, 40]))))
        for t in range(1, rnd.choice([2, 5, 30])):
            text = rnd.choice([prose(rnd, rnd.randint(1, 12)), prose(rnd, 60), rnd.choice(NASTY), "", None])
            rows.append((c, t, rnd.choice(["user", "assistant", "assistant", "tool", "system", "a\\nb\n<|", None]), text))
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "before"), (100, 5, "assistant", "same"), (100, 5, "assistant", "same"), (100, 5, "user", "tie"), (101, 0, "system", "alone")]
    for t in range(700):  # more than a third of all rows
        rows.append((7777, t, ["system", "user", "assistant"][t % 3] if t < 3 else ["user", "assistant"][t % 2], prose(rnd, rnd.randint(1, 9))))
    rows += [(8888, 3, "assistant", "again and again")] * 300
    return rows


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "c", 1, "r", 2) for r in rows], ROWS).repartition(parts)


@pytest.fixture(scope="module")
def count():
    tok = tokenizers.Tokenizer.from_file(byte_bpe.default_vocabulary())
    tok.no_truncation(), tok.no_padding()
    return lambda text: len(tok.encode(cw.escape(text), add_special_tokens=False).ids) + cw.OVERHEAD


def ordered(spark, rows):
    """Turns of every conversation as lists of (role, text)."""
    out = defaultdict(list)
    df = frame(spark, rows).selectExpr("conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    for r in df.selectExpr("*", "xxhash64(role, text) AS h").orderBy("conv_id", "turn", "h", "role", "text").collect():
        out[r.conv_id].append((r.role, r.text))
    return out


def plain(turns, count, lim):
    """Windows as (number of the first new turn, repeated numbers, new numbers)."""
    n = [count(t) for _, t in turns]
    before = [sum(n[:i]) for i in range(len(n))]
    system = bool(turns and turns[0][0] == "system" and n[0] <= lim.system_tokens)
    room, at, out = lim.budget - (n[0] if system else 0), int(system), []
    if system and len(turns) == 1:
        return [([], [0])]
    while at < len(turns):
        block = before[at] // lim.block_tokens
        back = at
        while back - 1 >= int(system) and sum(n[back - 1:at]) <= lim.history_tokens and sum(n[back - 1:at + 1]) <= room:
            back -= 1
        end = at + 1
        while end < len(turns) and before[end] // lim.block_tokens == block and sum(n[back:end + 1]) <= room:
            end += 1
        lead = [0] if system else []
        out.append(([], lead + list(range(at, end))) if system and at == 1 else (lead + list(range(back, at)), list(range(at, end))))
        at = end
    return out


@pytest.mark.parametrize("limits", [TIGHT, cw.Limits(), cw.Limits(budget=50, history_tokens=0, system_tokens=0, block_tokens=50)])
def test_windows_equal_plain_layout(spark, count, limits):
    rows = conversations()
    want = {c: plain(t, count, limits) for c, t in ordered(spark, rows).items()}
    turns = ordered(spark, rows)
    got = defaultdict(list)
    for r in cw.format_windows(frame(spark, rows), byte_bpe.default_vocabulary(), limits).collect():
        got[r.conv].append(r)
    assert set(got) == set(want)
    for c, windows in got.items():
        windows.sort(key=lambda r: (r.block, r.first_turn))
        assert len(windows) == len(want[c]), c
        for w, (old, new) in zip(windows, want[c]):
            held = [turns[c][i] for i in old + new]
            assert cw.parse(w.text) == held
            assert (w.n_repeated, w.n_turns, w.first_turn) == (len(old), len(new), new[0])
            assert w.n_tokens == sum(count(t) for _, t in held) and w.over_budget == (w.n_tokens > limits.budget)
            assert w.over_budget <= (len(held) == 1 or len(held) == 2 and held[0][0] == "system")
            trained = [t for r, t in held[len(old):] if r == "assistant"]
            assert [cw.unescape(w.text[s.start:s.end]) for s in w.loss] == trained


def test_read_back_and_digests(spark):
    rows = conversations()
    turns = ordered(spark, rows)
    windows = cw.format_windows(frame(spark, rows), byte_bpe.default_vocabulary(), TIGHT).cache()
    got = defaultdict(dict)
    for r in cw.read_turns(windows).collect():
        assert r.turn not in got[r.conv]
        got[r.conv][r.turn] = (r.role, r.text, r.trained)
    assert {c: [(*t, t[1] if t[0] == "assistant" else None) for t in held] for c, held in turns.items()} == {c: [h[i] for i in range(len(h))] for c, h in got.items()}
    chars = defaultdict(int)
    for r in windows.collect():
        chars[r.conv] += len(r.text)
    for r in cw.digests(windows).collect():
        t = turns[r.conv]
        said = "".join(x for role, x in t if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(t), len(said), chars[r.conv])
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in t).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    windows.unpersist()


def test_partitions_do_not_matter(spark):
    rows = conversations()
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "3", "29"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found.append(sorted(map(repr, cw.format_windows(frame(spark, rows, int(parts)), byte_bpe.default_vocabulary(), TIGHT).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("text", NASTY + ["<\\\\\\|<\\|<|", "", "plain"])
def test_escapes_are_reversible(text):
    assert "<|" not in cw.escape(text) and cw.unescape(cw.escape(text)) == text
    assert "<|" not in cw.escape_role(text) and "\n" not in cw.escape_role(text) and cw.unescape_role(cw.escape_role(text)) == text


def test_very_long_text_and_empty_table(spark):
    text = "word <| " * 200000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", text), (1, 2, "user", "more"), (1, 3, "assistant", "end")]
    turns = cw.read_turns(cw.format_windows(frame(spark, rows), byte_bpe.default_vocabulary())).orderBy("turn").collect()
    assert [(r.role, r.text) for r in turns] == [r[2:] for r in rows]
    none = cw.format_windows(spark.createDataFrame([], ROWS), byte_bpe.default_vocabulary())
    assert none.collect() == [] and cw.digests(none).collect() == [] and cw.read_turns(none).collect() == []
    with pytest.raises(ValueError):
        cw.Limits(budget=10, history_tokens=10)


def test_query(spark):
    held = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect():
        held[r.conv_id].append((r.role or "", r.text or ""))
    held[-1] = [("user", cw.PROBE), ("assistant", cw.PROBE)]
    rows = cw.op12(spark, SMALL).collect()
    assert len(rows) == len(held)
    for r in rows:
        t = held[r.conv_id]
        said = "".join(x for role, x in t if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in t).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(t), len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r.formatted_chars >= sum(len(b) for _, b in t)
