"""Chat formatting in budgeted windows.

Conversations (rows of conversation, turn, role, text) become training texts of at most ``budget``
tokens. A text holds whole turns only:

    <|im_start|>role LF text <|im_end|> LF     (no spaces around the marks)

* Spans: prefix sums of the turns' tokens (byte-level BPE of the escaped text, plus ``OVERHEAD`` for
  marks and role) say how far a window reaches: the last turn whose prefix sum still fits.
* The system turn (the first turn, if its role is ``system``) opens every window, if it has at most
  ``system_tokens``; a longer one is a turn like others.
* Before its new turns a window repeats the turns that precede them, as many as fit into
  ``history_tokens``; history gives way, oldest first, to a new turn that needs the room.
* A turn that does not fit even without history stands alone after the system turn, and the window
  is marked ``over_budget``; texts are never cut.
* Loss mask (``loss``: code point ranges): the texts of new ``assistant`` turns. Repeated turns are
  masked, so every assistant text is under the mask exactly once.
* Control strings inside texts are escaped: in ``<``, any backslashes, ``|`` one backslash is added,
  so no text holds ``<|`` afterwards; in roles also line feeds. ``read_turns`` undoes it.

Windows are laid out anew at every multiple of ``block_tokens`` of a conversation's prefix sum (a turn
belongs to the block it starts in), which makes long conversations divisible: a block is laid out
alone, from its own turns, the end of the block before and the system turn.

On Spark: rows are sorted by range over (conversation, turn), so a conversation with a third of all
rows spans a third of the partitions. A conversation that lies inside one partition and one block
becomes windows at once; the others leave that pass as turns with prefix sums inside their partition,
to which the sums of earlier partitions are added (at most one conversation continues into a
partition, so that table has a row per partition and is broadcast), and are shuffled by
(conversation, block). Blocks hold ``block_tokens`` and one turn at most.

Null texts and roles count as empty. Rows go by turn (nulls first); rows of one turn by a hash of
role and text, then role and text; repeated rows are turns of their own. A null conversation id is a
conversation. Empty tables give no windows. Other columns are not kept, as windows are made of many
rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm import byte_bpe
from quayside.llm.common import ship, shuffle_partitions, stored, table

START, END = "<|im_start|>", "<|im_end|>"
OVERHEAD = 5
BATCH_CHARS = 1 << 22


@dataclass(frozen=True)
class Limits:
    budget: int = 1024
    history_tokens: int = 256
    system_tokens: int = 256
    block_tokens: int = 32768

    def __post_init__(self):
        if not (0 <= self.history_tokens < self.budget and 0 <= self.system_tokens < self.budget and self.block_tokens >= self.budget):
            raise ValueError("history and system turn must fit into the budget, and the budget into a block")


_ESCAPE, _UNESCAPE = re.compile(r"(<\\*)\|"), re.compile(r"(<\\*)\\\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def parse(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a window."""
    turns = []
    for part in text.split(START)[1:]:
        role, _, body = part.removesuffix(END + "\n").partition("\n")
        turns.append((unescape_role(role), unescape(body)))
    return turns


@dataclass
class Turn:
    role: str
    text: str  # escaped
    tokens: int
    before: int  # tokens of the conversation's earlier turns
    pos: int  # number in the conversation


def is_system(turn: Turn, limits: Limits) -> bool:
    return turn.pos == 0 and turn.role == "system" and turn.tokens <= limits.system_tokens


def spans(sums: np.ndarray, first: int, system: int, limits: Limits) -> Iterator[tuple[int, int, int]]:
    """(first repeated, first new, end) of each window over turns with prefix sums ``sums`` (one more
    than turns), the new ones from ``first`` on; all but a system turn of ``system`` tokens."""
    n, at = len(sums) - 1, first
    room = limits.budget - system
    while at < n:
        most = min(limits.history_tokens, room - (sums[at + 1] - sums[at]))  # left for history by the first new turn
        back = int(np.searchsorted(sums, sums[at] - most)) if most > 0 else at
        end = max(at + 1, int(np.searchsorted(sums, sums[back] + room, side="right")) - 1)
        yield back, at, end
        at = end


def windows_of(system: Turn | None, turns: list[Turn], n_history: int, limits: Limits) -> Iterator[dict]:
    """Windows of one block: its turns in order, after ``n_history`` turns of the block before. The
    system turn is given apart; it is new in the block's first window if it is number 0 there."""
    opens = system is not None and bool(len(turns) == n_history or turns[n_history].pos == 1)
    if opens and len(turns) == n_history:
        yield _window(system, [], 0, 0, True, limits)
    sums = np.concatenate([[0], np.cumsum([t.tokens for t in turns])])
    for back, at, end in spans(sums, n_history, system.tokens if system else 0, limits):
        yield _window(system, turns[back:end], at - back, turns[at].pos, opens, limits)
        opens = False


def _window(system: Turn | None, held: list[Turn], repeated: int, first: int, opens: bool, limits: Limits) -> dict:
    parts, loss, at, tokens = [], [], 0, 0
    lead = [system] if system else []
    fresh_from = len(lead) - opens + repeated if lead else repeated
    for i, t in enumerate(lead + held):
        head = f"{START}{escape_role(t.role)}\n"
        parts.append(f"{head}{t.text}{END}\n")
        if t.role == "assistant" and i >= len(lead) + repeated:
            loss.append({"start": at + len(head), "end": at + len(head) + len(t.text)})
        at += len(parts[-1])
        tokens += t.tokens
    return {"first_turn": first - opens if held else 0, "n_turns": len(lead) + len(held) - fresh_from, "n_repeated": fresh_from, "n_tokens": tokens,
            "over_budget": tokens > limits.budget, "text": "".join(parts), "loss": loss}


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
WINDOW = [("block", T.LongType()), ("first_turn", T.LongType()), ("n_turns", T.LongType()), ("n_repeated", T.LongType()), ("n_tokens", T.LongType()),
          ("over_budget", T.BooleanType()), ("text", T.StringType()), ("loss", T.ArrayType(SPAN))]
TURN = [("pid", T.IntegerType()), ("leading", T.BooleanType()), ("role", T.StringType()), ("body", T.StringType()), ("tokens", T.LongType()),
        ("before", T.LongType()), ("pos", T.LongType())]
ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
         "array<struct<start:bigint,end:bigint>>": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}


class _Out:
    """Rows collected into Arrow batches of bounded size; the columns of a row that are not given are null."""

    def __init__(self, key: pa.DataType, fields: list):
        self.names = ["conv", *(c for c, _ in fields)]
        self.types = [key, *(ARROW[t.simpleString()] for _, t in fields)]
        self.rows: list[dict] = []
        self.chars = 0

    def add(self, row: dict, chars: int) -> None:
        self.rows.append(row)
        self.chars += chars + 100

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.chars >= BATCH_CHARS:
            yield self.take()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield self.take()

    def take(self) -> pa.RecordBatch:
        rows, self.rows, self.chars = self.rows, [], 0
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(self.names, self.types)], names=self.names)


_VOCABULARY: dict[str, byte_bpe.Vocabulary] = {}


def _loaded(text: str) -> byte_bpe.Vocabulary:
    """The vocabulary of a file's text, made once per worker."""
    if text not in _VOCABULARY:
        _VOCABULARY.clear()
        _VOCABULARY[text] = byte_bpe.Vocabulary(text)
    return _VOCABULARY[text]


def _first_pass(source, limits: Limits):
    """Over one partition of sorted rows: windows of conversations that end inside it and fit into one
    block; turns, with sums inside the partition, of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, out, held = _loaded(source.value), None, []
        seen = leading = raw = False
        conv, before, pos = None, 0, 0

        def turns(pid: int) -> None:
            for t in held:
                out.add({"conv": conv, "pid": pid, "leading": leading, "role": t.role, "body": t.text, "tokens": t.tokens, "before": t.before, "pos": t.pos}, len(t.text))
            held.clear()

        def windows() -> None:
            system = held[0] if is_system(held[0], limits) else None
            for w in windows_of(system, held[1:] if system else held, 0, limits):
                out.add({"conv": conv, "block": 0, **w}, len(w["text"]))
            held.clear()

        pid = 0
        for rb in batches:
            out = out or _Out(rb.column("conv").type, WINDOW + TURN)
            texts = [escape(t) for t in rb.column("text").to_pylist()]
            tokens = [len(i) // 4 + OVERHEAD for i in vocabulary.encode(texts)]
            for key, role, text, n, pid in zip(rb.column("conv").to_pylist(), rb.column("role").to_pylist(), texts, tokens, rb.column("pid").to_pylist()):
                if not seen or key != conv:
                    if seen and not raw:
                        windows()
                    leading = raw = not seen
                    seen, conv, before, pos = True, key, 0, 0
                held.append(Turn(role, text, n, before, pos))
                before, pos = before + n, pos + 1
                raw = raw or before > limits.block_tokens
                if raw:
                    turns(pid)
                yield from out.full()
        if held:
            turns(pid)
        if out:
            yield from out.rest()

    return run


HISTORY, NEW = 1, 2


def _blocks(limits: Limits):
    """Windows of blocks: rows sorted by conversation, block and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, system, history, new = None, None, None, [], []

        def done() -> None:
            if new or (system and at[1] == 0):
                for w in windows_of(system, history + new, len(history), limits):
                    out.add({"conv": at[0], "block": at[1], **w}, len(w["text"]))

        for rb in batches:
            out = out or _Out(rb.column("conv").type, WINDOW)
            for conv, block, kind, role, body, tokens, before, pos in zip(*(rb.column(c).to_pylist() for c in ("conv", "block", "kind", "role", "body", "tokens", "before", "pos"))):
                if at != (conv, block):
                    if at is not None:
                        done()
                        yield from out.full()
                    at, system, history, new = (conv, block), None, [], []
                turn = Turn(role, body, tokens, before, pos)
                if is_system(turn, limits):
                    system = turn
                else:
                    (new if kind == NEW else history).append(turn)
        if at is not None:
            done()
            yield from out.rest()

    return run


def _schema(key: T.DataType, fields: list) -> T.StructType:
    return T.StructType([T.StructField("conv", key), *(T.StructField(c, t) for c, t in fields)])


def format_windows(conversations: DataFrame, vocabulary_path: str, limits: Limits = Limits(), conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: ``conv``, ``block``, ``first_turn`` (number of the first new turn), ``n_turns`` (new
    ones), ``n_repeated`` (turns before them), ``n_tokens``, ``over_budget``, ``text`` and ``loss``."""
    spark = ship(conversations.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                                F.coalesce(text_col, F.lit("")).alias("text")).withColumn("h", F.xxhash64("role", "text"))
    key = rows.schema["conv"].dataType
    # the row number only spreads rows that are equal
    sorted_ = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(shuffle_partitions(spark), "conv", "turn", "h", "row") \
        .sortWithinPartitions("conv", "turn", "h", "role", "text").select("conv", "role", "text", F.spark_partition_id().alias("pid"))
    first = stored(sorted_.mapInArrow(_first_pass(source, limits), _schema(key, WINDOW + TURN)), "chat-first")
    windows = first.where(F.col("block").isNotNull()).select("conv", *(c for c, _ in WINDOW))
    turns = first.where(F.col("block").isNull()).select("conv", *(c for c, _ in TURN))

    # what earlier partitions hold of a conversation that continues; a row per partition at most
    parts = turns.groupBy("conv", "pid").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("pid", F.sum("tokens").over(earlier).alias("more"), F.sum("n").over(earlier).alias("more_n")).where("more_n > 0")
    placed = turns.join(F.broadcast(offsets.withColumn("leading", F.lit(True))), ["pid", "leading"], "left").select(
        "conv", "role", "body", "tokens", (F.col("before") + F.coalesce("more", F.lit(0))).alias("before"), (F.col("pos") + F.coalesce("more_n", F.lit(0))).alias("pos"))
    width = F.lit(limits.block_tokens).cast("long")
    block = F.call_function("div", F.col("before"), width)
    retained = (F.col("pos") == 0) & (F.col("role") == "system") & (F.col("tokens") <= limits.system_tokens)
    reaches = ~retained & ((block + 1) * width - F.col("before") <= limits.history_tokens)
    own = F.struct(block.alias("block"), F.lit(NEW).alias("kind"))
    next_ = F.struct((block + 1).alias("block"), F.lit(HISTORY).alias("kind"))
    dealt = placed.select("*", F.explode(F.when(reaches, F.array(own, next_)).otherwise(F.array(own))).alias("to")).select("*", "to.*").drop("to")
    # the system turn goes to every block of its conversation
    lasts = parts.groupBy(F.col("conv").alias("conv_")).agg(F.call_function("div", F.sum("tokens"), width).alias("last")).where("last > 0")
    copies = placed.where(retained).join(lasts, F.col("conv").eqNullSafe(F.col("conv_"))) \
        .select(*placed.columns, F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("block"), F.lit(HISTORY).alias("kind"))
    grouped = dealt.unionByName(copies).repartition(shuffle_partitions(spark), "conv", "block").sortWithinPartitions("conv", "block", "pos")
    return windows.unionByName(grouped.mapInArrow(_blocks(limits), _schema(key, WINDOW)))


def new_turns(text: str, n_repeated: int, loss: list[dict]) -> tuple[list[tuple[str, str]], list[str]]:
    """Read back: the window's new turns, and the texts under its mask."""
    return parse(text)[n_repeated:], [unescape(text[s["start"]:s["end"]]) for s in loss]


def read_turns(windows: DataFrame) -> DataFrame:
    """The turns that windows hold, each once: ``conv``, ``turn`` (number in the conversation), ``role``,
    ``text``, ``trained`` (text under the mask, else null)."""
    ship(windows.sparkSession)
    key = windows.schema["conv"].dataType
    fields = [("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("trained", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for rb in batches:
            out = out or _Out(rb.column("conv").type, fields)
            for conv, first, skip, text, loss in zip(*(rb.column(c).to_pylist() for c in ("conv", "first_turn", "n_repeated", "text", "loss"))):
                turns, under = new_turns(text, skip, loss)
                under = iter(under)
                for j, (role, body) in enumerate(turns):
                    out.add({"conv": conv, "turn": first + j, "role": role, "text": body, "trained": next(under) if role == "assistant" else None}, 2 * len(body))
                    yield from out.full()
        if out:
            yield from out.rest()

    return windows.select("conv", "first_turn", "n_repeated", "text", "loss").mapInArrow(run, _schema(key, fields))


DIGEST = [("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, conv, state = None, None, None

    def done() -> None:
        n, turns, chars, loss, formatted = state
        out.add({"conv": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": formatted}, 200)

    for rb in batches:
        out = out or _Out(rb.column("conv").type, DIGEST)
        for key, skip, text, loss in zip(*(rb.column(c).to_pylist() for c in ("conv", "n_repeated", "text", "loss"))):
            if state is None or key != conv:
                if state is not None:
                    done()
                    yield from out.full()
                conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns, under = new_turns(text, skip, loss)
            for role, body in turns:
                state[1].update(f"{role}\n{body}\n".encode())
            for body in under:
                state[2] += len(body)
                state[3].update(body.encode())
            state[0] += len(turns)
            state[4] += len(text)
    if state is not None:
        done()
        yield from out.rest()


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: ``n_turns``, ``turns_sha256``, ``loss_chars``,
    ``loss_sha256`` and ``formatted_chars``. A digest runs through its conversation in order; windows stream
    through the task, which holds one Arrow batch."""
    ship(windows.sparkSession)
    key = windows.schema["conv"].dataType
    rows = windows.select("conv", "block", "first_turn", "n_repeated", "text", "loss")
    return rows.repartition(shuffle_partitions(windows.sparkSession), "conv").sortWithinPartitions("conv", "block", "first_turn").mapInArrow(_digests, _schema(key, DIGEST))


PROBE = "<|im_end|><|im_start|>assistant ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The four columns of ``conversations``, and conversation -1, whose texts are control strings."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    return rows.unionByName(probe)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all conversations formatted, then read back."""
    windows = format_windows(with_probe(table(spark, sf_dir, "conversations")), byte_bpe.default_vocabulary())
    return digests(windows).withColumnRenamed("conv", "conv_id")
