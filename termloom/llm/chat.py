"""Conversations as training windows of a token budget.

A turn is written as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. Texts and roles may
hold control strings themselves: a backslash is put behind any ``<`` that is followed by backslashes, or none, and
a ``|``, so ``<|`` only ever starts a control string, and taking one backslash away restores the text.

Turns are sorted over all conversations and their tokens summed up: running sums within a task, then over tasks. A
turn's place in its conversation follows from two such sums, and cuts long conversations into segments of
``SEGMENT`` tokens that are worked on apart. Within a segment, windows take turns while they fit the budget: the
conversation's system turn, if it starts with one, then up to ``HISTORY`` tokens of the turns before, then new
turns. What a window repeats is masked: only the texts of new assistant turns are under its loss mask, so every
one is trained on once. A system turn stands whole in the window it opens; later windows repeat it whole if it takes no
more than half of the budget, and else the first part of its text that does. So output stays in proportion to input.

Defined results: a null text or role is empty. A null conversation id is a conversation. Turns go by turn number,
nulls first, then by role and by a hash of the text; repeated rows are turns of their own. A turn that does not fit
beside what its window repeats gets a window of its own, beyond the budget. A system turn of which no text fits in half
of the budget is repeated without text. An empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.bpe import Vocabulary, vocabulary
from termloom.llm.common import column
from termloom.llm.workers import tidy
from termloom.operators.lookup import salted_join
from termloom.session import materialize

BUDGET, HISTORY = 1024, 256
SEGMENT = 64 * BUDGET
START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM, TARGET = "system", "assistant"

_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window."""
    bodies = [x.removesuffix(END).split("\n", 1) for x in formatted.split(START)[1:]]
    return [(unescape_role(role), unescape(text)) for role, text in bodies]


def shortened(role: str, text: str, limit: int, words: Vocabulary) -> tuple[str, int]:
    """A formatted turn of at most ``limit`` tokens with as much of the start of ``text`` as fits, or none; its tokens."""
    ids = words.encode(text)[:limit]
    keep = len(ids)
    while True:
        formatted = format_turn(role, words.decode(ids[:keep]).decode("utf-8", "ignore"))
        tokens = len(words.encode(formatted))
        if tokens <= limit or not keep:
            return formatted, tokens
        keep = max(0, keep - (tokens - limit))


def _sorted_turns(conversations: DataFrame, path: str, limit: int) -> DataFrame:
    """Formatted turns in order, with their tokens and the tokens of all turns before (``position``); for system
    turns also what later windows repeat of them (``head``)."""

    @tidy
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            words = vocabulary(path)
            batch = batch.copy()
            batch["formatted"] = [format_turn(r, t) for r, t in zip(batch["role"], batch["text"])]
            batch["tokens"] = [len(words.encode(x)) for x in batch["formatted"]]
            heads = [
                (None, 0) if role != SYSTEM else (whole, n) if n <= limit else shortened(role, text, limit, words)
                for role, text, whole, n in zip(*[batch[c] for c in ("role", "text", "formatted", "tokens")])
            ]
            batch["head"], batch["head_tokens"] = [h for h, _ in heads], [n for _, n in heads]
            upto = batch["tokens"].cumsum()
            batch["part"], batch["before"] = part, total + upto - batch["tokens"]
            total += int(upto.iloc[-1]) if len(batch) else 0
            yield batch[["key", "role", "formatted", "tokens", "head", "head_tokens", "part", "before"]]

    rows = conversations.select(
        F.to_json(F.struct(column("conv_id").alias("conv_id"))).alias("key"),
        column("turn").alias("turn"),
        F.coalesce(column("role"), F.lit("")).alias("role"),
        F.coalesce(column("text"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = ["key", "turn", "role", F.xxhash64("text"), "place"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "role", "text")
    schema = "key string, role string, formatted string, tokens bigint, head string, head_tokens bigint, part int, before bigint"
    counted = materialize(ranged.mapInPandas(count, schema), "turns")
    per_part = counted.groupBy("part").agg(F.sum("tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    # One row per task on the broadcast side.
    placed = counted.join(F.broadcast(starts), "part")
    position = (F.col("start") + F.col("before")).alias("position")
    return placed.select("key", "role", "formatted", "tokens", "head", "head_tokens", position)


_WINDOW = (
    "key string, position bigint, formatted string, n_context int, n_tokens bigint, "
    "loss_start array<int>, loss_end array<int>"
)


def _windows(budget: int, history: int):
    """Windows of segments whose turns come one after the other. A segment begins with the row of what is repeated
    of its system turn (``kind`` 0), at the place of that turn, if there is one, and with the turns of the segment
    before that are history only (``kind`` 1)."""

    def window(key: str, context: list[tuple], turns: list[tuple]) -> tuple:
        text, starts, ends = "".join(x[2] for x in context), [], []
        size = len(text)
        parts = [text]
        for _, role, formatted, _ in turns:
            if role == TARGET:
                starts.append(size + formatted.index("\n") + 1)
                ends.append(size + len(formatted) - len(END))
            parts.append(formatted)
            size += len(formatted)
        tokens = sum(x[3] for x in context + turns)
        return key, turns[0][0], "".join(parts), len(context), tokens, starts, ends

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = key = system = None
        past: deque = deque()
        turns: list[tuple] = []
        used = past_tokens = 0
        names = [f.split()[0] for f in _WINDOW.split(", ")]

        def remember(turn: tuple) -> None:
            nonlocal past_tokens
            past.append(turn)
            past_tokens += turn[3]
            while past_tokens > history:
                past_tokens -= past.popleft()[3]

        for batch in batches:
            rows = []
            columns = [batch[c] for c in ("key", "segment", "kind", "position", "role", "formatted", "tokens")]
            for k, segment, kind, *turn in zip(*columns):
                turn = tuple(turn)
                if (k, segment) != group:
                    if turns:
                        rows.append(window(key, context, turns))
                    group, key, turns, system, used, past_tokens = (k, segment), k, [], None, 0, 0
                    past.clear()
                if kind == 0:
                    system = turn
                    continue
                if kind == 1:
                    remember(turn)
                    continue
                if turns and used + turn[3] > budget:
                    rows.append(window(key, context, turns))
                    for done in turns:
                        if not same_turn(done, system):
                            remember(done)
                    turns = []
                if not turns:
                    # The window that a system turn opens has it among its new turns.
                    context = ([system] if system and not same_turn(turn, system) else []) + list(past)
                    used = sum(x[3] for x in context)
                turns.append(turn)
                used += turn[3]
            if rows:
                yield pd.DataFrame(rows, columns=names)
        if turns:
            yield pd.DataFrame([window(key, context, turns)], columns=names)

    def same_turn(turn: tuple, system: tuple | None) -> bool:
        return system is not None and turn[:2] == system[:2]

    return cut


def format_windows(conversations: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows ``(key, position, formatted, n_context, n_tokens, loss_start, loss_end)``.

    ``key`` is the conversation id as JSON, ``position`` sorts the windows of a conversation; the first
    ``n_context`` turns are repeated ones; the loss mask covers characters from ``loss_start`` up to ``loss_end``.
    """
    turns = _sorted_turns(conversations, path, budget // 2)
    first = F.min(F.struct("position", "role", "head", "head_tokens")).alias("first")
    ends = [F.max("position").alias("last"), F.count(F.lit(1)).alias("n")]
    heads = materialize(turns.groupBy("key").agg(first, *ends), "heads")
    base = heads.select("key", F.col("first.position").alias("base"))
    joined = salted_join(turns.drop("head", "head_tokens"), base, "key", rows_per_key=heads.select("key", "n"))
    segment = F.floor((F.col("position") - F.col("base")) / SEGMENT)
    near_end = F.col("position") - F.col("base") >= (segment + 1) * SEGMENT - history
    own = F.struct(segment.alias("segment"), F.lit(2).alias("kind"))
    next_ = F.struct((segment + 1).alias("segment"), F.lit(1).alias("kind"))
    copies = F.explode(F.when(near_end, F.array(own, next_)).otherwise(F.array(own))).alias("in")
    turn = ["position", "role", "formatted", "tokens"]
    of_turns = joined.select("*", copies).select("key", "in.segment", "in.kind", *turn)
    # What is repeated of a system turn goes to each segment of its conversation, not to each turn.
    segments = F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - F.col("first.position")) / SEGMENT))
    of_system = heads.where(F.col("first.role") == SYSTEM).select(
        "key",
        F.explode(segments).alias("segment"),
        F.lit(0).alias("kind"),
        *[F.col(f"first.{c}").alias(name) for c, name in zip(("position", "role", "head", "head_tokens"), turn)],
    )
    dealt = (
        of_turns.unionByName(of_system)
        .repartition("key", "segment")
        .sortWithinPartitions("key", "segment", "kind", "position")
    )
    return dealt.mapInPandas(_windows(budget, history), _WINDOW)


READ = "key string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from its windows, read as a stream: only digests are held."""
    names = [f.split()[0] for f in READ.split(", ")]
    key, turns, loss, counts = None, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

    def row() -> tuple:
        return key, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]

    for batch in batches:
        rows = []
        columns = [batch[c] for c in ("key", "formatted", "n_context", "loss_start", "loss_end")]
        for k, formatted, n_context, starts, ends in zip(*columns):
            if k != key:
                if key is not None:
                    rows.append(row())
                key, turns, loss, counts = k, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            for role, text in read_turns(formatted)[n_context:]:
                turns.update(f"{role}\n{text}\n".encode())
                counts[0] += 1
            for a, b in zip(starts, ends):
                text = unescape(formatted[a:b])
                loss.update(text.encode())
                counts[1] += len(text)
            counts[2] += len(formatted)
        if rows:
            yield pd.DataFrame(rows, columns=names)
    if key is not None:
        yield pd.DataFrame([row()], columns=names)


def read_windows(windows: DataFrame, conv_type: str = "bigint") -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from windows alone."""
    dealt = windows.repartition("key").sortWithinPartitions("key", "position")
    read = dealt.mapInPandas(_read, READ)
    conv = F.from_json("key", f"conv_id {conv_type}")["conv_id"].alias("conv_id")
    return read.select(conv, *[f.split()[0] for f in READ.split(", ")[1:]])
