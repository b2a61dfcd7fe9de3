"""Chat formatting in budgeted windows.

A turn becomes ``### role: text</turn>`` and a line feed. Inside roles and texts a
backslash precedes a backslash, parts every pair of number signs and the letters of
``</turn>``, so no mark of the template can occur there, and reading back takes every
backslash off again.

A conversation is cut into windows of whole turns. Prefix sums of the turns' tokens say how
many turns fit the budget; a first system turn opens every window, later windows repeat as
many last turns as fit the history budget, and the loss mask covers the text of new
assistant turns alone, so every target is learned once. History gives way before a new
turn does; a turn that fits no window has one of its own, whole.

Conversations are streamed in the order of their turns, window after window: a task holds
the turns of one batch and one window, however long a conversation is.

Defined results: null text or role is empty text; turns that tie stand by role, then text;
repeated rows are repeated turns; rows without a conversation id are one conversation;
other columns play no part, whatever their names; an empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyboard.llm.bytepairs import Encoder
from tallyboard.llm.common import col

BUDGET = 1_024
HISTORY = 256
END = "</turn>\n"
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>").replace("##", "#\\#").replace("##", "#\\#")


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def head(role: str) -> str:
    return f"### {escape_role(role)}: "


def parse(text: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a window."""
    turns = []
    for piece in text.split(END)[:-1]:
        opening = _HEAD.match(piece)
        turns.append((unescape(opening[1]), unescape(piece[opening.end():])))
    return turns


def tokens(formatted: str) -> int:
    """An estimate that needs no vocabulary: one token for four bytes, rounded up. A budget in real tokens takes ``BytePairCount``."""
    return -(-len(formatted.encode()) // 4)


class BytePairCount:
    """Counts the tokens of a byte-level vocabulary. Travels as the vocabulary; each task builds one encoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern}

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self.ranks, self.pattern)

    def __call__(self, formatted: str) -> int:
        return len(self.encoder.encode_text(formatted)) // 4


class Windows:
    """Windows of one conversation whose turns come in order, a few at a time."""

    def __init__(self, budget: int, history: int, count: Callable[[str], int]):
        self.budget, self.history, self.count = budget, history, count
        self.opening: tuple | None = None  # the system turn
        self.turns: list[tuple] = []  # role, formatted head, formatted text, tokens; from the first that history may need
        self.new, self.number = 0, 0
        self.opened = False  # whether the system turn has left ``turns``

    def feed(self, more: list[tuple[str, str]]) -> Iterator[dict]:
        for role, text in more:
            start, body = head(role), escape(text)
            turn = role, start, body, self.count(start + body + END)
            if not self.turns and not self.number and role == "system" and self.opening is None:
                self.opening = turn
            self.turns.append(turn)
        yield from self._cut(last=False)

    def finish(self) -> Iterator[dict]:
        yield from self._cut(last=True)

    def _cut(self, last: bool) -> Iterator[dict]:
        sums = np.cumsum([0] + [t[3] for t in self.turns])
        while self.new < len(self.turns):
            # The system turn is new in the first window and repeated in front of all others.
            room = self.budget - (self.opening[3] if self.opening and self.number else 0)
            begin = int(np.searchsorted(sums, sums[self.new] - self.history))
            begin = max(begin, int(np.searchsorted(sums, sums[self.new + 1] - room)), 0)
            begin = min(begin, self.new)
            end = max(int(np.searchsorted(sums, sums[begin] + room, "right")) - 1, self.new + 1)
            if end == len(self.turns) and not last:
                break
            yield self._window(begin, end)
            self.new, self.number = end, self.number + 1
        # Turns before the reach of history are done with.
        begin = min(int(np.searchsorted(sums, sums[self.new] - self.history)), self.new)
        if self.opening and self.number and not self.opened:
            # The system turn leads every window and is no part of the history.
            begin, self.opened = max(begin, 1), True
        self.turns, self.new = self.turns[begin:], self.new - begin

    def _window(self, begin: int, end: int) -> dict:
        before = [self.opening] if self.opening and self.number else []
        turns = before + self.turns[begin:end]
        repeated = len(before) + self.new - begin
        parts, starts, ends, at = [], [], [], 0
        for i, (role, start, body, _) in enumerate(turns):
            parts += [start, body, END]
            if i >= repeated and role == "assistant":
                starts.append(at + len(start))
                ends.append(at + len(start) + len(body))
            at += len(start) + len(body) + len(END)
        return {"window": self.number, "text": "".join(parts), "mask_start": starts, "mask_end": ends,
                "repeated": repeated, "tokens": sum(t[3] for t in turns)}


def _segments(batch: pd.DataFrame, key: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """Consecutive rows of equal key; a missing key is None."""
    values = [None if pd.isna(v) else v for v in batch[key].tolist()]
    cuts = [i for i in range(1, len(values)) if values[i] != values[i - 1]]
    for a, b in zip([0, *cuts], [*cuts, len(values)]):
        if b > a:
            yield values[a], batch.iloc[a:b]


def windows(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = tokens) -> DataFrame:
    """One row per window: conv_id, window, text, mask (start and end in code points), repeated, tokens.

    ``count`` gives the tokens of a formatted turn; a window has no more than ``budget`` of them.
    ``repeated`` is the number of turns that earlier windows had, system turn included.
    """
    rows = turns.select(col(conversation).alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                        F.coalesce(col(text), F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, out, size = object(), None, [], 0
        for batch in batches:
            for key, part in _segments(batch, "conv_id"):
                found = []
                if key != now:
                    if state:
                        found += [(now, w) for w in state.finish()]
                    now, state = key, Windows(budget, history, count)
                found += [(key, w) for w in state.feed(list(zip(part["role"], part["text"])))]
                out += found
                size += sum(len(w["text"]) for _, w in found)
                if size > 1 << 22:
                    yield _frame(out)
                    out, size = [], 0
        if state:
            out += [(now, w) for w in state.finish()]
        yield _frame(out)

    schema = (f"conv_id {kind}, window int, text string, mask_start array<int>, mask_end array<int>, repeated int, tokens int")
    found = rows.mapInPandas(cut, schema)
    mask = F.arrays_zip(F.col("mask_start").alias("start"), F.col("mask_end").alias("end"))
    return found.select("conv_id", "window", "text", mask.alias("mask"), "repeated", "tokens")


def _frame(found: list[tuple[object, dict]]) -> pd.DataFrame:
    names = ["window", "text", "mask_start", "mask_end", "repeated", "tokens"]
    ids = pd.Series([k for k, _ in found], dtype=object)
    return pd.DataFrame({"conv_id": ids, **{n: pd.Series([w[n] for _, w in found], dtype=object) for n in names}})


def digests(found: DataFrame) -> DataFrame:
    """What windows say when they are read back, per conversation: turns, text under the mask, and lengths."""
    kind = found.schema["conv_id"].dataType.simpleString()
    rows = found.select("conv_id", "window", "text", F.transform("mask", lambda m: m["start"]).alias("starts"),
                        F.transform("mask", lambda m: m["end"]).alias("ends"), "repeated")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, out = object(), None, []
        for batch in batches:
            for key, part in _segments(batch, "conv_id"):
                if key != now:
                    out += [state] if state else []
                    now, state = key, [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for text, starts, ends, repeated in zip(part["text"], part["starts"], part["ends"], part["repeated"]):
                    for role, said in parse(text)[repeated:]:
                        state[1] += 1
                        state[2].update(f"{role}\n{said}\n".encode())
                    for a, b in zip(starts, ends):
                        target = unescape(text[a:b])
                        state[3] += len(target)
                        state[4].update(target.encode())
                    state[5] += len(text)
        out += [state] if state else []
        done = [[x.hexdigest() if hasattr(x, "hexdigest") else x for x in s] for s in out]
        yield pd.DataFrame({n: pd.Series([d[i] for d in done], dtype=object) for i, n in enumerate(names)})

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return rows.mapInPandas(read, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                  "loss_sha256 string, formatted_chars bigint")
