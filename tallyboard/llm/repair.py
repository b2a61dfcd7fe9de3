"""Conversation structure repair with a persistent audit.

The rows of a conversation, in order, are kept, given another role, or deleted, and turns
without text are inserted, so that the roles become nothing or an optional system turn
followed by pairs of a user and an assistant turn. Of all cheapest ways the one whose audit
(initials of the edits, in order) is least in ASCII order is taken.

The dynamic program has four states (nothing yet, after the system, a user, an assistant
turn) and keeps the best audit of each. Audits share their prefixes: an audit is a node
linked to the node before it, with its ancestors 1, 2, 4, ... edits back and a rolling hash
of the whole. Ways of equal cost are compared by the longest common prefix, found by
descending over ancestors with unequal hashes; where hashes agree but nodes differ, the
edits themselves are compared. What a row does to the four audits depends on its kind alone
(initial of the role, fault), so the heads after the first kinds of a conversation are
remembered and shared by all conversations of a task that begin alike.

Defined results: null role or text is one space; null turns come first, and rows that tie
stand by role, then text; repeated rows are faulty after the first; rows without a
conversation id are one conversation; other columns play no part, whatever their names; an
empty table gives an empty result. Texts are taken whole. The result of a conversation is
one row, so a conversation is repaired in one task, which holds it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyboard.llm.common import col

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired turns end with
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
# State after a turn of a role, by the state before it; other turns are not allowed there.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {"u": "user", "a": "assistant"}
BASE, PRIME = 257, (1 << 61) - 1
REMEMBERED = 1 << 16  # heads that a task remembers
REMEMBERED_DEPTH = 64


class Audit:
    """An edit after another audit; ``up[k]`` is the audit 2^k edits shorter."""

    __slots__ = ("edit", "size", "hash", "up")

    def __init__(self, edit: str, before: Audit | None):
        self.edit = edit
        if before is None:
            self.size, self.hash, self.up = 0, 0, ()
            return
        self.size = before.size + 1
        self.hash = (before.hash * BASE + ord(edit)) % PRIME
        up, node, k = [before], before, 0
        while k < len(node.up):
            node = node.up[k]
            up.append(node)
            k += 1
        self.up = tuple(up)

    def back(self, steps: int) -> Audit:
        node = self
        while steps:
            k = steps.bit_length() - 1
            node, steps = node.up[k], steps - (1 << k)
        return node

    def __str__(self) -> str:
        edits, node = [], self
        while node.up:
            edits.append(node.edit)
            node = node.up[0]
        return "".join(reversed(edits))


EMPTY = Audit("", None)


def _same(a: Audit, b: Audit) -> bool:
    """Whether two audits of one size are equal: by hash, and where that agrees by their edits."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.edit != b.edit:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Audit, b: Audit) -> bool:
    """Whether audit ``a`` comes before ``b``."""
    size = min(a.size, b.size)
    x, y = a.back(a.size - size), b.back(b.size - size)
    if _same(x, y):
        return a.size < b.size
    # The shortest unequal prefixes: descend as long as ancestors are unequal.
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and not _same(x.up[k], y.up[k]):
            x, y = x.up[k], y.up[k]
    return x.edit < y.edit


Head = tuple[int, Audit]


def _better(now: Head | None, cost: int, before: Audit, edit: str) -> Head:
    """The cheaper of a head and a way that adds an edit; of equally cheap ones the lesser audit."""
    if now is not None and now[0] < cost:
        return now
    audit = Audit(edit, before)
    return (cost, audit) if now is None or cost < now[0] or less(audit, now[1]) else now


def _inserted(heads: list[Head | None]) -> tuple[Head | None, ...]:
    """Heads after insertions, cheapest sources first, so that each source is final."""
    todo = {s for s in range(4) if heads[s] is not None}
    while todo:
        s = min(todo, key=lambda s: heads[s][0])
        todo.remove(s)
        cost, audit = heads[s]
        to = ASSISTANT if s == USER else USER
        better = _better(heads[to], cost + INSERT, audit, "I")
        if better is not heads[to]:
            heads[to] = better
            todo.add(to)
    return tuple(heads)


BEGIN = _inserted([(0, EMPTY), None, None, None])
Kind = tuple[str, str]  # initial of the role; fault


def step(heads: Sequence[Head | None], kind: Kind) -> tuple[Head | None, ...]:
    """Heads after one more row."""
    initial, fault = kind
    new: list[Head | None] = [None] * 4
    for s, head in enumerate(heads):
        if head is None:
            continue
        cost, audit = head
        new[s] = _better(new[s], cost + DELETE, audit, "D")
        if fault in ("blank", "duplicate"):
            continue
        extra = TRUNCATED if fault == "truncated" else 0
        kept = NEXT.get(initial, {}).get(s)
        if kept is not None:
            new[kept] = _better(new[kept], cost + KEEP + extra, audit, "K")
        to = ASSISTANT if s == USER else USER
        new[to] = _better(new[to], cost + REROLE + extra, audit, "R")
    return _inserted(new)


class Repairer:
    """Cheapest audits of conversations; heads after equal first kinds are worked out once."""

    def __init__(self):
        self.after: dict[tuple[int, Kind], tuple[int, tuple]] = {}
        self.places = 0

    def audit(self, kinds: Sequence[Kind]) -> tuple[int, str]:
        heads, place = BEGIN, 0
        for i, kind in enumerate(kinds):
            if i >= REMEMBERED_DEPTH:
                heads = step(heads, kind)
                continue
            known = self.after.get((place, kind))
            if known is None:
                if len(self.after) >= REMEMBERED:
                    self.after.clear()  # places are not used again
                self.places += 1
                known = self.after[place, kind] = self.places, step(heads, kind)
            place, heads = known
        best = heads[START]
        other = heads[ASSISTANT]
        if best is None or other is not None and (other[0] < best[0] or other[0] == best[0] and less(other[1], best[1])):
            best = other
        return best[0], str(best[1])


def repaired(rows: Sequence[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """Role and text of the turns that an audit leaves of rows."""
    out, state, left = [], START, iter(rows)
    for edit in audit:
        new = "a" if state == USER else "u"
        if edit == "I":
            out.append((NAMES[new], ""))
        else:
            role, text = next(left)
            if edit == "D":
                continue
            new = role[:1] if edit == "K" else new
            out.append((role if edit == "K" else NAMES[new], text))
        state = NEXT[new][state]
    return out


def faults(rows: Sequence[tuple[str, str]]) -> list[str]:
    """First fault of every row: blank, duplicate, truncated, or none."""
    seen: set[tuple[str, str]] = set()
    found = []
    for row in rows:
        said = row[1].rstrip(BLANKS)
        found.append("blank" if not said else "duplicate" if row in seen else "truncated" if said[-1] not in STOPS else "")
        seen.add(row)
    return found


def report(turns: Sequence[int | None], rows: Sequence[tuple[str, str]], repairer: Repairer) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit, and the repaired turns of a conversation."""
    numbers = {t for t in turns if t is not None}
    found = faults(rows)
    initials = [role[:1] for role, _ in rows]
    cost, audit = repairer.audit(list(zip(initials, found)))
    return (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(pair not in LEGAL for pair in zip(initials, initials[1:])), cost, audit, repaired(rows, audit))


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, counts of faults, cost, audit, and ``repaired``, its turns (role, text) in order."""
    rows = turns.select(col(conversation).alias("conv_id"), col(turn).cast("bigint").alias("turn"), F.coalesce(col(role), F.lit(" ")).alias("role"),
                        F.coalesce(col(text), F.lit(" ")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list, list]]:
        now, numbers, held, any_row = None, [], [], False
        for batch in batches:
            for c, n, r, t in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text"))):
                if c != now or not any_row:
                    if any_row:
                        yield now, numbers, held
                    now, numbers, held, any_row = c, [], [], True
                numbers.append(n)
                held.append((r, t))
        if any_row:
            yield now, numbers, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer()
        out, size = [], 0
        for c, numbers, held in whole(batches):
            out.append((c, *report(numbers, held, repairer)))
            size += sum(len(t) for _, t in held)
            if size > 1 << 22 or len(out) >= 1 << 13:
                yield frame(out)
                out, size = [], 0
        if out:
            yield frame(out)

    schema = f"conv_id {kind}, {', '.join(f'{n} bigint' for n in _COUNTS)}, audit string, repaired array<struct<role: string, text: string>>"
    turn_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def frame(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out))
        arrays = [pa.array(columns[0]), *[pa.array(c, pa.int64()) for c in columns[1:7]], pa.array(columns[7], pa.string()),
                  pa.array([[{"role": r, "text": t} for r, t in turns] for turns in columns[8]], turn_type)]
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", *_COUNTS, "audit", "repaired"])

    return rows.mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults dealt out by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 gives it the role of a user. Nulls are one space first.
    """
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    rows = turns.select("conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"),
                        (F.crc32(key.cast("binary")) % 20).alias("damage")).where("damage <> 0")
    text = F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def digests(found: DataFrame, conversations: DataFrame) -> DataFrame:
    """Counts, cost, audit, and a digest of the repaired turns, for each of ``conversations`` (conv_id); without rows zeros."""
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    light = found.select(F.col("conv_id").alias("found_id"), *_COUNTS, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    every = conversations.select("conv_id").distinct()
    return every.join(light, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in _COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
