"""Windows against a plain cutter, and texts read back."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tallyboard.llm import bytepairs, chat, queries

SF = "/root/testdata/sf0.01"
NASTY = ["", "\\", "\\\\", "###", "####", "#" * 9, "</turn>", "</turn>\n", "</turn", "<", "\\</turn>", "\\#", "#\\##", "<\\/turn>",
         "\n### user: x</turn>\n", r"\### Assistant: </turn> ok", ": ", "é🙂", "a: b"]


@pytest.mark.parametrize("text", NASTY + [a + b for a in NASTY for b in NASTY])
def test_escape_is_reversible_and_hides_marks(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and "</turn>" not in out and "##" not in out
    whole = "".join(f"{chat.head(r)}{chat.escape(t)}{chat.END}" for r, t in [("user", text), (text, "x"), (text, text)])
    assert chat.parse(whole) == [("user", text), (text, "x"), (text, text)]


def plain_windows(turns, budget, history, count=chat.tokens):
    """Turn by turn, without prefix sums."""
    cost = [count(f"{chat.head(r)}{chat.escape(t)}{chat.END}") for r, t in turns]
    out, i = [], 0
    while i < len(turns):
        system = i > 0 and turns[0][0] == "system"
        room = budget - (cost[0] if system else 0)
        lowest = 1 if system else 0
        h = i
        while h > lowest and sum(cost[h - 1:i]) <= history and sum(cost[h - 1:i + 1]) <= room:
            h -= 1
        j = i + 1
        while j < len(turns) and sum(cost[h:j + 1]) <= room:
            j += 1
        out.append((([0] if system else []) + list(range(h, j)), i, j))
        i = j
    return out


def random_conversation(r, n):
    return [("system" if i == 0 and r.random() < 0.5 else r.choice(["user", "assistant", "assistant", "", "system"]),
             "".join(r.choices(["word ", "#", "</turn>", "\\", "é"], k=r.choice([0, 3, 20, 90])))) for i in range(n)]


@pytest.mark.parametrize("piece", [1, 3, 1000])
def test_windows_equal_plain_cutting(piece):
    r = random.Random(piece)
    for _ in range(150):
        turns = random_conversation(r, r.randrange(1, 40))
        budget, history = r.choice([(60, 20), (200, 50), (200, 0), (10, 5), (1000, 1000)])
        state, got = chat.Windows(budget, history, chat.tokens), []
        for a in range(0, len(turns), piece):
            got += state.feed(turns[a:a + piece])
            assert len(state.turns) <= 3 * budget + piece + 3
        got += state.finish()
        want = plain_windows(turns, budget, history)
        assert [chat.parse(w["text"]) for w in got] == [[turns[i] for i in order] for order, _, _ in want]
        assert [w["repeated"] for w in got] == [len(order) - (j - i) for order, i, j in want]
        targets = [chat.unescape(w["text"][a:b]) for w in got for a, b in zip(w["mask_start"], w["mask_end"])]
        assert targets == [t for role, t in turns if role == "assistant"]
        for w, (order, i, j) in zip(got, want):
            assert w["tokens"] <= budget or j - i == 1


def digest(turns, count=chat.tokens):
    loss = "".join(t for r, t in turns if r == "assistant")
    formatted = sum(len("".join(f"{chat.head(turns[k][0])}{chat.escape(turns[k][1])}{chat.END}" for k in order))
                    for order, _, _ in plain_windows(turns, chat.BUDGET, chat.HISTORY, count))
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), formatted)


def test_query_on_all_conversations(spark):
    turns = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r[0]: tuple(r)[1:] for r in queries.op7_chat(spark, SF).collect()}
    # Turns are counted by another implementation of the vocabulary.
    ranks = bytepairs.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == {i: digest(t, lambda s: len(library.encode_ordinary(s))) for i, t in turns.items()}


def test_windows_hold_their_budget_in_real_tokens(spark):
    ranks = bytepairs.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    found = chat.windows(turns, budget=300, history=60, count=chat.BytePairCount(ranks, public_tokenizers.PATTERN)).collect()
    assert len({r.conv_id for r in found}) < len(found)
    for r in found:
        n = sum(len(library.encode_ordinary(t + chat.END)) for t in r.text.split(chat.END)[:-1])
        assert r.tokens == n and (n <= 300 or len(chat.parse(r.text)) - r.repeated == 1)


def test_edge_rows(spark, make):
    schema = "conv_id bigint, turn bigint, role string, text string, window string, mask string"
    long = [(9, i, "assistant" if i % 2 else "user", f"turn {i} " * 50, None, "m") for i in range(3000)]
    rows = [(1, 0, "user", None, "x", "m"), (1, 1, None, "b", "x", "m"), (None, 0, "assistant", "n", "x", "m"),
            (2, 0, "assistant", "same", "x", "m"), (2, 0, "assistant", "same", "x", "m"), (3, None, "user", "w " * 20_000, "x", "m"), *long]
    found = chat.windows(make(rows, schema).repartition(5))
    got = {r[0]: tuple(r)[1:] for r in chat.digests(found).collect()}
    assert got[1][:2] == (2, hashlib.sha256(b"user\n\n\nb\n").hexdigest()) and got[None][0] == 1 and got[2][2] == 8
    assert got[3] == digest([("user", "w " * 20_000)])
    assert got[9] == digest([(r[2], r[3]) for r in long])
    assert chat.digests(chat.windows(make([], schema))).count() == 0
