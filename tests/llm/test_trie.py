"""Tries against a plain dictionary of prefixes, and the query against SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyboard.llm import trie


def plain(conversations):
    """(conv_id, depth, parent, members, children, leaves, saved, ends) of every prefix, from {id: [(role, text)]}."""
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(conversations):
        said = tuple(conversations[c])
        for d in range(len(said) + 1):
            members[said[:d]].add(c)
        ends[said].append(str(c))
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(ends[p]).encode()).hexdigest()) for p, m in members.items())


def found(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def random_conversations(r, n):
    pool = [("user", "hi"), ("assistant", "ho é"), ("user", ""), ("system", "hi")]
    out = {}
    for c in r.sample(range(5 * n), n):
        near = r.choice([None, *out]) if out else None
        out[c] = [*(out[near][:r.randrange(12)] if near is not None else []), *r.choices(pool, k=r.choice([0, 0, 1, 2, 9]))]
    return out


def as_rows(conversations):
    return [(c, i, role, text) for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("shard, turns", [(1024, 1 << 16), (3, 1 << 16), (1, 5), (50, 7)])
def test_trie_equals_plain_prefixes(make, shard, turns):
    """Also with shards of few conversations, and conversations longer than a shard."""
    r = random.Random(shard)
    conversations = {c: t for c, t in random_conversations(r, 120).items() if t}
    light = trie.turn_digests(make(as_rows(conversations), SCHEMA).repartition(5))
    assert found(trie.trie(light, shard, turns)) == plain(conversations)


def test_deep_and_hot_subtrees(make):
    deep = [("user", f"t{i}") for i in range(70)]
    conversations = {c: deep[:c % 71] + [("user", f"own {c}")] * (c % 3 == 0) for c in range(1, 300)}
    conversations.update({c: deep[:40] for c in range(300, 600)})
    conversations = {c: t for c, t in conversations.items() if t}
    light = trie.turn_digests(make(as_rows(conversations), SCHEMA).repartition(5))
    assert found(trie.trie(light, 64)) == plain(conversations)


def rebuilt(conversations):
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conversations.get(c - c % 5, [])[:h] + own[h:]
    return out


def test_shared_openings(make):
    r = random.Random(8)
    conversations = {c: t for c, t in random_conversations(r, 200).items() if t}
    light = trie.shared_openings(trie.turn_digests(make(as_rows(conversations), SCHEMA).repartition(3)))
    assert found(trie.trie(light, 16)) == plain(rebuilt(conversations))


def test_edge_rows(make):
    schema = "conv_id bigint, turn bigint, role string, text string, node string, depth string"
    long = [(9, i, "user", "x", None, "m") for i in range(3000)]
    rows = [(1, 0, None, None, "n", "m"), (1, None, "", "first", "n", "m"), (2, 0, "user", "same", "n", "m"), (2, 0, "user", "same", "n", "m"),
            (None, 0, "user", "nobody", "n", "m"), (3, 1, "user", "w " * 90_000, "n", "m"), (4, 0, "user", "same", None, None), *long]
    want = {1: [("", "first"), ("", "")], 2: [("user", "same")] * 2, 3: [("user", "w " * 90_000)], 4: [("user", "same")], 9: [("user", "x")] * 3000}
    light = trie.turn_digests(make(rows, schema).repartition(4))
    got = found(trie.trie(light, 2, 1000))
    assert len(got) == 1 + 2 + 2 + 1 + 3000
    short = [r for r in got if r[1] <= 2]
    assert short == [r for r in plain({c: t[:40] for c, t in want.items()}) if r[1] <= 2]
    assert trie.trie(trie.turn_digests(make([], schema))).count() == 0
    assert trie.trie(trie.shared_openings(trie.turn_digests(make([], schema)))).count() == 0


def test_roles_and_texts_are_told_apart(make):
    conversations = {1: [("us", "er")], 2: [("use", "r")], 3: [("", "user")]}
    assert found(trie.trie(trie.turn_digests(make(as_rows(conversations), SCHEMA)))) == plain(conversations)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(equals_sql, sf):
    equals_sql("op13_trie", f"/root/testdata/{sf}")
