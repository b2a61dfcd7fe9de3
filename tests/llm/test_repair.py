"""Repairs against a search over all edits, and the query against SQL."""

import hashlib
import random
import re
from itertools import product

import pytest

from tallyboard.llm import queries, repair

GOOD = re.compile(r"(s?(ua)+)?")
KINDS = [(i, f) for i in ("s", "u", "a", "t", "") for f in ("", "truncated", "duplicate", "blank")]


def plain(kinds):
    """Least (cost, audit) of all ways to write a legal sequence of roles over the rows, state by state, as text."""
    heads = {"": (0, "")}  # roles so far, shortened to what the pattern needs to know
    shorten = lambda roles: roles if len(roles) < 3 else ("s" if roles[0] == "s" else "") + ("ua" if roles[-1] == "a" else "uau")

    def viable(roles):
        return any(GOOD.fullmatch(roles + rest) for rest in ("", "a", "ua", "uaua"))

    def offer(to, roles, cost, audit):
        if not viable(roles):
            return False
        roles = shorten(roles)
        if roles in to and to[roles] <= (cost, audit):
            return False
        to[roles] = cost, audit
        return True

    def insert(heads):
        changed = True
        while changed:
            changed = False
            for roles, (cost, audit) in list(heads.items()):
                for new in "ua":
                    changed |= offer(heads, roles + new, cost + 3, audit + "I")
        return heads

    heads = insert(heads)
    for initial, fault in kinds:
        new = {}
        for roles, (cost, audit) in heads.items():
            offer(new, roles, cost + 4, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if initial in ("s", "u", "a"):
                offer(new, roles + initial, cost + more, audit + "K")
            for role in "ua":
                offer(new, roles + role, cost + 3 + more, audit + "R")
        heads = insert(new)
    return min(h for roles, h in heads.items() if GOOD.fullmatch(roles))


def all_ways(kinds, most):
    """Least (cost, audit) over every audit of at most ``most`` edits."""
    best = None
    for size in range(most + 1):
        for audit in product("DIKR", repeat=size):
            if sum(e != "I" for e in audit) != len(kinds):
                continue
            for chosen in product("ua", repeat=sum(e in "IR" for e in audit)):
                rows, roles, cost, pick = iter(kinds), "", 0, iter(chosen)
                for e in audit:
                    if e == "I":
                        roles, cost = roles + next(pick), cost + 3
                        continue
                    initial, fault = next(rows)
                    if e == "D":
                        cost += 4
                        continue
                    if fault in ("blank", "duplicate"):
                        break
                    cost += (3 if e == "R" else 0) + (3 if fault == "truncated" else 0)
                    roles += next(pick) if e == "R" else initial or "-"
                else:
                    if GOOD.fullmatch(roles) and (best is None or (cost, "".join(audit)) < best):
                        best = cost, "".join(audit)
    return best


def test_short_conversations_against_all_edits():
    r = random.Random(1)
    repairer = repair.Repairer()
    for n in range(4):
        for kinds in (r.choices(KINDS, k=n) for _ in range(25)):
            want = all_ways(kinds, n + 3)
            assert repairer.audit(kinds) == want == plain(kinds), kinds


@pytest.mark.parametrize("remembered", [repair.REMEMBERED, 7])
def test_long_conversations_against_text_audits(monkeypatch, remembered):
    monkeypatch.setattr(repair, "REMEMBERED", remembered)
    r = random.Random(2)
    repairer = repair.Repairer()
    for _ in range(400):
        kinds = r.choices(KINDS[:12], weights=[1, 1, 1, 1, 8, 3, 1, 1, 8, 3, 1, 1], k=r.randrange(150))
        assert repairer.audit(kinds) == plain(kinds)


@pytest.mark.parametrize("prime", [repair.PRIME, 2, 3])
def test_order_of_audits_survives_hash_collisions(monkeypatch, prime):
    """With hashes modulo 2 or 3 most unequal audits collide."""
    monkeypatch.setattr(repair, "PRIME", prime)
    r = random.Random(3)
    nodes = [repair.EMPTY]
    for _ in range(300):
        nodes.append(repair.Audit(r.choice("DIKR"), r.choice(nodes[-20:])))
    for a in r.sample(nodes, 100):
        for b in r.sample(nodes, 40):
            if str(a) != str(b) or a is b:
                assert repair.less(a, b) == (str(a) < str(b))


def test_collisions_do_not_change_repairs(monkeypatch):
    monkeypatch.setattr(repair, "PRIME", 2)
    test_long_conversations_against_text_audits(monkeypatch, 50)


def test_faults_and_repaired_turns():
    rows = [("user", "a."), ("user", "a."), ("user", " \t"), ("assistant", "no stop"), ("assistant", "yes! \n")]
    assert repair.faults(rows) == ["", "duplicate", "blank", "truncated", ""]
    assert repair.repaired(rows, "KDDDK") == [("user", "a."), ("assistant", "yes! \n")]
    assert repair.repaired([("system", "s."), ("tool", "x.")], "KRI") == [("system", "s."), ("user", "x."), ("assistant", "")]


def test_edge_rows(spark, make):
    schema = "conv_id bigint, turn bigint, role string, text string, audit string"
    long = [(9, i, ("user", "assistant")[i % 2], f"turn {i}.", None) for i in range(5000)]
    rows = [(1, None, None, None, "x"), (1, 5, "user", "hm. ", "x"), (1, 9, "assistant", "so.", "x"), (None, 0, "user", "w " * 90_000 + ".", "x"),
            (2, 3, "user", "same", "x"), (2, 3, "user", "same", "x"), (3, None, "user", "", "x"), *long]
    got = {r.conv_id: r for r in repair.repair(make(rows, schema).repartition(4)).collect()}
    assert tuple(got[1])[1:8] == (3, 1, 0, 0, 1, 4, "DKK")
    assert got[None].audit == "KI" and got[None].repaired[0].text == "w " * 90_000 + "."
    assert tuple(got[2])[1:8] == (0, 0, 1, 1, 1, 8, "DD") and got[2].repaired == []
    assert tuple(got[3])[1:8] == (0, 1, 0, 0, 0, 4, "D")
    assert got[9].cost == 0 and got[9].audit == "K" * 5000 and len(got[9].repaired) == 5000
    assert repair.repair(make([], schema)).count() == 0
    gone = repair.digests(repair.repair(make([], schema)), make(rows, schema))
    assert {tuple(r)[1:] for r in gone.collect()} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and gone.count() == 5


def test_a_very_long_conversation(spark, make):
    """Faults all along; the audit is that of the plain program."""
    r = random.Random(4)
    rows = [(1, i, r.choice(["user", "assistant", "assistant", "system"]), f"{i}" + r.choice([".", "!", ""])) for i in range(20_000)]
    found = repair.repair(make(rows, "conv_id bigint, turn bigint, role string, text string")).first()
    kinds = list(zip([t[2][0] for t in rows], repair.faults([(t[2], t[3]) for t in rows])))
    heads = repair.BEGIN
    for k in kinds:
        heads = repair.step(heads, k)
    assert found.cost == min(heads[0][0], heads[3][0])
    assert GOOD.fullmatch("".join(t.role[0] for t in found.repaired))


def test_damage(spark, make):
    rows = [(c, t, "assistant", "a. b! c? d") for c in range(30) for t in range(10)]
    got = {}
    for x in repair.damaged(make(rows, "conv_id bigint, turn bigint, role string, text string")).collect():
        got.setdefault((x.conv_id, x.turn), []).append((x.role, x.text))
    import zlib
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        want = {0: None, 1: [(role, "")], 2: [(role, "a b c d")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
        assert got.get((c, t)) == want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(equals_sql, sf):
    equals_sql("op11_repair", f"/root/testdata/{sf}")
