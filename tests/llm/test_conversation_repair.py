"""Conversation repair against plain Python: a table of suffixes, and all audits of short ones."""

import hashlib
import itertools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm.audit_prefixes import Prefixes
from gridloom.llm.conversation_repair import damage_and_repair, damaged, repair, repaired_turns
from gridloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, n int, block string"
WHITE = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        told = ["" + (" " if v is None else str(v)) for v in (conv, turn, role, text)]
        fate = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        role, text = told[2], told[3]
        if fate == 1:
            text = ""
        if fate == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def options(state, row, fault):
    """Edits of one row in ASCII order: letter, cost, next state, line."""
    yield "D", 3, state, None
    if fault in ("blank", "duplicate"):
        return
    extra, role = (fault == "truncated"), row[2]
    if (state, role[:1]) in NEXT:
        yield "K", extra, NEXT[state, role[:1]], f"{role}:{row[3]}"
    want = "assistant" if state == "u" else "user"
    yield "R", 2 + extra, want[0], f"{want}:{row[3]}"


def least(rows):
    """Cheapest audit, least by ASCII, from the costs of all suffixes; and its lines."""
    fault = faults(rows)
    n, far = len(rows), 10**9
    cost = [dict.fromkeys(["", "s", "u", "a"], far) for _ in range(n + 1)]
    cost[n].update({"": 0, "a": 0, "u": 2, "s": 4})
    for i in reversed(range(n)):
        plain = {q: min(c + cost[i + 1][to] for _, c, to, _ in options(q, rows[i], fault[i])) for q in cost[i]}
        for q in plain:  # insertions ahead of the row
            one = "a" if q == "u" else "u"
            two = "a" if one == "u" else "u"
            cost[i][q] = min(plain[q], 2 + plain[one], 4 + plain[two])
    i, q, audit, lines = 0, "", "", []
    while i < n or q in "su" and q:
        moves = [(e, c, i + 1, to, line) for e, c, to, line in (options(q, rows[i], fault[i]) if i < n else ())]
        want = "assistant" if q == "u" else "user"
        moves.append(("I", 2, i, want[0], f"{want}:"))
        best = [m for m in sorted(moves) if m[1] + cost[m[2]][m[3]] == cost[i][q]]
        edit, _, i, q, line = best[0]
        audit += edit
        lines += [line] if line is not None else []
    return cost[0][""], audit, lines


def report(conv, rows):
    if not rows:
        return (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    fault, roles = faults(rows), [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(roles))
    cost, audit, lines = least(rows)
    counts = [fault.count(f) for f in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_conversation(rows):
    return {k: list(g) for k, g in itertools.groupby(in_order(rows), key=lambda r: r[0])}


def odd_rows(seed, n=60, turns=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "Well? ", "", " \t", "a.b", "É.", None, "x" * 500 + "."]
    rows = [
        (rng.choice([k, k, k, None]) if k % 7 == 0 else k, rng.choice([t, t, t, 3, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"Text {k} {t}.")
        for k in range(n)
        for roles in [["user", "assistant"] if k % 2 else ["system", "user", "assistant", "user", "assistant", "tool", "", None]]
        for t in range(rng.randrange(1, turns))
    ]
    return rows + rows[:20]


def plain_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_least_holds_all_audits_of_short_conversations():
    rng = random.Random(2)
    for _ in range(60):
        rows = [(0, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["A.", "B", "", "C!"])) for t in range(3)]
        fault, found = faults(rows), []
        for n in range(0, 8):
            for audit in itertools.product("DIKR", repeat=n):
                if sum(e != "I" for e in audit) != 3:
                    continue
                i, q, cost = 0, "", 0
                for e in audit:
                    if e == "I":
                        q, cost = ("a" if q == "u" else "u"), cost + 2
                        continue
                    move = [m for m in options(q, rows[i], fault[i]) if m[0] == e]
                    if not move:
                        break
                    q, cost, i = move[0][2], cost + move[0][1], i + 1
                else:
                    if q in ("", "a"):
                        found.append((cost, "".join(audit)))
        assert min(found) == least(rows)[:2]


@pytest.mark.parametrize("blocks", [(4096, 1 << 24), (3, 1 << 24), (5, 40), (4096, 1)])
def test_rows_against_brute_force(spark, blocks):
    rows = odd_rows(blocks[0])
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    told = [(c, t, r or "", x or "") for c, t, r, x in rows]
    want = sorted((report(c, r) for c, r in by_conversation(told).items()), key=repr)
    assert plain_rows(repair(df, *blocks)) == want
    turns = repaired_turns(df, *blocks).orderBy("block", "nth").collect()
    for c, r in by_conversation(told).items():
        assert [f"{x.role}:{x.text}" for x in turns if x.conv_id == c] == least(r)[2]


def test_damage_and_whole_query_on_odd_rows(spark):
    rows = odd_rows(9)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert plain_rows(damaged(df)) == sorted(damage(rows), key=repr)
    left = by_conversation(damage(rows))
    want = sorted((report(c, left.get(c, [])) for c in {r[0] for r in rows}), key=repr)
    assert plain_rows(damage_and_repair(df)) == want
    assert damage_and_repair(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = by_conversation(damage(rows))
    want = sorted((report(c, left.get(c, [])) for c in {r[0] for r in rows}), key=repr)
    assert plain_rows(QUERIES["op13_conversation_repair"](spark, sf)) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from("DIKR")), max_size=40), st.sampled_from([(1_000_003, (1 << 61) - 1), (1, 2), (3, 5)]))
def test_strings_compare_as_they_read(steps, hashing):
    """Also where nearly all hashes collide."""
    strings, text = Prefixes(*hashing), [""]
    for parent, letter in steps:
        parent %= len(text)
        strings.add(parent, letter)
        text.append(text[parent] + letter)
    for x, y in itertools.product(range(0, len(text), 3), range(len(text))):
        assert strings.less(x, y) == (text[x] < text[y])
        assert "".join(strings.pieces(x)) == text[x]


def test_long_ties_are_found_by_halving():
    strings = Prefixes()
    a = b = 0
    for _ in range(3000):
        a, b = strings.add(a, "K"), strings.add(b, "K")
    x, y = strings.add(a, "D"), strings.add(b, "K")
    assert strings.less(x, y) and not strings.less(y, x)
    assert strings.split(a, b) is None
