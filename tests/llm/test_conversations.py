"""Conversation repair against all edits tried out, and against a plain pass over whole conversations."""

import hashlib
import itertools
import random
import re
from functools import lru_cache

from tidemark.llm import conversations as c

ROWS = "audit string, conv_id long, turn long, role string, text string, copies int"
LEGAL = re.compile(r"(s?(ua)+)?")


@lru_cache(None)
def every_edit(rows, most_inserts=3):
    """(cost, audit) by trying every edit of every row with up to so many insertions between rows."""
    best = None
    gaps = [g for k in range(most_inserts + 1) for g in itertools.product("ua", repeat=k)]

    def after(n, cost, audit, roles):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for inserted in gaps if n <= len(rows) else ():
            now = (cost + 2 * len(inserted), audit + "I" * len(inserted), roles + "".join(inserted))
            if not re.fullmatch(r"s?(ua)*u?", now[2]):
                continue
            if n == len(rows):
                if LEGAL.fullmatch(now[2]) and (best is None or now[:2] < best):
                    best = now[:2]
                continue
            initial, fault = rows[n]
            after(n + 1, now[0] + 3, now[1] + "D", now[2])
            if fault not in "bd":
                late = fault == "t"
                after(n + 1, now[0] + late, now[1] + "K", now[2] + initial)
                for role in "ua":
                    after(n + 1, now[0] + late + 2, now[1] + "R", now[2] + role)

    after(0, 0, "", "")
    return best


def letters(rows):
    return "".join(i + f for i, f in rows)


def test_parse_equals_every_edit():
    rng = random.Random(1)
    kinds = [i + f for i in "sua?" for f in "bdt."]
    cases = [[]] + [[k] for k in kinds] + [list(p) for p in itertools.product(kinds, repeat=2)]
    cases += [[rng.choice(kinds) for _ in range(rng.choice((3, 4)))] for _ in range(120)]
    for rows in cases:
        rows = tuple((k[0], k[1]) for k in rows)
        assert c.cheapest(c.parse(letters(rows), 0)) == every_edit(rows), rows


def test_blocks_joined_equal_one_parse():
    rng = random.Random(2)
    for _ in range(200):
        rows = [(rng.choice("sua?"), rng.choice("bdt...")) for _ in range(rng.randrange(1, 40))]
        stacks, at = {0: (0, "")}, 0
        while at < len(rows):
            end = at + rng.randrange(1, 9)
            stacks = c.joined(stacks, {top: c.parse(letters(rows[at:end]), top) for top in c.tops()})
            at = end
        assert c.cheapest(stacks) == c.cheapest(c.parse(letters(rows), 0))


def plain(rows):
    """All results of the operator for rows of one conversation (turn, role, text), by whole lists."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, kinds = set(), []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        kinds.append("b" if not solid else "d" if (role, text) in seen else "." if solid[-1] in ".!?" else "t")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit = c.cheapest(c.parse.__wrapped__(letters([(i if i in ("s", "u", "a") else "?", k) for i, k in zip(initials, kinds, strict=True)]), 0))
    out, at = [], 0
    for edit in audit:
        turn = "user" if not out or out[-1][0][:1] != "u" else "assistant"
        if edit == "I":
            out.append((turn, "", edit))
            continue
        if edit in "KR":
            out.append((rows[at][1] if edit == "K" else turn, rows[at][2], edit))
        at += 1
    assert at == len(rows) and LEGAL.fullmatch("".join(r[:1] for r, _, _ in out))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit), out


def sample():
    rng = random.Random(5)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User"], ["One.", "Two", "Why?", " \n", "", None, "Go! \t", "é\x0b."]
    rows = [(n % 90, rng.randrange(6), rng.choice(roles[: 2 + n % 6]), rng.choice(texts)) for n in range(600)]
    rows += [(None, 1, "user", "One."), (None, 2, "assistant", "Two."), (None, None, "user", None)]
    rows += [(200, None, "user", "a."), (200, None, "user", "a."), (200, 3, "user", "a."), (200, 3, "assistant", "b")]
    # Conversations of several blocks and tasks: one of alternating turns, one of equal rows, one at a single turn.
    rows += [(500, t, rng.choice(("user", "assistant", "assistant", "tool")), f"{t % 3000}{rng.choice('.,')}") for t in range(9000)]
    rows += [(501, 7, "user", "same.")] * 5000 + [(501, 8, "assistant", "")] * 4500
    rows += [(502, None, rng.choice(("user", "assistant")), f"{n}.") for n in range(300)]
    return rows


def test_operator_equals_whole_conversations(spark):
    rows = sample()
    table = spark.createDataFrame([("x", *r, 1) for r in rows], ROWS).repartition(6)
    found = c.plans(table)
    by_id = {}
    for i, *rest in rows:
        by_id.setdefault(i, []).append(tuple(rest))
    expected = {i: plain(r) for i, r in by_id.items()}
    got = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    assert got == {i: e[0] for i, e in expected.items()}
    turns = {}
    for r in sorted(c.repaired(table, found).collect(), key=lambda r: r.place):
        assert r.place == len(turns.setdefault(r.conv_id, []))
        turns[r.conv_id].append((r.role, r.text, r.edit))
    assert turns == {i: e[1] for i, e in expected.items() if e[1]}
    digests = {r.conv_id: r.repaired_sha256 for r in c.digests(table, found).collect()}
    texts = {i: "\n".join(f"{r}:{x}" for r, x, _ in e[1]) for i, e in expected.items()}
    assert digests == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}
    empty = table.limit(0)
    assert c.plans(empty).collect() == [] and c.repaired(empty, c.plans(empty)).collect() == []
