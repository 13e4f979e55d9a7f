"""Conversation repair against an exhaustive search."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelmart.llm.role_repair import _Node, linked, repair, repair_damaged, ways

SCHEMA = "conv_id long, turn long, role string, text string, seg long, at string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def least_repair(kinds: str) -> tuple[int, str]:
    """(cost, audit) by trying every edit everywhere, with at most two insertions in one place."""

    @cache
    def rest(k: int, done: str, inserted: int):
        found = []
        if k == len(kinds) and (done == "" or done == "a"):
            found.append((0, ""))
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[done]
        if inserted < 2:
            found += [(c + 5, "I" + a) for x in nexts if x in "ua" for c, a in rest(k, x, inserted + 1)]
        if k < len(kinds):
            kind = kinds[k]
            found += [(c + 2, "D" + a) for c, a in rest(k + 1, done, 0)]
            if kind != "D":
                more = 5 * kind.isupper()
                if kind.lower() in nexts:
                    found += [(c + more, "K" + a) for c, a in rest(k + 1, kind.lower(), 0)]
                found += [(c + more + 1, "R" + a) for x in nexts if x in "ua" for c, a in rest(k + 1, x, 0)]
        return [min(found)] if found else []

    for k in range(len(kinds), 0, -1):  # from the end, so that no call goes deep
        for done in ("", "s", "u", "a"):
            rest(k, done, 0)
    return rest(0, "", 0)[0]


@settings(max_examples=400, deadline=None)
@given(st.text("suaxSUAXD", max_size=9))
def test_least_repair(kinds):
    assert repair(kinds) == least_repair(kinds)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("suaxSUAXD", min_size=1, max_size=4), min_size=1, max_size=5))
def test_segments_give_what_the_whole_gives(parts):
    cost, path = linked([list(ways(p)) for p in parts])
    assert (cost, "".join(a for _, a in path)) == least_repair("".join(parts))


def expected(rows):
    """Per conv_id the result row, from (conv_id, turn, role, text)."""
    out = {}
    one = lambda x: " " if x is None else str(x)
    held = {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        code = zlib.crc32(f"{one(c)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        row = (turn is not None, turn or 0, "user" if code == 4 else role, text)
        held[c] += [row] * {0: 0, 3: 2}.get(code, 1)
    for c, mine in held.items():
        mine.sort()
        blank = duplicate = truncated = 0
        kinds, seen = "", set()
        for _, _, role, text in mine:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not solid:
                blank, kind = blank + 1, "D"
            elif (role, text) in seen:
                duplicate, kind = duplicate + 1, "D"
            elif solid[-1] not in ".!?":
                truncated, kind = truncated + 1, initial.upper()
            else:
                kind = initial
            seen.add((role, text))
            kinds += kind
        illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(mine, mine[1:], strict=False))
        turns = {t for known, t, *_ in mine if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = least_repair(kinds)
        lines, top, k = [], "", 0
        for letter in audit:
            other = "a" if top == "u" else "u"
            name = {"u": "user", "a": "assistant"}[other]
            if letter == "I":
                lines.append(f"{name}:")
                top = other
                continue
            role, text = mine[k][2:]
            k += 1
            if letter != "D":
                lines.append(f"{role}:{text}" if letter == "K" else f"{name}:{text}")
                top = role[0] if letter == "K" else other
        assert GRAMMAR.fullmatch("".join(x[0] for x in lines))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)
    return out


def awkward():
    rnd = random.Random(3)
    said = ["Yes.", "No!", "What?", "cut off", "", "  \t\n", None, "Fine. ", "a.b", "é.", "line\nbreak?\r\n", "x "]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "s", "agent"]
    rows = [(c, rnd.choice([None, 0, *range(12), 40]), rnd.choice(roles[:3] * 3 + roles), rnd.choice(said)) for c in [*range(40), None] for _ in range(rnd.randrange(9))]
    rows += [(100, t, ("user", "assistant")[t % 2], f"turn {t % 300}." if t % 11 else "cut") for t in range(700)]
    rows += [(101, None, "user", "same.")] * 300 + [(102, 7, "user", f"said {k}.") for k in range(200)]
    rows += [(103, 1, "assistant", "long " * 50_000 + "."), (-5, -3, "user", "below."), (-5, 9, "assistant", "nine.")]
    return [*rows, *rows[:20]]


@pytest.mark.parametrize("block", [3, 64])
def test_conversations(spark, block):
    rows = awkward()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    got = repair_damaged(df, block).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    want = expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[n] for n in names) == want[r.conv_id], r.conv_id
    assert repair_damaged(df.limit(0)).count() == 0


def test_no_rows_left(spark):
    c = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    got = repair_damaged(spark.createDataFrame([(c, 1, "user", "Hello.")], "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_a_long_stack_compares_from_where_it_parts():
    cost, path = linked([list(ways("UX"))] * 20_000)
    assert cost == 40_000 * 2 and {a for _, a in path} == {"DD"}
    assert _Node.__slots__
