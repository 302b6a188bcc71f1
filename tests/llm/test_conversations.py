import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from foliorank.llm import conversations, turn_edits

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(symbols):
    """Plain recursion over the grammar's states: (cost, ASCII-least audit)."""

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == len(symbols) and state in ("", "a") else [(10**9, "~")]
        after = NEXT[state]

        def add(price, edit, rest):
            found.append((price + rest[0], edit + rest[1]))

        if inserted < 3:
            add(5, "I", best(i, after, inserted + 1))
        if i < len(symbols):
            add(2, "D", best(i + 1, state, 0))
            symbol = symbols[i]
            if symbol != "-":
                more = 5 if symbol.isupper() else 0
                if symbol.lower() == "s" and state == "":
                    add(more, "K", best(i + 1, "s", 0))
                same = symbol.lower() == after
                add(more + (not same), "K" if same else "R", best(i + 1, after, 0))
        return min(found)

    return best(0, "", 0)


def brute(rows):
    """Every conversation's result by the contract, one row after the other."""
    by_id = {}
    for conversation, turn, role, text in rows:
        by_id.setdefault(conversation, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conversation, own in by_id.items():
        kept = []
        for turn, role, text in own:
            key = f"{' ' if conversation is None else conversation}:{' ' if turn is None else turn}"
            code = zlib.crc32(key.encode()) % 20
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            role = "user" if code == 4 else role
            kept += [(turn, role, text)] * (2 if code == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, symbols, seen = [0, 0, 0], "", set()
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not bare or (role, text) in seen:
                faults[0 if not bare else 1] += 1
                symbol = "-"
            elif bare[-1] not in ".!?":
                faults[2] += 1
                symbol = symbol.upper()
            seen.add((role, text))
            symbols += symbol
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        cost, audit = cheapest(symbols)
        repaired, _ = turn_edits.apply_audit(audit, [(r, t) for _, r, t in kept])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conversation, gaps, *faults, illegal, cost, audit, digest))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df):
    found = conversations.repair(conversations.damage(df), copies="copies")
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str)


def corpus(seed=5):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t\n", None, "é!", "What?  \n", "again.", "a. b", "x" * 50_000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "agent"]
    rows = []
    for conversation in [*range(150), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"][turn % 2 :: 2] * 4 + roles)
            own = rng.choice([None, turn, turn, turn, turn + 3, 2])
            rows.append((conversation, own, role, rng.choice(texts + ["Fine text %d." % turn] * 6)))
    rows += rows[::17] + [rows[5]] * 40
    return rows


def test_equals_the_contract_row_by_row(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", copies int, audit string").repartition(5)
    assert repaired(df) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("rows_a_segment", [1, 3, 7])
def test_long_conversations_are_cut_without_a_change(spark, rows_a_segment):
    rng = random.Random(rows_a_segment)
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "No", "Well %d." % t, ""]))
        for c in range(4)
        for t in range(90)
    ]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    whole = conversations.SEGMENT
    try:
        conversations.SEGMENT = rows_a_segment
        assert repaired(spark.createDataFrame(rows, SCHEMA).repartition(3)) == sorted(brute(rows), key=str)
    finally:
        conversations.SEGMENT = whole
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_nothing_and_dropped(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]


def test_every_length_and_state():
    rng = random.Random(9)
    for _ in range(3000):
        symbols = "".join(rng.choice("suaxSUAX-uauasuA") for _ in range(rng.randint(0, 9)))
        assert turn_edits.whole_audit(symbols) == cheapest(symbols)
