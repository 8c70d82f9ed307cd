"""Cheapest edits against a search over all of them."""

import random
import re
import zlib
from functools import cache
from hashlib import sha256

import pytest

from stratica.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def slow_repair(rows):
    """(cost, audit, lines) by memoised search over (row, initials so far as their last one)."""
    fault = faults(rows)

    def legal(last, initial):
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[last]

    @cache
    def best(i, last, inserts):
        options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if i < len(rows):
            role, text = rows[i]
            cost, audit, lines = best(i + 1, last, 0)
            options.append((cost + 2, "D" + audit, lines))
            if fault[i] not in ("blank", "duplicate"):
                extra = 5 * (fault[i] == "truncated")
                if legal(last, role[:1]) and role[:1]:
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                for name in ("user", "assistant"):
                    if legal(last, name[0]):
                        cost, audit, lines = best(i + 1, name[0], 0)
                        options.append((cost + extra + 1, "R" + audit, (f"{name}:{text}", *lines)))
        if inserts < 3:
            for name in ("user", "assistant"):
                if legal(last, name[0]):
                    cost, audit, lines = best(i, name[0], inserts + 1)
                    options.append((cost + 5, "I" + audit, (f"{name}:", *lines)))
        return min(options, default=(10**9, "", ()))

    try:
        return best(0, "", 0)
    finally:
        best.cache_clear()


def slow_damage(logs):
    out = {}
    for conv, turn, role, text in logs:
        own = out.setdefault(conv, [])
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, rows in out.items()}


def slow_reports(logs):
    out = []
    for conv, rows in slow_damage(logs).items():
        said = [(role, text) for _, role, text in rows]
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [role[:1] for role, _ in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        found = faults(said)
        cost, audit, lines = slow_repair(tuple(said))
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, logs, schema=SCHEMA):
    frame = spark.createDataFrame(logs, schema)
    assert sorted(map(tuple, repair.repaired(frame).collect()), key=str) == slow_reports([r[:4] for r in logs])


def test_random_conversations(spark):
    chance = random.Random(5)
    logs = []
    for conv in range(400):
        for turn in range(chance.randrange(0, 14)):
            role = chance.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "s", "Ärger"])
            logs.append((conv, turn + chance.choice([0, 0, 0, 3]), role, chance.choice(["Yes.", "No!", "cut", "", " \n", "Why?", "Long text.", "x. "])))
    check(spark, logs)


def test_blocks_of_a_long_conversation(spark):
    chance = random.Random(6)
    logs = [(c, t, chance.choice(["user", "assistant"]), f"text {t}" + chance.choice([".", "!", "", " "])) for c, n in ((1, 230), (2, 97), (3, 1)) for t in range(n)]
    check(spark, logs)


def test_edits_are_never_dearer_than_any_other(spark):
    """Every edit sequence of short conversations, by enumeration."""
    for rows in [(("user", "a."), ("user", "b.")), (("system", "a"),), (("assistant", "a."), ("system", "b."), ("user", "c"))]:
        letters, lines, _, cost = repair.walked([(r, t, {None: 0, "blank": 1, "duplicate": 2, "truncated": 3}[f]) for (r, t), f in zip(rows, faults(rows), strict=True)], 0, list(repair.END), True)
        assert (cost, letters, tuple(lines)) == slow_repair(rows)
        assert LEGAL.fullmatch("".join(line[0] for line in lines))


def test_odd_rows(spark):
    logs = [
        (None, None, None, None, "k"), (None, None, None, None, "k"), (None, 1, "user", "Hi.", "k"), (1, None, "user", "Hi.", "k"),
        (1, None, "user", "Hi.", "k"), (2, 5, "system", "", "k"), (2, 4_000_000_000, "user", "ü中😀\x00.", "k"), (3, 1, "user", "x" * 200_000 + ".", "k"),
        (4, 0, None, "Text.", "k"), (5, -3, "user", "A.", "k"), (5, 7, "assistant", "B.", "k"),
    ]
    logs += [(100 + i, 0, "user", "Q.", "k") for i in range(60)]  # some lose their only row
    check(spark, logs, SCHEMA + ", block string")
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ["conversations"])
def test_whole_table(spark, folder, name):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)
