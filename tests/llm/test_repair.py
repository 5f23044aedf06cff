"""Conversation repair against a plain search over all strings of edits, piece by piece and whole."""

import hashlib
import random
import re
import zlib

import pytest

from starmart.llm import repair
from starmart.llm.common import prepare

COLUMNS = "conv_id long, turn long, role string, text string, piece int, costs string, digest string"
WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of one conversation after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(WHITE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    # for each sequence state so far: the least (cost, edits), and what is written
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    ways = {"": (0, "", ())}

    def better(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def inserted(ways):
        for _ in range(2):
            more = dict(ways)
            for state, (cost, edits, lines) in ways.items():
                due = "a" if state == "u" else "u"
                better(more, due, (cost + 5, edits + "I", (*lines, ("assistant:" if due == "a" else "user:"))))
            ways = more
        return ways

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, edits, lines) in inserted(ways).items():
            better(after, state, (cost + 2, edits + "D", lines))
            if fault in ("b", "d"):
                continue
            more, due = (5 if fault == "t" else 0), "a" if state == "u" else "u"
            if role and role[0] in legal[state]:
                better(after, role[0], (cost + more, edits + "K", (*lines, f"{role}:{text}")))
            better(after, due, (cost + more + 1, edits + "R", (*lines, f"{'assistant' if due == 'a' else 'user'}:{text}")))
        ways = after
    cost, audit, lines = min((w for s, w in inserted(ways).items() if s in ("", "a")), key=lambda w: w[:2])
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def some_rows(seed, convs, longest):
    pick = random.Random(seed)
    rows = []
    for conv in range(convs):
        turn = pick.randint(0, 3)
        for i in range(pick.randint(1, longest)):
            turn += pick.choice([0, 1, 1, 1, 1, 1, 2, 5])
            role = pick.choice(["user", "assistant"] * 4 + ["system", "tool", "", "u", None]) if pick.random() < 0.4 else ["user", "assistant"][i % 2]
            rows.append((conv, None if pick.random() < 0.03 else turn, role,
                         pick.choice(["Yes.", "No!", "so what", "  ", "", None, "a b?\n", f"line {i}.", f"line {i}", "é ."])))
    return rows


def table(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, 7, "x", "y") for r in rows], COLUMNS)


def answers(rows, convs):
    damaged = plain_damage(rows)
    return {c: plain([r for r in damaged if r[0] == c]) for c in convs}


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed,size", [(1, 128), (2, 3), (3, 1)])
def test_against_plain_search(spark, seed, size):
    rows = some_rows(seed, 60, 14)
    out = repair.report(table(spark, rows), size)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(out) == answers(rows, range(60))


def test_one_long_conversation_over_many_tasks(spark):
    rows = [(5, t, r, x) for _, t, r, x in some_rows(4, 150, 14)] + [(6, 1, "user", "hi.")]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(repair.report(table(spark, rows), 16)) == answers(rows, (5, 6))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_tables(spark):
    rows = [(None, None, None, None), (None, 3, "user", "x."), (1, 1, "user", "y" * 300_000 + "."), (1, 2, "assistant", "Fine."),
            (2, None, "user", "a."), (2, None, "user", "a."), (2, None, "assistant", "b."), (3, 9, "system", "only.")]
    assert got(repair.report(table(spark, rows))) == answers(rows, (None, 1, 2, 3))
    assert repair.report(table(spark, [])).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"4:{t}".encode()) % 20 == 0)
    assert got(repair.report(table(spark, [(4, gone, "user", "x.")]))) == {4: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_search_is_exact_on_its_own():
    """A user row that is cut off costs 5 to keep: it goes, and the answer to it becomes the question."""
    rows = [("u", repair.TRUNCATED), ("a", 0), ("a", 0)]
    assert repair.search(rows, 0, 3) == (3, "DRK")
    assert repair.search([("u", repair.BLANK)], 0, 0) == (2, "D")
    assert repair.search([("u", repair.BLANK)], 0, 1) is None
