"""Conversation repair against an exhaustive search and against its SQL."""

import hashlib
import random
import re
from functools import cache
from types import SimpleNamespace

import numpy as np
import pytest

from surestar.llm import repair
from surestar.llm.queries import QUERIES, SQL
from tests.oracle import compare

SCHEMA = "conv_id long, turn long, role string, text string"
END_OK = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """Cost, audit and repaired lines of one conversation, rows in order: the least (cost, audit) of all ways to edit."""
    seen, facts = set(), []
    for role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        duplicate = not blank and (role, text) in seen
        seen.add((role, text))
        cut = not blank and not duplicate and not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text)
        facts.append((role, text, blank, duplicate, cut))

    def plain(i, state):
        """Ways that start with the next row, or end."""
        if i == len(facts):
            return [(0, "", ())] if state in "-a" else []
        role, text, blank, duplicate, cut = facts[i]
        c, a, t = best(i + 1, state)
        out = [(c + 2, "D" + a, t)]
        if not blank and not duplicate:
            for letter, cost, new in [("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")]:
                if new and new[0] in follows[state] and (letter == "K" or new != role):
                    c, a, t = best(i + 1, new[0])
                    out.append((c + cost + 5 * cut, letter + a, (f"{new}:{text}", *t)))
        return out

    @cache
    def best(i, state):
        options = plain(i, state)
        for n in (1, 2):  # more than two inserted turns in a row are never cheaper
            now, lines = state, []
            for _ in range(n):
                now = "u" if "u" in follows[now] else "a"
                lines.append("user:" if now == "u" else "assistant:")
            options += [(c + 5 * n, "I" * n + a, (*lines, *t)) for c, a, t in plain(i, now)]
        return min(options, key=lambda x: x[:2])

    follows = {"-": "su", "s": "u", "u": "a", "a": "u"}
    cost, audit, lines = best(0, "-")
    return facts, cost, audit, lines


def expected(rows):
    """The result's row for (turn, role, text) rows of one conversation."""
    def order(r):
        return (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest())

    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    facts, cost, audit, lines = brute([(r, x) for _, r, x in rows])
    assert END_OK.fullmatch("".join(x[:1] for x in lines))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:]))
    counts = [sum(f[k] for f in facts) for k in (2, 3, 4)]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def some_rows(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "ok", "", " \t", None, "Stop!", "a.b", "end.\n"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "uncle"]
    return [(rng.choice([None, *range(max(2, n))]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_like_an_exhaustive_search(spark):
    talks = {i: some_rows(i, i % 9) for i in range(160)}
    talks[2**60 + 1] = some_rows(7, 6)
    talks[None] = some_rows(8, 7)
    rows = [(conv, *row) for conv, talk in talks.items() for row in talk]
    got = found(repair.repair(spark.createDataFrame(rows, SCHEMA)))
    assert got == {conv: expected(talk) for conv, talk in talks.items() if talk}


def test_one_conversation_over_many_ranges(spark):
    talks = {5: some_rows(1, 4), 6: [(i, *r[1:]) for i, r in enumerate(some_rows(2, 600))], 7: some_rows(3, 5)}
    talks[8] = [(i, "user", f"cut {i}") for i in range(400)]  # nothing tells one state from another for long
    talks[9] = [(3, "user", "the same.")] * 300 + [(None, "assistant", "the same.")] * 2
    rows = [(conv, *row) for conv, talk in talks.items() for row in talk]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    import sys

    sys.setrecursionlimit(20_000)
    assert got == {conv: expected(talk) for conv, talk in talks.items()}


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_pieces_give_the_costs_of_one_run(piece):
    rng = np.random.default_rng(piece)
    n = 500
    rows = repair.Rows(rng.integers(0, 4, n), rng.random(n) < 0.8, np.where(rng.random(n) < 0.4, 5, 0), rng.integers(0, 3, n))
    segment = np.sort(rng.integers(0, 6, n))
    segment = np.cumsum(np.append(False, segment[1:] != segment[:-1]))
    ends = np.tile(repair.END, (segment[-1] + 1, 1))
    before, behind, passes = repair.backward_costs(rows, segment, ends, piece)
    whole, after, once = repair.backward_costs(rows, segment, ends, n)
    assert once == 1 and (passes > 1 or piece == 64)
    assert repair.parallel(before, whole).all() and repair.parallel(behind, after).all()
    assert (repair.audit_steps(rows, before, behind) == repair.audit_steps(rows, whole, after)).all()


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "x" * 2_000_000 + ".")], SCHEMA)
    got = found(repair.repair(rows.selectExpr("*", "1 AS n", "'x' AS digest", "2 AS steps", "3 AS kind")))
    assert got == {1: expected([(0, "user", "Hi."), (1, "assistant", "x" * 2_000_000 + ".")])}


def test_damage(spark):
    from zlib import crc32

    rows = [(c, t, "assistant", "One. Two!") for c in (1, 2, None) for t in [*range(60), None]] + [(1, 3, None, None)]
    got = sorted(map(str, repair.damage(spark.createDataFrame(rows, SCHEMA)).collect()))
    wanted = []
    for c, t, role, text in rows:
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = "user" if kind == 4 else role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        wanted += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(f"Row(conv_id={c!r}, turn={t!r}, role={r!r}, text={x!r})" for c, t, r, x in wanted)


def test_query_like_its_sql(spark, folder):
    name = "op11_repair"
    assert compare(spark, folder, SimpleNamespace(run=QUERIES[name], sql=SQL[name])) == []
