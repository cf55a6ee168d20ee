"""Conversation repair against a plain forward search."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from dockmart.llm import repair
from dockmart.llm.common import prepare

TURNS = "conv_id long, turn long, role string, text string"
FULL = {"u": "user", "a": "assistant"}
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain(rows):
    """The result of ordered (turn, role, text): the least (cost, audit) to each ending, row by row."""
    seen, faults = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def better(best, end, path):
        if end not in best or path < best[end]:
            best[end] = path

    def inserted(best):
        for _ in range(3):
            for end, (cost, audit, out) in list(best.items()):
                better(best, AFTER[end], (cost + 3, audit + "I", (*out, FULL[AFTER[end]] + ":")))
        return best

    best = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        extra, then = 3 * (fault == "truncated"), {}
        for end, (cost, audit, out) in best.items():
            better(then, end, (cost + 4, audit + "D", out))
            if fault in ("", "truncated"):
                if role[:1] and end + role[:1] in ("s", "u", "su", "ua", "au"):
                    better(then, role[:1], (cost + extra, audit + "K", (*out, f"{role}:{text}")))
                better(then, AFTER[end], (cost + 3 + extra, audit + "R", (*out, f"{FULL[AFTER[end]]}:{text}")))
        best = inserted(then)
    cost, audit, out = min(best[end] for end in best if end in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out.setdefault(conv, []).extend([(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1))
    for v in out.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def check(spark, rows, chunk_rows, parts=8):
    prepare(spark)
    table = spark.createDataFrame(rows, TURNS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = repair.repair(repair.damage(table), "copies", chunk_rows).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {conv: plain(v) for conv, v in damaged(rows).items()}
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want


def random_rows(seed, convs, roles, longest):
    rng = random.Random(seed)
    texts = ["ok.", "ok", "", None, "a", "b.", "c!", "no\n", "yes. \t"]
    rows = []
    for conv in [None, *range(convs)]:
        for t in range(rng.choice([1, 2, 5, longest])):
            turn = rng.choice([None, t, t, t + 1, 3 * t])
            rows.append((conv, turn, rng.choice(roles), rng.choice([*texts, f"x{t}.", f"y{t}?", f"z{t}"])))
    return rows


@pytest.mark.parametrize("chunk_rows,parts", [(1024, 8), (1, 3), (7, 20)])
@pytest.mark.parametrize("roles", [["user", "assistant"], ["user", "assistant", "system", "tool", "", None, "ursa"]])
def test_equals_plain_search(spark, chunk_rows, parts, roles):
    check(spark, random_rows(chunk_rows, 25, roles, 60), chunk_rows, parts)


@pytest.mark.parametrize("roles", [["user"], ["tool"], ["system"], ["assistant"], ["user", "user", "user", "assistant"]])
@pytest.mark.parametrize("end", [".", ""])
def test_vectors_that_do_not_converge(spark, roles, end):
    """One long conversation in many chunks whose rows keep or swap every difference."""
    rows = [(1, t, roles[t % len(roles)], f"t{t}{end}") for t in range(400)]
    check(spark, rows, 5, parts=11)


def test_at_most_three_passes(spark):
    prepare(spark)
    for role in ("user", "tool", "system"):
        table = spark.createDataFrame([(1, t, role, f"t{t}") for t in range(300)], TURNS)
        chunks = repair.cut_chunks(repair.ordered_rows(table), 4)
        _, passes = repair.stitched(chunks.filter("open"))
        assert chunks.filter("open").count() >= 70 and passes <= 3


def test_hot_conversation_of_equal_rows(spark):
    """Most rows are one row of one turn; they are counted, not sorted."""
    rows = [(7, 1, "user", "same.")] * 3000 + [(7, 2, "assistant", "fine."), (8, 0, "user", "a."), (8, 1, "assistant", "b.")]
    prepare(spark)
    got = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, TURNS)).collect()}
    assert got[7].duplicate == 2999 and got[7].audit == "K" + "D" * 2999 + "K" and got[7].cost == 4 * 2999 and got[7].illegal == 2999
    assert got[8].audit == "KK" and got[8].repaired_sha256 == hashlib.sha256(b"user:a.\nassistant:b.").hexdigest()


def test_no_rows_left_and_empty_table(spark):
    prepare(spark)
    table = spark.createDataFrame([(1, 1, "user", "x", 0), (2, None, None, None, 1)], TURNS + ", copies long")
    table = table.withColumns({c: F.lit(1) for c in ("kind", "chunk", "n", "key", "digest")})
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(table, "copies").collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {1: (0, 0, 0, 0, 0, 0, "", nothing), 2: (0, 1, 0, 0, 0, 4, "D", nothing)}
    assert repair.repair(table.limit(0), "copies").count() == 0


def test_long_texts(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], ("word " * 60_000 if t % 3 else "short") + str(t)) for c in range(3) for t in range(8)]
    check(spark, rows, 1024)


def test_matrix_and_fixup_equal_the_plain_run():
    rng = random.Random(5)
    for _ in range(300):
        kinds = bytes(rng.choices(range(9), k=rng.randrange(0, 12)))
        after = repair.parallel([rng.randrange(0, 7) for _ in range(4)])
        after = repair.run_back(bytes(rng.choices(range(8), k=2)), after)  # as vectors behind rows are
        want = repair.run_back(kinds, after)
        assert repair.run_fixup(kinds, repair.END, after) == want
        assert repair.apply_matrix(repair.unit_runs(kinds), after) == want


def test_fixup_stops_at_parallel_vectors(monkeypatch):
    kinds = bytes([2, 4] * 500)  # user, assistant
    steps = []
    real = repair.step
    monkeypatch.setattr(repair, "step", lambda kind, after: steps.append(kind) or real(kind, after))
    start = repair.run_back(kinds, repair.END)
    steps.clear()
    assert repair.run_fixup(kinds, repair.END, (9, 9, 0, 5)) == start
    assert len(steps) < 1020  # both vectors for a few rows, then one
