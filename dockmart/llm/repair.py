"""Repair of conversation structure by rank-convergence parallel Viterbi.

A conversation is to have the role initials ``(s?(ua)+)?``. Edits: Keep a row (0), Rerole it to user or assistant (3), Delete it
(4; blank and duplicate rows must go), Insert an empty-text user or assistant row (3); a truncated row that stays adds 3. The
cheapest edits are a shortest path through four states (nothing, system, user, assistant) by rows, and the audit is the least
string of edit initials among the cheapest paths.

**Rank-convergence.** Costs run backwards: a vector holds, for each state, the cost of finishing from there. Ordered rows
are cut into chunks. Each chunk starts from a speculative vector, the one behind a conversation's last row. Stitching goes
from the last chunk to the first: where the vector that arrives is not one that the chunk has started from, it is run again
from this one (the fix-up), and stops as soon as its vector differs from that of the speculative run by a constant only,
because from there on both runs agree. Chunks where vectors never become parallel (a row that each state must delete keeps
every difference) are run from the four unit vectors, which answers any vector; so no conversation needs more than three
passes, however many chunks it has. Rows that must be deleted change no difference and need no step.

**Tracing.** With the stitched vector behind it, a chunk is traced forwards from each state; the chunks' (entry, exit) states
are chained, and each chunk writes its edits and repaired rows from its true entry. Where a state allows several edits of
least cost, the one with the smallest initial is taken; it determines the next state, so the audit determines the repair.

Scale: equal rows of a turn are counted before the shuffle, rows are dealt by ranges of (conversation, turn, role, text), so
a conversation that holds a third of all rows is spread over many tasks and chunks of at most ``CHUNK`` rows or ``CHUNK_BYTES``.
A conversation that lies within one task is finished there. For the others only vectors and states are stitched in one
stream for each conversation, one row a chunk; texts meet in order only for the digest, which streams. Repeated texts are
found by joining the keys that stand in several turns, which is small, or else a join that adaptive handling splits.
An audit is one string, so it needs a byte for each row of its conversation.

Edge cases: rows are ordered by (turn, role, text), null turns first; equal rows follow each other. A null role or text is one
space; a null conv_id is a conversation. A role whose initial is not s, u or a, or an empty one, cannot be kept. Rows with
``copies`` 0 count for nothing, but their conversation is reported. No rows: zeros, an empty audit, the digest of nothing.
Very long texts are whole. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmart.llm.common import staged

CHUNK = 1024
CHUNK_BYTES = 1 << 20

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state after an inserted or reroled row; its role follows from the state before.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
#: Kinds of rows: initial (s, u, a, other), and whether it is truncated; FORCED rows must be deleted.
FORCED = 8
_FAR = 1 << 40

Vector = tuple[int, int, int, int]
#: Costs behind the last row: what is missing to an end is inserted.
END: Vector = (0, 2 * INSERT, INSERT, 0)


def kind_of(initial: str, truncated: bool) -> int:
    return ("sua".find(initial) if initial else -1) % 4 * 2 + truncated


def _kept(kind: int, state: int) -> int | None:
    """The state after keeping a row, if it may be kept."""
    initial = kind // 2
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    if initial == 2:
        return ASSISTANT if state == USER else None
    return None


def _choices(kind: int, after: Vector, state: int) -> list[tuple[int, str, int]]:
    """(cost to the end, edit, next state) of the edits of a row."""
    out = [(DELETE + after[state], "D", state)]
    if kind != FORCED:
        extra = TRUNCATED * (kind % 2)
        kept = _kept(kind, state)
        if kept is not None:
            out.append((KEEP + extra + after[kept], "K", kept))
        out.append((REROLE + extra + after[NEXT[state]], "R", NEXT[state]))
    return out


@lru_cache(maxsize=1 << 16)
def _before(kind: int, after: Vector) -> Vector:
    """The costs before a row, inserted rows included."""
    plain = [min(_choices(kind, after, s))[0] for s in STATES]
    return tuple(min(plain[s], INSERT + plain[NEXT[s]], 2 * INSERT + plain[NEXT[NEXT[s]]]) for s in STATES)


@lru_cache(maxsize=1 << 16)
def step(kind: int, after: Vector) -> Vector:
    """The costs before a row, less their minimum."""
    return parallel(_before(kind, after))


def parallel(v) -> Vector:
    """The vector that stands for all that differ from it by a constant."""
    low = min(v)
    return tuple(int(x - low) for x in v)


@lru_cache(maxsize=1 << 16)
def edits(kind: int, after: Vector, state: int) -> tuple[str, int, int]:
    """(edits, state after the row, cost) of the least audit from ``state`` up to and with a row."""
    before, done, cost = _before(kind, after), "", 0
    while True:
        options = [(e, n, c - after[n]) for c, e, n in _choices(kind, after, state) if c == before[state]]
        if INSERT + before[NEXT[state]] == before[state]:
            options.append(("I", NEXT[state], INSERT))
        edit, state, paid = min(options)
        done, cost = done + edit, cost + paid
        if edit != "I":
            return done, state, cost


def run_back(kinds: bytes, after: Vector) -> Vector:
    """The vector before a chunk's rows."""
    for kind in reversed(kinds):
        if kind != FORCED:
            after = step(kind, after)
    return after


def run_fixup(kinds: bytes, speculative: Vector, after: Vector) -> Vector:
    """As ``run_back``, stopped where the run has become parallel to the speculative one."""
    for i in range(len(kinds) - 1, -1, -1):
        if after == speculative:
            return run_back(kinds[: i + 1], speculative)
        if kinds[i] != FORCED:
            speculative, after = step(kinds[i], speculative), step(kinds[i], after)
    return after


def unit_runs(kinds: bytes) -> list[int]:
    """The chunk as a matrix: row t holds the costs before it if the end must be reached in state t."""
    out = []
    for t in STATES:
        v, paid = tuple(0 if s == t else _FAR for s in STATES), 0
        for kind in reversed(kinds):
            if kind != FORCED:
                v = _before(kind, v)
                paid, v = paid + min(v), parallel(v)
                v = tuple(min(x, _FAR) for x in v)
        out += [x + paid for x in v]
    return out


def apply_matrix(matrix, after: Vector) -> Vector:
    return parallel([min(matrix[4 * t + s] + after[t] for t in STATES) for s in STATES])


def vectors_after(kinds: bytes, after: Vector) -> list[Vector]:
    """The vector behind each row of a chunk."""
    out = [after] * len(kinds)
    for i in range(len(kinds) - 1, -1, -1):
        out[i] = after
        if kinds[i] != FORCED:
            after = step(kinds[i], after)
    return out


class Chunk:
    """Consecutive rows of a conversation, equal rows of a turn as one with their count."""

    def __init__(self):
        self.kinds = bytearray()
        self.counts: list[int] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.bytes = 0
        self.first = self.last = self.turn_a = self.turn_b = None

    def add(self, turn, role: str, text: str, n: int, repeated: bool) -> None:
        if not n:
            return
        words = text.strip(" \t\n\x0b\x0c\r")
        initial = role[:1]
        truncated = not repeated and bool(words) and words[-1] not in ".!?"
        self.blank += 0 if words else n
        self.duplicate += 0 if not words else n if repeated else n - 1
        self.truncated += truncated
        self.illegal += n - 1 + (self.last is not None and self.last + initial not in LEGAL)
        if self.first is None:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.turns += turn != self.turn_b
            self.turn_a = turn if self.turn_a is None else self.turn_a
            self.turn_b = turn
        self.kinds.append(kind_of(initial, truncated) if words and not repeated else FORCED)
        self.counts.append(n)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(role) + len(text)

    def full(self, rows: int) -> bool:
        return len(self.kinds) >= rows or self.bytes >= CHUNK_BYTES


def trace(kinds: bytes, counts, after: Vector, state: int) -> Iterator[tuple[int, str, int, int]]:
    """(row, edits, state before, cost) of a chunk's least audit; a row's further copies are deleted."""
    for i, v in enumerate(vectors_after(kinds, after)):
        done, then, cost = edits(kinds[i], v, state)
        yield i, done + "D" * (counts[i] - 1), state, cost + DELETE * (counts[i] - 1)
        state = then


def repaired(kinds: bytes, counts, roles, texts, after: Vector, state: int, last: bool) -> tuple[str, int, list[str]]:
    """(audit, cost, repaired rows) of a chunk; behind the last one the missing rows are inserted."""
    audit, cost, rows = [], 0, []
    for i, done, state, paid in trace(kinds, counts, after, state):
        audit.append(done)
        cost += paid
        for edit in done[: len(done) - counts[i] + 1]:
            if edit == "I":
                state = NEXT[state]
                rows.append(f"{ROLE[state]}:")
            elif edit == "R":
                state = NEXT[state]
                rows.append(f"{ROLE[state]}:{texts[i]}")
            elif edit == "K":
                state = _kept(kinds[i], state)
                rows.append(f"{roles[i]}:{texts[i]}")
    while last and state not in (START, ASSISTANT):
        state = NEXT[state]
        audit.append("I")
        cost += INSERT
        rows.append(f"{ROLE[state]}:")
    return "".join(audit), cost, rows


def exits(kinds: bytes, after: Vector) -> list[int]:
    """The state behind a chunk for each state before it."""
    behind, states = vectors_after(kinds, after), list(STATES)
    for i, kind in enumerate(kinds):
        if kind != FORCED:
            states = [edits(kind, behind[i], s)[1] for s in states]
    return states


def _gaps(first, last, turns: int) -> int:
    return 0 if first is None else min(last - first + 1 - turns, (1 << 63) - 1)


_ROW = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_CHUNK = _ROW + (
    ", open boolean, chunk long, first string, last string, turn_a long, turn_b long, turns long, kinds binary, counts binary,"
    " roles array<string>, texts array<string>, ins array<long>, outs array<long>"
)


def _arrow(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[t]) for n, t in fields], [n for n, _ in fields])


def ordered_rows(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, turn, role, text, n, repeated): equal rows of a turn counted; ``repeated``: an earlier turn has role and text."""
    spaces = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    n = F.lit(1).cast("long") if copies is None else F.col(copies).cast("long")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *spaces, n.alias("n"))
    gone = F.col("n") == 0
    blank = [F.when(gone, None).otherwise(F.col(c)).alias(c) for c in ("turn", "role", "text")]
    rows = staged(rows.select("conv_id", *blank, "n").groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")), "turns")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keys = rows.filter("n > 0").select("conv_id", digest.alias("digest"), "turn").groupBy("conv_id", "digest")
    keys = keys.agg(F.min(F.struct("turn")).alias("earliest"), F.count("*").alias("places")).filter("places > 1")
    keys = keys.select(F.col("conv_id").alias("key_conv"), F.col("digest").alias("key"), F.col("earliest.turn").alias("first_turn"))
    found = rows.withColumn("digest", digest).join(keys, F.expr("conv_id <=> key_conv and digest = key"), "left")
    repeated = F.expr("key is not null and not (turn <=> first_turn)")
    return found.select("conv_id", "turn", "role", "text", "n", repeated.alias("repeated"))


def _open(conv, part: Chunk, key: int) -> dict:
    """A chunk of a conversation that other chunks may belong to, run from the speculative vector."""
    found = {"conv_id": conv, "open": True, "chunk": key, "ins": list(END), "outs": list(run_back(bytes(part.kinds), END))}
    found |= {k: getattr(part, k) for k in ("blank", "duplicate", "truncated", "illegal", "first", "last", "turn_a", "turn_b", "turns", "roles", "texts")}
    return found | {"kinds": bytes(part.kinds), "counts": np.array(part.counts, np.int64).tobytes()}


def _whole(conv, part: Chunk) -> dict:
    """The repair of a conversation that is one chunk."""
    audit, cost, rows = repaired(bytes(part.kinds), part.counts, part.roles, part.texts, END, START, True)
    found = {"conv_id": conv, "open": False, "gaps": _gaps(part.turn_a, part.turn_b, part.turns), "cost": cost, "audit": audit}
    found |= {k: getattr(part, k) for k in ("blank", "duplicate", "truncated", "illegal")}
    return found | {"repaired_sha256": hashlib.sha256("\n".join(rows).encode()).hexdigest()}


def _records(rows: Iterator[tuple], key: int, chunk_rows: int) -> Iterator[dict]:
    """The chunks of one task's rows; its first and last conversation may go on in another task, so they are open."""
    conv, part, pieces, seen = None, None, 0, 0
    for row in rows:
        if part is None or row[0] != conv:
            if part is not None:
                yield _open(conv, part, key) if pieces or seen == 1 else _whole(conv, part)
                key += 1
            conv, part, pieces, seen = row[0], Chunk(), 0, seen + 1
        elif part.full(chunk_rows):
            yield _open(conv, part, key)
            key, part, pieces = key + 1, Chunk(), pieces + 1
        part.add(*row[1:])
    if part is not None:
        yield _open(conv, part, key)


def cut_chunks(rows: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """The chunks of ``ordered_rows``; a conversation that lies within one task and chunk is repaired at once, others are open."""
    order = ["conv_id", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(6))))
        yield from _batched(_records(rows, TaskContext.get().partitionId() << 32, chunk_rows), _CHUNK)

    return staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _CHUNK), "chunks")


def _batched(records: Iterator[dict], schema: str) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in records:
        held.append(r)
        size += 64 + len(r.get("audit") or "") + len(r.get("blob") or b"") + sum(map(len, r.get("texts") or ()))
        if len(held) >= 1000 or size >= 4 << 20:
            yield _arrow(held, schema)
            held, size = [], 0
    if held:
        yield _arrow(held, schema)


def _stream(df: DataFrame, fn, schema: str, descending: bool = False) -> DataFrame:
    """``fn`` over the rows (dicts) of each conversation's chunks in their order, in one stream a task."""
    order = F.col("chunk").desc() if descending else F.col("chunk").asc()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(fn(r for b in batches for r in b.to_pylist()), schema)

    return df.repartition("conv_id").sortWithinPartitions("conv_id", order).mapInArrow(run, schema)


def _each(df: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched((fn(r) for b in batches for r in b.to_pylist()), schema)

    return df.mapInArrow(run, schema)


_RUNS = "conv_id long, chunk long, ins array<long>, outs array<long>, matrix array<long>"
_NEEDS = _RUNS + ", need array<long>, last boolean, miss boolean"


def _stitch(rows: Iterator[dict]) -> Iterator[dict]:
    """From the last chunk of a conversation to its first: the vector that arrives behind each, and whether it is answered."""
    conv, after, begun = None, END, False
    for r in rows:
        last = not begun or r["conv_id"] != conv
        if last:
            conv, after, begun = r["conv_id"], END, True
        known = {tuple(r["ins"][i : i + 4]): tuple(r["outs"][i : i + 4]) for i in range(0, len(r["ins"]), 4)}
        miss = after not in known and r["matrix"] is None
        yield r | {"need": list(after), "last": last, "miss": miss}
        if after in known:
            after = known[after]
        else:  # without an answer the speculative one is passed on
            after = tuple(r["outs"][:4]) if miss else apply_matrix(r["matrix"], after)


def stitched(chunks: DataFrame) -> tuple[DataFrame, int]:
    """The vector behind each open chunk, (conv_id, chunk, need, last), and the passes that it took."""
    spark = chunks.sparkSession
    kinds = chunks.select("chunk", "kinds")
    runs = chunks.select("conv_id", "chunk", "ins", "outs", F.lit(None).cast("array<long>").alias("matrix"))
    needs = staged(_stream(runs, _stitch, _NEEDS, descending=True), "stitch")
    passes = 1

    def fixup(r: dict) -> dict:
        if not r["miss"]:
            return r
        need = tuple(r["need"])
        return r | {"ins": r["ins"] + r["need"], "outs": r["outs"] + list(run_fixup(r["kinds"], tuple(r["ins"][:4]), need))}

    def units(r: dict) -> dict:
        return r | {"matrix": unit_runs(r["kinds"])}

    for again in (fixup, units):
        if needs.filter("miss").isEmpty():
            break
        open_convs = needs.filter("miss").select("conv_id").distinct()
        rows = needs.join(kinds, "chunk") if again is fixup else needs.join(open_convs, needs.conv_id.eqNullSafe(open_convs.conv_id), "left_semi").join(kinds, "chunk")
        done = needs.join(open_convs, needs.conv_id.eqNullSafe(open_convs.conv_id), "left_anti") if again is units else spark.createDataFrame([], needs.schema)
        ran = _each(rows, again, _RUNS)
        needs = staged(_stream(staged(ran, "runs"), _stitch, _NEEDS, descending=True).unionByName(done), "stitch")
        passes += 1
    return needs.select("conv_id", "chunk", "need", "last"), passes


def _chain(rows: Iterator[dict]) -> Iterator[dict]:
    """The state in which each chunk is entered."""
    conv, state, begun = None, START, False
    for r in rows:
        if not begun or r["conv_id"] != conv:
            conv, state, begun = r["conv_id"], START, True
        yield r | {"entry": state}
        state = r["exits"][state]


_PART = "conv_id long, chunk long, blank long, duplicate long, truncated long, illegal long, first string, last string, turn_a long, turn_b long, turns long, cost long, audit string, blob binary, rows long"


def _write(r: dict) -> dict:
    counts = np.frombuffer(r["counts"], np.int64).tolist()
    audit, cost, rows = repaired(r["kinds"], counts, r["roles"], r["texts"], tuple(r["need"]), r["entry"], r["final"])
    return r | {"audit": audit, "cost": cost, "blob": "\n".join(rows).encode(), "rows": len(rows)}


def _join_parts(rows: Iterator[dict]) -> Iterator[dict]:
    """One row a conversation from its parts in order; texts stream through the digest."""
    held, digest, audits, written = None, None, [], 0

    def finished() -> dict:
        return held | {"gaps": _gaps(held["turn_a"], held["turn_b"], held["turns"]), "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

    for r in rows:
        if held is None or r["conv_id"] != held["conv_id"]:
            if held is not None:
                yield finished()
            held, digest, audits, written = {k: v for k, v in r.items() if k not in ("audit", "blob")}, hashlib.sha256(), [], 0
        else:
            for k in ("blank", "duplicate", "truncated", "cost"):
                held[k] += r[k]
            if r["first"] is not None:
                held["illegal"] += r["illegal"] + (held["last"] is not None and held["last"] + r["first"] not in LEGAL)
                held["last"] = r["last"]
            if r["turn_a"] is not None:
                held["turns"] += r["turns"] - (held["turn_b"] == r["turn_a"])
                held["turn_a"] = r["turn_a"] if held["turn_a"] is None else held["turn_a"]
                held["turn_b"] = r["turn_b"]
        audits.append(r["audit"])
        if r["rows"]:
            digest.update((b"\n" if written else b"") + r["blob"])
            written += r["rows"]
    if held is not None:
        yield finished()


def repair(turns: DataFrame, copies: str | None = None, chunk_rows: int = CHUNK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``turns``: (conv_id, turn, role, text); ``copies`` names a column that says how often a row stands.
    """
    chunks = cut_chunks(ordered_rows(turns, copies), chunk_rows)
    columns = [x.split()[0] for x in _ROW.split(", ")]
    opened = chunks.filter("open")
    needs, _ = stitched(opened)
    traced = opened.select("chunk", "kinds").join(needs, "chunk")
    mapped = _each(traced, lambda r: r | {"exits": exits(r["kinds"], tuple(r["need"]))}, "conv_id long, chunk long, need array<long>, last boolean, exits array<long>")
    entered = _stream(mapped, _chain, "chunk long, need array<long>, last boolean, entry int")
    entered = entered.withColumnRenamed("last", "final")
    parts = _each(opened.join(entered, "chunk"), _write, _PART)
    joined = _stream(staged(parts, "parts"), _join_parts, _ROW)
    return chunks.filter("not open").select(columns).unionByName(joined)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by crc32(``conv_id:turn``) modulo 20.

    0 drops the row (``copies`` 0), 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it,
    4 makes it a user's. Nulls are one space, in the key too; null turns stay null in the order.
    """

    def spaced(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(fault == 4, "user").otherwise(spaced("role"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))
