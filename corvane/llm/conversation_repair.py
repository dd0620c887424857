"""Conversation structure repair by a rank-compressed dynamic program.

A conversation's turns are layers; the states of a layer are what the roles kept so far end in. An edit of a layer is a
macro: a run of inserted turns and what becomes of the turn itself (Delete, Keep, Rerole). Written as initials, macros
are prefix-free codes, so audits of equally many layers compare as their macros do. A state of a layer therefore holds
no audit, only its least cost, its rank among the audits of the layer, and a pointer to parent and macro; audits are
read back from the pointers afterwards. Inserts before a deleted turn needn't be tried: behind it they cost as much and
come first in ASCII. A run of deletions of equal rows is one layer.

Turns are sorted by range, so a conversation of any length is cut into chunks of bounded size wherever partitions end.
A chunk that doesn't begin its conversation is solved for all four states it may be entered in; its costs and ranks,
4 x 4 numbers, are all that is folded along the conversation. Then every chunk knows its states and is read back by
itself. Equal rows are counted before they are shuffled. The last step streams a conversation's chunks in order through
one task, since SHA-256 of a text and the audit are one value; it holds the audit and one batch.

Defined cases: rows of null conv_id are one conversation; turns are in order of turn (null first), ties in order of role
and text; a role without an initial can't be kept; empty tables give none; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: What the roles kept so far end in: nothing, system, user, assistant. A conversation ends in nothing or assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS, NEVER = 4, (NOTHING, ASSISTANT), 1 << 60
#: Ordered prefix-free codes of the macros: inserts, then what becomes of the turn.
CODES = sorted(["D", *("I" * k + e for k in range(3) for e in "KR")])
#: Rows and characters of a chunk.
ROWS, CHARS = 4096, 4 << 20
COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 2, 3, 2, 1

CHUNK = "conv_id long, chunk long, first boolean, roles array<string>, texts array<string>, copies array<long>, pointers array<binary>, costs array<long>, ranks array<int>, blank long, duplicate long, truncated long, illegal long, initials string, turns array<long>"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: rows after the damage that the checksum of conversation and turn decides."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies and the first fault of the first copy; copies of a row follow it as duplicates."""
    each = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    seen = each.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("s"))
    a, b = each.alias("a"), seen.alias("b")
    j = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest")))
    return j.select("a.conv_id", "a.turn", "a.role", "a.text", "a.n", fault(F.col("a.text"), ~F.col("a.turn").eqNullSafe(F.col("b.s.turn"))).alias("fault"))


def fault(text: Column, seen: Column) -> Column:
    return F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK).when(seen, DUPLICATE).when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(0)


def after(state: int) -> int:
    """The state once a turn that fits is added."""
    return ASSISTANT if state == USER else USER


@functools.cache
def moves(initial: str, truncated: bool) -> list[list[tuple[int, int, int]]]:
    """For each state after a turn, the (state before, cost, code) that lead there."""
    to: list[list[tuple[int, int, int]]] = [[] for _ in range(STATES)]
    for s in range(STATES):
        to[s].append((s, COST_DELETE, CODES.index("D")))
        at = s
        for k in range(3):
            paid = k * COST_INSERT + truncated * COST_TRUNCATED
            kept = {"s": SYSTEM if at == NOTHING else None, "u": USER if at != USER else None, "a": ASSISTANT if at == USER else None}.get(initial)
            if kept is not None:
                to[kept].append((s, paid, CODES.index("I" * k + "K")))
            to[after(at)].append((s, paid + COST_REROLE, CODES.index("I" * k + "R")))
            at = after(at)
    return to


def solve(turns: list[tuple[str, int, int]], entry: int) -> tuple[list[int], list[int], bytes]:
    """Least cost and rank of each state after the turns (initial, fault, copies), and the pointers of all layers."""
    cost, rank = [NEVER] * STATES, [0] * STATES
    cost[entry] = 0
    pointers = bytearray()
    for initial, bad, n in turns:
        gone = n - 1
        if bad in (BLANK, DUPLICATE):
            gone, best = n, None
        else:
            best = [min(((cost[s] + c, rank[s], code, s) for s, c, code in to if cost[s] < NEVER), default=(NEVER, 0, 0, 0)) for to in moves(initial, bad == TRUNCATED)]
            order = sorted(range(STATES), key=lambda t: best[t][1:3])
            cost, rank = [b[0] for b in best], [order.index(t) for t in range(STATES)]
        pointers += bytes(b[3] << 4 | b[2] for b in best) if best else bytes(t << 4 for t in range(STATES))
        cost = [c + COST_DELETE * gone if c < NEVER else c for c in cost]
    return cost, rank, bytes(pointers)


def tail(state: int) -> int:
    """Turns inserted at the end."""
    return {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]


def read_back(roles: list[str], texts: list[str], copies: list[int], pointers: bytes, entry: int, exit_: int) -> tuple[str, list[str]]:
    """The audit of a chunk and its repaired turns, from the pointers."""
    codes, s = [], exit_
    for k in range(len(roles) - 1, -1, -1):
        p = pointers[STATES * k + s]
        codes.append(p & 15)
        s = p >> 4
    audit, turns, at = [], [], entry
    for role, text, n, code in zip(roles, texts, copies, reversed(codes), strict=True):
        macro = CODES[code]
        audit.append(macro + "D" * (n - 1))
        for _ in range(len(macro) - 1):
            at = after(at)
            turns.append(f"{'user' if at == USER else 'assistant'}:")
        if macro[-1] == "K":
            at = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
            turns.append(f"{role}:{text}")
        elif macro[-1] == "R":
            at = after(at)
            turns.append(f"{'user' if at == USER else 'assistant'}:{text}")
    return "".join(audit), turns


class Chunk:
    """Turns of one conversation on their way into a row."""

    def __init__(self, conv: int | None, number: int, first: bool):
        self.conv, self.number, self.first, self.chars = conv, number, first, 0
        self.rows: list[tuple] = []

    def row(self) -> tuple:
        roles, texts, copies = [r[1] for r in self.rows], [r[2] for r in self.rows], [r[3] for r in self.rows]
        turns = [(r[1][:1], r[4], r[3]) for r in self.rows]
        bad = [0] * 4
        for _, f, n in turns:
            bad[f] += n if f == BLANK else 1
            bad[DUPLICATE] += 0 if f == BLANK else n - 1
        pairs = sum(a + b not in ("su", "ua", "au") for (a, *_), (b, *_) in zip(turns, turns[1:], strict=False)) + sum(n - 1 for *_, n in turns)
        solved = [solve(turns, e) if e == NOTHING or not self.first else ([NEVER] * STATES, [0] * STATES, b"") for e in range(STATES)]
        known = [r[0] for r in self.rows if r[0] is not None]
        return (self.conv, self.number, self.first, roles, texts, copies, [s[2] for s in solved], [c for s in solved for c in s[0]], [c for s in solved for c in s[1]], bad[BLANK], bad[DUPLICATE], bad[TRUNCATED], pairs, turns[0][0].ljust(1) + turns[-1][0].ljust(1), [known[0], known[-1], len(set(known))] if known else [])


def chunks(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Rows (conv_id, turn, role, text, n, fault) as solved chunks, settled."""
    limit = most or ROWS
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.int64()] * 4, pa.string(), pa.list_(pa.int64())]
    fields = [c.split()[0] for c in CHUNK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, c, out, chars = TaskContext.get().partitionId(), 0, None, [], 0
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], fields)
        for b in batches:
            for conv, *turn in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c is None or c.conv != conv or len(c.rows) >= limit or c.chars >= CHARS:
                    if c is not None:
                        out.append(c.row())
                        chars += c.chars
                    c, made = Chunk(conv, task << 32 | made, c is not None and c.conv != conv), made + 1
                    if len(out) >= 1000 or chars >= CHARS:
                        yield pack(out)
                        out, chars = [], 0
                c.rows.append(turn)
                c.chars += len(turn[2])
        if c is not None:
            yield pack([*out, c.row()])

    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.select(*order, "n", "fault").repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(dealt.mapInArrow(run, CHUNK), "conversation-chunks")


def by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")


def crossed(solved: DataFrame) -> DataFrame:
    """chunk, entry, exit, last, cost: the states in which the cheapest audit enters and leaves each chunk."""

    def choose(group: list[dict]) -> list[tuple]:
        cost, rank, back = [0 if s == NOTHING else NEVER for s in range(STATES)], [0] * STATES, []
        for r in group:
            best = [min(((cost[s] + r["costs"][STATES * s + t], rank[s], r["ranks"][STATES * s + t], s) for s in range(STATES) if cost[s] < NEVER and r["costs"][STATES * s + t] < NEVER), default=(NEVER, 0, 0, 0)) for t in range(STATES)]
            order = sorted(range(STATES), key=lambda t: best[t][1:3])
            cost, rank = [x[0] for x in best], [order.index(t) for t in range(STATES)]
            back.append(bytes(x[3] for x in best))
        end = min(range(STATES), key=lambda t: (cost[t] + COST_INSERT * tail(t), rank[t]))
        total, out = cost[end] + COST_INSERT * tail(end), []
        for k in range(len(group) - 1, -1, -1):
            entry = back[k][end]
            out.append((group[k]["chunk"], entry, end, k == len(group) - 1, total))
            end = entry
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for b in batches:
            out = []
            for r in b.to_pylist():
                if group and group[-1]["conv_id"] != r["conv_id"]:
                    out += choose(group)
                    group = []
                group.append(r)
            yield table(out)
        yield table(choose(group) if group else [])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()))], ["chunk", "entry", "exit", "last", "cost"])

    return by_conversation(solved.select("conv_id", "chunk", "costs", "ranks")).mapInArrow(run, "chunk long, entry int, exit int, last boolean, cost long")


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def assembled(found: DataFrame) -> DataFrame:
    """One row per conversation from its chunks in order."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                audit, turns = read_back(r["roles"], r["texts"], r["copies"], r["pointers"][r["entry"]], r["entry"], r["exit"])
                if r["last"]:
                    audit += "I" * tail(r["exit"])
                    turns += ["user:", "assistant:"][STATES - 2 - tail(r["exit"]) :] if tail(r["exit"]) else []
                rows.append((r["conv_id"], r["chunk"], audit, "\n".join(turns), bool(turns), r["cost"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["initials"], r["turns"]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), *[pa.int64()] * 5, pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], PART_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, out = None, None, []
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                if held is None or now != r["conv_id"]:
                    if held:
                        out.append((now, *held.values()))
                    now, held = r["conv_id"], Whole()
                held.add(r)
            yield table(out)
            out = []
        yield table([(now, *held.values())] if held else [])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate([*[pa.int64()] * 7, pa.string(), pa.string()])], [c.split()[0] for c in RESULT.split(", ")])

    read = found.mapInArrow(parts, "conv_id long, chunk long, audit string, repaired string, any boolean, cost long, blank long, duplicate long, truncated long, illegal long, initials string, turns array<long>")
    return by_conversation(read).mapInArrow(run, RESULT)


PART_FIELDS = ["conv_id", "chunk", "audit", "repaired", "any", "cost", "blank", "duplicate", "truncated", "illegal", "initials", "turns"]


class Whole:
    """A conversation put together chunk by chunk."""

    def __init__(self):
        self.sha, self.started, self.audit, self.cost = hashlib.sha256(), False, [], 0
        self.sums, self.last, self.lo, self.hi, self.distinct = [0] * 4, None, None, None, 0

    def add(self, r: dict) -> None:
        if r["any"]:
            self.sha.update(("\n" * self.started + r["repaired"]).encode("utf-8", "surrogatepass"))
            self.started = True
        self.audit.append(r["audit"])
        self.cost = r["cost"]
        self.sums = [a + r[k] for a, k in zip(self.sums, ("blank", "duplicate", "truncated", "illegal"), strict=True)]
        if self.last is not None and self.last + r["initials"][0] not in ("su", "ua", "au"):
            self.sums[3] += 1
        self.last = r["initials"][1]
        if r["turns"]:
            lo, hi, n = r["turns"]
            self.distinct += n - (self.hi == lo)
            self.lo, self.hi = lo if self.lo is None else self.lo, hi

    def values(self) -> tuple:
        gaps = self.hi - self.lo + 1 - self.distinct if self.hi is not None else 0
        return gaps, *self.sums, self.cost, "".join(self.audit), self.sha.hexdigest()


def repair(rows: DataFrame, conversations: DataFrame, most: int | None = None) -> DataFrame:
    """The cheapest repair of every conversation whose rows (conv_id, turn, role, text, n) are given; conversations
    (conv_id) without rows have an empty one."""
    solved = chunks(faults(rows), most)
    found = assembled(solved.drop("costs", "ranks", "first").join(crossed(solved), "chunk"))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("e")
    j = every.join(found.alias("f"), F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    numbers = [F.coalesce(f"f.{c}", F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return j.select("e.conv_id", *numbers, F.coalesce("f.audit", F.lit("")).alias("audit"), F.coalesce("f.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
